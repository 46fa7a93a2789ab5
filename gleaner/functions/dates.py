"""Date literals and date math."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit names of the date math syntax.
UNITS = ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND")
_ALIASES = {"DATE": "DAY", "MILLI": "MILLISECOND"}
_STEP = re.compile(r"(/|[+-]\d+)([A-Z]+?)S?(?=$|[/+-])")


def date_math(ts: Column, expression: str) -> Column:
    """Apply ``/DAY+6MONTHS+3DAYS`` style steps, left to right, to a timestamp."""
    rest = expression.removeprefix("NOW")
    done = 0
    for step in _STEP.finditer(rest):
        if step.start() != done:
            break
        done = step.end()
        unit = _ALIASES.get(step.group(2), step.group(2))
        if unit not in UNITS:
            raise ValueError(f"unknown date unit {step.group(2)!r} in {expression!r}")
        if step.group(1) == "/":
            ts = F.date_trunc(unit.lower(), ts)
        else:
            ts = ts + F.expr(_interval(int(step.group(1)), unit))
    if done != len(rest):
        raise ValueError(f"bad date math {expression!r}")
    return ts


def _interval(amount: int, unit: str) -> str:
    if unit == "MILLISECOND":
        return f"make_dt_interval(0, 0, 0, {amount / 1000:.3f})"
    if unit in ("YEAR", "MONTH"):
        return f"make_ym_interval({amount if unit == 'YEAR' else 0}, {amount if unit == 'MONTH' else 0})"
    slots = ", ".join(str(amount) if unit == u else "0" for u in ("DAY", "HOUR", "MINUTE", "SECOND"))
    return f"make_dt_interval({slots})"


def to_epoch(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp (of the first value of an array)."""
    return F.unix_timestamp(ts)


def date_literal(value) -> dt.datetime:
    """Epoch number or text -> UTC datetime, cut to the second."""
    if isinstance(value, dt.datetime):
        value = value.astimezone(dt.timezone.utc) if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
        return value.replace(microsecond=0)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day, tzinfo=dt.timezone.utc)
    text = str(value).strip()
    if re.fullmatch(r"[+-]?\d+(\.\d+)?", text):
        return dt.datetime.fromtimestamp(int(float(text)), dt.timezone.utc)
    try:
        return date_literal(dt.datetime.fromisoformat(text.replace("Z", "+00:00")))
    except ValueError:
        raise ValueError(f"bad date literal {value!r}") from None
