"""Small Column helpers shared by the rest of the package."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` by name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def any_of(flags: Iterable[Column]) -> Column:
    out = None
    for flag in flags:
        out = flag if out is None else out | flag
    return F.lit(False) if out is None else out


def all_of(flags: Iterable[Column]) -> Column:
    out = None
    for flag in flags:
        out = flag if out is None else out & flag
    return F.lit(True) if out is None else out


def total(values: Iterable[Column]) -> Column:
    out = None
    for value in values:
        out = value if out is None else out + value
    return F.lit(0.0) if out is None else out


def largest(values: list[Column]) -> Column:
    return values[0] if len(values) == 1 else F.greatest(*values)


def is_array(df, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "array"


def string_array(values: Iterable[str]) -> Column:
    values = list(values)
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def compute_once(df, columns: dict[str, Column]):
    """Add columns that later steps read but do not recompute.

    Catalyst merges projections and moves filters below them by repeating their
    expressions.  For expressions that walk a whole text, and for scalar
    subqueries, this would multiply the work, so they are produced by a one-row
    generator, which nothing is inlined across.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def sort_key(value: Column) -> Column:
    """Case-insensitive sort companion of a string."""
    return F.trim(F.lower(value))
