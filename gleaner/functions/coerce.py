"""Write-time coercion of raw text values to field types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.spec import TYPES

NUMBER_PREFIX = r"^\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMERIC = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def to_boolean(raw: Column) -> Column:
    """Truthiness: every value but the empty text and ``0`` is true."""
    return ~raw.isin("", "0")


def to_decimal(raw: Column) -> Column:
    """The leading number of the text, 0 where there is none."""
    return F.coalesce(F.regexp_extract(raw, NUMBER_PREFIX, 1).try_cast("double"), F.lit(0.0))


def to_integer(raw: Column) -> Column:
    """The leading number cut to a whole one; whole texts keep all 64 bits."""
    return F.coalesce(raw.try_cast("bigint"), to_decimal(raw).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_date(raw: Column) -> Column:
    """Epoch seconds or date text -> UTC second; null for a bad date."""
    seconds = to_integer(raw)
    # years 1 to 9999; other epochs are bad dates
    epoch = F.when(raw.rlike(NUMERIC) & seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds))
    return F.coalesce(epoch, F.date_trunc("second", F.try_to_timestamp(raw)))


def to_point(raw: Column) -> Column:
    """``lat,lon`` -> a place; null for anything else."""
    lat, lon = (F.get(F.split(raw, ","), F.lit(k)).try_cast("double") for k in (0, 1))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


#: By the Spark type of a logical type; other types stay text.
COERCIONS = {
    "boolean": to_boolean, "timestamp": to_date, "bigint": to_integer, "int": lambda v: to_integer(v).try_cast("int"),
    "double": to_decimal, "float": lambda v: to_decimal(v).cast("float"), "struct<lat:double,lon:double>": to_point,
}


def spark_name(type_name: str) -> str:
    return TYPES[type_name].spark_type.simpleString()


def coerce_values(raw: Column, type_name: str) -> Column:
    """Coerce an ``array<string>``.  A bad date ends the list: later values are not kept."""
    kind = spark_name(type_name)
    if kind not in COERCIONS:
        return raw
    values = F.transform(raw, lambda v: COERCIONS[kind](v))
    if kind != "timestamp":
        return values
    bad = F.array_position(F.transform(values, lambda v: v.isNull()), F.lit(True))
    return F.when(bad > 0, F.slice(values, F.lit(1), (bad - 1).cast("int"))).otherwise(values)


def first_value(raw: Column, type_name: str) -> Column:
    """First coerced value; null for dates as soon as one value of the field is bad."""
    values = coerce_values(raw, type_name)
    first = F.get(values, F.lit(0))
    if spark_name(type_name) != "timestamp":
        return first
    return F.when(F.size(values) == F.size(raw), first)
