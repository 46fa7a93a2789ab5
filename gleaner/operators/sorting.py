"""Sort orders with explicit places for missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.columns import sort_key
from gleaner.functions.geo import geodist
from gleaner.spec import IndexSpec

BY_ID, BY_RELEVANCE, BY_RANDOM = "_id", "_relevance", "_random"


def random_key(seed: int | str, item: str = "item_id") -> Column:
    """Repeatable for one seed on any partitioning."""
    return F.md5(F.concat(F.col(item), F.lit(str(seed))))


def directed(column: Column, direction: str, missing_last: bool) -> Column:
    """Missing values: last both ways, or (numbers, dates) lowest of all."""
    if direction.lower() == "desc":
        return column.desc_nulls_last()
    return column.asc_nulls_last() if missing_last else column.asc_nulls_first()


def sort_columns(
    sorts: list[tuple[str, str]], spec: IndexSpec, seed: int | str = 0,
    points: dict[str, tuple[float, float]] | None = None,
) -> list[Column]:
    """Order columns of a request; ties always end on the item id."""
    out = []
    for name, direction in sorts:
        if name == BY_ID:
            out.append(directed(F.col("item_id"), direction, True))
        elif name == BY_RELEVANCE:
            out.append(directed(F.col("score"), direction, True))
        elif name == BY_RANDOM:
            out.append(random_key(seed).asc())
        elif points and name in points:
            lat, lon = points[name]
            place = F.col(name)
            out.append(directed(F.round(geodist(place["lat"], place["lon"], lat, lon), 6), direction, True))
        else:
            f = spec[name]
            if f.sort_column is None:
                continue  # places have no order of their own
            value = sort_key(F.col(f.first_column)) if f.is_text else F.col(f.sort_column)
            out.append(directed(value, direction, f.field_type.missing_last))
    return out + [F.col("item_id").asc()]
