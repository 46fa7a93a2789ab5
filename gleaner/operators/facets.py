"""Facets: documents per value over the result, all facets in one pass.

Every row is expanded to (facet, value) pairs with a flag that says whether the
row counts for that facet; one grouped sum serves all facets.  The sum is partial
per task, so a value held by a third of all rows costs one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import all_of
from gleaner.operators.grouping import top_n
from gleaner.operators.spatial import Spatial
from gleaner.sources.index import value_array, with_words
from gleaner.spec import IndexSpec

DEFAULT_LIMIT = 10
DEFAULT_STEPS = 5
DEFAULT_REACH = 100.0
MISSING = "!"


@dataclass(frozen=True)
class Facet:
    field: str
    limit: int = DEFAULT_LIMIT  # 0: all values
    min_count: int = 1  # 0: also values of the index without a hit
    missing: bool = False
    operator: str = "and"  # or: ignore the filter tagged facet:<field>
    prefix: str | None = None
    name: str | None = None

    @property
    def key(self) -> str:
        return self.name or self.field

    @property
    def tag(self) -> str:
        return f"facet:{self.field}"


def label(value: Column, type_name: str) -> Column:
    """Quoted value; booleans as 1 and 0, dates as epoch seconds."""
    if type_name == "boolean":
        value = F.when(value, F.lit("1")).otherwise(F.lit("0"))
    elif type_name.startswith("date"):
        value = F.unix_timestamp(value).cast("string")
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _labels(facet: Facet, docs: DataFrame, spec: IndexSpec) -> Column:
    f = spec[facet.field]
    if f.is_text:
        values = F.col(f"_facet_{f.name}")
    else:
        values = value_array(docs, f.name)
    if facet.prefix:
        values = F.filter(values, lambda v: v.cast("string").startswith(facet.prefix))
    labels = F.transform(values, lambda v: label(v, f.type))
    if facet.missing:
        labels = F.when(F.size(labels) == 0, F.array(F.lit(MISSING))).otherwise(labels)
    return labels


def facet_counts(
    docs: DataFrame, facets: list[Facet], spec: IndexSpec, masks: dict[str, Column] | None = None,
    group: str | None = None,
) -> DataFrame:
    """``(facet, value, count)``.

    ``masks`` maps filter tags (and ``None`` for everything else) to flags; a row
    counts for a facet when all masks hold, save the facet's own tag if it is an
    OR facet.  With ``group`` distinct groups are counted instead of documents.
    """
    masks = masks or {}
    text = list(dict.fromkeys(f.field for f in facets if spec[f.field].is_text))
    if text:
        docs = with_words(docs, spec, text, "_facet_", distinct=True)
    pairs = []
    for facet in facets:
        holds = all_of(
            m for tag, m in masks.items() if not (facet.operator == "or" and tag == facet.tag)
        )
        counted = F.coalesce(holds, F.lit(False))
        labels = _labels(facet, docs, spec)
        if facet.min_count > 0:
            labels = F.when(counted, labels).otherwise(F.array().cast("array<string>"))
        pairs.append(
            F.transform(
                labels,
                lambda v: F.struct(
                    F.lit(facet.key).alias("facet"), v.alias("value"), counted.alias("hit")
                ),
            )
        )
    rows = docs.select(*([group] if group else []), F.inline(F.concat(*pairs)))
    if group:
        # distinct (facet, value, group) first: spreads hot values over groups
        rows = rows.groupBy("facet", "value", F.struct(group).alias("_g")).agg(F.max("hit").alias("hit"))
    counts = rows.groupBy("facet", "value").agg(F.count_if("hit").alias("count"))
    counts = _with_empty_bucket(counts, facets)
    kept = None
    for facet in facets:
        test = (F.col("facet") == facet.key) & (F.col("count") >= facet.min_count)
        kept = test if kept is None else kept | test
    return _limited(counts.where(kept), facets)


def stored_facets(frequencies: DataFrame, facets: list[Facet]) -> DataFrame:
    """Facets of text fields over a whole stored index, from its (field, term, df); no document is read."""
    out = None
    for facet in facets:
        own = frequencies.where(F.col("field") == facet.field)
        if facet.prefix:
            own = own.where(F.col("term").startswith(facet.prefix))
        one = own.select(F.lit(facet.key).alias("facet"), label(F.col("term"), "text").alias("value"), F.col("df").alias("count"))
        one = one.where(F.col("count") >= facet.min_count)
        out = one if out is None else out.unionByName(one)
    return _limited(out, facets)


def _with_empty_bucket(counts: DataFrame, facets: list[Facet]) -> DataFrame:
    """A facet that lists values without hits also lists an empty missing bucket."""
    names = [f.key for f in facets if f.missing and f.min_count == 0]
    if not names:
        return counts
    spark = counts.sparkSession
    empty = spark.sql("SELECT 1").select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("facet"),
        F.lit(MISSING).alias("value"), F.lit(0).cast("bigint").alias("count"),
    )
    return counts.unionByName(empty).groupBy("facet", "value").agg(F.sum("count").alias("count"))


def _limited(counts: DataFrame, facets: list[Facet]) -> DataFrame:
    order = [F.col("count").desc(), F.col("value").asc()]
    by_limit: dict[int, list[str]] = {}
    for f in facets:
        by_limit.setdefault(f.limit, []).append(f.key)
    parts = []
    for limit, names in by_limit.items():
        part = counts.where(F.col("facet").isin(*names)) if len(by_limit) > 1 else counts
        parts.append(top_n(part, ["facet"], order, limit).drop("rank") if limit else part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distance_facet(docs: DataFrame, facet: Facet, spatial: Spatial, mask: Column) -> DataFrame:
    """Cumulative counts at even steps up to the radius, widest first."""
    steps = facet.limit if facet.limit > 0 else DEFAULT_STEPS
    step = (spatial.radius if spatial.radius is not None else DEFAULT_REACH) / steps
    reaches = [step * k for k in range(steps - 1, 0, -1)]
    distance = spatial.distance
    one = docs.select(distance.alias("_d"), F.coalesce(mask, F.lit(False)).alias("_m")).agg(
        *[F.count_if(F.col("_m") & (F.col("_d") <= r)).alias(f"c{i}") for i, r in enumerate(reaches)]
    )
    entries = F.array(*[
        F.struct(
            F.lit(facet.key).alias("facet"), F.lit(f"[* {_number(r)}]").alias("value"),
            F.col(f"c{i}").alias("count"),
        )
        for i, r in enumerate(reaches)
    ])
    return one.select(F.inline(entries)).where(F.col("count") >= facet.min_count)


def _number(value: float) -> str:
    return str(int(value)) if value == int(value) else f"{value:.14g}"
