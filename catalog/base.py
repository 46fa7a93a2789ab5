"""Registry and the indexes the queries run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import FieldSpec, IndexSpec, SearchIndex
from gleaner.streaming.ingest import read_changes

#: Tasks that the documents are spread over before their texts are analyzed; None leaves Spark's own split.
PARTITIONS: int | None = None
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def table_changes(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of files (a pattern matches both)."""
    return read_changes(spark, f"{sf}/{name}.parque[t]", table(spark, sf, name).schema)


DOCUMENTS = IndexSpec(
    "documents", "doc_id",
    (
        FieldSpec("text", "text_ws"), FieldSpec("lang"), FieldSpec("source"),
        FieldSpec("n_chars", "integer"), FieldSpec("quality", "integer"), FieldSpec("toxic", "boolean"),
    ),
)
PARTS = IndexSpec(
    "parts", "p_partkey",
    (
        FieldSpec("name", "text_ws", source="p_name", boost=5.0),
        FieldSpec("kind_text", "text_ws", source="p_type"),
        FieldSpec("words", "string", source="split(p_name, ' ')", multi=True),
        FieldSpec("codes", "integer", source="array(p_size, p_partkey % 50)", multi=True),
        FieldSpec("brand", source="p_brand"), FieldSpec("kind", source="p_type"),
        FieldSpec("size", "integer", source="p_size"), FieldSpec("price", "decimal", source="p_retailprice"),
    ),
)
ORDERS = IndexSpec(
    "orders", "o_orderkey",
    (
        FieldSpec("status", source="o_orderstatus"), FieldSpec("priority", source="o_orderpriority"),
        FieldSpec("ordered", "date", source="o_orderdate"), FieldSpec("price", "decimal", source="o_totalprice"),
        FieldSpec("customer", "integer", source="o_custkey"),
    ),
)
PLACES = IndexSpec(
    "customers", "c_custkey",
    (
        FieldSpec("name", source="c_name"), FieldSpec("segment", source="c_mktsegment"),
        FieldSpec("balance", "decimal", source="c_acctbal"),
        FieldSpec(
            "place", "location",
            source="named_struct('lat', cast(c_custkey * 37 % 16000 as double) / 100 - 80,"
            " 'lon', cast(c_custkey * 91 % 36000 as double) / 100 - 180)",
        ),
    ),
)


def documents(spark: SparkSession, sf: str, spec: IndexSpec = DOCUMENTS) -> SearchIndex:
    """Documents with their labels; labels are missing for most of them."""
    rows = table(spark, sf, "documents")
    if any(f.name in ("quality", "toxic") for f in spec.fields):
        rows = rows.join(table(spark, sf, "labels"), "doc_id", "left")
    return SearchIndex.build(rows, spec, partitions=PARTITIONS)


def unlabelled(*fields: FieldSpec, name: str = "documents") -> IndexSpec:
    return IndexSpec(name, "doc_id", (*fields, FieldSpec("lang"), FieldSpec("source"), FieldSpec("n_chars", "integer")))


TEXT = unlabelled(FieldSpec("text", "text_ws"))
NORMED = unlabelled(FieldSpec("text", "text_ws", norms=True))


def parts(spark: SparkSession, sf: str) -> SearchIndex:
    return SearchIndex.build(table(spark, sf, "part"), PARTS)


def orders(spark: SparkSession, sf: str) -> SearchIndex:
    return SearchIndex.build(table(spark, sf, "orders"), ORDERS)


def places(spark: SparkSession, sf: str) -> SearchIndex:
    return SearchIndex.build(table(spark, sf, "customer"), PLACES)


def ids(df: DataFrame) -> DataFrame:
    return df.select("item_id")


# SQL pieces --------------------------------------------------------------
TOK = r"""tok AS (SELECT doc_id, lang, n_chars, term FROM (
  SELECT doc_id, lang, n_chars, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents) WHERE term <> '')"""
POS = r"""pos AS (SELECT doc_id, lang, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS p FROM (
  SELECT doc_id, lang, list_filter(string_split_regex(lower(text), '\s+'), lambda t: t <> '') AS l FROM documents))"""
PLACE = """place AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
  CAST(c_custkey * 37 % 16000 AS DOUBLE) / 100 - 80 AS lat, CAST(c_custkey * 91 % 36000 AS DOUBLE) / 100 - 180 AS lon
  FROM customer)"""


def km(lat: float, lon: float) -> str:
    return (
        f"2 * 6371.0087714 * asin(sqrt(least(1.0, pow(sin(radians(lat - ({lat})) / 2), 2)"
        f" + cos(radians(lat)) * cos(radians({lat})) * pow(sin(radians(lon - ({lon})) / 2), 2))))"
    )


def doc_flags(*terms: str, having: str, extra: str = "") -> str:
    flags = ", ".join(f"count(*) FILTER (term = '{t}') > 0 AS k{i}" for i, t in enumerate(terms))
    return (
        f"WITH {TOK}, f AS (SELECT doc_id, {flags} FROM tok GROUP BY doc_id)"
        f" SELECT CAST(d.doc_id AS VARCHAR) AS item_id FROM documents d LEFT JOIN f USING (doc_id)"
        f" WHERE {having}{extra}"
    )


__all__ = [n for n in dir() if not n.startswith("_")] + ["F"]
