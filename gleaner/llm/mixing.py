"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Sizes are words `[^\\x20\\x09-\\x0D]+`. Every source asks for its share, by weight, of all words. A target
stops at `epochs` times its source's size; what is above goes to the other sources by weight until nothing
is above. Sorted by cap / weight that is one running sum: the level at which the first source stays below its cap is
the level of all that do.

A document is taken floor(target / source size) whole times. The rest of the target is one more repetition
of documents in a seeded order (md5 of seed and key): whole ones, and the first words of the one at which the
target is reached. The order is found in two steps, so that no source meets in one task: sums by source and
bucket of the hash, then a running sum inside the one bucket in which the target ends. There are more buckets
where there are more rows, so that this one bucket stays small.

Definitions. Null text has size 0. Sources are in code point order, null last, and take the weights in turn.
A source without words has target 0. Rows with equal keys and texts are rows like any other; which of two
rows equal in key and size comes first doesn't change the result. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm._frame import settle, table, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
#: Buckets of a source are at least 2^BUCKET_BITS, and so many that one has about EDGE_ROWS rows at most.
BUCKET_BITS, HASH_BITS, EDGE_ROWS = 10, 52, 20_000
#: Rows of the table of sources that may go to all tasks; a larger one is joined by shuffle.
BROADCAST_ROWS = 50_000


def place(key: str, seed: str) -> Column:
    """52 seeded bits of the key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")


def bucket_bits(rows: int) -> int:
    return min(max(BUCKET_BITS, (rows // EDGE_ROWS).bit_length()), HASH_BITS)


def targets(sizes: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row a source."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn % len(weights) + 1).cast("int"))
    caps = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    levels = caps.select(
        "*",
        ((F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(so_far), F.lit(0)))
         / F.sum("weight").over(from_here)).alias("level"),
    )
    # Levels rise until the right one and fall after it, so the right one is the highest that its cap allows.
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    levels = levels.withColumn("water", F.max(F.when(fits, F.col("level"))).over(Window.partitionBy()))
    target = F.least(F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of `docs` with what the mix takes of each.

    The second value names the new columns, by `size`, `source_size`, `target`, `whole` (repetitions) and
    `part` (words of one more repetition: 0, some, or all).
    """
    names: dict[str, str] = {}
    for name in ("size", "source_size", "target", "whole", "part"):
        names[name] = unused(docs, name)
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    bits = bucket_bits(docs.count())
    bucket = F.shiftright(place(key, seed), HASH_BITS - bits)
    sums = settle(docs.select(F.col(source).alias("source"), bucket.alias("bucket"), size.alias("size")).groupBy("source", "bucket").agg(F.sum("size").alias("n")))
    goals = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, epochs)
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = goals.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")
    ends = sums.select("source", "bucket", before.alias("before"), "n").where("n > 0").alias("s").join(goals.alias("g"), F.expr("s.source <=> g.source"))
    ends = ends.where("before <= rest and rest < before + n").select(F.col("s.source").alias("source"), F.col("bucket").alias("edge"), "before")
    plan = settle(
        goals.alias("g").join(ends.alias("e"), F.expr("g.source <=> e.source"), "left")
        .select(F.col("g.source").alias("of"), "source_size", "target", "whole", "rest", F.coalesce("edge", F.lit(1 << bits)).alias("edge"), F.coalesce("before", F.lit(0)).alias("before"))
    )
    if plan.count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    goal = unused(docs, "goal")
    joined = docs.join(plan.select(F.col("of").alias(goal + "_of"), F.struct("source_size", "target", "whole", "rest", "edge", "before").alias(goal)), F.col(source).eqNullSafe(F.col(goal + "_of"))).drop(goal + "_of")

    def with_part(rows: DataFrame, part: Column) -> DataFrame:
        return rows.select(
            *docs.columns, F.col(names["size"]),
            F.col(goal + ".source_size").alias(names["source_size"]), F.col(goal + ".target").alias(names["target"]),
            F.col(goal + ".whole").alias(names["whole"]), part.alias(names["part"]),
        )

    clear = joined.where(bucket != F.col(goal + ".edge")).withColumn(names["size"], size)
    clear = with_part(clear, F.when(bucket < F.col(goal + ".edge"), F.col(names["size"])).otherwise(F.lit(0).cast("long")))
    edge = joined.where(bucket == F.col(goal + ".edge")).withColumn(names["size"], size)
    order = Window.partitionBy(source).orderBy(place(key, seed), key, names["size"]).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col(goal + ".rest") - F.col(goal + ".before") - F.coalesce(F.sum(names["size"]).over(order), F.lit(0))
    edge = with_part(edge, F.least(F.col(names["size"]), F.greatest(F.lit(0).cast("long"), left)))
    return clear.unionByName(edge), names


def repeated(docs: DataFrame, *, text: str = "text", length: str | None = "n_chars", **options) -> DataFrame:
    """The mixed rows: each as often as the mix takes it, the part of a row with that many of its words.

    All columns of `docs` and no other; a column named `length` gets the characters of a shortened text. The words
    of a shortened text are joined by single blanks.
    """
    found, names = mix(docs, text=text, **options)
    turn = unused(docs, "turn")
    whole, part, size = (F.col(names[n]) for n in ("whole", "part", "size"))
    turns = found.withColumn(turn, F.explode(F.filter(F.sequence(F.lit(0).cast("long"), whole), lambda k: (k > 0) | (part > 0))))
    cut = (F.col(turn) == 0) & (part < size)
    words = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.lit(1), part.cast("int")), " ")
    out = turns.withColumn(text, F.when(cut, words).otherwise(F.col(text)))
    if length in docs.columns:
        out = out.withColumn(length, F.when(cut, F.char_length(text)).otherwise(F.col(length)).cast(docs.schema[length].dataType))
    return out.select(docs.columns)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    found, names = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = F.col(names["whole"]) * F.col(names["size"]) + F.col(names["part"])
    return found.select("doc_id", F.col(names["size"]).alias("size"), F.col(names["source_size"]).alias("source_size"), F.col(names["target"]).alias("target"), taken.alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w),
g AS (
  SELECT *, least(coalesce((SELECT max(level) FROM l WHERE level * weight <= 3 * source_size) * weight, 3 * source_size), 3 * source_size)::DOUBLE AS target FROM l),
h AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM g),
r AS (
  SELECT doc_id, size, source_size, target, whole, round(target - whole * source_size)::BIGINT AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, size, source_size, target, (whole * size + least(size, greatest(0, rest - before)))::BIGINT AS taken FROM r
"""
