"""Pairs of near-equal embeddings by a subspace pigeonhole join.

Vectors are scaled to length 1 and rotated (one seeded orthogonal matrix for each number of dimensions), then
split into BLOCKS blocks. Two vectors at cosine c are at squared distance 2 - 2c; in at least one block they
are then within that block's share of it, in proportion to its dimensions. Each block is joined by itself:
its first two coordinates give a grid cell as wide as the block's reach, so partners lie in the same or a
neighbouring cell, and each cell is cut into tiles of about TILE vectors, so that a dense cell is many rows of
the join. Tiles that meet are compared as matrices: candidates are pairs within the block's share, and each
is verified at once with its whole vectors in double precision, in the first block that has it and no other.

Equal vectors are one node with a count. A tile pair returns one row for each vector that has a link in it:
the number of links and the smallest vector it reaches there. Nothing lists all pairs of a dense group.

Definitions. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
neither do vectors with different numbers of dimensions. A row without a key links with nothing and has a
null component. Rows with one key and different vectors are one node; equal rows count once. Very large and
very small components count like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm._frame import settle, table
from gleaner.llm.graph import components

COSINE, BLOCKS, TILE, SEED = 0.9, 4, 1024, 11
#: Slack for rounding: of the shares, and of the single-precision filter that comes before the exact test.
SLACK, FILTER_SLACK = 1e-9, 1e-4

_rotations: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    if size not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
        _rotations[size] = q * np.sign(np.diag(r))
    return _rotations[size]


def split(size: int, blocks: int) -> list[slice]:
    edges = [size * b // blocks for b in range(blocks + 1)]
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]


def share(part: slice, size: int, cosine: float) -> float:
    return (2 - 2 * cosine) * (part.stop - part.start) / size + SLACK


def rotated(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1)[:, None]) @ rotation(vectors.shape[1])


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """One vector a row, each times the power of two that brings its largest component below 1: no square can
    overflow or vanish then, and other digits don't change."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0.0))[1][:, None])


def cells(nodes: DataFrame, cosine: float, blocks: int) -> DataFrame:
    """For each block of each vector (id, n, v, size): the block's number and the cell of its first two coordinates."""
    kind = nodes.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                turned = rotated(matrix(some.column("v"), size))
                for number, part in enumerate(split(int(size), blocks)):
                    width = np.sqrt(share(part, size, cosine)) + 1e-6
                    cell = np.floor(turned[:, part][:, :2] / width).astype(np.int32)
                    if cell.shape[1] == 1:
                        cell = np.hstack([cell, np.zeros_like(cell)])
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(np.full(len(cell), number, np.int32)), pa.array(cell[:, 0]), pa.array(cell[:, 1])],
                        names=[*some.schema.names, "block", "x", "y"],
                    )

    return nodes.mapInArrow(run, f"id {kind}, n long, v array<double>, size int, block int, x int, y int")


def tiles(placed: DataFrame) -> DataFrame:
    """Rows of about TILE vectors: (size, block, x, y, tile, ids, ns, vs)."""
    cell = ["size", "block", "x", "y"]
    counts = placed.groupBy(*cell).agg(F.count("*").alias("in_cell"))
    number = F.pmod(F.xxhash64("id"), F.ceil(F.col("in_cell") / TILE).cast("long"))
    rows = placed.join(counts, cell).withColumn("tile", number)
    packed = rows.groupBy(*cell, "tile").agg(F.collect_list(F.struct("id", "n", "v")).alias("rows"))
    return packed.select(*cell, "tile", *[F.col(f"rows.{c}").alias(f"{c}s") for c in ("id", "n", "v")])


def smallest_reached(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of `count` nodes the smallest one that it reaches by the links a - b."""
    low = np.arange(count)
    while True:
        new = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, low, new)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def links_between(one: np.ndarray, two: np.ndarray | None, part: slice, earlier: list[slice], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs of two tiles (of one with itself if `two` is None) that this block is to find."""
    size = one.shape[1]
    turned = rotated(one)
    other, other_turned = (one, turned) if two is None else (two, rotated(two))
    limit = share(part, size, cosine)
    x, y = turned[:, part].astype(np.float32), other_turned[:, part].astype(np.float32)
    reach = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    near = reach <= np.float32(limit + FILTER_SLACK)
    if two is None:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    found_i, found_j = [], []
    for at in range(0, len(i), 100_000):
        a, b = i[at : at + 100_000], j[at : at + 100_000]
        gap = (turned[a] - other_turned[b]) ** 2
        mine = gap[:, part].sum(axis=1) <= limit
        for before in earlier:
            mine &= gap[:, before].sum(axis=1) > share(before, size, cosine)
        a, b = a[mine], b[mine]
        u, v = one[a], other[b]
        close = (u * v).sum(axis=1) / (np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1)) >= cosine
        found_i.append(a[close])
        found_j.append(b[close])
    return np.concatenate([*found_i, np.zeros(0, int)]), np.concatenate([*found_j, np.zeros(0, int)])


def compare(pairs: DataFrame, cosine: float, blocks: int, kind: str) -> DataFrame:
    """(a, b, links): for each vector with links in a tile pair, the smallest it reaches there and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                size = row["size"].as_py()
                parts = split(size, blocks)
                number = row["block"].as_py()
                ids, ns = row["ids"].values, row["ns"].values.to_numpy(zero_copy_only=False)
                one, two = matrix(row["vs"].values, size), None
                if row["other_ids"].is_valid:
                    two = matrix(row["other_vs"].values, size)
                i, j = links_between(one, two, parts[number], parts[:number], cosine)
                if not len(i):
                    continue
                if two is not None:
                    j = j + len(ids)
                    ids, ns = pa.concat_arrays([ids, row["other_ids"].values]), np.concatenate([ns, row["other_ns"].values.to_numpy(zero_copy_only=False)])
                links = np.bincount(i, weights=ns[j], minlength=len(ns)) + np.bincount(j, weights=ns[i], minlength=len(ns))
                order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
                rank = np.empty(len(order), dtype=np.int64)
                rank[order] = np.arange(len(order))
                low = smallest_reached(len(order), rank[i], rank[j])
                some = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(some)), ids.take(pa.array(order[low[rank[some]]])), pa.array(links[some].astype(np.int64))], names=["a", "b", "links"]
                )

    return pairs.mapInArrow(run, f"a {kind}, b {kind}, links long")


def near_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """(key, n_links, component) for each row of `vectors`."""
    v = F.col("v")
    number = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).alias("id"), number.alias("v"))
    kind = rows.schema["id"].dataType.simpleString()
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = rows.where("id is not null").where(good).distinct()
    members = settle(usable.join(usable.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "v"))
    nodes = members.where("id = rep").select("id", "n", "v", F.size("v").alias("size"))
    tiled = settle(tiles(cells(nodes, cosine, blocks)))
    # A cell meets itself and half of its neighbours; the other half meets it.
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    visits = tiled.withColumn("step", F.explode(steps)).select(
        "size", "block", (F.col("x") - F.col("step.dx")).alias("x"), (F.col("y") - F.col("step.dy")).alias("y"),
        ((F.col("step.dx") == 0) & (F.col("step.dy") == 0)).alias("same"), F.col("tile").alias("other"),
        *[F.col(c).alias("other_" + c) for c in ("ids", "ns", "vs")],
    )
    met = tiled.join(visits, ["size", "block", "x", "y"]).where("not same or tile <= other")
    itself = F.col("same") & (F.col("tile") == F.col("other"))
    met = met.select("size", "block", "ids", "ns", "vs", *[F.when(~itself, F.col("other_" + c)).alias("other_" + c) for c in ("ids", "ns", "vs")])
    found = settle(compare(met, cosine, blocks, kind))
    edges = found.select("a", "b").union(members.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    counted = members.join(links, "rep", "left").groupBy("id").agg(F.max(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    out = rows.select("id").join(counted, "id", "left").join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"))


def op8_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    found = near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"))
