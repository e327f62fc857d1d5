"""Approximate nearest neighbours on shifted Hilbert curves.

Equal vectors are one point.  For each curve a seeded rotation projects the
points to a few axes, a seeded shift moves the grid, and the cell's place on
the Hilbert curve is the key; all curves' keys are range-partitioned and
numbered in one pass.  A query meets the points within ``half`` places of its
own on every curve; each (curve, block of places) is one bounded task group
that scores its points against the queries that reach it.  The lists of all
blocks and curves merge and the nearest by exact distance stay.

``half`` is fitted, not guessed: the true neighbours of a bounded sample of
queries (``FIT_QUERIES``, scanned against all points) are looked up on the
curves, and the width that catches ``TARGET`` of them is used.  On vectors
with structure that is narrow; on vectors without any (the test tables are
random directions in 64 dimensions) it is a fixed share of the table, because
there no order has the neighbours close together.

Nearness is the Euclidean distance in double precision on the given vectors.

Defined cases: vectors that are null, zero, of another dimension than the most
common, or hold a null or non-finite component take no part; equal distances
go to the smaller id; copies of a vector are all candidates; rows repeated
with one id count once; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm.common import materialize, small_side, spread, table

ship_by_value(__name__)

CURVES = 8
AXES = 8
BITS = 7
FIT_QUERIES = 64
TARGET = 0.97
#: Points of a block, at most and at least; queries scored at once.
BLOCK = (256, 4096)
CHUNK = 512
SEED = 42


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (points x axes, below 2**bits) on the Hilbert curve."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns, from the coarsest bit on
        p = q - 1
        for i in range(n):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ t) >> b) & 1)
    return key


def _projection(dim: int, curve: int, seed: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """A curve's rotation and shift."""
    rng = np.random.default_rng([seed, curve])
    basis, _ = np.linalg.qr(rng.standard_normal((dim, min(axes, dim))))
    return basis, rng.random(basis.shape[1])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _keys(batches: Iterator[pa.RecordBatch], dim: int, curves: int, mean: np.ndarray, scale: float, seed: int) -> Iterator[pa.RecordBatch]:
    side = 1 << (BITS - 1)  # the shifted grid spans twice the points' range
    for batch in batches:
        x = _matrix(batch.column(1), dim) - mean
        for curve in range(curves):
            basis, shift = _projection(dim, curve, seed, AXES)
            cells = np.clip((x @ basis / scale + 4) / 8, 0, 1 - 1e-9) * side + shift * side
            key = hilbert(np.floor(cells).astype(np.int64), BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), curve, np.int32)), pa.array(key), *batch.columns],
                                             names=["curve", "key", "id", "v"])


def _moments(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([x.sum(0).tolist()]), pa.array([float((x * x).sum())])],
                                         names=["n", "s", "q"])


def nearest(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list, list]:
    """Per query its up to ``k`` nearest of ``x`` by (distance, id): query ids, ids, distances."""
    out: tuple[list, list, list] = ([], [], [])
    norms = (x * x).sum(1)
    for at in range(0, len(q), CHUNK):
        part = q[at:at + CHUNK]
        rough = norms[None] - 2 * part @ x.T + (part * part).sum(1)[:, None]
        cut = np.partition(rough, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        slip = 1e-9 * (norms.max() + (part * part).sum(1))
        for i, (row, limit) in enumerate(zip(rough, cut + slip)):
            near = np.flatnonzero(row <= limit)
            exact = np.sqrt(((x[near] - part[i]) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:k]
            out[0].extend([q_ids[at + i]] * len(best))
            out[1].extend(ids[near][best].tolist())
            out[2].extend(exact[best].tolist())
    return out


def _scan(batches: Iterator[pa.RecordBatch], dim: int, q: np.ndarray, q_ids: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = nearest(q, q_ids, _matrix(batch.column(1), dim), np.asarray(batch.column(0)), k)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                                             names=["q", "id", "d"])


def _block(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    if points.empty or queries.empty:
        return pd.DataFrame({"q": [], "id": [], "d": []}).astype({"q": "int64", "id": "int64", "d": "float64"})
    found = nearest(np.stack(queries["v"]).astype(np.float64), queries["id"].to_numpy(),
                    np.stack(points["v"]).astype(np.float64), points["id"].to_numpy(), k)
    return pd.DataFrame({"q": found[0], "id": found[1], "d": found[2]})


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull()).where(fine)
    size = rows.groupBy(F.size("v").alias("n")).count().agg(F.max_by("n", F.struct("count", "n")).alias("n"))
    return rows.where(F.size("v") == size.scalar())


def _numbered(keys: DataFrame, width: int) -> DataFrame:
    """``keys`` with ``place``, from 0 on each curve, in key order."""
    dealt = materialize(keys.repartitionByRange(width, "curve", "key", "id").withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(dealt.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("c")).withColumn(
        "at", F.coalesce(F.sum("c").over(order), F.lit(0))).drop("c"))
    inside = Window.partitionBy("curve", "part").orderBy("key", "id")
    return materialize(dealt.join(small_side(starts, 32), ["curve", "part"]).select(
        "curve", "id", "v", (F.col("at") + F.row_number().over(inside) - 1).alias("place")))


def _fit(points: DataFrame, queries: DataFrame, placed: DataFrame, dim: int, k: int) -> int:
    """The half width that catches ``TARGET`` of the sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(FIT_QUERIES).collect()  # bounded
    if not sample:
        return 1
    q, q_ids = np.array([r["v"] for r in sample]), np.array([r["id"] for r in sample])
    near = points.select("id", "v").mapInArrow(lambda it: _scan(it, dim, q, q_ids, k + 1), "q long, id long, d double").where("q != id")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    true = materialize(near.withColumn("r", rank).where(F.col("r") <= k).select("q", "id"))  # FIT_QUERIES x k rows
    at = placed.select("curve", "id", "place")
    there = at.join(F.broadcast(true), "id").join(F.broadcast(materialize(at.join(
        F.broadcast(true.select(F.col("q").alias("id")).distinct()), "id").select(
            F.col("id").alias("q"), "curve", F.col("place").alias("own")))), ["q", "curve"])
    gaps = there.groupBy("q", "id").agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap"))
    return int(gaps.agg(F.percentile("gap", F.lit(TARGET)).alias("g")).first()["g"] or 1) + 1


def search(vectors: DataFrame, is_query: F.Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           curves: int = CURVES, seed: int = SEED, half: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the up to ``k``
    nearest found for the rows where ``is_query`` (over column ``id``) holds."""
    rows = materialize(usable(vectors, key, vector).dropDuplicates(["id"]).withColumn("h", F.xxhash64("v")))
    first = rows.select("v").first()
    if first is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = len(first["v"])
    points = materialize(rows.groupBy("h").agg(F.min_by("v", "id").alias("v"), F.min("id").alias("id"), F.count(F.lit(1)).alias("c")))
    n = points.count()
    of = materialize(rows.where(is_query).select(F.col("id").alias("q"), "h").join(points.select("h", "id"), "h").drop("h"))
    queries = points.select("id", "v").join(of.select("id").distinct(), "id", "left_semi")
    sums = points.select("v").mapInArrow(lambda it: _moments(it, dim), "n long, s array<double>, q double").agg(
        F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s"), F.sum("q").alias("q")).first()
    mean = np.array(sums["s"]) / n
    scale = max(float(np.sqrt(max(sums["q"] / n - (mean ** 2).sum(), 0) / dim)), 1e-12)
    keys = points.select("id", "v").mapInArrow(lambda it: _keys(it, dim, curves, mean, scale, seed),
                                               "curve int, key long, id long, v array<double>")
    placed = _numbered(keys, spread(n * curves, 20_000, rows))
    half = half or _fit(points, queries, placed, dim, k)
    size = min(max(half // 2, BLOCK[0]), BLOCK[1])
    blocks = placed.select("curve", F.expr(f"place div {size}").alias("block"), "id", "v")
    asked = placed.join(of.select("id").distinct(), "id", "left_semi").select("curve", "id", "v", F.explode(F.sequence(
        F.expr(f"greatest(0, place - {half}) div {size}"), F.expr(f"least({n - 1}, place + {half}) div {size}"))).alias("block"))
    asked = asked.toDF("at_curve", "id", "v", "at_block")
    found = blocks.groupBy("curve", "block").cogroup(asked.groupBy("at_curve", "at_block")).applyInPandas(
        lambda a, b: _block(a, b, k + 1), "q long, id long, d double")
    best = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    merged = materialize(found.groupBy("q", "id").agg(F.min("d").alias("d")).withColumn("r", best).where(F.col("r") <= k + 1).drop("r"))
    return _expanded(merged, of, rows, points, k)


def _expanded(merged: DataFrame, of: DataFrame, rows: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Points become the ids that share them (the ``k + 1`` smallest are enough)."""
    many = materialize(points.where("c > 1").select("h", F.col("id").alias("point"), "c"))
    copies = rows.select("h", "id").join(small_side(many, 32), "h")
    salted = Window.partitionBy("h", F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / 4096).cast("long"))).orderBy("id")
    fewer = copies.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
    least = fewer.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where(F.col("r") <= k + 1)
    members = least.groupBy("point").agg(F.collect_list("id").alias("ids"))  # k + 1 at most
    lists = of.withColumnsRenamed({"id": "p"}).join(merged.withColumnRenamed("q", "p"), "p")
    each = lists.join(members.withColumnRenamed("point", "id"), "id", "left").select(
        "q", "d", F.explode(F.coalesce("ids", F.array("id"))).alias("vec_id")).where("q != vec_id")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("q").alias("query_id"), "rank", "vec_id", F.col("d").alias("score"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {"op3_neighbours": op3_neighbours}
ORACLES: dict[str, str] = {}
