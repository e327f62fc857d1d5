"""Recommendation against a catalogue that no broadcast may hold.

The catalogue is written once in tiles of at most ``broadcast_max_bytes``, and
each tile is broadcast.  A task collects a buffer of whole queries, ``BUFFER_ROWS``
rows at most and one query at least, and meets the tiles one after the other, holding one
at a time; so a tile is loaded once a buffer, sums and best items stay in
the task, and nothing wide is written or shuffled between tiles.  Items are no
shuffle key: one that a third of all playlists hold is no hot key.

* Means: a tile adds the vectors of its items to the sums of the buffer's queries.
* Scores: a tile scores the buffer with one matrix product and merges its best
  into the buffer's.
* Few queries (``best_of_few``) go to the items instead, which stay where they lie.

The order is that of one catalogue: score, then item id.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist._workers import ship_by_value
from setlist.operators import similarity as core
from setlist.session import checkpoint_dir, materialize

ship_by_value(__name__)

#: Rows that meet the tiles together, and those whose vectors are gathered at a time.
BUFFER_ROWS = 1 << 18
GATHER_ROWS = 1 << 15


def _folder(df: DataFrame) -> str:
    return f"{checkpoint_dir(df.sparkSession).rstrip('/')}/setlist-tables/{uuid.uuid4().hex}"


def _by_tile(df: DataFrame) -> DataFrame:
    """``df`` written in one folder per ``_tile``; a filter on it reads that folder."""
    path = _folder(df)
    df.write.partitionBy("_tile").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tile_count(n_items: int, item_bytes: int, broadcast_max_bytes: int) -> int:
    return max(1, min(n_items, math.ceil(item_bytes / max(1, broadcast_max_bytes))))


def _held(items: DataFrame, feature_cols: list[str], tiles: int) -> list:
    """A broadcast per tile: ids, ascending, and raw vectors."""
    catalogue = _by_tile(items.select("item", *feature_cols).repartition(tiles).withColumn("_tile", F.spark_partition_id()))
    return [items.sparkSession.sparkContext.broadcast(core._collected(catalogue.where(F.col("_tile") == t), feature_cols))
            for t in range(tiles)]


def _each(held: list):
    """The tiles that hold items, one after the other; of several a worker keeps one at a time."""
    for tile in held:
        value = tile.value
        if len(held) > 1:
            vars(tile).pop("_value", None)
        if len(value[0]):
            yield value
        del value


def _buffers(chunks, rows: int = 0):
    """Frames of whole queries put together up to ``rows`` rows."""
    rows = rows or BUFFER_ROWS
    held, n = [], 0
    for chunk in chunks:
        if held and n + len(chunk) > rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
        held.append(chunk)
        n += len(chunk)
    if held:
        yield pd.concat(held, ignore_index=True)


def _starts(q: np.ndarray) -> np.ndarray:
    return np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]


def _sums(query: np.ndarray, item: np.ndarray, n: int, held: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed vectors and number of the item rows of every query; ``query`` numbers them, ascending."""
    total, known = np.zeros((n, width)), np.zeros(n, dtype=np.int64)
    for ids, rows in _each(held):
        low, high = np.searchsorted(ids, item, "left"), np.searchsorted(ids, item, "right")
        known += np.bincount(query, weights=high - low, minlength=n).astype(np.int64)
        while len(mine := np.flatnonzero(low < high)):  # every copy of an id
            for s in range(0, len(mine), GATHER_ROWS):
                some = mine[s:s + GATHER_ROWS]
                first = _starts(query[some])
                total[query[some[first]]] += np.add.reduceat(rows[low[some]], first, axis=0)
            low = np.minimum(low + 1, high)
    return total, known


# ------------------------------------------------------------------ means ---
def means(pairs: DataFrame, items: DataFrame, feature_cols: list[str], query_col: str, tiles: int,
          hot_rows: int = core.HOT_QUERY_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``similarity.query_vectors`` by tiles; ``pairs`` are distinct ``(query_col, item)``, with
    columns ``carry`` of one value a query.  Queries above ``hot_rows`` rows are summed in
    salted parts first."""
    cols, width = list(feature_cols), core.compute_partitions(pairs)
    held = _held(items, cols, tiles)
    keys = [query_col, *carry]
    schema = T.StructType([*[pairs.schema[c] for c in keys], *[T.StructField(c, T.DoubleType()) for c in cols],
                           T.StructField("n_known", T.LongType())])
    hot = core._hot_queries(pairs, query_col, hot_rows)

    def summed(rows: DataFrame, *by) -> DataFrame:
        dealt = rows.repartition(width, *by).sortWithinPartitions(query_col)
        return dealt.select(*keys, "item").mapInPandas(lambda it, whole=len(by) == 1: run(it, whole), schema)

    def run(batches, whole: bool):
        for chunk in _buffers(core._sorted_batches(batches, query_col)):
            first = _starts(chunk[query_col].to_numpy())
            query = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(chunk)]))
            total, known = _sums(query, chunk["item"].to_numpy(), len(first), held, len(cols))
            keep = known > 0
            out = pd.DataFrame(total[keep] / known[keep, None] if whole else total[keep], columns=cols)
            for i, c in enumerate(keys):
                out.insert(i, c, chunk[c].to_numpy()[first][keep])
            out["n_known"] = known[keep]
            yield out

    if hot is None:
        return summed(pairs, query_col)
    cold = summed(pairs.join(hot, query_col, "left_anti"), query_col)
    parts = summed(pairs.join(hot, query_col), query_col, F.pmod(F.xxhash64("item"), F.lit(core.HOT_SALTS)))
    warm = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols], F.sum("n_known").alias("n_known"))
    return cold.unionByName(warm.select(*keys, *[(F.col(c) / F.col("n_known")).alias(c) for c in cols], "n_known"))


# ----------------------------------------------------------------- scores ---
def _best(vectors: np.ndarray, ks: np.ndarray, held: list, seen: tuple[np.ndarray, np.ndarray] | None = None):
    """``(row, item, score, rank)`` of each vector's ``ks`` best items; ``seen``: pairs (row, item) that are not chosen.
    A tile gives what is not below the ``ks``-th best of the tiles before it."""
    unit = core._normalise(vectors)
    least = None
    rows = vals = np.zeros(0, dtype=np.int64)
    found, rank = None, rows
    for ids, raw in _each(held):
        cells = None if seen is None else core._seen_cells(*seen, ids)
        r, c, v, _ = core._best_rows(unit, core._normalise(raw), ks, cells, least)
        rows, vals = np.r_[rows, r], np.r_[vals, v]
        found = ids[c] if found is None else np.r_[found, ids[c]]
        order = np.unique(found, return_inverse=True)[1]
        # Ranked by score, then place of the id; the place leads back to the id.
        ordered = np.unique(found)
        rows, at, vals, rank = core._ranked(rows, order, vals, ks)
        found = ordered[at]
        full = rank == ks[rows]
        least = np.full(len(ks), -np.inf)
        least[rows[full]] = vals[full]
    return rows, found, vals, rank


def recommended(pairs: DataFrame, items: DataFrame, feature_cols: list[str], query_col: str, exclude_seen: bool,
                schema: T.StructType, tiles: int) -> DataFrame:
    """Means and best items in one pass over ``pairs`` (query_col, item, _n), dealt and sorted by query."""
    held, width = _held(items, feature_cols, tiles), len(feature_cols)

    def run(batches):
        for chunk in _buffers(core._sorted_batches(batches, query_col)):
            q, item = chunk[query_col].to_numpy(), chunk["item"].to_numpy()
            first = _starts(q)
            query = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(q)]))
            total, known = _sums(query, item, len(first), held, width)
            ks = chunk["_n"].to_numpy(np.int64)[first]
            keep = (known > 0) & (ks > 0)
            if not keep.any():
                continue
            row_of = np.full(len(first), -1)
            row_of[keep] = np.arange(int(keep.sum()))
            r, found, v, rank = _best(total[keep] / known[keep, None], ks[keep], held, (row_of[query], item) if exclude_seen else None)
            yield pd.DataFrame({query_col: q[first][keep][r], "rank": rank, "item": found, "cosine": v})

    return pairs.mapInPandas(run, schema)


def best(queries: DataFrame, items: DataFrame, feature_cols: list[str], query_col: str, tiles: int) -> DataFrame:
    """Per query row (``query_col``, features, ``_k``, ``_n``) its ``_k`` best items as
    rows ``(query_col, item, cosine, rank, _n)``."""
    held = _held(items, feature_cols, tiles)
    packed = F.array(*[F.col(c) for c in feature_cols]).alias("v")
    rows = materialize(queries.select(query_col, "_k", "_n", packed))
    names = core._candidate_schema(queries, items, query_col).names

    def run(batches):
        for b in _tables(batches):
            vectors = b.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            r, found, v, rank = _best(vectors, b.column("_k").to_numpy(), held)
            if len(r):
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays([b.column(query_col).combine_chunks().take(at), pa.array(found.tolist(), kind), pa.array(v),
                                                  pa.array(rank), b.column("_n").combine_chunks().take(at)], names=names)

    kind = _arrow(items, "item")
    return rows.mapInArrow(run, core._candidate_schema(queries, items, query_col))


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    return df.select(name).limit(0).toArrow().schema.field(name).type


def _tables(batches):
    """Batches put together up to a buffer's rows."""
    held, n = [], 0
    for b in batches:
        if held and n + b.num_rows > BUFFER_ROWS // 4:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if b.num_rows:
            held.append(b)
            n += b.num_rows
    if held:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------ few queries ---
#: Score bins of a query, and rows that the batches may give without a look at them.
BINS = 1024
ROWS_UNSEEN = 1 << 22


def best_of_few(queries: DataFrame, items: DataFrame, feature_cols: list[str], query_col: str, n_items: int) -> DataFrame:
    """``best`` where the queries are few (at most ``similarity.FEW_QUERIES``): they are
    broadcast, the items are scored where they lie, and each batch of items gives a
    query's best of it.  Where those would be many rows, the scores are counted
    by ``BINS`` bins first, and items below the bin that holds a query's
    ``_k``-th best are left out."""
    spark, cols = queries.sparkSession, list(feature_cols)
    got = queries.select(query_col, "_k", "_n", F.array(*[F.col(c) for c in cols]).alias("v")).toArrow()
    n = got.num_rows
    unit = core._normalise(got.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, len(cols)))
    ks = got.column("_k").to_numpy()
    keys = spark.createDataFrame(got.select([query_col, "_n"]).append_column("_q", pa.array(np.arange(n), pa.int32())),
                                 T.StructType([queries.schema[query_col], T.StructField("_n", T.LongType()), T.StructField("_q", T.IntegerType())]))
    rows = items.select("item", F.array(*[F.col(c) for c in cols]).alias("v"))
    held = spark.sparkContext.broadcast(unit)
    least = np.zeros(n, dtype=np.int64)
    per_batch = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if n and ks.sum() * math.ceil(n_items / max(1, per_batch)) > ROWS_UNSEEN:
        counts = rows.mapInArrow(lambda it: _counted(it, held), "_q int, bin int, n long").groupBy("_q", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("_q").orderBy(F.desc("bin")))
        wanted = spark.createDataFrame([(i, int(k)) for i, k in enumerate(ks)], "_q int, _k long")
        cut = counts.withColumn("_above", above).join(F.broadcast(wanted), "_q").where("_above >= _k").groupBy("_q").agg(F.max("bin").alias("bin"))
        for r in cut.collect():
            least[r["_q"]] = r["bin"]
    schema = T.StructType([T.StructField("_q", T.IntegerType()), items.schema["item"], T.StructField("cosine", T.DoubleType())])
    found = rows.mapInArrow(lambda it: _chosen(it, held, ks, least), schema)
    w = Window.partitionBy("_q").orderBy(F.desc("cosine"), F.asc("item"))
    want = spark.createDataFrame([(i, int(k)) for i, k in enumerate(ks)], "_q int, _k long")
    ranked = (found.withColumn("rank", F.row_number().over(w).cast("long"))
              .join(F.broadcast(want), "_q").where("rank <= _k").join(F.broadcast(keys), "_q"))
    return ranked.select(query_col, "item", "cosine", "rank", "_n")


def _scored(batch: pa.RecordBatch, held) -> np.ndarray:
    """Rounded scores, queries by items."""
    raw = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.round(held.value @ core._normalise(raw).T, core.SCORE_DECIMALS)


def _bins(scores: np.ndarray) -> np.ndarray:
    return np.clip((scores + 1.0) * (BINS / 2), 0, BINS - 1).astype(np.int32)


def _parts(batch: pa.RecordBatch, queries: int):
    """Slices whose scores stay within a block."""
    step = max(1, core.SCORE_BLOCK_BYTES // (8 * max(queries, 1)))
    for s in range(0, batch.num_rows, step):
        yield batch.slice(s, step)


def _counted(batches, held):
    n = len(held.value)
    counts = np.zeros(n * BINS, dtype=np.int64)
    base = np.arange(n)[:, None] * BINS
    for batch in batches:
        for part in _parts(batch, n):
            counts += np.bincount((base + _bins(_scored(part, held))).ravel(), minlength=n * BINS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array((at // BINS).astype(np.int32)), pa.array((at % BINS).astype(np.int32)), pa.array(counts[at])],
                                     names=["_q", "bin", "n"])


def _chosen(batches, held, ks: np.ndarray, least: np.ndarray):
    n = len(held.value)
    for batch in batches:
        for part in _parts(batch, n):
            scores = _scored(part, held)
            scores[_bins(scores) < least[:, None]] = -np.inf
            # Ties by id: the part's rows in the order of their ids.
            order = np.argsort(part.column(0).to_pandas().to_numpy(), kind="stable")
            r, c, v, _ = core._topk_rows(scores[:, order], ks)
            fin = np.isfinite(v)
            yield pa.RecordBatch.from_arrays([pa.array(r[fin].astype(np.int32)), part.column(0).take(pa.array(order[c[fin]])), pa.array(v[fin])],
                                             names=["_q", "item", "cosine"])
