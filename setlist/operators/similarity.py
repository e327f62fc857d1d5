"""Item vectors, query vectors and cosine top-n.

Data layout: one ``double`` column per feature.  The query vector of a
playlist is then a hash aggregate of per-feature sums over narrow
(query, item) pairs partitioned by query (hot queries salted, see
:func:`query_vectors`), and the scoring stage sees a dense ``float64`` matrix.

Scoring never emits all (query, item) pairs.  Each task multiplies a block of
query vectors with an item matrix and keeps only the top ``k`` per query:

* ``broadcast`` — the item matrix goes out once per executor.  Only used after
  counting the items and checking ``rows x features x 8`` bytes against
  ``broadcast_max_bytes``.
* ``tiled`` — the catalogue is written in tiles of that size, each broadcast; a
  task meets them one after the other with a buffer of queries
  (:mod:`setlist.operators.tiles`).
* ``few`` — few queries and a large catalogue: the queries go to the items.

Ties are broken by item id ascending; results are ordered by cosine
descending.  Zero vectors score 0 against everything (as the reference's
library does).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.session import materialize

# The eleven audio features the model uses, in the model's order.
MUSIC_FEATURES = [
    "track_danceability",
    "track_energy",
    "track_key",
    "track_loudness",
    "track_mode",
    "track_speechiness",
    "track_acousticness",
    "track_instrumentalness",
    "track_liveness",
    "track_valence",
    "track_tempo",
]

DEFAULT_BROADCAST_MAX_BYTES = 64 << 20
# Bound on the score matrix one Python worker holds at a time.
SCORE_BLOCK_BYTES = 32 << 20
SCORE_DECIMALS = 12


# --------------------------------------------------------------------- R2 ---
def item_vectors(df: DataFrame, id_col: str, feature_cols: list[str],
                 drop_null: bool = True) -> DataFrame:
    """Item table ``(item, *features)`` with double features.

    Rows with a null id are dropped; rows with a null, NaN or infinite feature
    are dropped unless ``drop_null`` is False (no cosine is defined for them);
    :func:`dropped_items` counts them.
    """
    out = df.select(F.col(id_col).alias("item"),
                    *[F.col(c).cast("double").alias(c) for c in feature_cols])
    out = out.filter(F.col("item").isNotNull())
    if drop_null:
        for c in feature_cols:
            out = out.filter(F.abs(F.col(c)) < F.lit(float("inf")))  # false for NaN, which is above it
    return out


def dropped_items(df: DataFrame, id_col: str, feature_cols: list[str]) -> DataFrame:
    """One row ``(n_rows, n_dropped)``: item rows, and those that
    :func:`item_vectors` leaves out."""
    whole = F.col(id_col).isNotNull()
    for c in feature_cols:
        whole = whole & F.coalesce(F.abs(F.col(c).cast("double")) < F.lit(float("inf")), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~whole, 1)).alias("n_dropped"))


def array_features(df: DataFrame, array_col: str, dim: int,
                   prefix: str = "f") -> tuple[DataFrame, list[str]]:
    """Expand a fixed-width numeric array into ``dim`` double columns."""
    cols = [f"{prefix}{i}" for i in range(dim)]
    keep = [c for c in df.columns if c != array_col]
    out = df.select(*keep, *[F.get(F.col(array_col), i).cast("double").alias(c)
                             for i, c in enumerate(cols)])
    return out, cols


def array_item_vectors(df: DataFrame, id_col: str, array_col: str, dim: int,
                       prefix: str = "f") -> tuple[DataFrame, list[str]]:
    """Item table from an array column (R2 for embeddings).

    Rows whose array is null, of another width or holds a null, NaN or infinite
    value are dropped
    with one predicate on the array *before* it is expanded; a null filter on
    dozens of aliased columns would make Catalyst's constraint inference
    explode at planning time.
    """
    arr = F.col(array_col)
    ok = (F.col(id_col).isNotNull() & arr.isNotNull() & (F.size(arr) == dim)
          & F.forall(arr, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    base = df.filter(ok).select(F.col(id_col).alias("item"), arr.alias("_v"))
    return array_features(base, "_v", dim, prefix)


def item_matrix_bytes(items: DataFrame, feature_cols: list[str]) -> tuple[int, int]:
    """(rows, bytes) of the dense item matrix — one count job; the check every
    broadcast of the items goes through."""
    ids = F.octet_length(F.col("item").cast("string"))
    n, id_bytes = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.greatest(ids, F.lit(8))), F.lit(0))).first()
    return n, id_bytes + n * 2 * len(feature_cols) * 8  # unit vectors and the sums behind them


# --------------------------------------------------------------------- R3 ---
def compute_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle whose *consumer* is compute-heavy (a wide
    aggregate, then the scoring kernel): at least one per core.  An explicit
    count keeps AQE from coalescing a small-in-bytes narrow shuffle (pairs)
    down to a few tasks that then do all the arithmetic."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


HOT_QUERY_ROWS = 1_000_000
HOT_SALTS = 64


def _hot_queries(ids: DataFrame, query_col: str, hot_rows: int) -> DataFrame | None:
    """Queries with more than ``hot_rows`` items, or None when there are none.

    The list stays a table: only whether it has a row comes to the driver."""
    sizes = ids.groupBy(query_col).agg(F.count(F.lit(1)).alias("_c"))
    hot = sizes.filter(F.col("_c") > hot_rows).select(query_col)
    if hot.isEmpty():
        return None
    return materialize(hot)


def query_vectors(pairs: DataFrame, items: DataFrame, feature_cols: list[str],
                  query_col: str = "pid", item_col: str = "item",
                  hot_rows: int = HOT_QUERY_ROWS, salts: int = HOT_SALTS,
                  broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                  pairs_distinct: bool = False, item_bytes: int | None = None) -> DataFrame:
    """Mean feature vector per query over its *distinct* known items.

    Returns ``(query_col, *features, n_known)``.  A query with no known item
    gets no row (D5); a duplicated item key in ``items`` counts every copy,
    as the reference's index filter does.  ``items`` must hold no null
    feature (``item_vectors`` drops such rows), so one count serves every mean.

    Plan: only the narrow ``(query, item)`` pairs are shuffled, by query;
    the item matrix is joined inside the partition (broadcast after its size
    is checked against ``broadcast_max_bytes``; above it tile by tile, see
    :mod:`setlist.operators.tiles`) and summed there, so the wide
    per-feature rows are never shuffled at pair cardinality and no item is a
    shuffle key.  Queries with more than ``hot_rows``
    distinct items are salted over ``salts`` partitions and merged by a
    second, tiny aggregation; all other queries finish in one pass.  Their
    list grows with the pairs, so Spark picks its join.
    """
    ids = pairs.select(F.col(query_col), F.col(item_col).alias("item"))
    if not pairs_distinct:
        ids = ids.distinct()
    n_items = None
    if item_bytes is None:
        n_items, item_bytes = item_matrix_bytes(items, feature_cols)
    if item_bytes > broadcast_max_bytes:
        n_items = items.count() if n_items is None else n_items
        return _tiled_means(ids.filter(F.col(query_col).isNotNull() & F.col("item").isNotNull()), items, feature_cols,
                            query_col, (n_items, item_bytes, broadcast_max_bytes), hot_rows)
    side = F.broadcast(items)
    sizes = ids.groupBy(query_col).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.filter(F.col("_n") > hot_rows).select(query_col)
    sums = [F.sum(c).alias(c) for c in feature_cols]
    # Ordinary queries: narrow pairs partitioned by query, summed in place.
    cold = (ids.join(hot, query_col, "left_anti").repartition(compute_partitions(ids), query_col)
            .join(side, "item", "inner")
            .groupBy(query_col).agg(*sums, F.count(F.lit(1)).alias("n_known")))
    # Hot queries (empty list → AQE drops this branch): salted, then merged.
    warm = (ids.join(hot, query_col, "inner")
            .withColumn("_s", F.pmod(F.xxhash64("item"), F.lit(salts)))
            .repartition(query_col, "_s")
            .join(side, "item", "inner")
            .groupBy(query_col, "_s").agg(*sums, F.count(F.lit(1)).alias("n_known"))
            .groupBy(query_col).agg(*[F.sum(c).alias(c) for c in feature_cols],
                                    F.sum("n_known").alias("n_known")))
    merged = cold.unionByName(warm)
    return merged.select(query_col, *[(F.col(c) / F.col("n_known")).alias(c) for c in feature_cols],
                         F.col("n_known").cast("long").alias("n_known"))


# ------------------------------------------------------------- numpy core ---
def _normalise(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    out = np.zeros_like(m)
    nz = norms > 0
    out[nz] = m[nz] / norms[nz, None]
    return out


def _topk_rows(scores: np.ndarray, ks: np.ndarray):
    """Per-row top-k of a score block (modified in place), ties by column
    (= item id order).

    Returns ``(row, col, score, rank)`` arrays.  Every value tied with the
    k-th largest is kept before the final cut so the tie-break is exact.
    """
    b, t = scores.shape
    # Rank on 12-decimal scores: mathematically tied candidates (e.g. parallel
    # vectors) then tie exactly and fall back to item id, whatever order the
    # sums were formed in.  Real gaps are many orders of magnitude larger.
    np.round(scores, SCORE_DECIMALS, out=scores)
    ks = np.clip(ks, 0, t)
    if ks.max(initial=0) <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0), empty
    # Rows of like k share one cut: a single row with a huge k does not make
    # every row of the block keep as many.
    level = np.ceil(np.log2(np.maximum(ks, 1))).astype(np.int64)
    found = []
    for x in np.unique(level[ks > 0]):
        mine = np.flatnonzero((level == x) & (ks > 0))
        part = scores if mine.size == b else scores[mine]
        k = int(ks[mine].max())
        if k < t:
            thr = np.partition(part, t - k, axis=1)[:, t - k]
            r, c = np.nonzero(part >= thr[:, None])
        else:
            r, c = np.divmod(np.arange(mine.size * t, dtype=np.int64), t)
        found.append((mine[r], c))
    rows, cols = (np.concatenate(x) for x in zip(*found))
    vals = scores[rows, cols]
    order = np.lexsort((cols, -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    first = np.searchsorted(rows, rows, side="left")
    rank = np.arange(rows.size, dtype=np.int64) - first + 1
    keep = rank <= ks[rows]
    return rows[keep], cols[keep], vals[keep], rank[keep]


#: Rows and columns that meet at a time (their scores stay in a core's cache), and columns that the
#: bound is taken from: at least, if that is no more than half of them, and at most.
STRIDE_ROWS, STRIDE, FIRST_MIN, FIRST_MAX = 512, 512, 1 << 12, 1 << 14


def _best_rows(q: np.ndarray, x: np.ndarray, ks: np.ndarray, seen: tuple[np.ndarray, np.ndarray] | None = None,
               least: np.ndarray | None = None):
    """Per unit vector of ``q`` its ``ks`` best rows of the unit matrix ``x``, ties
    by column: ``(row, col, score, rank)``.  ``seen``: cells ``(rows, cols)`` that
    are not chosen.  ``least``: scores below which a row wants nothing.

    Scores of single precision only tell where to look.  The ``k``-th best score of
    some columns, drawn by a fixed seed, is a lower bound of the ``k``-th
    best of all; every column is scored, and those that fall short of the bound by more
    than the error of single precision are out.  The others are scored in
    double precision, so the result is that of the whole matrix.  Rows that ask
    for many items, or have many near ties, take the whole matrix."""
    t = len(x)
    ks = np.clip(ks, 0, t)
    asked = np.flatnonzero(ks > 0)
    found, rest = [], []
    level = np.ceil(np.log2(np.maximum(ks, 8))).astype(np.int64)
    if seen is not None:
        by_row = np.lexsort((seen[1], seen[0]))
        seen = seen[0][by_row], seen[1][by_row]
    drawn = None
    for lv in np.unique(level[asked]):
        mine = asked[level[asked] == lv]
        first = max(min(max(t // 8, FIRST_MIN), t // 2, FIRST_MAX), 32 << int(lv))
        if 2 * first > t:
            rest.append(mine)
            continue
        if drawn is None:
            order = np.random.default_rng(t).permutation(t)
            drawn = x[order].astype(np.float32), order, np.argsort(order)
        for s in range(0, mine.size, STRIDE_ROWS):
            rows = mine[s:s + STRIDE_ROWS]
            r, c, v, left = _above(q, x, drawn, rows, int(ks[rows].max()), first, seen, least)
            found.append(_ranked(r, c, v, ks)[:3])
            rest.append(left)
    rest = np.sort(np.concatenate(rest)) if rest else asked[:0]
    block = max(1, SCORE_BLOCK_BYTES // (8 * max(t, 1)))
    for s in range(0, rest.size, block):
        rows = rest[s:s + block]
        scores = q[rows] @ x.T
        if seen is not None:
            at, cols = _cells(rows, seen)
            scores[at, cols] = -np.inf
        r, c, v, _ = _topk_rows(scores, ks[rows])
        fin = np.isfinite(v)
        found.append((rows[r[fin]], c[fin], v[fin]))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0), empty
    return _ranked(*(np.concatenate(f) for f in zip(*found)), ks)


def _ranked(rows, cols, vals, ks):
    """The best ``ks`` cells of every row by score, then column, with their rank."""
    order = np.lexsort((cols, -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    rank = np.arange(rows.size, dtype=np.int64) - np.searchsorted(rows, rows, side="left") + 1
    keep = rank <= ks[rows]
    return rows[keep], cols[keep], vals[keep], rank[keep]


def _cells(rows: np.ndarray, seen):
    """The cells of ``seen`` (by row) in ``rows`` (ascending), their rows counted inside ``rows``."""
    lo, hi = np.searchsorted(seen[0], rows, "left"), np.searchsorted(seen[0], rows, "right")
    width = hi - lo
    at = np.repeat(lo - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
    return np.repeat(np.arange(rows.size), width), seen[1][at]


def _above(q, x, drawn, rows, k: int, first: int, seen, least):
    """Cells that can be among the ``k`` best of ``rows``, scored in double precision,
    and those of ``rows`` that have too many.  ``drawn``: the columns in single precision, in the
    order that they are met, that order, and the place of each column in it."""
    t, d = x.shape
    x32, order, place = drawn
    n = rows.size
    mine = q[rows].astype(np.float32).T
    # Twice the error of a dot product of unit vectors in single precision.
    slack = np.float32((d + 4) * 2.0 ** -22)
    low = np.full(n, -np.inf, np.float32) if least is None else least[rows].astype(np.float32) - slack
    room, flags = np.empty((STRIDE, n), np.float32), np.empty((STRIDE, n), bool)
    gone = None
    if seen is not None:
        at, cols = _cells(rows, seen)
        gone = np.unique(place[cols] * n + at)
    if not np.isfinite(low).all():
        # Columns that share a place are met by their maximum; of the seen ones none counts.
        wide = max(STRIDE, 32 * k)
        best = np.full((wide, n), -np.inf, np.float32)
        for c in range(0, first, wide):
            part = x32[c:min(c + wide, first)] @ mine
            if gone is not None:
                part.ravel()[gone[slice(*np.searchsorted(gone, (c * n, c * n + part.size)))] - c * n] = -np.inf
            np.maximum(best[:len(part)], part, out=best[:len(part)])
        low = np.maximum(low, np.partition(best.T, wide - k, axis=1)[:, wide - k] - slack)
    many, count, most = np.zeros(n, bool), np.zeros(n, np.int64), max(4096, t // 16)
    out = []
    for c in range(0, t, STRIDE):
        end = min(c + STRIDE, t)
        scores = np.matmul(x32[c:end], mine, out=room[:end - c])
        near = np.greater_equal(scores, low, out=flags[:end - c])
        cell = _true_cells(near.ravel())
        if not len(cell):
            continue
        r = cell % n
        if len(cell) > near.size // 16:
            flood = np.bincount(r, minlength=n) > max((end - c) // 8, 4 * k)
            many |= flood
            low[flood] = np.inf
            cell = cell[~flood[r]]
            r = cell % n
        out.append((r, c + cell // n, scores.ravel()[cell]))
        count += np.bincount(r, minlength=n)
        if (over := count > most).any():
            many |= over
            low[over] = np.inf
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), rows[many]
    r, at, v = (np.concatenate(o) for o in zip(*out))
    keep = ~many[r]
    if gone is not None and len(gone):
        cell = at * n + r
        keep &= gone[np.minimum(np.searchsorted(gone, cell), len(gone) - 1)] != cell
    r, at, v = r[keep], at[keep], v[keep]
    # The k-th best of these, as the k-th smallest key of a row.
    keys = np.sort((r << 32) + ((2.0 - v) * 2.0 ** 29).astype(np.int64))
    ends = np.searchsorted(keys, np.arange(n + 1) << 32)
    kth = ends[:-1] + k - 1
    full = kth < ends[1:]
    last = np.full(n, -np.inf)
    last[full] = 2.0 - ((keys[kth[full]] & 0xFFFFFFFF) + 1) * 2.0 ** -29 - slack
    keep = v >= last[r]
    r, cols = rows[r[keep]], order[at[keep]]
    vals = np.empty(len(r))
    step = max(1, SCORE_BLOCK_BYTES // (16 * d))
    for s in range(0, len(r), step):
        vals[s:s + step] = np.einsum("ij,ij->i", x[cols[s:s + step]], q[r[s:s + step]])
    return r, cols, np.round(vals, SCORE_DECIMALS), rows[many]


def _true_cells(flat: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of flags of which few are true, looked at by eight."""
    whole = flat.size & ~7
    eight = np.flatnonzero(flat[:whole].view(np.int64).astype(bool))
    at, inside = np.nonzero(flat[:whole].reshape(-1, 8)[eight])
    cells = eight[at] * 8 + inside
    return cells if whole == flat.size else np.concatenate([cells, whole + np.flatnonzero(flat[whole:])])


def _score_frame(qids, ks, ns, qmat: np.ndarray, item_ids, xn: np.ndarray,
                 query_col: str) -> pd.DataFrame:
    """Top-k of every query row against one item matrix (already normalised,
    rows in item-id order)."""
    r, c, v, rk = _best_rows(_normalise(qmat), xn, ks)
    return pd.DataFrame({query_col: qids[r], "item": item_ids[c], "cosine": v, "rank": rk, "_n": ns[r]})


# --------------------------------------------------------------------- R4 ---
def _collected(items: DataFrame, feature_cols) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and vectors of (size-checked) items; one packed column comes to the driver."""
    got = items.select("item", F.array(*[F.col(c) for c in feature_cols]).alias("v")).toArrow()
    ids = got.column("item").to_pandas().to_numpy()
    raw = got.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), len(feature_cols))
    order = np.argsort(ids, kind="stable")
    return ids[order], raw[order]


def _candidate_schema(queries: DataFrame, items: DataFrame, query_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_col, queries.schema[query_col].dataType),
        T.StructField("item", items.schema["item"].dataType),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("rank", T.LongType()),
        T.StructField("_n", T.LongType()),
    ])


def _broadcast_candidates(queries: DataFrame, items: DataFrame, feature_cols, query_col):
    spark = queries.sparkSession
    # Bounded by the caller's size check: rows x features x 8 <= broadcast_max_bytes.
    ids, raw = _collected(items, feature_cols)
    bc = spark.sparkContext.broadcast((ids, _normalise(raw)))
    fcols = list(feature_cols)

    def score(batches):
        item_ids, mat = bc.value
        for b in batches:
            if len(b) == 0:
                continue
            yield _score_frame(b[query_col].to_numpy(), b["_k"].to_numpy(np.int64),
                               b["_n"].to_numpy(np.int64), b[fcols].to_numpy(dtype=np.float64), item_ids, mat, query_col)

    return queries.mapInPandas(score, _candidate_schema(queries, items, query_col))


def recommend(queries: DataFrame, items: DataFrame, n, feature_cols: list[str], *,
              query_col: str = "pid", exclude: DataFrame | None = None,
              strategy: str = "auto",
              broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
              tile_rows: int | None = None, qblock_rows: int | None = None,
              item_stats: tuple[int, int] | None = None) -> DataFrame:
    """Top-``n`` items by cosine similarity for every query vector.

    ``queries``: ``(query_col, *feature_cols[, n column])`` — e.g. the output
    of :func:`query_vectors`.  ``items``: ``(item, *feature_cols)`` from
    :func:`item_vectors`.  ``n``: an int, or the name of a per-row column of
    ``queries`` (R5).  ``tile_rows`` sets the size of a tile in rows (``qblock_rows``
    is not needed any more).  ``exclude``: optional ``(query_col, item)`` pairs that
    must not be recommended (``exclude_seen=True``; without it the query's own
    items stay candidates, as in the reference, D1).

    Returns ``(query_col, rank, item, cosine)``, ``rank`` 1-based by cosine
    desc then item asc; fewer than ``n`` rows when fewer candidates exist (D4).
    """
    if isinstance(n, str):
        nk = F.col(n).cast("long")
    else:
        nk = F.lit(int(n)).cast("long")
    q = queries.select(query_col, *feature_cols, F.greatest(nk, F.lit(0)).alias("_n"))
    if exclude is not None:
        # Keep n + (catalogue rows of excluded items) per query: at most that many
        # excluded rows can rank above the n-th allowed one, so the cut is exact.
        ex = exclude.select(query_col, "item").distinct()
        copies = items.groupBy("item").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1)
        m = (ex.join(copies, "item", "left").groupBy(query_col)
             .agg(F.sum(F.coalesce("_c", F.lit(1))).alias("_m")))
        q = q.join(m, query_col, "left").withColumn(
            "_k", F.col("_n") + F.coalesce(F.col("_m"), F.lit(0))).drop("_m")
    else:
        q = q.withColumn("_k", F.col("_n"))
    q = q.filter(F.col("_k") > 0)

    n_items, item_bytes = item_stats or item_matrix_bytes(items, feature_cols)
    if strategy == "auto":
        strategy = "broadcast" if item_bytes <= broadcast_max_bytes else "tiled"
    if strategy == "broadcast":
        if item_bytes > broadcast_max_bytes:
            raise ValueError(f"item matrix of {item_bytes} bytes exceeds broadcast_max_bytes")
        cand = _broadcast_candidates(q, items, feature_cols, query_col)
    elif strategy == "tiled":
        from setlist.operators import tiles

        n_tiles = math.ceil(n_items / tile_rows) if tile_rows else tiles.tile_count(n_items, item_bytes, broadcast_max_bytes)
        cand = tiles.best(q, items, feature_cols, query_col, max(1, n_tiles))
    elif strategy == "few":
        from setlist.operators import tiles

        cand = tiles.best_of_few(q, items, feature_cols, query_col, n_items)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    if exclude is None:
        return cand.select(query_col, "rank", "item", "cosine")

    cand = cand.join(ex.hint("merge"), [query_col, "item"], "left_anti")
    w = Window.partitionBy(query_col).orderBy(F.desc("cosine"), F.asc("item"))
    return (cand.withColumn("rank", F.row_number().over(w).cast("long"))
            .filter(F.col("rank") <= F.col("_n"))
            .select(query_col, "rank", "item", "cosine"))


def _tiled_means(ids: DataFrame, items: DataFrame, feature_cols, query_col, sizes, hot_rows=HOT_QUERY_ROWS, carry=()) -> DataFrame:
    from setlist.operators import tiles

    return tiles.means(ids, items, feature_cols, query_col, tiles.tile_count(*sizes), hot_rows, carry)


#: Queries that go to the items, where the items are too many to go to the queries.
FEW_QUERIES = 1024


def _joined_means(ids: DataFrame, items: DataFrame, feature_cols, query_col) -> DataFrame:
    """Means of few queries: an item meets at most as many pairs as there are queries,
    and the sums of a task are one row a query.  Pairs and items grow with the catalogue, so
    neither is sent to the driver for a broadcast."""
    sums = ids.join(items.hint("merge"), "item").groupBy(query_col).agg(*[F.sum(c).alias(c) for c in feature_cols], F.count(F.lit(1)).alias("n_known"))
    return sums.select(query_col, *[(F.col(c) / F.col("n_known")).alias(c) for c in feature_cols], "n_known")


# ------------------------------------------------------ R3 + R4 fused ---
def _item_broadcast(items: DataFrame, feature_cols: list[str]):
    """Broadcast of the (size-checked) item matrix for the fused kernel:
    candidate ids sorted (copies kept), their unit vectors, and per distinct
    id the summed raw vector and number of copies (for query means)."""
    ids, raw = _collected(items, feature_cols)
    uniq, first, copies = np.unique(ids, return_index=True, return_counts=True)
    sums = np.add.reduceat(raw, first, axis=0) if len(ids) else raw[:0]
    return items.sparkSession.sparkContext.broadcast(
        (ids, _normalise(raw), uniq, sums, copies.astype(np.float64)))


def _fused_scores(chunk: pd.DataFrame, bc_value, query_col: str, exclude_seen: bool) -> pd.DataFrame:
    """Mean vector of every query's known items (rows of one query are
    contiguous), then its top-``_n`` candidates by cosine; the query's own
    items are masked when ``exclude_seen``."""
    cand_ids, xn, uniq, sums, copies = bc_value
    q = chunk[query_col].to_numpy()
    it = chunk["item"].to_numpy()
    nreq = chunk["_n"].to_numpy(np.int64)
    starts = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]
    sizes = np.diff(np.r_[starts, len(q)])
    gid = np.repeat(np.arange(len(starts)), sizes)
    pos = np.searchsorted(uniq, it)
    posc = np.minimum(pos, max(len(uniq) - 1, 0))
    valid = (pos < len(uniq)) & (uniq[posc] == it) if len(uniq) else np.zeros(len(it), bool)
    g = gid[valid]
    total = np.zeros((len(starts), xn.shape[1]))
    np.add.at(total, g, sums[posc[valid]])
    known = np.bincount(g, weights=copies[posc[valid]], minlength=len(starts))
    ks = nreq[starts]
    keep = (known > 0) & (ks > 0)
    row_of = np.full(len(starts), -1)
    row_of[keep] = np.arange(int(keep.sum()))
    qmat = total[keep] / known[keep, None]
    qids, ks = q[starts][keep], ks[keep]
    seen = None
    if exclude_seen and len(cand_ids):
        seen = _seen_cells(row_of[gid], it, cand_ids)
    r, c, v, rank = _best_rows(_normalise(qmat), xn, ks, seen)
    return pd.DataFrame({query_col: qids[r], "rank": rank, "item": cand_ids[c], "cosine": v})


def _seen_cells(rows: np.ndarray, item: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (row, place in the sorted ``ids``, every copy) of the pairs ``(rows, item)``; rows below 0 have none."""
    low, high = np.searchsorted(ids, item, "left"), np.searchsorted(ids, item, "right")
    width = np.where(rows >= 0, high - low, 0)
    at = np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
    return np.repeat(rows, width), at


def recommend_from_pairs(pairs: DataFrame, items: DataFrame, n, feature_cols: list[str], *,
                         query_col: str = "pid", item_col: str = "item",
                         exclude_seen: bool = False, pairs_distinct: bool = False,
                         item_stats: tuple[int, int] | None = None,
                         broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                         hot_rows: int = HOT_QUERY_ROWS, salts: int = HOT_SALTS) -> DataFrame:
    """R3 + R4 in one pass: each query's mean vector over its distinct known
    items, then its top-``n`` items by cosine (``exclude_seen``: never its own
    items).  Same result as :func:`query_vectors` + :func:`recommend`.

    ``n`` is an int or a DataFrame ``(query_col, n)`` (per-query n, R5/R7;
    duplicate rows for a query collapse to the largest n).

    When the item matrix passes the size check, only narrow ``(query, item,
    n)`` rows are shuffled (by query, sorted inside the partition) and one
    Arrow-batched kernel forms each mean from the broadcast matrix and scores
    it: no per-feature row exists in the JVM.  Queries above ``hot_rows``
    items and catalogues above ``broadcast_max_bytes`` use the salted / tiled
    operators instead; whether there is a hot query is asked first, and
    without one the fallback is left out of the plan.
    """
    n_items, item_bytes = item_stats or item_matrix_bytes(items, feature_cols)
    ids = pairs.select(F.col(query_col), F.col(item_col).alias("item")).filter(
        F.col(query_col).isNotNull() & F.col("item").isNotNull())
    if not pairs_distinct:
        ids = ids.distinct()
    if isinstance(n, DataFrame):
        # One n per query (a duplicate row would duplicate the query's pairs).
        nreq = n.groupBy(query_col).agg(F.max(F.col("n").cast("long")).alias("_n"))
    else:
        nreq = None

    def classic(sub: DataFrame, qv: DataFrame, **how) -> DataFrame:
        ncol = int(n) if nreq is None else "_n"
        if nreq is not None:
            qv = qv.join(nreq, query_col)
        return recommend(qv, items, ncol, feature_cols, query_col=query_col,
                         exclude=sub if exclude_seen else None, item_stats=(n_items, item_bytes),
                         broadcast_max_bytes=broadcast_max_bytes, **how)

    tiled = item_bytes > broadcast_max_bytes
    if tiled and ids.select(query_col).distinct().limit(FEW_QUERIES + 1).count() <= FEW_QUERIES:
        return classic(ids, _joined_means(ids, items, feature_cols, query_col), strategy="few")
    hot = _hot_queries(ids, query_col, hot_rows)
    cold = ids if hot is None else ids.join(hot, query_col, "left_anti")
    parts = compute_partitions(ids)
    cold = cold.repartition(parts, query_col)
    if nreq is not None:
        # A co-partitioned sort-merge join keeps the pairs' pinned partitioning
        # (and sorts by query).  Left to AQE, the small per-query side can be
        # coalesced to one partition and the pairs broadcast into it, which
        # would run the whole kernel in one task.
        cold = cold.hint("merge").join(nreq, query_col)
    else:
        cold = cold.withColumn("_n", F.lit(int(n)).cast("long"))
    cold = cold.filter(F.col("_n") > 0).sortWithinPartitions(query_col)
    schema = T.StructType([T.StructField(query_col, pairs.schema[query_col].dataType),
                           T.StructField("rank", T.LongType()),
                           T.StructField("item", items.schema["item"].dataType),
                           T.StructField("cosine", T.DoubleType())])
    if tiled:
        from setlist.operators import tiles

        fused = tiles.recommended(cold.select(query_col, "item", "_n"), items, feature_cols, query_col, exclude_seen, schema,
                                  tiles.tile_count(n_items, item_bytes, broadcast_max_bytes))
    else:
        bc = _item_broadcast(items, feature_cols)

        def run(batches):
            for chunk in _sorted_batches(batches, query_col):
                yield _fused_scores(chunk, bc.value, query_col, exclude_seen)

        fused = cold.select(query_col, "item", "_n").mapInPandas(run, schema)
    if hot is None:
        return fused
    sub = ids.join(hot, query_col, "inner")
    if tiled:
        warm = classic(sub, _tiled_means(sub, items, feature_cols, query_col, (n_items, item_bytes, broadcast_max_bytes), hot_rows))
    else:
        warm = classic(sub, query_vectors(sub, items, feature_cols, query_col, pairs_distinct=True, item_bytes=item_bytes,
                                          broadcast_max_bytes=broadcast_max_bytes, hot_rows=hot_rows, salts=salts))
    return fused.unionByName(warm.select(query_col, "rank", "item", "cosine"))


def _group_means(chunk: pd.DataFrame, bc_value, query_col: str):
    """Per contiguous query group: summed vectors of its known items and the
    number of item rows behind them (copies of a duplicated id counted)."""
    _, xn, uniq, sums, copies = bc_value
    q = chunk[query_col].to_numpy()
    it = chunk["item"].to_numpy()
    starts = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]
    gid = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(q)]))
    pos = np.searchsorted(uniq, it)
    posc = np.minimum(pos, max(len(uniq) - 1, 0))
    valid = (pos < len(uniq)) & (uniq[posc] == it) if len(uniq) else np.zeros(len(it), bool)
    total = np.zeros((len(starts), xn.shape[1]))
    np.add.at(total, gid[valid], sums[posc[valid]])
    known = np.bincount(gid[valid], weights=copies[posc[valid]], minlength=len(starts))
    return starts, total, known


def _sorted_batches(batches, query_col: str):
    """Re-cut Arrow batches of query-sorted rows so no query spans two chunks."""
    carry = None
    for b in batches:
        if carry is not None and len(carry):
            b = pd.concat([carry, b], ignore_index=True)
        if len(b) == 0:
            continue
        q = b[query_col].to_numpy()
        other = np.flatnonzero(q != q[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        carry = b.iloc[cut:]
        if cut:
            yield b.iloc[:cut]
    if carry is not None and len(carry):
        yield carry


def query_means_from_pairs(pairs: DataFrame, items: DataFrame, feature_cols: list[str], *,
                           query_col: str = "pid", item_col: str = "item",
                           pairs_distinct: bool = False,
                           item_stats: tuple[int, int] | None = None,
                           broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                           hot_rows: int = HOT_QUERY_ROWS, salts: int = HOT_SALTS,
                           carry: tuple[str, ...] = ()) -> DataFrame:
    """:func:`query_vectors` computed like :func:`recommend_from_pairs`: narrow
    pairs sorted by query inside the partition, means formed in an Arrow
    kernel from the size-checked broadcast matrix.  Hot queries use
    :func:`query_vectors`, large catalogues go by tiles.  Columns of ``pairs`` named
    in ``carry``, each one value a query, run along with the narrow pairs, so that
    no join by query has to move the vectors."""
    n_items, item_bytes = item_stats or item_matrix_bytes(items, feature_cols)
    ids = pairs.select(F.col(query_col), F.col(item_col).alias("item"), *carry).filter(
        F.col(query_col).isNotNull() & F.col("item").isNotNull())
    if not pairs_distinct:
        ids = ids.distinct()
    if item_bytes > broadcast_max_bytes:
        return _tiled_means(ids, items, feature_cols, query_col, (n_items, item_bytes, broadcast_max_bytes), hot_rows, carry)
    hot = _hot_queries(ids, query_col, hot_rows)
    cold = ids if hot is None else ids.join(hot, query_col, "left_anti")
    cold = cold.repartition(compute_partitions(ids), query_col).sortWithinPartitions(query_col)
    bc = _item_broadcast(items, feature_cols)
    fcols = list(feature_cols)
    schema = T.StructType([pairs.schema[c] for c in (query_col, *carry)]
                          + [T.StructField(c, T.DoubleType()) for c in fcols]
                          + [T.StructField("n_known", T.LongType())])

    def run(batches):
        value = bc.value
        for chunk in _sorted_batches(batches, query_col):
            starts, total, known = _group_means(chunk, value, query_col)
            keep = known > 0
            out = pd.DataFrame(total[keep] / known[keep, None], columns=fcols)
            for i, c in enumerate((query_col, *carry)):
                out.insert(i, c, chunk[c].to_numpy()[starts][keep])
            out["n_known"] = known[keep].astype(np.int64)
            yield out

    fused = cold.select(query_col, "item", *carry).mapInPandas(run, schema)
    if hot is None:
        return fused
    sub = ids.join(hot, query_col, "inner")
    warm = query_vectors(sub.select(query_col, "item"), items, feature_cols, query_col,
                         pairs_distinct=True, item_bytes=item_bytes,
                         broadcast_max_bytes=broadcast_max_bytes, hot_rows=hot_rows, salts=salts)
    if carry:
        warm = warm.join(sub.select(query_col, *carry).distinct(), query_col)
    return fused.unionByName(warm)


def as_lists(recs: DataFrame, query_col: str = "pid") -> DataFrame:
    """One ordered list of item ids per query (the reference's prediction shape).

    The group is bounded by the query's own ``n``.
    """
    return (recs.groupBy(query_col)
            .agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("_r"))
            .select(query_col, F.col("_r.item").alias("track_ids")))


def cosine_expr(a, b):
    """Cosine of two array columns as a native expression (F19); 0 for a zero vector."""
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, v: s + v * v))
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot / (na * nb))


from setlist._workers import ship_by_value  # noqa: E402

ship_by_value(__name__)
