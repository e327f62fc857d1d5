"""Hit rate and evaluation of the cosine recommender."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist._workers import ship_by_value
from setlist.operators import similarity as core, tiles
from setlist.operators.similarity import item_matrix_bytes, recommend_from_pairs

ship_by_value(__name__)


def hit_rate(recs: DataFrame, test: DataFrame, query_col: str = "pid") -> DataFrame:
    """Distinct recommended ∩ held-out over the number of held-out rows.

    ``test`` is long form ``(query, item)``; duplicate held-out rows count in
    the divisor, as ``len(test_ids)`` does.  No held-out rows → null (D3).
    Returns ``(query, n_test, hits, hit_rate)`` for every query in ``test``.
    """
    n_test = test.groupBy(query_col).agg(F.count(F.lit(1)).alias("n_test"))
    hits = (recs.select(query_col, "item").distinct()
            .join(test.select(query_col, "item").distinct().hint("merge"), [query_col, "item"], "left_semi")
            .groupBy(query_col).agg(F.count(F.lit(1)).alias("hits")))
    return (n_test.join(hits, query_col, "left")
            .withColumn("hits", F.coalesce("hits", F.lit(0)).cast("long"))
            .withColumn("hit_rate", F.when(F.col("n_test") > 0,
                                           F.col("hits") / F.col("n_test"))))


def evaluate(split_long: DataFrame, items: DataFrame, feature_cols: list[str], *,
             query_col: str = "pid", item_col: str = "item", exclude_seen: bool = False,
             item_stats: tuple[int, int] | None = None, hot_rows: int = core.HOT_QUERY_ROWS,
             broadcast_max_bytes: int = core.DEFAULT_BROADCAST_MAX_BYTES, **recommend_args) -> DataFrame:
    """R7/R8 over every split playlist: n = size of its held-out part.

    ``split_long``: ``(query, item, part)`` with part in {train, test}.
    Returns ``(query, n_test, n_known, hits, hit_rate)``; playlists whose train
    items are all unknown get no recommendations, ``n_known`` 0 and hit rate 0
    (D5); an empty held-out part gives a null hit rate (D3); rows without a
    playlist id belong to none.

    One shuffle by playlist: its train and held-out rows, tagged and sorted,
    meet in one kernel that forms the mean, ranks the candidates and counts the
    hits; of a catalogue above ``broadcast_max_bytes`` it holds one tile at a time.
    Held-out items that n candidates are seen to come before are no hits, and a playlist
    that has no others need not meet the rest of the catalogue (``_outranked``).
    Playlists above ``hot_rows`` rows (looked for only where there are
    so many rows at all), and few playlists over such a catalogue, are
    evaluated by joins over the salted and tiled operators.
    """
    s = split_long.filter(F.col(query_col).isNotNull()).select(F.col(query_col), F.col(item_col).alias("item"), "part")
    if item_stats is None:
        item_stats = item_matrix_bytes(items, feature_cols)

    def joined(rows: DataFrame) -> DataFrame:
        return _evaluate_by_joins(rows, items, feature_cols, query_col, exclude_seen, item_stats=item_stats,
                                  hot_rows=hot_rows, broadcast_max_bytes=broadcast_max_bytes, **recommend_args)

    tiled = item_stats[1] > broadcast_max_bytes
    if tiled and s.select(query_col).distinct().limit(core.FEW_QUERIES + 1).count() <= core.FEW_QUERIES:
        return joined(s)
    hot = core._hot_queries(s, query_col, hot_rows) if s.count() > hot_rows else None
    cold = s if hot is None else s.join(hot, query_col, "left_anti")
    n_tiles = tiles.tile_count(*item_stats, broadcast_max_bytes) if tiled else 0
    out = _evaluate_in_one_pass(cold, items, feature_cols, query_col, exclude_seen, n_tiles)
    return out if hot is None else out.unionByName(joined(s.join(hot, query_col)))


_TRAIN, _TEST, _OTHER = 0, 1, 2


def _evaluate_in_one_pass(s: DataFrame, items: DataFrame, feature_cols, query_col: str, exclude_seen: bool, n_tiles: int = 0) -> DataFrame:
    """With ``n_tiles``, a catalogue that no broadcast may hold."""
    role = F.when(F.col("part") == "train", _TRAIN).when(F.col("part") == "test", _TEST).otherwise(_OTHER)
    kind = items.schema["item"].dataType
    # A null item is no item: it counts among the held-out rows only.
    tagged = s.select(query_col, role.alias("_role"), F.col("item").isNotNull().alias("_has"),
                      F.coalesce(F.col("item").cast(kind), F.lit("0").cast(kind)).alias("item"))
    rows = (tagged.repartition(core.compute_partitions(s), query_col)
            .sortWithinPartitions(query_col, "_role", "_has", "item"))
    held, width = tiles._held(items, feature_cols, n_tiles) if n_tiles else core._item_broadcast(items, feature_cols), len(feature_cols)
    schema = T.StructType([s.schema[query_col], *[T.StructField(c, T.LongType()) for c in ("n_test", "n_known", "hits")],
                           T.StructField("hit_rate", T.DoubleType())])

    def run(batches):
        chunks = core._sorted_batches(batches, query_col)
        for chunk in tiles._buffers(chunks) if n_tiles else chunks:
            yield _scored_by_tile(chunk, held, width, query_col, exclude_seen) if n_tiles else _scored(chunk, held.value, query_col, exclude_seen)

    return rows.mapInPandas(run, schema)


def _scored(chunk: pd.DataFrame, catalogue, query_col: str, exclude_seen: bool) -> pd.DataFrame:
    """Hits of whole playlists, whose rows stand together: train items first, each in item order."""
    ids, unit, uniq, sums, copies = catalogue
    q, item, role = chunk[query_col].to_numpy(), chunk["item"].to_numpy(), chunk["_role"].to_numpy()
    first = np.r_[True, q[1:] != q[:-1]]
    group = np.cumsum(first) - 1
    n = int(group[-1]) + 1
    n_test = np.bincount(group[role == _TEST], minlength=n)
    # Distinct known rows of either part, as (group, place among the distinct ids).
    at = np.minimum(np.searchsorted(uniq, item), max(len(uniq) - 1, 0))
    new = np.r_[True, (item[1:] != item[:-1]) | (role[1:] != role[:-1]) | first[1:]]
    known = new & chunk["_has"].to_numpy(bool) & (uniq[at] == item if len(uniq) else np.zeros(len(item), bool))
    train, test = known & (role == _TRAIN), known & (role == _TEST)
    n_known = np.bincount(group[train], weights=copies[at[train]], minlength=n).astype(np.int64)
    asked = np.flatnonzero((n_known > 0) & (n_test > 0))
    hits = np.zeros(n, dtype=np.int64)
    if len(asked):
        starts = np.searchsorted(group[train], np.flatnonzero(n_known > 0))
        means = np.add.reduceat(sums[at[train]], starts, axis=0)[n_test[n_known > 0] > 0] / n_known[asked, None]
        vectors = core._normalise(means)
        row_of = _rows_of(asked, n)
        best = _best_held_out(vectors, row_of[group[test]], uniq[at[test]], [(ids, unit)])
        taken = core._seen_cells(row_of[group[train]], uniq[at[train]], ids) if exclude_seen else None
        left = np.flatnonzero(~_outranked(vectors, n_test[asked], best, unit, taken))
        asked, vectors = asked[left], vectors[left]
    if len(asked):
        place = np.searchsorted(uniq, ids)  # of every candidate among the distinct ids
        row_of = _rows_of(asked, n)
        wanted = np.unique(group[test].astype(np.int64) * len(uniq) + at[test])
        seen_row, seen_at = row_of[group[train]], at[train]
        seen = core._seen_cells(seen_row, uniq[seen_at], ids) if exclude_seen else None
        r, c, _, _ = core._best_rows(vectors, unit, n_test[asked], seen)
        found = np.unique(asked[r].astype(np.int64) * len(uniq) + place[c])
        hits += np.bincount(found[np.isin(found, wanted)] // len(uniq), minlength=n)
    return _rated(q[first], query_col, n_test, n_known, hits)


def _scored_by_tile(chunk: pd.DataFrame, held: list, width: int, query_col: str, exclude_seen: bool) -> pd.DataFrame:
    """``_scored`` where the catalogue comes in tiles."""
    q, item, role = chunk[query_col].to_numpy(), chunk["item"].to_numpy(), chunk["_role"].to_numpy()
    first = np.r_[True, q[1:] != q[:-1]]
    group = np.cumsum(first) - 1
    n = int(group[-1]) + 1
    n_test = np.bincount(group[role == _TEST], minlength=n)
    new = (np.r_[True, (item[1:] != item[:-1]) | (role[1:] != role[:-1])] | first) & chunk["_has"].to_numpy(bool)
    train, test = new & (role == _TRAIN), new & (role == _TEST)
    total, n_known = tiles._sums(group[train], item[train], n, held, width)
    asked = np.flatnonzero((n_known > 0) & (n_test > 0))
    hits = np.zeros(n, dtype=np.int64)
    if len(asked):
        vectors, row_of = core._normalise(total[asked] / n_known[asked, None]), _rows_of(asked, n)
        best = _best_held_out(vectors, row_of[group[test]], item[test], tiles._each(held))
        ids, raw = next(tiles._each(held))  # a known item lies in some tile
        taken = core._seen_cells(row_of[group[train]], item[train], ids) if exclude_seen else None
        asked = asked[~_outranked(vectors, n_test[asked], best, raw, taken)]
        del ids, raw
    if len(asked):
        row_of = _rows_of(asked, n)
        seen = (row_of[group[train]], item[train]) if exclude_seen else None
        r, found, _, _ = tiles._best(total[asked] / n_known[asked, None], n_test[asked], held, seen)
        if len(r):
            ids, place = np.unique(np.concatenate([found, item[test]]), return_inverse=True)
            chosen = np.unique(asked[r].astype(np.int64) * len(ids) + place[:len(r)])
            wanted = group[test].astype(np.int64) * len(ids) + place[len(r):]
            hits += np.bincount(chosen[np.isin(chosen, wanted)] // len(ids), minlength=n)
    return _rated(q[first], query_col, n_test, n_known, hits)


def _rows_of(asked: np.ndarray, n: int) -> np.ndarray:
    """The row of each of ``n`` groups among ``asked``, -1 for the others."""
    rows = np.full(n, -1)
    rows[asked] = np.arange(len(asked))
    return rows


def _best_held_out(vectors: np.ndarray, rows: np.ndarray, item: np.ndarray, held) -> np.ndarray:
    """Of each unit vector the best score of its held-out items, pairs ``(rows, item)``, in the
    tiles ``held`` of ids and vectors; minus infinity where none is known."""
    best = np.full(len(vectors), -np.inf)
    for ids, raw in held:
        r, c = core._seen_cells(rows, item, ids)
        for s in range(0, len(r), tiles.GATHER_ROWS):
            some, at = r[s:s + tiles.GATHER_ROWS], c[s:s + tiles.GATHER_ROWS]
            np.maximum.at(best, some, np.einsum("ij,ij->i", core._normalise(raw[at]), vectors[some]))
    return best


#: Candidates that a playlist meets first, and at most at a time.
FIRST, MOST = 128, 8192


def _outranked(vectors: np.ndarray, ks: np.ndarray, best: np.ndarray, x: np.ndarray, seen) -> np.ndarray:
    """Rows of which no held-out item can be among the ``ks`` best: none is known, or ``ks`` of the
    candidates ``x`` score above ``best`` by more than the error of single precision.  Candidates are met in an
    order drawn by a fixed seed, ever more at a time, by the rows still open; ``seen``: cells
    ``(rows, places)`` that are no candidates.  Rows that half of ``x`` leaves open stay so."""
    t, d = x.shape
    count, open_ = np.zeros(len(vectors), np.int64), np.flatnonzero(best > -np.inf)
    limit = np.nextafter((best + (d + 4) * 2.0 ** -22).astype(np.float32), np.float32(np.inf))
    order = np.random.default_rng(t).permutation(t)
    mine, at, size = vectors.astype(np.float32), 0, FIRST
    if seen is not None:
        place = np.argsort(order)[seen[1]]
        by_place = np.argsort(place, kind="stable")
        seen_rows, place = seen[0][by_place], place[by_place]
    while len(open_) and at + size <= t // 2:
        block = core._normalise(x[order[at:at + size]]).astype(np.float32).T
        step = max(1, core.SCORE_BLOCK_BYTES // (4 * size))
        for s in range(0, len(open_), step):
            rows = open_[s:s + step]
            count[rows] += np.count_nonzero(mine[rows] @ block > limit[rows, None], axis=1)
        if seen is not None:  # taken off whether they scored above or not: at worst a row stays open
            lo, hi = np.searchsorted(place, (at, at + size))
            count -= np.bincount(seen_rows[lo:hi], minlength=len(count))
        at, size = at + size, min(2 * size, MOST)
        open_ = open_[count[open_] < ks[open_]]
    out = np.ones(len(vectors), bool)
    out[open_] = False
    return out


def _rated(playlists, query_col: str, n_test, n_known, hits) -> pd.DataFrame:
    rate = np.where(n_test > 0, hits / np.maximum(n_test, 1), np.nan)
    return pd.DataFrame({query_col: playlists, "n_test": n_test, "n_known": n_known, "hits": hits,
                         "hit_rate": pd.Series(rate, dtype=object).where(n_test > 0, None)})


def _evaluate_by_joins(s: DataFrame, items: DataFrame, feature_cols, query_col: str, exclude_seen: bool,
                       **recommend_args) -> DataFrame:
    train = s.filter(F.col("part") == "train").drop("part")
    test = s.filter(F.col("part") == "test").drop("part")
    n_test = test.groupBy(query_col).agg(F.count(F.lit(1)).alias("n"))
    recs = recommend_from_pairs(train, items, n_test, feature_cols, query_col=query_col,
                                exclude_seen=exclude_seen, **recommend_args)
    # Known train items per playlist: a narrow id-only join, no feature columns.
    known = (train.distinct().join(items.select("item").hint("merge"), "item")
             .groupBy(query_col).agg(F.count(F.lit(1)).alias("n_known")))
    scores = hit_rate(recs, test, query_col)
    playlists = s.select(query_col).distinct()
    return (playlists.join(scores, query_col, "left")
            .join(known, query_col, "left")
            .select(query_col,
                    F.coalesce("n_test", F.lit(0)).cast("long").alias("n_test"),
                    F.coalesce("n_known", F.lit(0)).cast("long").alias("n_known"),
                    F.coalesce("hits", F.lit(0)).cast("long").alias("hits"),
                    F.when(F.coalesce("n_test", F.lit(0)) > 0,
                           F.when(F.col("n_known") > 0, F.col("hit_rate")).otherwise(F.lit(0.0)))
                    .alias("hit_rate")))


def list_hit_rate(pred_col: str, test_col: str) -> F.Column:
    """Array form of A9 / X3 for one row: size(distinct pred ∩ test) / size(test)."""
    inter = F.size(F.array_intersect(F.array_distinct(F.col(pred_col)), F.col(test_col)))
    return F.when(F.size(test_col) > 0, inter / F.size(test_col))
