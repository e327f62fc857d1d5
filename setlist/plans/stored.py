"""Queries on stored states and bucketed tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from setlist.operators import sketches
from setlist.operators.bucketed import count_by_key, join_by_key, write_bucketed
from setlist.operators.similarity import compute_partitions, query_means_from_pairs
from setlist.plans.recsys import SQL_SPLIT, _items, _split, _train
from setlist.plans.tables import table
from setlist.session import checkpoint_dir

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _folder(spark) -> str:
    return os.path.join(checkpoint_dir(spark), "setlist-states", uuid.uuid4().hex)


def _by_year(spark, sf_dir, *columns):
    return table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), *columns)


def _stored_in_two(spark, states, cut: int, schema: str):
    """The states added in two loads, the second of which brings a slice of the first again."""
    path = _folder(spark)
    sketches.store(states(F.col("year") <= cut), path)
    sketches.store(states(F.col("year") >= cut), path)
    return sketches.stored(spark, path, schema)


#: Ship year loaded twice, in the first and again in the second load.
CUT = 1996
_STATE = "slice int, state struct<sketch: binary, maxItemsTracked: int, itemDataType: bigint, itemDataTypeDDL: string>"


@register("stored_top_items", """
SELECT l_partkey AS item, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL AND l_shipdate IS NOT NULL
GROUP BY 1 ORDER BY n DESC, item LIMIT 20""")
def q_stored_top_items(spark, sf_dir):
    """The twenty most frequent tracks from states of ship years, merged."""
    rows = _by_year(spark, sf_dir, "l_partkey")
    states = _stored_in_two(spark, lambda c: sketches.top_states(rows.where(c), "year", "l_partkey"), CUT, _STATE)
    return sketches.top_of(states, 20)


LO, HI, BINS = 0.0, 100_000.0, 40
_BIN = f"""CAST(CASE WHEN l_extendedprice < {LO} THEN 0 WHEN l_extendedprice >= {HI} THEN {BINS + 1}
 ELSE floor((l_extendedprice - {LO}::DOUBLE) * {BINS}.0::DOUBLE / {HI - LO}::DOUBLE) + 1 END AS BIGINT)"""
_ROWS = "FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_shipdate IS NOT NULL"


def _bins(spark, sf_dir):
    rows = _by_year(spark, sf_dir, "l_extendedprice")
    return _stored_in_two(spark, lambda c: sketches.bin_states(rows.where(c), "year", "l_extendedprice", LO, HI, BINS), CUT,
                          "slice int, bin bigint, n bigint")


@register("stored_histogram", f"SELECT {_BIN} AS bin, count(*) AS n {_ROWS} GROUP BY 1")
def q_stored_histogram(spark, sf_dir):
    """The distribution of one feature from histograms of ship years, merged."""
    return sketches.bins_of(_bins(spark, sf_dir))


SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("stored_quantiles", f"""
WITH v AS (SELECT l_extendedprice AS x {_ROWS}), share AS (SELECT unnest({SHARES})::DOUBLE AS share),
q AS (SELECT share, (SELECT list(x ORDER BY x) FROM v)[CAST(ceil(share * (SELECT count(*) FROM v)) AS BIGINT)] AS l_extendedprice FROM share),
b AS (SELECT share, {_BIN} AS bin FROM q)
SELECT share, bin, CASE WHEN bin > 0 THEN {LO}::DOUBLE + (bin - 1) * {(HI - LO) / BINS}::DOUBLE END AS low,
       CASE WHEN bin <= {BINS} THEN {LO}::DOUBLE + bin * {(HI - LO) / BINS}::DOUBLE END AS high FROM b""")
def q_stored_quantiles(spark, sf_dir):
    """Quantiles to within a bin; the SQL finds the exact values and their bins."""
    return sketches.quantile_bins(_bins(spark, sf_dir), SHARES, LO, HI, BINS)


@register("bucketed_split_sizes", "WITH " + SQL_SPLIT + """
SELECT pid, count(*) FILTER (WHERE part = 'train') AS n_train, count(*) FILTER (WHERE part = 'test') AS n_test
FROM split GROUP BY pid HAVING n_train > 0""")
def q_bucketed_split_sizes(spark, sf_dir):
    """Both halves stored by playlist, sizes joined without a shuffle."""
    split = _split(spark, sf_dir)
    halves = [write_bucketed(split.where(F.col("part") == p).drop("part"), "pid") for p in ("train", "test")]
    train, test = count_by_key(halves[0], "n_train"), count_by_key(halves[1], "n_test")
    return train.join(test.hint("merge"), "pid", "left").select("pid", "n_train", F.coalesce("n_test", F.lit(0)).alias("n_test"))


@register("bucketed_vectors_held_out", "WITH " + SQL_SPLIT + """,
known AS (SELECT s.pid, count(*) AS n_known FROM split s JOIN embeddings e ON e.vec_id = s.item
          WHERE s.part = 'train' GROUP BY s.pid)
SELECT k.pid, s.item, k.n_known FROM known k JOIN split s ON s.pid = k.pid WHERE s.part = 'test'""")
def q_bucketed_vectors_held_out(spark, sf_dir):
    """Query vectors and held-out entries, both stored by playlist, joined bucket by bucket."""
    items, cols, stats = _items(spark, sf_dir)
    split = _split(spark, sf_dir)
    means = query_means_from_pairs(_train(split), items, cols, pairs_distinct=True, item_stats=stats)
    # One vector a playlist, dealt by playlist when it is formed: wide rows are written and not moved.
    buckets = compute_partitions(split)
    held = write_bucketed(split.where(F.col("part") == "test").select("pid", "item"), "pid", buckets)
    vectors = write_bucketed(means, "pid", buckets, hot_rows=None, dealt=True)
    return join_by_key(held, vectors).select("pid", "item", "n_known")
