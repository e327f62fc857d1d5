"""Stored states per slice (A11, A12) and tables in buckets."""

import os
import random

import duckdb
import pytest
from collections import Counter
from pyspark.sql import functions as F

from setlist.operators import sketches
from setlist.operators.bucketed import count_by_key, join_by_key, write_bucketed
from setlist.operators.counts import feature_histogram, most_featured

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entries(spark):
    rng = random.Random(3)
    rows = [(n % 5, f"t{int(rng.paretovariate(1)) % 60}" if rng.random() < 0.95 else None, rng.gauss(50, 30)) for n in range(4000)]
    rows += [(n % 5, "hot", None) for n in range(2000)]
    return spark.createDataFrame(rows, "s int, track string, x double")


def test_merged_states_equal_the_full_reports(spark, entries, tmp_dir):
    top, bins = f"{tmp_dir}/top", f"{tmp_dir}/bins"
    for lot in ([0, 1, 2], [2, 3], [4], [4]):  # slices added again count once
        some = entries.where(F.col("s").isin(lot))
        sketches.store(sketches.top_states(some, "s", "track", 1024), top)
        sketches.store(sketches.bin_states(some, "s", "x", 0.0, 100.0, 20), bins)
    states = spark.read.parquet(top)
    assert states.count() == 5
    full = most_featured(entries.where("track is not null"), "track", 15)
    assert [tuple(r) for r in sketches.top_of(states, 15, 1024).collect()] == [tuple(r) for r in full.collect()]
    merged = sketches.stored(spark, bins, "slice int, bin bigint, n bigint")
    whole = feature_histogram(entries.where("x is not null"), "x", 0.0, 100.0, 20)
    assert sorted(map(tuple, sketches.bins_of(merged).collect())) == sorted(map(tuple, whole.collect()))
    values = sorted(r["x"] for r in entries.where("x is not null").collect())
    for r in sketches.quantile_bins(merged, [0.0, 0.1, 0.5, 0.999, 1.0], 0.0, 100.0, 20).collect():
        exact = values[max(0, -(-int(r["share"] * 1000) * len(values) // 1000) - 1)]
        assert (r["low"] is None or r["low"] <= exact) and (r["high"] is None or exact < r["high"])


def test_counts_beyond_the_bound_stay_within_the_stated_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("s"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    got = {r["item"]: r["n"] for r in sketches.top_of(sketches.top_states(rows, "s", "v", 256), 1, 256).collect()}
    assert abs(got[1] - 20_000) <= 3.5 / 256 * 60_000


def test_empty_states(spark, entries):
    none = entries.limit(0)
    assert sketches.top_of(sketches.top_states(none, "s", "track", 64), 5, 64).count() == 0
    assert sketches.quantile_bins(sketches.bin_states(none, "s", "x", 0.0, 1.0, 4), [0.5], 0.0, 1.0, 4).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_meet_without_an_exchange(spark):
    left = spark.range(5000).select((F.col("id") % 700).alias("pid"), "id")
    right = spark.range(600).select(F.col("id").alias("pid"), (F.col("id") * 2).alias("n"))
    a, b = write_bucketed(left, "pid", 4), write_bucketed(right, "pid", 4)
    assert a.hot is None and b.hot is None
    for df in (join_by_key(a, b), join_by_key(a, b, "left"), count_by_key(a, "c")):
        assert "Exchange" not in _plan(df)
    assert sorted(map(tuple, join_by_key(a, b, "left").collect())) == sorted(map(tuple, left.join(right, "pid", "left").select("pid", "id", "n").collect()))


@pytest.mark.parametrize("hot_left", [12, 10**6])
@pytest.mark.parametrize("hot_right", [12, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_and_null_keys(spark, hot_left, hot_right, how):
    rng = random.Random(7)
    keys = [None, 0, 1, 2] + list(range(3, 40))

    def rows(n):
        return [(rng.choice(keys[:3]) if rng.random() < 0.3 else rng.choice(keys[rng.randrange(4):]), i) for i in range(n)]

    left, right = spark.createDataFrame(rows(300), "pid int, a int"), spark.createDataFrame(rows(200), "pid int, b int").where("pid is null or pid < 30")
    a, b = write_bucketed(left, "pid", 3, hot_left), write_bucketed(right, "pid", 3, hot_right)
    assert (a.hot is None) == (hot_left > 300) and (b.hot is None) == (hot_right > 300)
    assert Counter(map(tuple, join_by_key(a, b, how).collect())) == Counter(map(tuple, left.join(right, "pid", how).collect()))
    assert {r["pid"]: r["c"] for r in count_by_key(a, "c").collect()} == {r["pid"]: r["count"] for r in left.groupBy("pid").count().collect()}


def test_bucketed_refuses(spark):
    a = write_bucketed(spark.range(0).toDF("pid"), "pid", 2)
    b = write_bucketed(spark.range(3).toDF("other"), "other", 2)
    assert join_by_key(a, a).count() == 0 and count_by_key(a, "c").count() == 0
    with pytest.raises(ValueError):
        join_by_key(a, b)
    with pytest.raises(ValueError):
        join_by_key(a, a, "outer")


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_queries_match_their_sql(spark):
    from scripts.check_oracles import TABLES, _rows
    from setlist.plans import stored
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in stored.ORACLES.items():
        df, cur = stored.QUERIES[name](spark, SF), con.execute(sql)
        got = _rows(df.columns, df.collect())
        assert got and got == _rows([d[0] for d in cur.description], cur.fetchall()), name
