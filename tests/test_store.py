"""The versioned keyed table: equal to a dict, bounded rewrites, old versions stay readable."""

import os
import random

import pytest
from pyspark.sql import functions as F

from setlist.operators import store

SCHEMA = "k string, v long, t long"


def rows_of(df):
    return {r["k"]: (r["v"], r["t"]) for r in df.collect()}


def test_upserts_equal_a_dict(spark, tmp_dir):
    rng, want, seen = random.Random(2), {}, []
    for n in (0, 40, 300, 5, 120):
        batch = [(rng.choice([None, *(f"k{i}" for i in range(250))]), rng.randrange(99), t) for t in range(n)]
        version = store.upsert(spark, tmp_dir, spark.createDataFrame(batch, SCHEMA), "k", "t", max_rows=16)
        for k, v, t in batch:
            want[k] = (v, t)
        seen.append((version, dict(want)))
        got = store.read(spark, tmp_dir)
        assert got.columns == ["k", "v", "t"] and got.count() == len(want)
        assert rows_of(got) == want
    for version, then in seen:  # every version is still there
        assert rows_of(store.read(spark, tmp_dir, version)) == then
    ranges = store.manifest(spark, tmp_dir).collect()
    assert sum(2.0 ** -r["_bits"] for r in ranges) == 1.0 and sum(r["n_rows"] for r in ranges) == len(want)
    assert max(r["n_rows"] for r in ranges) <= 64 and len(ranges) > 8


def test_one_key_rewrites_one_range(spark, tmp_dir):
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    store.upsert(spark, tmp_dir, rows, "k", max_rows=100)
    reader = store.read(spark, tmp_dir)  # began before the next upsert
    store.upsert(spark, tmp_dir, spark.createDataFrame([(7, 5, "x")], "k long, v int, more string"), "k", max_rows=100)
    assert reader.agg(F.sum("v")).first()[0] == 2000
    now = store.read(spark, tmp_dir)
    assert now.agg(F.sum("v")).first()[0] == 2004 and now.where("more = 'x'").count() == 1
    a, b = ({(r["_prefix"], r["_bits"]): r["_gen"] for r in store.manifest(spark, tmp_dir, v).collect()} for v in (1, 2))
    assert sum(a[x] != b.get(x) for x in a) == 1
    gen = next(b[x] for x in b if b[x] not in a.values())
    assert spark.read.parquet(os.path.join(tmp_dir, "data", f"_gen={gen}")).count() <= 200
    assert store.unused_folders(spark, tmp_dir, keep=2) == [] and store.unused_folders(spark, tmp_dir, keep=1) == []


def test_a_dying_upsert_changes_nothing(spark, tmp_dir, monkeypatch):
    store.upsert(spark, tmp_dir, spark.createDataFrame([("a", 1, 1)], SCHEMA), "k")
    boom = spark.createDataFrame([("a", 2, 2)], SCHEMA).withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("lost"))).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.upsert(spark, tmp_dir, boom, "k")
    os.makedirs(os.path.join(tmp_dir, "manifest", f"{2:010d}"))  # begun, never committed
    assert store.versions(spark, tmp_dir) == [1] and rows_of(store.read(spark, tmp_dir)) == {"a": (1, 1)}
    assert store.upsert(spark, tmp_dir, spark.createDataFrame([("a", 3, 3)], SCHEMA), "k") == 3
    assert rows_of(store.read(spark, tmp_dir)) == {"a": (3, 3)} and rows_of(store.read(spark, tmp_dir, 1)) == {"a": (1, 1)}
