"""A9, R7, R8 in one pass: equal to the joins and to brute force, one shuffle by playlist."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from setlist.operators.evaluate import evaluate

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    vectors = {f"i{i:02d}": rng.integers(-3, 4, 3).astype(float) for i in range(50)}
    rows = [(k, *map(float, v)) for k, v in vectors.items()] + [("i03", 2.0, 1.0, 0.0), ("i03", 0.0, 1.0, 1.0)]
    split = []
    for p in range(40):
        for i in rng.choice(60, rng.integers(1, 14)):
            item = f"i{i:02d}" if i else None
            split += [(p, item, "test" if rng.random() < 0.4 else "train")] * int(rng.integers(1, 3))
    split += [(100, "i01", "train"), (101, "i01", "test"), (102, "zz", "train"), (102, "i01", "test"), (103, "i04", "dev"), (None, "i01", "test")]
    split += [(104, f"i{i:02d}", "train" if i % 2 else "test") for i in range(50)]
    return rows, split


def by_hand(rows, split, exclude):
    out = {}
    for p in {r[0] for r in split} - {None}:
        train = sorted({i for q, i, part in split if q == p and part == "train" and i is not None})
        test = [i for q, i, part in split if q == p and part == "test"]
        known = [np.array(v) for t in train for i, *v in rows if i == t]
        hits = 0
        if known and test:
            mean = np.mean(known, axis=0)
            def cos(v):
                d = np.linalg.norm(mean) * np.linalg.norm(v)
                return round(float(mean @ np.array(v) / d), 12) if d else 0.0
            ranked = sorted((-cos(v), i) for i, *v in rows if not (exclude and i in train))
            hits = len({i for _, i in ranked[:len(test)]} & set(test))
        out[p] = (len(test), len(known), hits, hits / len(test) if test else None)
    return out


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("how", ["one pass", "hot", "large"])
def test_equals_brute_force(spark, data, exclude, how):
    rows, split = data
    kw = {"one pass": {}, "hot": dict(hot_rows=30), "large": dict(broadcast_max_bytes=900)}[how]
    if how == "one pass":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        items = spark.createDataFrame(rows, "item string, a double, b double, c double")
        df = spark.createDataFrame(split, "pid long, item string, part string")
        got = {r["pid"]: (r["n_test"], r["n_known"], r["hits"], r["hit_rate"]) for r in evaluate(df, items, COLS, exclude_seen=exclude, **kw).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = by_hand(rows, split, exclude)
    assert any(w[2] for w in want.values()) and set(got) == set(want)
    for p, w in want.items():
        assert got[p][:3] == w[:3] and got[p][3] == (w[3] if w[3] is None else pytest.approx(w[3])), p


def test_empty_sides(spark, data):
    items = spark.createDataFrame(data[0], "item string, a double, b double, c double")
    df = spark.createDataFrame(data[1], "pid long, item string, part string")
    assert evaluate(df.limit(0), items, COLS).count() == 0
    assert {r["hits"] for r in evaluate(df, items.limit(0), COLS).collect()} == {0}


def test_one_shuffle_by_playlist(spark, tmp_dir):
    spark.range(400).select((F.col("id") % 40).alias("pid"), (F.col("id") % 7).alias("item"),
                            F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("part")).write.parquet(f"{tmp_dir}/split")
    items = spark.range(7).select(F.col("id").alias("item"), *[(F.col("id") * k).cast("double").alias(c) for k, c in enumerate(COLS)])
    plan = evaluate(spark.read.parquet(f"{tmp_dir}/split"), items, COLS)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange ") == 1 and "Join" not in plan
