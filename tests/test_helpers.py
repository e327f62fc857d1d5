"""Small helpers: native cosine (F19), ceil division (F18), JSON text (F17),
range layout (O3), intersection (X3), id batching (B1), junk keys (P22),
array hit rate (A9 list form)."""

import json

import numpy as np
from pyspark.sql import functions as F

from setlist.functions.scalars import ceil_div, to_json_text
from setlist.operators.evaluate import list_hit_rate
from setlist.operators.lookup import batch_ids, drop_junk_keys, intersect_ids
from setlist.operators.similarity import cosine_expr
from setlist.operators.split import range_layout


def test_cosine_expr_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 5)), rng.normal(size=(20, 5))
    b[0] = 0.0
    df = spark.createDataFrame([(a[i].tolist(), b[i].tolist()) for i in range(20)], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_expr("a", "b")).collect()]
    want = [0.0] + [float(a[i] @ b[i] / np.linalg.norm(a[i]) / np.linalg.norm(b[i])) for i in range(1, 20)]
    assert np.allclose(got, want)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(101, 50), (0, 50), (100, 50)], "a long, b long")
    assert [r[0] for r in df.select(ceil_div("a", "b")).collect()] == [3, 0, 2]
    j = spark.createDataFrame([("x", 1)], "k string, v long").select(to_json_text("k", "v")).first()[0]
    assert json.loads(j) == {"k": "x", "v": 1}


def test_layout_and_sets(spark):
    df = spark.range(1000).withColumnRenamed("id", "pid")
    laid = range_layout(df, "pid", 4)
    parts = laid.rdd.mapPartitions(lambda it: [[r[0] for r in it]]).collect()
    assert all(p == sorted(p) for p in parts) and len(parts) == 4
    assert max(parts[0]) < min(parts[-1])
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k long")
    b = spark.createDataFrame([(2,), (3,), (4,)], "k long")
    assert sorted(r[0] for r in intersect_ids(a, b, "k").collect()) == [2, 3]
    batched = batch_ids(spark.range(6000).withColumnRenamed("id", "k"), "k", 2500)
    assert batched.rdd.getNumPartitions() == 3 and batched.count() == 6000


def test_junk_and_list_hit_rate(spark):
    df = spark.createDataFrame([("a",), ("<NA>",), ("b",), (None,)], "k string")
    assert sorted(r[0] or "" for r in drop_junk_keys(df, "k").collect()) == ["", "b"]
    rows = spark.createDataFrame([(["C", "E"], ["C", "C"]), (["A"], []), (["A"], ["C"])],
                                 "pred array<string>, test array<string>")
    got = [r[0] for r in rows.select(list_hit_rate("pred", "test")).collect()]
    assert got == [0.5, None, 0.0]
