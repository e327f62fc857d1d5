"""G6 upsert, G7 id sets, G8 null-key join, dedup, counts."""

import os

from setlist.operators.counts import progress_counts, reconcile_counts
from setlist.operators.dedup import dedup_any, dedup_first
from setlist.operators.lookup import join_on, lookup_found, lookup_missing, remaining_ids
from setlist.operators.upsert import upsert_by_key, write_upsert
from setlist.sources.readers import dataset_exists, read_or_empty


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_g6_upsert(spark, tmp_dir):
    target = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v long")
    upd = spark.createDataFrame([("k2", 20, 1), ("k2", 21, 2), ("k3", 3, 1)], "k string, v long, t long")
    out = upsert_by_key(target, upd, "k", "t").select("k", "v")
    assert _set(out) == {("k1", 1), ("k2", 21), ("k3", 3)}
    # on disk: missing target = empty, applying twice changes nothing
    path = os.path.join(tmp_dir, "store")
    schema = upd.schema
    assert read_or_empty(spark, path, schema).count() == 0
    write_upsert(spark, path, spark.createDataFrame([("k1", 1, 0), ("k2", 2, 0)], schema), "k", schema, "t")
    once = _set(write_upsert(spark, path, upd, "k", schema, "t").select("k", "v"))
    twice = _set(write_upsert(spark, path, upd, "k", schema, "t").select("k", "v"))
    assert once == twice == {("k1", 1), ("k2", 21), ("k3", 3)}
    assert dataset_exists(spark, path)


def test_g7_id_sets(spark):
    total = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    done = spark.createDataFrame([("b",)], "id string")
    assert _set(remaining_ids(total, done, "id")) == {("a",), (None,)}
    store = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v long")
    ids = spark.createDataFrame([("a",), ("c",), ("c",)], "id string")
    assert _set(lookup_found(store, ids, "id")) == {("a", 1)}
    assert [tuple(r) for r in lookup_missing(ids, store, "id").collect()] == [("c",)]
    counts = progress_counts(total, done, "id").first()
    assert (counts["n_total"], counts["n_done"], counts["n_remaining"]) == (3, 1, 2)


def test_g8_null_key_join(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a long")
    right = spark.createDataFrame([(None, 3), ("x", 4)], "k string, b long")
    assert join_on(left, right, ["k"]).count() == 1
    assert _set(join_on(left, right, ["k"], null_safe=True)) == {(None, 1, 3), ("x", 2, 4)}


def test_dedup_first_and_null_keys(spark):
    df = spark.createDataFrame([("t1", 3, "c"), ("t1", 1, "a"), (None, 5, "n1"), (None, 2, "n2"), ("t2", 9, "z")],
                               "k string, pos long, v string")
    assert _set(dedup_first(df, ["k"], ["pos"])) == {("t1", 1, "a"), (None, 2, "n2"), ("t2", 9, "z")}
    assert _set(dedup_first(df, ["k"], [("pos", "desc")])) == {("t1", 3, "c"), (None, 5, "n1"), ("t2", 9, "z")}
    assert dedup_any(df, ["k"]).count() == 3


def test_reconcile(spark):
    a = spark.range(3)
    b = spark.range(2)
    r = reconcile_counts(a, b, spark.range(5)).first()
    assert (r["n_new"], r["n_stored"], r["n_total"], r["balanced"]) == (3, 2, 5, True)
