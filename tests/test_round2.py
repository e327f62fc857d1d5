"""Null and non-finite input, safe upserts, broken slices, positional split, request identity."""

import os

import pytest
from pyspark.sql import functions as F

from setlist.functions.flatten import flatten_paths
from setlist.functions.scalars import epoch_to_timestamp, uri_part
from setlist.operators.enrich import enrich_batches, enrich_from_table
from setlist.operators.similarity import dropped_items, item_vectors, query_means_from_pairs, recommend_from_pairs
from setlist.operators.upsert import read_store, upsert_by_key, write_upsert
from setlist.plans import jobs
from setlist.schemas import TRACK_FEATURE_RECORD
from setlist.streaming.incremental import clean_new_slices
from tests.test_clean import _fixture, _pl, _write


def _items(spark):
    return spark.createDataFrame(
        [("A", 1.0, 0.0), ("B", 0.0, 1.0), ("C", 1.0, 1.0), ("N", None, 1.0), ("I", float("inf"), 1.0), ("Q", float("nan"), 0.0)],
        "id string, x double, y double")


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_null_items_and_non_finite_vectors(spark, bound):
    raw = _items(spark)
    items = item_vectors(raw, "id", ["x", "y"])
    assert tuple(dropped_items(raw, "id", ["x", "y"]).first()) == (6, 3)
    pairs = spark.createDataFrame([(1, "A"), (1, None), (2, "B"), (2, "Q"), (2, "I"), (3, None)], "pid long, item string")
    recs = recommend_from_pairs(pairs, items, 3, ["x", "y"], broadcast_max_bytes=bound).collect()
    got = {}
    for r in sorted(recs, key=lambda r: (r["pid"], r["rank"])):
        got.setdefault(r["pid"], []).append(r["item"])
    assert got == {1: ["A", "C", "B"], 2: ["B", "C", "A"]}
    means = query_means_from_pairs(pairs, items, ["x", "y"], broadcast_max_bytes=bound)
    assert {r["pid"]: (r["x"], r["y"]) for r in means.collect()} == {1: (1.0, 0.0), 2: (0.0, 1.0)}


def test_upsert_keeps_columns_and_null_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    first = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v long, extra string")
    write_upsert(spark, path, first, "k", first.schema)
    later = spark.createDataFrame([("b", 20, 7), ("c", 30, 8), (None, 40, 9)], "k string, v long, more long")
    for _ in range(2):
        out = write_upsert(spark, path, later, "k", later.schema)
    rows = {r["k"]: (r["v"], r["extra"], r["more"]) for r in out.collect()}
    assert out.count() == 4
    assert rows == {"a": (1, "x", None), "b": (20, None, 7), "c": (30, None, 8), None: (40, None, 9)}
    assert set(read_store(spark, path).columns) == {"k", "v", "extra", "more"}
    once = upsert_by_key(first, later, "k")
    assert sorted(map(str, once.collect())) == sorted(map(str, upsert_by_key(once, later, "k").select(once.columns).collect()))


def test_untouched_folders_stay(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    write_upsert(spark, path, rows, "k", rows.schema)
    before = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    write_upsert(spark, path, rows.where("k = 7").withColumn("v", F.lit(2)), "k", rows.schema)
    after = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    assert len(before - after) == 1 and read_store(spark, path).agg(F.sum("v")).first()[0] == 501


def test_broken_and_empty_slices(spark, tmp_dir):
    raw, out = _fixture(tmp_dir), os.path.join(tmp_dir, "clean")
    _write(raw, "5-5", [_pl(5, "e", "true", [])])
    assert "mpd.slice.5-5" in clean_new_slices(spark, raw, out)
    assert clean_new_slices(spark, raw, out) == []  # a slice without tracks is done as well
    with open(os.path.join(raw, "mpd.slice.9-9.json"), "w") as f:
        f.write('{"playlists": [{"pid": 9, "na')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        clean_new_slices(spark, raw, out)


def test_fetch_is_called_once_per_id(spark, tmp_dir):
    log = os.path.join(tmp_dir, "calls")
    os.makedirs(log)

    def fetch(ids):
        for i in ids:
            with open(os.path.join(log, str(i)), "a") as f:
                f.write(".")
        return [{"id": i} for i in ids]

    out = enrich_batches(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string"), "id", fetch, TRACK_FEATURE_RECORD)
    assert out.count() == 2 and len(out.collect()) == 2
    assert [os.path.getsize(os.path.join(log, x)) for x in ("a", "b")] == [1, 1]
    records = spark.createDataFrame([("a", "u"), ("z", "v")], "id string, uri string")
    got = enrich_from_table(out, "id", records, "id", TRACK_FEATURE_RECORD)
    assert [(r["id"], r["uri"], r["tempo"]) for r in got.collect()] == [("a", "u", None)]


def test_requests_with_one_key_are_answered_apart(spark):
    feats = spark.createDataFrame([("A", 1.0, 0.0), ("B", 0.0, 1.0), ("C", 1.0, 0.9)], "track_spid string, x double, y double")
    req = spark.createDataFrame([(1, ["A"], 1), (1, ["B"], 2)], "pid long, track_ids array<string>, n int")
    recs = jobs.batch_recommend(req, feats, features=["x", "y"])
    lists = sorted(r["track_ids"] for r in jobs.predictions_as_lists(recs).collect())
    assert lists == [["A"], ["B", "C"]]


def test_split_by_position(spark):
    pl = spark.createDataFrame([(0, "a", "true", 1, 1, 1, ["t1", "t2", "t1"])], "pid long, name string, collaborative string, "
                               "modified_at long, num_followers long, num_edits long, track_ids array<string>")
    feats = spark.createDataFrame([], "track_spid string, " + ", ".join(f"{c} double" for c in jobs.MUSIC_FEATURES))
    split = jobs.prepare(pl, feats, by_position=True)["split"].collect()
    assert sorted(r["item"] for r in split) == ["t1", "t1", "t2"] and sorted(r["part"] for r in split) == ["test", "train", "train"]


def test_scalars(spark):
    df = spark.createDataFrame([(1500000000123456999, "a.b|c", [("x", 1), ("y", 2)])], "n long, u string, a array<struct<p:string,q:long>>")
    r = df.select(epoch_to_timestamp("n", "ns", ntz=True).alias("t"), uri_part("u", 1, ".").alias("d"), uri_part("u", 1, "|").alias("b")).first()
    assert r["t"].microsecond == 123456 and (r["d"], r["b"]) == ("b|c", "c")
    assert tuple(flatten_paths(df, ["a:1:p", "a:5:q"]).first()) == ("y", None)
    with pytest.raises(ValueError):
        flatten_paths(df, ["a:0:none"])
