"""Whole flows W1-W7 on hand-made fixtures."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from setlist.operators.similarity import MUSIC_FEATURES
from setlist.operators.store import read, versions
from setlist.plans import jobs
from tests.services import hashed_track_service
from setlist.schemas import TRACK_FEATURES
from tests.test_clean import _fixture, _pl, _write


def _track_features(spark, ids):
    rows = []
    for k, i in enumerate(ids):
        vec = [float((k * 7 + j * 3) % 5) for j in range(len(MUSIC_FEATURES))]
        rows.append((i, *vec))
    return spark.createDataFrame(rows, ", ".join(["track_spid string"] +
                                                 [f"{c} double" for c in MUSIC_FEATURES]))


def test_w1_w4_w5(spark, tmp_dir):
    raw = _fixture(tmp_dir)
    _write(raw, "3-3", [_pl(3, "d", "true", [f"x:track:t{i}" for i in range(8)]),
                        _pl(4, "e", "no", [f"x:track:t{i}" for i in range(3, 9)])])
    out = os.path.join(tmp_dir, "clean")
    jobs.clean_new_slices(spark, raw, out)
    playlists = spark.read.parquet(f"{out}/playlists")
    feats = _track_features(spark, [f"t{i}" for i in range(1, 10)])
    prep = jobs.prepare(playlists, feats)
    split = prep["split"]
    assert split.select("pid").distinct().count() == 4          # pid 2 has one item: left out
    assert prep["playlist_features"].columns == ["pid", "name", "collaborative", "modified_at",
                                                 "num_followers", "num_edits"]
    ex = prep["inference_example"].collect()
    assert [r["pid"] for r in ex] == [0, 1, 3] and all(r["n"] == 5 for r in ex)
    ev = jobs.train_and_evaluate(split, prep["track_features"]).collect()
    assert len(ev) == 4 and all(r["hit_rate"] is None or 0 <= r["hit_rate"] <= 1 for r in ev)
    req = spark.createDataFrame([(1, "['t1', 't2']", 3), (2, "['t9']", 2)], "pid long, track_ids string, n int")
    recs = jobs.batch_recommend(req, feats, exclude_seen=True)
    got = recs.groupBy("pid").agg(F.count("*").alias("c")).collect()
    assert {r["pid"]: r["c"] for r in got} == {1: 3, 2: 2}
    assert recs.filter("pid = 1 AND item IN ('t1', 't2')").count() == 0
    lists = jobs.predictions_as_lists(recs).collect()
    assert all(len(r["track_ids"]) in (2, 3) for r in lists)


def test_w2_scrape(spark, tmp_dir):
    raw = _fixture(tmp_dir)
    out, feats_path = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "features")
    first = jobs.scrape_new_tracks(spark, raw, out, feats_path, hashed_track_service, "2024-01-01 00:00:00")
    want = {r["id"] for r in hashed_track_service(["t1", "t2", "t3"]) if r}
    assert {r["track_spid"] for r in first.collect()} == want
    again = jobs.scrape_new_tracks(spark, raw, out, feats_path, hashed_track_service, "2024-01-02 00:00:00")
    assert again.count() == 0
    assert spark.read.schema(TRACK_FEATURES).parquet(feats_path).count() == len(want)


def test_w2_asks_nothing_twice(spark, tmp_dir):
    """A run whose calls fail keeps nothing of them; the next one asks again, and what is settled is never asked."""
    raw = _fixture(tmp_dir)
    out, feats, calls = (os.path.join(tmp_dir, n) for n in ("clean", "features", "calls"))
    os.makedirs(calls)

    def broken(ids):
        raise RuntimeError("no answer")

    def counted(ids):
        for i in ids:
            with open(os.path.join(calls, str(i)), "a") as fh:
                fh.write("x")
        return [None if i == "t2" else {"id": i, "energy": 0.5} for i in ids]

    assert jobs.scrape_new_tracks(spark, raw, out, feats, broken, "2024-01-01").count() == 0
    got = {r["track_spid"] for r in jobs.scrape_new_tracks(spark, raw, out, feats, counted, "2024-01-02").collect()}
    assert got and "t2" not in got
    assert jobs.scrape_new_tracks(spark, raw, out, feats, counted, "2024-01-03").count() == 0
    assert set(os.listdir(calls)) == got | {"t2"}
    assert all(os.path.getsize(os.path.join(calls, i)) == 1 for i in os.listdir(calls))


def test_w3_load(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    f = spark.createDataFrame([("a", 0.5, "2021-01-01T00:00:00"), ("b", None, "bad"), ("c", 0.1, None)],
                              "track_spid string, track_energy double, time_pulled string")
    one = jobs.load_features(spark, f, store)
    rows = {r["track_spid"]: r for r in one.collect()}
    assert set(rows) == {"a", "b", "c"} and rows["b"]["time_pulled"] == dt.datetime(1970, 1, 1)
    two = jobs.load_features(spark, f, store)
    assert two.count() == 3
    assert versions(spark, store) == [1]  # no row was new: no new version
    more = spark.createDataFrame([("d", 0.9, None)], "track_spid string, track_energy double, time_pulled string")
    assert jobs.load_features(spark, more, store).count() == 4 and versions(spark, store) == [1, 2]
    assert read(spark, store, 1).count() == 3


def test_w6_liked(spark, tmp_dir):
    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    def item(i, added):
        art = {"id": f"ar{i % 2}", "name": f"artist{i % 2}", "type": "artist", "external_urls": {"spotify": "u"}}
        return {"added_at": added, "track": {
            "id": f"t{i}", "name": f"song{i}", "explicit": False, "is_local": False, "popularity": i,
            "preview_url": None, "track_number": i, "type": "track", "external_ids": {"isrc": f"i{i}"},
            "external_urls": {"spotify": f"s{i}"}, "artists": [art],
            "album": {"id": "al", "name": "album", "type": "album", "album_type": "album",
                      "release_date": "2020", "total_tracks": 3, "images": [{"url": "img"}],
                      "artists": [art], "external_urls": {"spotify": "a"}}}}
    for p, rng in enumerate([(0, 2), (2, 3)]):
        with open(os.path.join(pages, f"page{p}.json"), "w") as fh:
            json.dump({"items": [item(i, f"2021-0{i + 1}-01T00:00:00Z") for i in range(*rng)]}, fh)
    tracks = {r["id"]: r for r in hashed_track_service(["t0", "t1", "t2"]) if r}
    artists = {"ar0": {"id": "ar0", "followers": {"total": 9}, "genres": ["g"], "images": [], "popularity": 1},
               "ar1": {"id": "ar1", "genres": ["h"], "images": [{"url": "x"}], "popularity": 2}}
    out_csv = os.path.join(tmp_dir, "liked_csv")
    t = jobs.liked_items_table(spark, pages, lambda ids: [tracks.get(i) for i in ids],
                               lambda ids: [artists.get(i) for i in ids], "2024-01-01", out_csv)
    rows = t.collect()
    assert [r["track_spid"] for r in rows] == sorted(tracks, reverse=True)   # newest first
    assert all(r["interaction_style"] == "Liked Songs" for r in rows)
    assert "album_artist_spurl" in t.columns and "track_danceability" in t.columns
    assert "artist_img_url" in t.columns and glob.glob(os.path.join(out_csv, "*.csv"))


def test_w7_nodes(spark):
    pl = spark.createDataFrame([(0, "a", "true", 1500000000, 1, 2)],
                               "pid long, name string, collaborative string, modified_at long, "
                               "num_followers long, num_edits long")
    n = jobs.node_table(pl).first()
    assert n["attributes"]["collaborative"] == "true"
    assert n["attributes"]["modified_at"].startswith("2017-07-14 02:40:00")
    ns = jobs.node_table(pl, epoch_unit="ns").first()
    assert ns["attributes"]["modified_at"].startswith("1970-01-01 00:00:01.5")
