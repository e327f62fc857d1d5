"""G3 artists, recursive flatten, node table, sparse columns."""

from pyspark.sql import functions as F

from setlist.functions.flatten import (drop_sparse_columns, flatten_artist, flatten_columns,
                                       flatten_entries, id_attribute_map, prefix_columns)
from setlist.schemas import ARTIST_RECORD


def test_flatten_artist_cases(spark):
    rows = [
        ("1", (5,), ["g"], [("u",), ("v",)], 3),
        ("2", None, None, None, None),
        ("3", None, None, [], None),
        ("4", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, ARTIST_RECORD)
    out = df.select(*flatten_artist(F.struct(*df.columns))).orderBy("artist_spid").collect()
    assert tuple(out[0]) == (5, ["g"], "1", "u", 3)
    assert tuple(out[1]) == (None, [], "2", None, None)
    assert out[2]["artist_img_url"] is None
    assert tuple(out[3]) == (None, [], "4", None, None)


def test_flatten_columns_and_entries(spark):
    df = spark.createDataFrame(
        [(1, ("n", [("a1", "x"), ("a2", "y")], ("al", [("img",)])))],
        "id int, track struct<name:string, artists:array<struct<id:string,name:string>>,"
        " album:struct<name:string, images:array<struct<url:string>>>>")
    flat = flatten_columns(df, ":", max_items=1)
    assert flat.columns == ["id", "track:name", "track:artists:0:id", "track:artists:0:name",
                            "track:album:name", "track:album:images:0:url"]
    assert tuple(flat.first()) == (1, "n", "a1", "x", "al", "img")
    ent = {(r["key"], r["value"]) for r in flatten_entries(df, "id").collect()}
    assert ("track:artists:1:name", "y") in ent and ("track:album:images:0:url", "img") in ent
    assert len(ent) == 7


def test_id_attribute_map(spark):
    df = spark.createDataFrame([(7, "a", True)], "pid long, name string, collaborative boolean")
    r = id_attribute_map(df, "pid").first()
    assert r["pid"] == 7 and r["attributes"] == {"name": "a", "collaborative": "true"}


def test_prefix_and_sparse(spark):
    df = spark.createDataFrame([("i", 1.0, None), ("j", 2.0, None), ("k", None, 1)],
                               "id string, danceability double, rare int")
    p = prefix_columns(df, "track_", {"id": "spid"})
    assert p.columns == ["track_spid", "track_danceability", "track_rare"]
    assert drop_sparse_columns(p, 0.6).columns == ["track_spid", "track_danceability"]
