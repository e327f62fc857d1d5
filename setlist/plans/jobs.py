"""User-level flows (W1-W7) composed from the operators.

Each job is a function over DataFrames / paths.  Paths are arguments; there
is no catalogue, runner or scheduler — Spark plans and runs the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.functions.flatten import flatten_paths, id_attribute_map, rename_select
from setlist.functions.scalars import (epoch_to_timestamp, fill_by_type, parse_list_text,
                                       parse_timestamp, text_to_bool)
from setlist.operators import store
from setlist.operators.clean import playlist_items_long
from setlist.operators.dedup import dedup_first
from setlist.operators.enrich import CALL_SIZE, enrich, track_features_frame
from setlist.operators.evaluate import evaluate
from setlist.operators.ledger import enrich_with_ledger
from setlist.operators.lookup import join_on, new_rows, remaining_ids
from setlist.operators.similarity import MUSIC_FEATURES, item_vectors, recommend_from_pairs
from setlist.operators.split import holdout_split, inference_example, split_lists
from setlist.schemas import PLAYLIST_FEATURE_COLUMNS, TRACK_FEATURE_RECORD, TRACK_FEATURES
from setlist.session import materialize
from setlist.sinks.writers import append_parquet, save_csv
from setlist.sources.readers import read_liked_pages, read_or_empty
from setlist.streaming.incremental import clean_new_slices

# Liked-item flat columns → table names (26 renames, in order).
LIKED_RENAMES = {
    "track:album:album_type": "album_type",
    "track:album:artists:0:external_urls:spotify": "album_artist_spurl",
    "track:album:artists:0:id": "album_artist_spid",
    "track:album:artists:0:name": "album_artist_name",
    "track:album:artists:0:type": "album_artist_type",
    "track:album:external_urls:spotify": "album_spurl",
    "track:album:id": "album_spid",
    "track:album:images:0:url": "album_img_url",
    "track:album:name": "album_name",
    "track:album:release_date": "album_release_date",
    "track:album:total_tracks": "album_tracks_count",
    "track:album:type": "album_track_type",
    "track:artists:0:external_urls:spotify": "artist_spurl",
    "track:artists:0:id": "artist_spid",
    "track:artists:0:name": "artist_name",
    "track:artists:0:type": "artist_type",
    "track:explicit": "track_explicit",
    "track:external_ids:isrc": "track_isrc",
    "track:external_urls:spotify": "track_spurl",
    "track:id": "track_spid",
    "track:is_local": "track_is_local",
    "track:name": "track_name",
    "track:popularity": "track_popularity",
    "track:preview_url": "track_preview_url",
    "track:track_number": "track_number",
    "track:type": "track_type",
}


# --------------------------------------------------------------------- W1 ---
def select_playlist_features(playlists: DataFrame, epoch_unit: str = "s") -> DataFrame:
    """P1 + F3 + F4: the six playlist columns with typed flag and time."""
    return playlists.select(
        "pid", "name", text_to_bool("collaborative").alias("collaborative"),
        epoch_to_timestamp("modified_at", epoch_unit).alias("modified_at"),
        "num_followers", "num_edits").select(*PLAYLIST_FEATURE_COLUMNS)


def select_track_features(track_features: DataFrame) -> DataFrame:
    """``track_spid`` + the eleven model features."""
    return track_features.select("track_spid", *MUSIC_FEATURES)


def prepare(playlists: DataFrame, track_features: DataFrame, seed=42, test_frac=0.25,
            by_position: bool = False):
    """Split, selected track features, selected playlist features, inference example.

    ``by_position`` splits the entries of a list, duplicates included (D10);
    else each distinct item of a playlist is on one side."""
    long = playlist_items_long(playlists).select("pid", "pos", F.col("track_id").alias("item"))
    if by_position:
        split = holdout_split(long, "pid", "pos", test_frac, seed).drop("pos")
    else:
        split = holdout_split(long.drop("pos").distinct(), "pid", "item", test_frac, seed)
    rows = split_lists(split)
    return {
        "split": split,
        "split_rows": rows,
        "track_features": select_track_features(track_features),
        "playlist_features": select_playlist_features(playlists),
        "inference_example": inference_example(split),
    }


# --------------------------------------------------------------------- W2 ---
def scrape_new_tracks(spark: SparkSession, raw_dir: str, cleaned_dir: str, features_path: str,
                      fetch: Callable[[list], list], time_pulled) -> DataFrame:
    """Clean new slices → dedup tracks → ids without features → enrich → append.

    Answers go through the ledger beside the features (``<features_path>_ledger``):
    a run that dies before the append asks for nothing again, nor does a later run
    for ids that have no features; ids of failed calls are asked by the next run."""
    clean_new_slices(spark, raw_dir, cleaned_dir)
    tracks = spark.read.parquet(f"{cleaned_dir}/tracks")
    deduped = dedup_first(tracks.select("track_id", "slice"), ["track_id"], ["slice"])
    scraped = read_or_empty(spark, features_path, TRACK_FEATURES).select(
        F.col("track_spid").alias("track_id"))
    todo = remaining_ids(deduped, scraped, "track_id")
    records = enrich_with_ledger(todo, "track_id", fetch, TRACK_FEATURE_RECORD, f"{features_path}_ledger",
                                 call_size=CALL_SIZE["track"])
    feats = materialize(track_features_frame(records, time_pulled))
    append_parquet(feats, features_path)
    return feats


# --------------------------------------------------------------------- W3 ---
def load_features(spark: SparkSession, features: DataFrame, store_path: str,
                  key: str = "track_spid") -> DataFrame:
    """Time text → timestamp (F6), rows not stored yet (J3), type-wise null
    fill (F7), keyed upsert into the store (K7), a new version only if there are such rows."""
    f = features.withColumn("time_pulled", parse_timestamp(F.col("time_pulled").cast("string")))
    stored = store.read(spark, store_path) if store.versions(spark, store_path) else spark.createDataFrame([], f.schema)
    fresh = materialize(fill_by_type(new_rows(f, stored.select(key), key)))
    if fresh.isEmpty():
        return stored
    store.upsert(spark, store_path, fresh, key, "time_pulled")
    return store.read(spark, store_path)


# --------------------------------------------------------------------- W4 ---
def train_and_evaluate(split: DataFrame, track_features: DataFrame, *,
                       exclude_seen: bool = False, features=MUSIC_FEATURES) -> DataFrame:
    """Item table (R2) → evaluation of every playlist."""
    items = item_vectors(track_features, "track_spid", list(features))
    return evaluate(split, items, list(features), exclude_seen=exclude_seen)


# --------------------------------------------------------------------- W5 ---
def batch_recommend(requests: DataFrame, track_features: DataFrame, key: str = "pid",
                    features=MUSIC_FEATURES, exclude_seen: bool = False) -> DataFrame:
    """Rows of ``(key, track_ids, n)`` → ``(key, request, rank, item, cosine)``.

    Every row is answered by itself: ``request`` numbers the rows (any
    numbers), so rows that share a key keep their own ids and ``n``.
    ``track_ids`` may be an array or its text form (F12, never evaluated).
    """
    ids_col = requests.schema["track_ids"].dataType
    ids = parse_list_text("track_ids") if ids_col.typeName() == "string" else F.col("track_ids")
    if key == "request":
        raise ValueError("a key named 'request' would be taken for the row's number: rename it")
    # Written, so that a row keeps its number.
    rows = materialize(requests.select(key, ids.alias("track_ids"), "n").withColumn(
        "request", F.monotonically_increasing_id()))
    long = rows.select("request", F.explode("track_ids").alias("item"))
    items = item_vectors(track_features, "track_spid", list(features))
    recs = recommend_from_pairs(long, items, rows.select("request", "n"), list(features),
                                query_col="request", exclude_seen=exclude_seen)
    return recs.join(rows.select("request", key), "request").select(key, "request", "rank", "item", "cosine")


# --------------------------------------------------------------------- W6 ---
def liked_items_table(spark: SparkSession, pages_path: str, fetch_tracks, fetch_artists,
                      time_pulled, out_csv: str | None = None) -> DataFrame:
    """Saved-item pages → flat renamed rows (F9, P6) → track and artist
    features fetched in batches (B4, F8) → joined (J1, J2), newest first (O1),
    tagged (P8), optionally written as CSV (K6)."""
    items = read_liked_pages(spark, pages_path)
    flat = flatten_paths(items, ["added_at", *LIKED_RENAMES])
    liked = rename_select(flat, LIKED_RENAMES, keep_first=["added_at"])
    tf = enrich(liked, "track_spid", fetch_tracks, "track", time_pulled).drop(
        "track_uri", "track_track_href", "track_analysis_url", "track_type", "time_pulled")
    af = enrich(liked, "artist_spid", fetch_artists, "artist", time_pulled).drop("time_pulled")
    out = (join_on(join_on(liked, tf, ["track_spid"]), af, ["artist_spid"])
           .orderBy(F.desc("added_at"), "track_spid")
           .withColumn("interaction_style", F.lit("Liked Songs")))
    if out_csv:
        save_csv(out.withColumn("artist_genres", F.to_json("artist_genres")), out_csv)
    return out


# --------------------------------------------------------------------- W7 ---
def node_table(playlists: DataFrame, id_col: str = "pid", epoch_unit: str = "s") -> DataFrame:
    """Playlist features (``epoch_unit="ns"`` reproduces D14) → (id, attributes)."""
    return id_attribute_map(select_playlist_features(playlists, epoch_unit), id_col)


def predictions_as_lists(recs: DataFrame, key: str = "pid") -> DataFrame:
    """The reference's prediction shape: one ordered list per request row."""
    from setlist.operators.similarity import as_lists
    keys = recs.select("request", key).distinct()
    return as_lists(recs, "request").join(keys, "request").select(key, "request", "track_ids")
