"""Steps whose cost must not grow faster than the input: files, steps, waves, driver bytes."""

import glob
import json
import os
import random
import types

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.operators import evaluate as evaluation, ledger, similarity, store, tiles
from setlist.operators.bucketed import write_bucketed
from setlist.operators.clean import first_seen_in_files, first_seen_tracks
from setlist.operators.evaluate import evaluate
from setlist.operators.similarity import query_means_from_pairs, query_vectors, recommend_from_pairs
from setlist.plans import files
from setlist.sinks.writers import write_slice_tables
from setlist.sources.readers import playlists_of, read_raw_files
from setlist.streaming import incremental
from setlist.streaming.incremental import clean_files

ship_by_value(__name__)
COLS = ["a", "b", "c"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("t", [40, 3000])
@pytest.mark.parametrize("copies", [False, True])
def test_best_rows_equal_brute_force(t, copies, monkeypatch):
    rng = np.random.default_rng(t)
    x = rng.normal(size=(t, 12))
    if copies:
        x[t // 2:] = x[:t - t // 2]  # every score twice, ties by column
    q = rng.normal(size=(70, 12))
    q[3] = 0.0
    ks = rng.integers(0, 9, 70)
    ks[5], ks[6] = t, t + 7
    monkeypatch.setattr(similarity, "STRIDE_ROWS", 16)
    unit, xn = similarity._normalise(q), similarity._normalise(x)
    cells = rng.integers(0, 70, 400), rng.integers(0, t, 400)
    for seen in (None, cells):
        scores = np.round(unit @ xn.T, similarity.SCORE_DECIMALS)
        gone = set() if seen is None else set(zip(*map(list, seen)))
        want = []
        for r in range(70):
            order = [c for c in np.lexsort((np.arange(t), -scores[r])) if (r, c) not in gone][:ks[r]]
            want += [(r, c, n) for n, c in enumerate(order, 1)]
        rows, cols, vals, rank = similarity._best_rows(unit, xn, ks, seen)
        assert list(zip(rows, cols, rank)) == want
        assert np.allclose(vals, scores[rows, cols], atol=2e-12)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), *map(float, rng.integers(-3, 4, 3))) for i in range(60)] + [(5, 1.0, 1.0, 0.0)] * 3
    pairs = [(int(p), int(i)) for p in range(30) for i in rng.choice(66, rng.integers(1, 9), replace=False)]
    return spark.createDataFrame(rows, "item long, a double, b double, c double"), spark.createDataFrame(pairs, "pid long, item long")


@pytest.mark.parametrize("counted", [False, True])
@pytest.mark.parametrize("few", [0, 1024])
def test_large_catalogue_gives_the_same_list(spark, data, monkeypatch, few, counted):
    items, pairs = data
    n = pairs.groupBy("pid").agg((F.col("pid") % 5 + F.count(F.lit(1))).alias("n"))

    def run(exclude, **kw):
        out = recommend_from_pairs(pairs, items, n, COLS, exclude_seen=exclude, pairs_distinct=True, **kw)
        return sorted((r["pid"], r["rank"], r["item"], round(r["cosine"], 9)) for r in out.collect())

    whole = {e: run(e) for e in (False, True)}
    monkeypatch.setattr(similarity, "FEW_QUERIES", few)
    monkeypatch.setattr(tiles, "ROWS_UNSEEN", -1 if counted else 1 << 22)
    monkeypatch.setattr(tiles, "BUFFER_ROWS", 10)
    for e in (False, True):
        assert run(e, broadcast_max_bytes=900) == whole[e]
    assert run(True, broadcast_max_bytes=900, hot_rows=6) == whole[True]


@pytest.mark.parametrize("exclude", [False, True])
def test_pairs_and_items_are_not_broadcast(spark, data, tmp_dir, exclude):
    """Few playlists over a large catalogue: what the driver gets does not grow with the pairs."""
    items, pairs = data
    pairs.withColumn("part", F.when(F.col("item") % 4 == 0, "test").otherwise("train")).write.parquet(f"{tmp_dir}/split")
    items.write.parquet(f"{tmp_dir}/items")
    split, items = spark.read.parquet(f"{tmp_dir}/split"), spark.read.parquet(f"{tmp_dir}/items")
    means = similarity._joined_means(split.where("part = 'train'").drop("part"), items, COLS, "pid")
    assert "BroadcastHashJoin" not in plan(means) and means.count() > 0
    whole = plan(evaluate(split, items, COLS, exclude_seen=exclude, broadcast_max_bytes=900))
    for line in whole.splitlines():
        assert not ("BroadcastHashJoin" in line and "[item#" in line), line
    assert "SortMergeJoin [item#" in whole


@pytest.mark.parametrize("exclude", [False, True])
def test_many_playlists_meet_a_large_catalogue_in_one_pass(spark, data, monkeypatch, exclude):
    """The hits are counted where the items are ranked: no list of recommendations is moved."""
    items, pairs = data
    split = pairs.withColumn("part", F.when(F.col("item") % 4 == 0, "test").otherwise("train"))
    split = split.unionByName(split.where("pid < 5")).unionByName(spark.createDataFrame([(1, None, "test"), (40, 99, "train"), (40, 1, "test"), (41, 2, "x")], split.schema))
    want = sorted(map(tuple, evaluate(split, items, COLS, exclude_seen=exclude).collect()))
    monkeypatch.setattr(similarity, "FEW_QUERIES", 0)
    monkeypatch.setattr(tiles, "BUFFER_ROWS", 10)
    got = evaluate(split, items, COLS, exclude_seen=exclude, broadcast_max_bytes=900)
    assert sorted(map(tuple, got.collect())) == want and any(r[3] for r in want)
    assert "Join" not in plan(got)


def test_a_tile_is_held_to_the_best_of_those_before(monkeypatch):
    rng = np.random.default_rng(4)
    x, q, ks = rng.normal(size=(4000, 8)), rng.normal(size=(40, 8)), np.full(40, 5)
    whole = similarity._best_rows(similarity._normalise(q), similarity._normalise(x), ks)
    given = []
    monkeypatch.setattr(similarity, "_best_rows", lambda *a, f=similarity._best_rows: given.append(len((out := f(*a))[0])) or out)
    tile = type("Tile", (), {})
    held = [tile() for _ in range(4)]
    for n, t in enumerate(held):
        t.value = np.arange(4000)[n::4], x[n::4]
    rows, found, _, rank = tiles._best(q, ks, held)
    assert [*zip(rows, found, rank)] == [*zip(whole[0], whole[1], whole[3])]
    assert given[0] == 200 and sum(given[1:]) < 500  # not five a query and tile


def test_few_queries_leave_the_catalogue_where_it_lies(spark, data, monkeypatch):
    """By kind: a fixed number of playlists over a growing catalogue."""
    items, pairs = data
    split = pairs.withColumn("part", F.when(F.col("item") % 4 == 0, "test").otherwise("train"))
    want = sorted(map(tuple, evaluate(split, items, COLS, exclude_seen=True).collect()))

    def collected(*_):
        raise AssertionError("the items came to the driver")

    monkeypatch.setattr(similarity, "_collected", collected)
    assert sorted(map(tuple, evaluate(split, items, COLS, exclude_seen=True, broadcast_max_bytes=900).collect())) == want


@pytest.mark.parametrize("kw", [{}, dict(broadcast_max_bytes=900), dict(hot_rows=5), dict(hot_rows=5, broadcast_max_bytes=900)])
def test_means_are_not_moved(spark, data, kw):
    """Columns run along with the pairs; the vectors are formed after the only shuffles."""
    items, pairs = data
    sized = pairs.join(pairs.groupBy("pid").agg(F.count(F.lit(1)).alias("size")), "pid")
    out = query_means_from_pairs(sized, items, COLS, pairs_distinct=True, carry=("size",), **kw)
    want = {r["pid"]: r for r in query_vectors(pairs, items, COLS).collect()}
    sizes = {r["pid"]: r["count"] for r in pairs.groupBy("pid").count().collect()}
    got = {r["pid"]: r for r in out.collect()}
    assert set(got) == set(want) and all(got[p]["size"] == sizes[p] for p in got)
    assert all(got[p][c] == pytest.approx(want[p][c]) for p in want for c in [*COLS, "n_known"])
    if "hot_rows" not in kw:
        assert "InPandas" in plan(out).split("Exchange")[0]


def test_dealt_rows_are_bucketed_as_they_stand(spark):
    rows = spark.range(200).select(F.col("id").alias("pid"), (F.col("id") * 3).alias("v"))
    b = write_bucketed(rows.repartition(4, "pid"), "pid", 4, hot_rows=None, dealt=True)
    assert b.hot is None and b.hot_keys.count() == 0 and b.cold.count() == 200
    assert len(b.cold.inputFiles()) <= 4
    other = write_bucketed(rows, "pid", 4)
    joined = b.cold.join(other.cold.hint("merge"), "pid")
    assert joined.count() == 200 and "Exchange" not in plan(joined)


def test_a_slice_is_one_file(spark, tmp_dir):
    track = "struct('x:track:' || (id * 7 + i) % 40 AS track_uri, CAST(i AS INT) AS pos, 'n' AS track_name, 'a' AS artist_name, 'u' AS artist_uri, 'l' AS album_name, 'm' AS album_uri, 1L AS duration_ms)"
    lists = spark.range(0, 400, 1, 8).selectExpr("'s' || id % 20 AS slice", "id AS ppos", f"transform(sequence(0, 5), i -> {track}) AS tracks")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = first_seen_tracks(lists)
        write_slice_tables(spark.range(20).selectExpr("'s' || id AS slice", "id"), found, tmp_dir)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{tmp_dir}/tracks/slice=*/*.parquet")) == 20
    assert found.count() == found.select("slice", "track_uri").distinct().count()


def test_files_of_a_step_follow_from_the_cores(spark, tmp_dir, monkeypatch):
    assert incremental.step_files(spark) == 30 * spark.sparkContext.defaultParallelism
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for n in range(5):
        with open(f"{raw}/mpd.slice.{n}-{n}.json", "w") as f:
            json.dump({"playlists": [{"pid": n, "name": "x", "tracks": [{"track_uri": "x:track:t1", "pos": 0}]}]}, f)
    listed = []
    monkeypatch.setattr(incremental, "slices_to_clean", lambda *a, f=incremental.slices_to_clean: listed.append(1) or f(*a))
    assert len(incremental.clean_new_slices(spark, raw, f"{tmp_dir}/out", max_files=2)) == 5
    assert len(listed) == 2  # before the steps and after the last


def test_waves_are_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_WAVES", 3)
    made = []
    monkeypatch.setattr(ledger, "_answers", lambda *a, f=ledger._answers: made.append(1) or f(*a))
    schema = spark.createDataFrame([], "id long, size int").schema
    records = spark.range(300).select("id", F.col("id").cast("int").alias("size"))

    def fetch(call, rows):
        by = dict(zip(rows["id"], rows["size"]))
        return [{"id": i, "size": int(by[i])} if i in by else None for i in call]

    got = ledger.enrich_with_ledger(spark.range(0, 600, 2), "id", fetch, schema, f"{tmp_dir}/l", call_size=10, ids_per_partition=20,
                                    wave_ids=10, records=records, record_key="id")
    assert {(r["id"], r["size"]) for r in got.collect()} == {(i, i) for i in range(0, 300, 2)}
    assert len(made) == 3


def test_a_store_of_many_ranges_has_few_files(spark, tmp_dir):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    store.upsert(spark, tmp_dir, rows, "k", max_rows=20)
    assert store.manifest(spark, tmp_dir).count() >= 128
    assert len(glob.glob(f"{tmp_dir}/data/**/*.parquet", recursive=True)) <= 8
    store.upsert(spark, tmp_dir, rows.where("k < 2").withColumn("v", F.lit(5)), "k", max_rows=20)
    assert store.read(spark, tmp_dir).agg(F.sum("v"), F.count("k")).first()[:] == (4008, 4000)


def test_slices_take_little_disk(spark, tmp_dir):
    """Raw files are written compressed, and neither playlists nor entries are written or shuffled to be cleaned."""
    orders = spark.range(2500).selectExpr("id AS o_orderkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus",
                                          "timestamp_ntz'2020-01-01' AS o_orderdate", "id % 9 AS o_custkey")
    orders = orders.unionByName(orders.where("o_orderkey = 7")).unionByName(orders.where("o_orderkey = 8").withColumn("o_orderkey", F.lit(None).cast("long")))
    lines = spark.range(5000).selectExpr("IF(id = 4, NULL, id div 4) AS l_orderkey", "id % 50 AS l_partkey", "id % 7 AS l_suppkey",
                                         "cast(id % 4 AS int) AS l_linenumber", "'R' AS l_returnflag", "3.0D AS l_quantity")
    for name, df in (("orders", orders), ("lineitem", lines)):
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    files._write_slices(spark, tmp_dir, f"{tmp_dir}/raw")
    raw = glob.glob(f"{tmp_dir}/raw/file=*/part-*")
    assert len(raw) == 2 and all(f.endswith(".gz") for f in raw)
    read = read_raw_files(spark, f"{tmp_dir}/raw", lambda p: F.regexp_extract(p, "file=([^/]+)/", 1))
    tracks = first_seen_in_files(read)
    assert "Exchange" not in tracks._jdf.queryExecution().executedPlan().toString()
    clean_files(read, f"{tmp_dir}/out")
    stored = spark.read.parquet(f"{tmp_dir}/out/playlists")
    assert stored.count() == 1251 and stored.where("pid = 7").count() == 2 and stored.where("pid = 1 AND size(tracks) = 3").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/out/tracks").groupBy("slice").count().collect() and tracks.count() == 100


def test_first_seen_in_files_is_first_seen(spark, tmp_dir):
    def entry(rng):
        return None if rng.random() < 0.1 else {"track_uri": rng.choice([None, *[f"x:track:{i}" for i in range(6)]]), "track_name": f"n{rng.random()}"}

    rng = random.Random(4)
    def document():
        lists = [None if rng.random() < 0.1 else {"pid": p, "tracks": None if rng.random() < 0.2 else [entry(rng) for _ in range(rng.randrange(12))]}
                 for p in range(rng.randrange(6))]
        return {"playlists": None if rng.random() < 0.1 else lists}

    for n in range(12):
        for twice in range(1 + (n == 3)):  # a name that two files bear
            os.makedirs(f"{tmp_dir}/{twice}", exist_ok=True)
            with open(f"{tmp_dir}/{twice}/mpd.slice.{n}-{n}.json", "w") as f:
                json.dump(document() if n != 3 else {"playlists": [{"pid": 1, "tracks": [{"track_uri": "x:track:1", "pos": 0}]}]}, f)
    raw = read_raw_files(spark, [f"{tmp_dir}/0", f"{tmp_dir}/1"])
    rows = lambda df: sorted(map(repr, df.collect()))
    alone = raw.where("slice <> 'mpd.slice.3-3'")
    assert rows(first_seen_in_files(alone)) == rows(first_seen_tracks(playlists_of(alone)))
    clean_files(raw, f"{tmp_dir}/out")
    assert spark.read.parquet(f"{tmp_dir}/out/tracks").where("slice = 'mpd.slice.3-3'").count() == 1


@pytest.mark.parametrize("exclude", [False, True])
def test_outranked_held_out_items_are_not_ranked(exclude, monkeypatch):
    """Playlists whose held-out items many candidates come before don't meet the whole catalogue; hits stay those of the whole ranking."""
    rng = np.random.default_rng(5)
    t, d, n = 4000, 16, 300
    ids = np.sort(np.r_[np.arange(t - 40), rng.integers(0, t - 40, 40)])  # some ids have copies
    raw = rng.normal(size=(t, d))
    raw[0] = 0  # scores 0 against everything
    unit = similarity._normalise(raw)
    rows = []
    for p in range(n):
        train = rng.choice(t, rng.integers(1, 4), replace=False)
        near = np.argsort(-(unit @ raw[train].mean(0)))
        test = ids[near[rng.integers(0, 6, 2)]] if p % 6 == 0 else rng.integers(0, t + 500, 2)  # some hit, some are unknown
        rows += [(p, 0, i) for i in np.unique(ids[train])] + [(p, 1, i) for i in np.sort(test)]
    rows += [(n, 0, 5), (n + 1, 1, 5), (n + 2, 0, 10 ** 6), (n + 2, 1, 5)]  # nothing held out, no train item, none known
    chunk = pd.DataFrame(rows, columns=["pid", "_role", "item"]).assign(_has=True)
    uniq, first, copies = np.unique(ids, return_index=True, return_counts=True)
    catalogue = ids, unit, uniq, np.add.reduceat(raw, first, axis=0), copies.astype(float)
    tile = [types.SimpleNamespace(value=(ids[s::2], raw[s::2])) for s in range(2)]
    monkeypatch.setattr(tiles, "_each", lambda held: (x if isinstance(x, tuple) else x.value for x in held))
    ranked = []
    monkeypatch.setattr(similarity, "_best_rows", lambda q, *a, f=similarity._best_rows, **k: ranked.append(len(q)) or f(q, *a, **k))

    def both():
        ranked.clear()
        return (evaluation._scored(chunk, catalogue, "pid", exclude), evaluation._scored_by_tile(chunk, tile, d, "pid", exclude)), max(ranked)

    (one, two), met = both()
    monkeypatch.setattr(evaluation, "_outranked", lambda v, *a: np.zeros(len(v), bool))
    (whole, tiled), most = both()
    pd.testing.assert_frame_equal(one, whole)
    pd.testing.assert_frame_equal(two, tiled)
    pd.testing.assert_frame_equal(one, two)
    assert whole["hits"].sum() > 20 and most == n and met < n // 2
