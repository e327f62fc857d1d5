"""G5 recommend and hit rate; both scoring strategies agree with brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from setlist.operators.evaluate import evaluate
from setlist.operators.similarity import item_vectors, query_vectors, recommend

FEATS = ["x", "y", "z"]
ITEMS = [("A", 1.0, 0.0, 0.0), ("B", 0.0, 1.0, 0.0), ("C", 1.0, 1.0, 0.0), ("D", 0.0, 0.0, 1.0),
         ("E", 2.0, 2.0, 0.0), ("F", 0.0, 0.0, 0.0), ("G", None, 1.0, 0.0)]
# (playlist, train, test, n)
PLAYLISTS = [(1, "AB", "CD", 2), (2, "A", "C", 1), (3, "Z", "A", 1), (4, "AB", "", 0), (5, "AAB", "CC", 2)]


@pytest.fixture()
def items(spark):
    return item_vectors(spark.createDataFrame(ITEMS, "id string, x double, y double, z double"), "id", FEATS)


def _split(spark):
    rows = []
    for pid, train, test, _ in PLAYLISTS:
        rows += [(pid, i, "train") for i in train] + [(pid, i, "test") for i in test]
    return spark.createDataFrame(rows, "pid long, item string, part string")


def _recs(spark, items, exclude_seen, **kw):
    split = _split(spark)
    train = split.filter("part = 'train'").drop("part")
    qv = query_vectors(train, items, FEATS)
    n = spark.createDataFrame([(p, n) for p, _, _, n in PLAYLISTS], "pid long, n long")
    out = recommend(qv.join(n, "pid"), items, "n", FEATS,
                    exclude=train if exclude_seen else None, **kw)
    return {(r["pid"], r["rank"]): (r["item"], round(r["cosine"], 6)) for r in out.collect()}


@pytest.mark.parametrize("strategy", [dict(strategy="broadcast"),
                                      dict(strategy="tiled", tile_rows=2, qblock_rows=2)])
def test_g5_recommend(spark, items, strategy):
    assert items.count() == 6                                      # G dropped (D6)
    got = _recs(spark, items, False, **strategy)
    assert got == {(1, 1): ("C", 1.0), (1, 2): ("E", 1.0), (2, 1): ("A", 1.0),
                   (5, 1): ("C", 1.0), (5, 2): ("E", 1.0)}
    got = _recs(spark, items, True, **strategy)
    assert got == {(1, 1): ("C", 1.0), (1, 2): ("E", 1.0), (2, 1): ("C", 0.707107),
                   (5, 1): ("C", 1.0), (5, 2): ("E", 1.0)}


def test_n_larger_than_candidates(spark, items):
    qv = query_vectors(spark.createDataFrame([(1, "A"), (1, "B")], "pid long, item string"), items, FEATS)
    out = recommend(qv, items, 10, FEATS).orderBy("rank").collect()
    assert [r["item"] for r in out] == ["C", "E", "A", "B", "D", "F"]      # D4: all usable items
    assert out[-1]["cosine"] == 0.0                                        # zero vector scores 0


@pytest.mark.parametrize("exclude_seen", [False, True])
def test_g5_hit_rate(spark, items, exclude_seen):
    ev = {r["pid"]: r for r in evaluate(_split(spark), items, FEATS, exclude_seen=exclude_seen).collect()}
    assert ev[1]["hit_rate"] == 0.5 and ev[5]["hit_rate"] == 0.5
    assert ev[2]["hit_rate"] == (1.0 if exclude_seen else 0.0)
    assert ev[3]["hit_rate"] == 0.0 and ev[3]["n_known"] == 0              # D5
    assert ev[4]["hit_rate"] is None                                       # D3
    assert ev[5]["n_test"] == 2                                            # duplicates in divisor


def test_strategies_agree_with_brute_force(spark):
    rng = np.random.default_rng(3)
    n_items, n_q, d = 300, 60, 8
    X = rng.normal(size=(n_items, d))
    Q = rng.normal(size=(n_q, d))
    Q[0] = 0.0
    cols = [f"f{i}" for i in range(d)]
    items = spark.createDataFrame([(int(i), *map(float, X[i])) for i in range(n_items)],
                                  ", ".join(["item long"] + [f"{c} double" for c in cols]))
    qs = spark.createDataFrame([(int(i), *map(float, Q[i])) for i in range(n_q)],
                               ", ".join(["pid long"] + [f"{c} double" for c in cols]))
    seen = spark.createDataFrame([(int(p), int(i)) for p in range(n_q) for i in rng.choice(n_items, 5)],
                                 "pid long, item long")
    xn = X / np.linalg.norm(X, axis=1, keepdims=True)
    norms = np.linalg.norm(Q, axis=1, keepdims=True)
    S = np.divide(Q, norms, out=np.zeros_like(Q), where=norms > 0) @ xn.T
    seen_set = {(r[0], r[1]) for r in seen.collect()}
    for excl in (None, seen):
        want = {}
        for p in range(n_q):
            order = sorted(range(n_items), key=lambda i: (-S[p, i], i))
            if excl is not None:
                order = [i for i in order if (p, i) not in seen_set]
            for rank, i in enumerate(order[:7], 1):
                want[(p, rank)] = i
        for kw in (dict(strategy="broadcast"), dict(strategy="tiled", tile_rows=70, qblock_rows=16)):
            got = {(r["pid"], r["rank"]): r["item"]
                   for r in recommend(qs, items, 7, cols, exclude=excl, **kw).collect()}
            assert got == want, kw


def test_exclude_never_returns_train(spark, items):
    split = _split(spark)
    train = split.filter("part = 'train'").drop("part")
    qv = query_vectors(train, items, FEATS)
    recs = recommend(qv, items, 10, FEATS, exclude=train)
    assert recs.join(train, ["pid", "item"], "left_semi").count() == 0
    assert recs.filter(F.col("cosine") > 1.0 + 1e-9).count() == 0


def test_query_vectors_hot_path_matches(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(50, 4))
    cols = ["a", "b", "c", "d"]
    items = spark.createDataFrame([(int(i), *map(float, X[i])) for i in range(50)],
                                  "item long, a double, b double, c double, d double")
    pairs = [(0, int(i)) for i in range(50)] + [(1, 3), (1, 4), (2, 7), (2, 7)]
    pdf = spark.createDataFrame(pairs, "pid long, item long")
    plain = {r["pid"]: r for r in query_vectors(pdf, items, cols).collect()}
    salted = {r["pid"]: r for r in query_vectors(pdf, items, cols, hot_rows=5, salts=4).collect()}
    assert set(plain) == set(salted) == {0, 1, 2}
    for p, want in ((0, X.mean(axis=0)), (1, X[[3, 4]].mean(axis=0)), (2, X[7])):
        assert np.allclose([salted[p][c] for c in cols], want)
        assert np.allclose([plain[p][c] for c in cols], want)
    assert salted[0]["n_known"] == 50 and salted[2]["n_known"] == 1


@pytest.mark.parametrize("seed", [11, 12])
def test_ties_and_per_row_n_match_brute_force(spark, seed):
    """Integer vectors give many exact cosine ties; the cut must follow item id."""
    rng = np.random.default_rng(seed)
    n_items, n_q, d = 120, 40, 3
    X = rng.integers(0, 3, size=(n_items, d)).astype(float)
    Q = rng.integers(0, 3, size=(n_q, d)).astype(float)
    ns = rng.integers(0, 9, size=n_q)
    cols = ["a", "b", "c"]
    items = spark.createDataFrame([(int(i), *map(float, X[i])) for i in range(n_items)],
                                  "item long, a double, b double, c double")
    qs = spark.createDataFrame([(int(p), *map(float, Q[p]), int(ns[p])) for p in range(n_q)],
                               "pid long, a double, b double, c double, n long")
    seen_rows = [(int(p), int(i)) for p in range(n_q) for i in rng.choice(n_items, 4, replace=False)]
    seen = spark.createDataFrame(seen_rows, "pid long, item long")

    def unit(m):
        nr = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, nr, out=np.zeros_like(m), where=nr > 0)
    S = unit(Q) @ unit(X).T
    for excl in (None, seen):
        want = {}
        for p in range(n_q):
            order = sorted(range(n_items), key=lambda i: (-round(S[p, i], 12), i))
            if excl is not None:
                order = [i for i in order if (p, i) not in set(seen_rows)]
            for rank, i in enumerate(order[:ns[p]], 1):
                want[(p, rank)] = i
        for kw in (dict(strategy="broadcast"), dict(strategy="tiled", tile_rows=25, qblock_rows=8)):
            got = {(r["pid"], r["rank"]): r["item"]
                   for r in recommend(qs, items, "n", cols, exclude=excl, **kw).collect()}
            assert got == want, (kw, excl is not None)


@pytest.mark.parametrize("variant", ["plain", "hot", "large_catalogue", "small_batches"])
def test_fused_matches_two_step(spark, variant):
    from setlist.operators.similarity import recommend_from_pairs
    rng = np.random.default_rng(21)
    n_items, d = 80, 4
    X = rng.integers(-2, 3, size=(n_items, d)).astype(float)
    cols = ["a", "b", "c", "d"]
    rows = [(int(i), *map(float, X[i])) for i in range(n_items)] + [(5, 1.0, 1.0, 1.0, 1.0)]  # id 5 twice
    items = spark.createDataFrame(rows, "item long, a double, b double, c double, d double")
    pairs = [(int(p), int(i)) for p in range(60) for i in rng.choice(n_items + 10, rng.integers(1, 12))]
    pairs += [(999, int(i)) for i in range(40)]                       # one larger playlist
    pdf = spark.createDataFrame(pairs, "pid long, item long")
    nreq = spark.createDataFrame([(p, int(rng.integers(0, 7))) for p in list(range(60)) + [999]],
                                 "pid long, n long")
    kw = {"plain": {}, "hot": dict(hot_rows=20, salts=3),
          "large_catalogue": dict(broadcast_max_bytes=500), "small_batches": {}}[variant]
    if variant == "small_batches":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for excl in (False, True):
            for n in (4, nreq):
                got = {(r["pid"], r["rank"]): (r["item"], round(r["cosine"], 9)) for r in
                       recommend_from_pairs(pdf, items, n, cols, exclude_seen=excl, **kw).collect()}
                qv = query_vectors(pdf, items, cols)
                if isinstance(n, int):
                    ref = recommend(qv, items, n, cols, exclude=pdf if excl else None)
                else:
                    ref = recommend(qv.join(n, "pid"), items, "n", cols, exclude=pdf if excl else None)
                want = {(r["pid"], r["rank"]): (r["item"], round(r["cosine"], 9)) for r in ref.collect()}
                assert got == want, (variant, excl, isinstance(n, int))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("variant", ["plain", "hot", "large_catalogue", "small_batches"])
def test_fused_means_match_query_vectors(spark, variant):
    from setlist.operators.similarity import query_means_from_pairs
    rng = np.random.default_rng(8)
    X = rng.normal(size=(60, 3))
    items = spark.createDataFrame([(int(i), *map(float, X[i])) for i in range(60)] + [(4, 1.0, 2.0, 3.0)],
                                  "item long, a double, b double, c double")
    pairs = [(int(p), int(i)) for p in range(50) for i in rng.choice(70, rng.integers(1, 9))]
    pairs += [(777, int(i)) for i in range(45)]
    pdf = spark.createDataFrame(pairs, "pid long, item long")
    kw = {"plain": {}, "hot": dict(hot_rows=20, salts=3), "large_catalogue": dict(broadcast_max_bytes=100),
          "small_batches": {}}[variant]
    if variant == "small_batches":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {r["pid"]: r for r in query_means_from_pairs(pdf, items, ["a", "b", "c"], **kw).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r["pid"]: r for r in query_vectors(pdf, items, ["a", "b", "c"]).collect()}
    assert set(got) == set(want)
    for p in want:
        assert got[p]["n_known"] == want[p]["n_known"]
        assert np.allclose([got[p][c] for c in "abc"], [want[p][c] for c in "abc"])
