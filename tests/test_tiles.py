"""The tiled recommender: means and best items whatever the tiles are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from setlist.operators import tiles
from setlist.operators.similarity import query_vectors, recommend_from_pairs

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    rows = [(f"i{i:02d}", *map(float, rng.integers(-3, 4, 2))) for i in range(40)] + [("i05", 1.0, 1.0)] * 30  # an id that is a third of the catalogue
    pairs = {(int(p), f"i{i:02d}") for p in range(25) for i in rng.choice(45, rng.integers(1, 9))}
    pairs |= {(p, "i07") for p in range(60)}  # an item that most playlists hold
    return (spark.createDataFrame(rows, "item string, a double, b double"),
            spark.createDataFrame(sorted(pairs), "pid long, item string"))


@pytest.mark.parametrize("n", [1, 3, 50])
def test_means(data, n):
    items, pairs = data
    got = {r["pid"]: (r["n_known"], r["a"], r["b"]) for r in tiles.means(pairs, items, COLS, "pid", n).collect()}
    want = {r["pid"]: (r["n_known"], r["a"], r["b"]) for r in query_vectors(pairs, items, COLS).collect()}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p]) for p in want)


@pytest.mark.parametrize("exclude", [False, True])
def test_any_bound_gives_the_same_list(data, exclude):
    items, pairs = data
    def run(bound):
        out = recommend_from_pairs(pairs, items, 4, COLS, exclude_seen=exclude, broadcast_max_bytes=bound)
        return sorted((r["pid"], r["rank"], r["item"], round(r["cosine"], 9)) for r in out.collect())
    whole = run(1 << 20)
    assert whole and run(1500) == whole == run(400)


def test_empty_sides(data):
    items, pairs = data
    assert tiles.means(pairs.limit(0), items, COLS, "pid", 3).count() == 0
    assert tiles.means(pairs, items.limit(0), COLS, "pid", 3).count() == 0
    qv = tiles.means(pairs, items, COLS, "pid", 2).withColumns({"_k": F.lit(2).cast("long"), "_n": F.lit(2).cast("long")})
    assert tiles.best(qv, items.limit(0), COLS, "pid", 2).count() == 0


def test_no_item_is_shuffled_for_the_queries(data):
    items, pairs = data
    qv = tiles.means(pairs, items, COLS, "pid", 2).withColumns({"_k": F.lit(2).cast("long"), "_n": F.lit(2).cast("long")})
    plan = tiles.best(qv, items, COLS, "pid", 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
