"""Long lists in bounded rows."""

import random

from pyspark.sql import functions as F

from setlist.operators.segments import segment_items, segments


def test_segments_equal_lists(spark):
    rng = random.Random(7)
    rows = [("hot", rng.randrange(500), f"i{rng.randrange(900)}") for _ in range(3000)] + [("hot", 3, "same")] * 400
    rows += [(p, rng.choice([None, 1, 2]), rng.choice(["a", "b", None])) for p in (None, "x", "y") for _ in range(20)]
    cut = segments(spark.createDataFrame(rows, "pid string, pos int, item string"), ["pid"], "item", ["pos"], rows=64).cache()
    assert max(r[0] for r in cut.select(F.size("ids")).collect()) == 64
    want = {}
    for p in {r[0] for r in rows}:
        want[p] = [i for _, _, i in sorted((o is not None, o or 0, i) for q, o, i in rows if q == p and i is not None)]
    for p, items in want.items():
        mine = sorted((r["segment"], r["ids"]) for r in cut.collect() if r["pid"] == p)
        assert [s for s, _ in mine] == list(range(-(-len(items) // 64)))
        assert [i for _, ids in mine for i in ids] == items
    back = segment_items(cut, ["pid"], rows=64).collect()
    assert sorted((str(r["pid"]), r["pos"], r["item"]) for r in back) == sorted((str(p), n, i) for p, v in want.items() for n, i in enumerate(v))


def test_no_segments_of_nothing(spark):
    assert segments(spark.createDataFrame([], "pid long, item string"), ["pid"], "item").count() == 0
