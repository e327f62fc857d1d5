"""G4 hold-out split; the skew-safe rank equals a plain window rank."""

import hashlib
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from setlist.operators.split import hash_rank, holdout_split, sample_n


def _md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def test_g4_holdout(spark):
    pairs = spark.createDataFrame([(1, x) for x in "abcde"] + [(2, "z")], "pid long, item string")
    out = {(r["pid"], r["item"]): r["part"] for r in holdout_split(pairs, seed=42).collect()}
    assert {k[1] for k, v in out.items() if v == "test"} == {"e", "a"}
    assert {k[1] for k, v in out.items() if v == "train"} == {"b", "c", "d"}
    assert (2, "z") not in out            # single-item playlist left out
    assert _md5(42, 1, "e").startswith("618af127")


def test_holdout_sizes(spark):
    rows = [(n, f"i{j}") for n in (2, 4, 5, 8) for j in range(n)]
    pairs = spark.createDataFrame(rows, "pid long, item string")
    got = {r["pid"]: r["n"] for r in holdout_split(pairs).filter("part = 'test'")
           .groupBy("pid").agg(F.count("*").alias("n")).collect()}
    assert got == {2: 1, 4: 1, 5: 2, 8: 2}
    # parts are disjoint and together the input
    full = holdout_split(pairs)
    assert full.count() == len(rows) and full.select("pid", "item").distinct().count() == len(rows)


def test_hash_rank_matches_window_with_hot_group(spark):
    random.seed(7)
    rows = [(0, i) for i in range(3000)]                         # one hot group
    rows += [(g, random.randrange(10**6)) for g in range(1, 400) for _ in range(random.randrange(1, 9))]
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame(rows, "g long, k long")
    got = hash_rank(df, ["g"], ["k"], seed=3, big_group_rows=1000).select("g", "k", "_rank", "_size")
    plain = hash_rank(df, ["g"], ["k"], seed=3).select("g", "k", "_rank", "_size")
    h = F.md5(F.concat_ws("|", F.lit("3"), F.col("g").cast("string"), F.col("k").cast("string")))
    w = Window.partitionBy("g").orderBy(h, "k")
    want = df.select("g", "k", F.row_number().over(w).cast("long").alias("_rank"),
                     F.count("*").over(Window.partitionBy("g")).alias("_size"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert plain.exceptAll(want).count() == 0 and want.exceptAll(plain).count() == 0


def test_sample_n_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = sorted(r[0] for r in sample_n(df, 17, ["k"], 5).collect())
    b = sorted(r[0] for r in sample_n(df, 17, ["k"], 5).collect())
    assert len(a) == 17 and a == b
    want = sorted(range(1000), key=lambda k: (_md5(5, k), k))[:17]
    assert a == sorted(want)
    assert math.isclose(len(a), 17)
