"""Counting reports.

Multi-measure reports are computed in one aggregation over a tagged union
instead of joining one-row results, so every report is a single shuffle on
the key with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_non_null(df: DataFrame, col: str) -> DataFrame:
    """Rows and non-null values of one column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.col(col)).alias("n_non_null"))


def progress_counts(total: DataFrame, done: DataFrame, key: str,
                    done_key: str | None = None) -> DataFrame:
    """Distinct ids wanted, done, and remaining — one row.

    Counts distinct values the way a set does (null counts once).
    """
    done_key = done_key or key
    tagged = (total.select(F.col(key).alias("k"), F.lit(1).alias("t"), F.lit(0).alias("d"))
              .unionByName(done.select(F.col(done_key).alias("k"), F.lit(0).alias("t"),
                                       F.lit(1).alias("d"))))
    per_key = tagged.groupBy("k").agg(F.max("t").alias("t"), F.max("d").alias("d"))
    return per_key.agg(
        F.sum("t").cast("long").alias("n_total"),
        F.sum("d").cast("long").alias("n_done"),
        F.count(F.when((F.col("t") == 1) & (F.col("d") == 0), 1)).alias("n_remaining"))


def reconcile_counts(new: DataFrame, stored: DataFrame, total: DataFrame) -> DataFrame:
    """New rows + stored rows against the total, one row with a balance flag."""
    tagged = (new.select(F.lit("new").alias("s"))
              .unionByName(stored.select(F.lit("stored").alias("s")))
              .unionByName(total.select(F.lit("total").alias("s"))))
    out = tagged.agg(*[F.count(F.when(F.col("s") == s, 1)).alias(f"n_{s}")
                       for s in ("new", "stored", "total")])
    return out.withColumn("balanced", (F.col("n_new") + F.col("n_stored")) == F.col("n_total"))


def most_featured(df: DataFrame, col: str, n: int = 10, weight: str | None = None) -> DataFrame:
    """The ``n`` most frequent values (ties by value) — a top-k report.
    ``weight`` names a count made before (rows counted ahead of a join).

    Hash aggregate with partial counts, then ``orderBy + limit`` which Spark
    runs as a per-partition top-k (TakeOrderedAndProject).
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return (df.groupBy(col).agg(total.alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(n))


def bucket_of(col: str, lo: float, hi: float, bins: int):
    """Equal-width bucket 1..bins; below ``lo`` → 0, at or above ``hi`` → bins+1
    (``width_bucket`` semantics, written out so every engine computes the
    same floating-point expression)."""
    v = F.col(col).cast("double")
    inner = F.floor((v - F.lit(float(lo))) * F.lit(float(bins)) / F.lit(float(hi - lo))) + 1
    return (F.when(v.isNull(), None).when(v < lo, 0).when(v >= hi, bins + 1)
            .otherwise(inner).cast("long"))


def feature_histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int = 10) -> DataFrame:
    """Distribution of one feature over equal-width bins."""
    return (df.select(bucket_of(col, lo, hi, bins).alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
