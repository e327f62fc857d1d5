"""Keyed upsert on a parquet table.

``upsert_by_key`` is the pure plan: target rows whose key has no update,
plus the latest update per key.  ``write_upsert`` keeps the table in folders
by key hash and replaces, through Spark's own commit, only the folders that
updates fall into.  The merged rows are written to the shared checkpoint
folder first, so nothing is overwritten while it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.operators.dedup import dedup_any, dedup_first
from setlist.session import materialize
from setlist.sources.readers import dataset_exists

#: Folder column of a stored table, and the folders of a new one.
FOLDER = "_key_hash"
FOLDERS = 64


def latest_per_key(updates: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """One update per key: the last by ``order_col`` (ties broken by the other
    atomic columns, so the choice is repeatable), or any when no order is given."""
    if order_col is None:
        return dedup_any(updates, [key])
    ties = [f.name for f in updates.schema.fields
            if f.name not in (key, order_col) and isinstance(f.dataType, T.AtomicType)]
    return dedup_first(updates, [key], [(order_col, "desc")] + [(c, "desc") for c in ties])


def upsert_by_key(target: DataFrame, updates: DataFrame, key: str,
                  order_col: str | None = None) -> DataFrame:
    """Replace whole rows by key, insert new keys (ReplaceOne with upsert).

    Applying the same updates twice gives the same table; a null key is one
    key.  Columns: the union of both sides (missing ones null).
    """
    latest = latest_per_key(updates, key, order_col)
    keys = latest.select(F.col(key).alias("_updated"))
    kept = target.join(keys, F.col(key).eqNullSafe(F.col("_updated")), "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_upsert`` keeps at ``path``, with every column it ever had."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(FOLDER)


def write_upsert(spark: SparkSession, path: str, updates: DataFrame, key: str,
                 schema: T.StructType, order_col: str | None = None) -> DataFrame:
    """Upsert ``updates`` into the table at ``path`` (created if absent, with
    the columns of ``schema``).  Stored columns that the updates lack stay;
    new ones are null in stored rows.  Returns the new table."""
    folder = F.pmod(F.xxhash64(F.col(key)), F.lit(FOLDERS)).cast("int")
    fresh = materialize(updates.withColumn(FOLDER, folder))
    if dataset_exists(spark, path):
        stored = spark.read.option("mergeSchema", True).parquet(path)
        touched = fresh.select(FOLDER).distinct()  # at most FOLDERS rows
        target = stored.join(F.broadcast(touched), FOLDER, "left_semi")
    else:
        target = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(FOLDER, T.IntegerType())]))
    merged = materialize(upsert_by_key(target, fresh, key, order_col))
    (merged.repartition(FOLDER).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(FOLDER).parquet(path))
    return read_store(spark, path)
