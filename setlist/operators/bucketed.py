"""Tables stored by key, read and joined without a shuffle.

The split and the query vectors are read by playlist again and again.  Stored
in buckets by that key, joins and aggregates by it need no exchange.  Keys of
more than ``hot_rows`` rows would fill one bucket, so they stand in a plain
table beside; there Spark plans the join, and its adaptive execution may split
it.  The hot list holds at most rows / ``hot_rows`` keys and is found with one
partial count.

Null keys are one key like any other; an empty table gives empty tables.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.session import checkpoint_dir, materialize

HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Bucketed:
    """``cold`` is stored in buckets by ``key``; ``hot`` (None if no key is) holds the
    rows of the keys listed in ``hot_keys`` (column ``_hot``)."""
    key: str
    cold: DataFrame
    hot: DataFrame | None
    hot_keys: DataFrame


def write_bucketed(df: DataFrame, key: str, buckets: int | None = None, hot_rows: int | None = HOT_ROWS, dealt: bool = False) -> Bucketed:
    """Store ``df`` in ``buckets`` (default: the session's shuffle partitions) by ``key``, a file each.

    ``hot_rows`` None: keys are distinct, none is looked for.  ``dealt``: the rows stand
    in ``buckets`` partitions by ``key`` already and are written as they stand; were they
    not, there would be more files, and the same table."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = spark.createDataFrame([], T.StructType([T.StructField("_hot", df.schema[key].dataType)])) if hot_rows is None else materialize(df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
                       .where(F.col("_n") > hot_rows).select("_hot"))
    hot = None
    cold = df
    if hot_rows is not None and not many.isEmpty():
        alike = F.col(key).eqNullSafe(F.col("_hot"))
        hot = materialize(df.join(many, alike, "left_semi"))
        cold = df.join(many, alike, "left_anti")
    name = f"setlist_{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_dir(spark), "setlist-tables", name)
    ((cold if dealt else cold.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(name))
    return Bucketed(key, spark.table(name), hot, many)


def _both(stored: Bucketed) -> list[DataFrame]:
    return [stored.cold] + ([stored.hot] if stored.hot is not None else [])


def count_by_key(stored: Bucketed, name: str) -> DataFrame:
    """Rows per key; a key stands in one of the two tables, so the union needs no sum."""
    parts = [t.groupBy(stored.key).agg(F.count(F.lit(1)).alias(name)) for t in _both(stored)]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def join_by_key(left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on their common key name (inner or left).

    Cold rows meet cold rows bucket by bucket.  A key may be hot on one side
    only: those rows are joined apart.
    """
    if left.key != right.key:
        raise ValueError("both tables must be stored by the same key")
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    key = left.key
    if right.hot is None:
        out = left.cold.join(right.cold.hint("merge"), key, how)
        if left.hot is not None:
            out = out.unionByName(left.hot.join(right.cold, key, how))
        return out
    out = None
    for side in _both(left):
        # A key of ``right`` is cold or hot, never both.
        some = side.join(right.hot_keys, side[key] == F.col("_hot"), "left_anti")
        met = some.join(right.cold.hint("merge"), key, how).unionByName(side.join(right.hot, key, "inner"))
        out = met if out is None else out.unionByName(met)
    return out
