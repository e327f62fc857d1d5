"""A keyed table with versions (K7, W3): an upsert rewrites only what it touches.

Rows belong to ranges, the leading bits of their key's hash.  An upsert writes its
ranges as one folder, sorted by range, in files of ``FILE_ROWS`` rows or so, however
many ranges there are.  A manifest names
the folder of every range of hashes; it is written last, and the table is what
the newest whole manifest says.  An upsert finds the ranges of its keys, merges
those ranges into a new folder, splits a range that would exceed
``max_rows`` and writes the next manifest.  Nothing is ever replaced, so a
reader keeps the version it began with, an upsert that dies leaves the table
as it was, and one changed key rewrites at most ``max_rows`` rows.

Keys are distinct and hashed, so no range is hot.  One writer at a time; a
manifest that exists is never overwritten.  The driver holds folder names, as it
does for any scan.
"""

from __future__ import annotations

import json
import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.operators.upsert import latest_per_key, upsert_by_key
from setlist.session import materialize
from setlist.sources.readers import _jfs

#: Rows of a range before it is split.
MAX_ROWS = 1_000_000
_BITS, _PREFIX, _GEN = "_bits", "_prefix", "_gen"
_MANIFEST = f"{_BITS} int, {_PREFIX} bigint, {_GEN} string, n_rows bigint, columns string"
#: Ranges whose sizes are broadcast; above it they are joined.
_FEW = 100_000
#: Rows of a file at least, where ranges are smaller; ranges that a scan is asked for by name.
FILE_ROWS = 100_000
_NAMED = 64


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _jfs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    found = sorted(int(n) for n in _names(spark, f"{path}/manifest") if n.isdigit())
    return [v for v in found if "_SUCCESS" in _names(spark, f"{path}/manifest/{v:010d}")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The ranges of a version: bits, prefix, folder (null if the range is empty), rows and the table's columns."""
    version = versions(spark, path)[-1] if version is None else version
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/{version:010d}")


def _rows(spark: SparkSession, path: str, ranges: DataFrame, schema: T.StructType) -> DataFrame:
    """The stored rows of ``ranges``, with their range."""
    whole = T.StructType([*schema.fields, T.StructField(_GEN, T.StringType()), T.StructField(_BITS, T.IntegerType()), T.StructField(_PREFIX, T.LongType())])
    live = ranges.where(f"{_GEN} is not null").select(_GEN, _BITS, _PREFIX)
    at = [f"{path}/data/{_GEN}={r[0]}" for r in live.select(_GEN).distinct().collect()]
    if not at:
        return spark.createDataFrame([], whole).drop(_GEN)
    stored = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*at)
    n = live.count()
    if n <= _NAMED:  # few ranges: the files' own bounds tell which to open
        stored = stored.where(reduce(Column.__or__, [(F.col(_GEN) == r[0]) & (F.col(_BITS) == r[1]) & (F.col(_PREFIX) == r[2]) for r in live.collect()]))
    return stored.join(F.broadcast(live) if n <= _FEW else live, [_GEN, _BITS, _PREFIX], "left_semi").select(*[f"`{c}`" for c in whole.names if c != _GEN])


def _schema_of(ranges: DataFrame) -> T.StructType:
    return T.StructType.fromJson(json.loads(ranges.select("columns").first()[0]))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (the newest by default), with every column it had by then."""
    ranges = manifest(spark, path, version)
    return _rows(spark, path, ranges, _schema_of(ranges)).drop(_BITS, _PREFIX)


def _prefix(key: str, bits: Column | int) -> Column:
    """The leading ``bits`` bits of the key's hash."""
    h = F.xxhash64(F.col(f"`{key}`"))
    b = F.lit(bits) if isinstance(bits, int) else bits
    return F.when(b == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", h, F.lit(64) - b))


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: str, order_col: str | None = None,
           max_rows: int = MAX_ROWS) -> int:
    """Replace rows by key, insert new keys; returns the new version.

    The latest update of a key counts (``latest_per_key``); a null key is one
    key.  Columns are the union of both sides, null where a side lacks one.
    Applying the same updates again gives a new version of the same rows."""
    done = versions(spark, path)
    later = max([int(n) for n in _names(spark, f"{path}/manifest") if n.isdigit()], default=0) + 1
    fresh = materialize(latest_per_key(updates, key, order_col))
    if done:
        ranges = manifest(spark, path, done[-1])
        old_schema = _schema_of(ranges)
    else:
        ranges = spark.range(1).select(F.lit(0).alias(_BITS), F.lit(0).cast("long").alias(_PREFIX), F.lit(None).cast("string").alias(_GEN),
                                       F.lit(0).cast("long").alias("n_rows"), F.lit("").alias("columns"))
        old_schema = fresh.schema
    # A key belongs to the one range that its hash begins with; hashes are even, so there are few lengths.
    lengths = [r[0] for r in ranges.select(_BITS).distinct().collect()]
    could = F.array(*[F.struct(F.lit(b).alias(_BITS), _prefix(key, b).alias(_PREFIX)) for b in lengths])
    routed = materialize(fresh.select("*", F.explode(could).alias("_r")).select(*[f"`{c}`" for c in fresh.columns], "_r.*")
                         .join(ranges.select(_BITS, _PREFIX), [_BITS, _PREFIX]).select(*[f"`{c}`" for c in fresh.columns], _BITS, _PREFIX))
    touched = materialize(ranges.join(routed.select(_BITS, _PREFIX).distinct(), [_BITS, _PREFIX], "left_semi").select(_BITS, _PREFIX, _GEN))
    merged = materialize(upsert_by_key(_rows(spark, path, touched, old_schema), routed, key))
    sizes = merged.groupBy(_BITS, _PREFIX).agg(F.count(F.lit(1)).alias("n"))
    more = F.ceil(F.log2(F.greatest(F.col("n") / F.lit(max_rows), F.lit(1.0)))).cast("int")
    # Every touched range, as it was and with the bits that its parts get.
    parts = materialize(touched.join(sizes, [_BITS, _PREFIX], "left").select(
        _BITS, _PREFIX, (F.col(_BITS) + F.least(F.coalesce(more, F.lit(0)), F.lit(62) - F.col(_BITS))).alias("bits")))
    n_parts = parts.count()
    placed = merged.join(F.broadcast(parts) if n_parts <= _FEW else parts, [_BITS, _PREFIX]).drop(_PREFIX, _BITS)
    placed = placed.withColumn(_PREFIX, _prefix(key, F.col("bits"))).withColumnRenamed("bits", _BITS)
    gen = f"{later}-{uuid.uuid4().hex[:12]}"
    width = max(1, min(math.ceil(merged.count() / max(max_rows, FILE_ROWS)) * 4, 10_000))
    placed.repartition(width, _BITS, _PREFIX).sortWithinPartitions(_BITS, _PREFIX).write.parquet(f"{path}/data/{_GEN}={gen}")
    schema = T.StructType([f for f in merged.schema.fields if f.name not in (_BITS, _PREFIX)])
    found = placed.groupBy(_BITS, _PREFIX).agg(F.count(F.lit(1)).alias("n_rows"))
    children = F.sequence(F.lit(0).cast("long"), F.expr(f"shiftleft(1L, bits - {_BITS}) - 1"))
    new = (parts.select("bits", F.col(_PREFIX).alias("p"), _BITS, F.explode(children).alias("c"))
           .select(F.col("bits").alias(_BITS), (F.expr(f"shiftleft(p, bits - {_BITS})") + F.col("c")).alias(_PREFIX))
           .join(found, [_BITS, _PREFIX], "left")
           .select(_BITS, _PREFIX, F.when(F.col("n_rows") > 0, F.lit(gen)).alias(_GEN), F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")))
    kept = ranges.join(touched.select(_BITS, _PREFIX), [_BITS, _PREFIX], "left_anti").select(_BITS, _PREFIX, _GEN, "n_rows")
    whole = kept.unionByName(new).withColumn("columns", F.lit(schema.json()))
    whole.coalesce(max(1, n_parts // _FEW)).write.mode("errorifexists").parquet(f"{path}/manifest/{later:010d}")
    return later


def unused_folders(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Generations that none of the newest ``keep`` versions names: what may be deleted once nobody reads older ones."""
    live = {r[0] for v in versions(spark, path)[-keep:] for r in manifest(spark, path, v).select(_GEN).distinct().collect()}
    return sorted(n for n in _names(spark, f"{path}/data") if n.startswith(f"{_GEN}=") and n.split("=", 1)[1] not in live)
