"""Long lists as rows of bounded length.

A list of ids per playlist is what the reference stores; a playlist that holds
a third of all rows would be one row of that size.  Here a list is cut into
segments: ``(playlist, segment, ids)``, each of at most ``rows`` ids, in the
list's order.  Positions in a list of any length come from ``positions``: equal
rows are counted first, the distinct ones range-partitioned, and running sums
over the ranges give each its start, so no list meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setlist.session import materialize

#: Ids of a segment at most.
ROWS = 4096


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The distinct rows of ``df`` (which holds ``group`` and ``order`` columns
    only, nulls first) with ``_copies``, ``_start`` (rows of the group before the
    first copy) and ``_size`` (rows of the group)."""
    keys = group + order
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = materialize(runs.repartitionByRange(width, *keys).withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy("_part", *group).agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(parts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                          .withColumn("_size", F.sum("_n").over(Window.partitionBy(*group))).drop("_n"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    a, b = counted.alias("a"), offsets.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for c in group:
        same &= F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same).select(*[f"a.{c}" for c in keys], "a._copies", (F.col("a._inside") + F.col("b._offset")).alias("_start"), "b._size")


def segments(long: DataFrame, group: list[str], item: str, order: list[str] = (), rows: int = ROWS) -> DataFrame:
    """``(*group, segment, ids)``: each group's items by ``order``, then item, repeats
    included, cut into segments of ``rows``; null items are left out."""
    keys = [c for c in order if c != item] + [item]
    ranked = positions(long.where(F.col(item).isNotNull()).select(*group, *keys), group, keys)
    placed = ranked.select(*group, item, F.explode(F.sequence("_start", F.col("_start") + F.col("_copies") - 1)).alias("_at"))
    ids = F.array_sort(F.collect_list(F.struct("_at", item)))
    return (placed.groupBy(*group, F.expr(f"_at div {int(rows)}").alias("segment")).agg(ids.alias("_l"))
            .select(*group, "segment", F.col(f"_l.{item}").alias("ids")))


def segment_items(cut: DataFrame, group: list[str], item: str = "item", rows: int = ROWS) -> DataFrame:
    """Segments back to ``(*group, pos, item)``, positions counted through the whole list."""
    at = F.posexplode("ids").alias("_i", item)
    return cut.select(*group, "segment", at).select(*group, (F.col("segment") * rows + F.col("_i")).alias("pos"), item)
