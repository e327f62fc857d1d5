"""Flattening of records whose shape no schema declares.

A record is JSON text, or a VARIANT.  Its leaves come out as ``(id, key,
value)`` rows, the key being the path (``track:artists:0:id``); paths are
found in the data, level by level, with ``variant_explode``.  Each level is
written once, so nothing is parsed or exploded twice, and only what is still
nested goes on: a table costs as many steps as its deepest record has levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlist.session import materialize

_NESTED = "(?s)^(OBJECT|ARRAY)<.+>$"


def parse(text: str | Column) -> Column:
    """JSON text as a VARIANT; null for null and for text that is no JSON."""
    return F.try_parse_json(text)


def leaves(df: DataFrame, id_cols: list[str], record: str, sep: str = ":") -> DataFrame:
    """Every leaf of the VARIANT column ``record`` as ``(*id_cols, key, value)``.

    Values are text, a JSON null is null.  An empty object or list is a leaf,
    ``{}`` or ``[]``.  A record that is one scalar has the key ``""``; a null
    record has no rows.  Members of any shape may stand side by side: no type is
    assumed for a path.  Records that repeat give their rows again.
    """
    ids = [F.col(f"`{c}`") for c in id_cols]
    level = df.where(F.col(f"`{record}`").isNotNull()).select(F.struct(*ids).alias("id"), F.lit("").alias("key"),
                                                             F.col(f"`{record}`").alias("v"))
    done = []
    while True:
        shape = F.schema_of_variant("v")
        # Empty containers have an empty shape (OBJECT<>), or the type of no element (ARRAY<VOID>).
        marked = level.withColumn("nested", shape.rlike(_NESTED) & ~F.col("v").cast("string").isin("[]", "{}"))
        level = materialize(marked)
        done.append(level.where(~F.col("nested")).select("id.*", "key", F.col("v").cast("string").alias("value")))
        inside = level.where("nested")
        if inside.isEmpty():
            return reduce(DataFrame.unionByName, done)
        parts = df.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "part")
        step = F.coalesce("name", F.col("pos").cast("string"))
        level = inside.lateralJoin(parts).select(
            "id", F.when(F.col("key") == "", step).otherwise(F.concat("key", F.lit(sep), step)).alias("key"), F.col("part").alias("v"))


def paths(found: DataFrame) -> DataFrame:
    """``(key, n_values, n_null)`` of the leaves: what columns the records could have."""
    return found.groupBy("key").agg(F.count("value").alias("n_values"), F.count(F.when(F.col("value").isNull(), 1)).alias("n_null"))


def columns(df: DataFrame, record: str, wanted: list[str], sep: str = ":") -> DataFrame:
    """``df`` without ``record`` and with one text column per wanted path, null where a record lacks it.

    A step of digits is an element of a list or a member of that name, whichever the record has."""
    out = [c for c in df.columns if c != record]
    return df.select(*[F.col(f"`{c}`") for c in out], *[_at(F.col(f"`{record}`"), p.split(sep)).alias(p) for p in wanted])


def _at(value: Column, steps: list[str]) -> Column:
    for s in steps:
        name = s.replace("\\", "\\\\").replace('"', '\\"')
        inner = F.try_variant_get(value, f'$["{name}"]', "variant")
        value = F.coalesce(inner, F.try_variant_get(value, f"$[{int(s)}]", "variant")) if s.isdigit() else inner
    return value.cast("string")
