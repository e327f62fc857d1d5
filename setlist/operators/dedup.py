"""Distinct values and key deduplication (A1, A2, A3, A4).

First-row choice uses ``min_by(struct(row), struct(order))`` grouped by the
key: an ordinary aggregate, so map-side partial aggregation collapses a hot
key before the shuffle — unlike ``row_number() over (partition by key)``,
which sorts a hot key inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A1: distinct values of one column (null is one value, as in a set)."""
    return df.select(col).distinct()


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """A2: group by key without measures (= the store's distinct keys); the
    plan is the same grouping-only hash aggregate as ``distinct``."""
    return df.select(key).distinct()


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3 when any row per key will do: ``dropDuplicates`` (null keys are equal)."""
    return df.dropDuplicates(keys)


def dedup_first(df: DataFrame, keys: list[str], order: list,
                carry: list[str] | None = None) -> DataFrame:
    """A3 with a repeatable choice (D12): per key, the row that is first by ``order``.

    ``order`` items are column names (ascending) or ``(name, "desc")``.  All
    descending → ``max_by``; mixed orders negate the numeric descending keys.
    Null keys form one group, as pandas' ``drop_duplicates`` treats them.
    Pass a total order (add tie-breakers) when rows may tie.  ``carry``
    limits the output to keys + those columns (the default keeps every
    column), so order-only columns are not carried through the shuffle twice.
    """
    parsed = [(o, "asc") if isinstance(o, str) else (o[0], o[1]) for o in order]
    all_desc = all(d == "desc" for _, d in parsed)
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    ord_fields = []
    for i, (name, direction) in enumerate(parsed):
        c = F.col(_q(name))
        if direction == "desc" and not all_desc:
            if name not in numeric:
                raise ValueError(f"mixed-direction order needs numeric {name!r}")
            c = -c
        ord_fields.append(c.alias(f"o{i}"))
    rest = [c for c in (carry if carry is not None else df.columns) if c not in keys]
    row = F.struct(*[F.col(_q(c)) for c in rest]) if rest else F.lit(True)
    pick = F.max_by if all_desc else F.min_by
    agg = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(
        pick(row, F.struct(*ord_fields)).alias("_first"))
    cols = [F.col(_q(k)) for k in keys] + [F.col("_first")[c].alias(c) for c in rest]
    out = [c for c in df.columns if c in keys or c in rest]
    return agg.select(*cols).select(*[F.col(_q(c)) for c in out])


def first_seen(long: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """A4: per key, the ``carry`` columns of the first occurrence by ``order``."""
    cols = list(dict.fromkeys([*keys, *carry, *order]))
    return dedup_first(long.select(*cols), keys, order, carry=carry).select(*keys, *carry)
