"""Positions of rows in long sorted groups, by the library's general helper."""

from __future__ import annotations

from pyspark.sql import DataFrame

from setlist.operators import segments


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The distinct rows of ``df`` with ``copies``, ``start`` (rows of the group
    before the first copy) and ``size`` (rows of the group); no group and no set
    of equal rows meets in one task."""
    return segments.positions(df, group, order).withColumnsRenamed({f"_{c}": c for c in ("copies", "start", "size")})
