"""Nested-record flattening, renames and schema-driven projections
(F8, F9, F10, P5, P6, P7, P12, P19, P21).

Column sets are derived from the declared schema on the driver (a few
hundred fields at most), never from the data; every generated column is a
native expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --------------------------------------------------------------------- F8 ---
def flatten_artist(artist: str | Column = "artist") -> list[Column]:
    """F8: artist record → the five artist feature columns.

    ``followers.total``; ``genres`` (missing/null → empty list); ``id``; url of
    the first image (no images → null); ``popularity``.  Explicit nulls give
    nulls instead of failing (D29).
    """
    a = F.col(artist) if isinstance(artist, str) else artist
    return [  # fixed values: the five column names
        a["followers"]["total"].cast("long").alias("artist_follower_total"),
        F.coalesce(a["genres"], F.array().cast("array<string>")).alias("artist_genres"),
        a["id"].alias("artist_spid"),
        F.get(a["images"], 0)["url"].alias("artist_img_url"),
        a["popularity"].cast("long").alias("artist_popularity"),
    ]


# --------------------------------------------------------------------- F9 ---
def flatten_columns(df: DataFrame, sep: str = ":", *, max_items: int,
                    keep_arrays: bool = False) -> DataFrame:
    """F9 (column form): every leaf of nested structs/arrays → one top-level
    column named by its path (``track:album:images:0:url``).

    Arrays contribute elements ``0..max_items-1`` (null where shorter); the
    bound has no default, since later elements have no column;
    :func:`flatten_entries` keeps every element, :func:`flatten_paths` takes
    the paths that a caller wants.
    ``keep_arrays`` also keeps arrays of scalars as one column.
    """
    cols: list[Column] = []

    def walk(expr: Column, dtype: T.DataType, path: str):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(expr[f.name], f.dataType, f"{path}{sep}{f.name}" if path else f.name)
        elif isinstance(dtype, T.ArrayType) and not (
                keep_arrays and not isinstance(dtype.elementType, (T.StructType, T.ArrayType))):
            for i in range(max_items):
                walk(F.get(expr, i), dtype.elementType, f"{path}{sep}{i}")
        else:
            cols.append(expr.alias(path))

    for f in df.schema.fields:
        walk(F.col(_q(f.name)), f.dataType, f.name)
    return df.select(*cols)


def flatten_paths(df: DataFrame, paths: list[str], sep: str = ":") -> DataFrame:
    """F9 for named leaves: one column per path (``track:artists:0:id``), null
    where an array is shorter.  A path that the schema lacks is an error."""
    cols: list[Column] = []
    for path in paths:
        expr, dtype = None, df.schema
        for step in path.split(sep):
            if isinstance(dtype, T.ArrayType) and step.isdigit():
                expr, dtype = F.get(expr, int(step)), dtype.elementType
            elif isinstance(dtype, T.StructType) and step in dtype.fieldNames():
                expr, dtype = (F.col(_q(step)) if expr is None else expr[step]), dtype[step].dataType
            else:
                raise ValueError(f"no field {step!r} on the path {path!r}")
        cols.append(expr.alias(path))
    return df.select(*cols)


def flatten_entries(df: DataFrame, id_col: str, sep: str = ":") -> DataFrame:
    """F9 (long form): every leaf as a ``(id, key, value)`` row, all list
    elements included (the flat-dict result without any bound on list size).

    Values are rendered as text.  Built from native ``transform``/``flatten``
    expressions; one output row per leaf.
    """
    empty = F.array().cast("array<struct<key:string,value:string>>")

    def entries(expr: Column, dtype: T.DataType, key: Column) -> Column:
        if isinstance(dtype, T.StructType):
            parts = [F.coalesce(entries(expr[f.name], f.dataType,
                                        F.concat(key, F.lit(sep + f.name))), empty)
                     for f in dtype.fields]
            return F.concat(*parts) if len(parts) > 1 else parts[0]
        if isinstance(dtype, T.ArrayType):
            return F.flatten(F.transform(expr, lambda x, i: F.coalesce(
                entries(x, dtype.elementType, F.concat(key, F.lit(sep), i.cast("string"))), empty)))
        if isinstance(dtype, T.MapType):
            return F.flatten(F.transform(F.map_entries(expr), lambda e: F.coalesce(
                entries(e["value"], dtype.valueType, F.concat(key, F.lit(sep), e["key"].cast("string"))),
                empty)))
        return F.array(F.struct(key.alias("key"), expr.cast("string").alias("value")))

    parts = [F.coalesce(entries(F.col(_q(f.name)), f.dataType, F.lit(f.name)), empty)
             for f in df.schema.fields if f.name != id_col]
    allp = F.concat(*parts) if len(parts) > 1 else parts[0]
    return (df.select(F.col(_q(id_col)), F.explode(allp).alias("e"))
            .select(id_col, "e.key", "e.value"))


# -------------------------------------------------------------------- F10 ---
def id_attribute_map(df: DataFrame, id_col: str, cols: list[str] | None = None) -> DataFrame:
    """row → ``(id, attributes)``; attributes = map of the other columns as text."""
    cols = [c for c in (cols or df.columns) if c != id_col]
    return df.select(F.col(_q(id_col)),
                     F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                       F.array(*[F.col(_q(c)).cast("string") for c in cols]))
                     .alias("attributes"))


# ---------------------------------------------------------------- P5-P7 ----
def prefix_columns(df: DataFrame, prefix: str, renames: dict | None = None) -> DataFrame:
    """P5: optional renames first (``id`` → ``spid``), then prefix every column."""
    renames = renames or {}
    return df.select(*[F.col(_q(c)).alias(prefix + renames.get(c, c)) for c in df.columns])


def rename_select(df: DataFrame, mapping: dict, keep_first: list[str] = ()) -> DataFrame:
    """Rename by a map, then keep ``keep_first`` + the renamed columns in map order."""
    return df.select(*[F.col(_q(c)) for c in keep_first],
                     *[F.col(_q(src)).alias(dst) for src, dst in mapping.items()])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns (absent names are ignored)."""
    return df.drop(*cols)


# -------------------------------------------------------------------- P12 ---
def conform(df: DataFrame, schema: T.StructType, lenient: bool = True,
            keep_extra: bool = True) -> DataFrame:
    """Add each declared column as a typed null if absent, else cast it.

    ``lenient`` uses ``try_cast`` (bad values → null); otherwise a bad value
    fails the job under ANSI mode.  Missing columns get their declared type,
    not float (D16).  Extra columns follow unless ``keep_extra`` is False.
    """
    present = set(df.columns)
    declared = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(_q(f.name))
            declared.append((c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name))
        else:
            declared.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.col(_q(c)) for c in df.columns if c not in set(schema.fieldNames())] if keep_extra else []
    return df.select(*declared, *extra)


# -------------------------------------------------------------------- P19 ---
def sparse_columns(df: DataFrame, min_frac: float) -> list[str]:
    """Columns with fewer than ``min_frac`` x rows non-null values — one aggregate pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(_q(c))).alias(c) for c in df.columns]).first()
    n = row["__n"]
    return [c for c in df.columns if row[c] < min_frac * n]


def drop_sparse_columns(df: DataFrame, min_frac: float = 0.6) -> DataFrame:
    """Keep only columns with at least ``min_frac`` non-null values."""
    return df.drop(*sparse_columns(df, min_frac))
