"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.session import materialize  # noqa: F401  (re-exported for the operators)

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular expression class body.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, as one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of non-space characters, in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")


def lines(text: Column) -> Column:
    """The text cut at every line feed; null text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shuffle_width(df: DataFrame) -> int:
    """The session's shuffle partition count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(rows: int, per_task: int, df: DataFrame) -> int:
    """Partitions for ``rows`` rows at ``per_task`` each, at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A written table is broadcast only up to this many bytes (rows x row bytes).
BROADCAST_BYTES = 16 << 20


def small_side(written: DataFrame, row_bytes: int) -> DataFrame:
    """``written`` (a materialised table) marked for broadcast if its counted
    rows of ``row_bytes`` stay under the bound; else as it is, for a shuffled
    join."""
    fits = written.count() * row_bytes <= BROADCAST_BYTES
    return F.broadcast(written) if fits else written
