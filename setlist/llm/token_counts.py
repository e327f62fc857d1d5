"""Exact token counts from a histogram of encoded lengths.

Tasks reduce their documents to (length, documents) before the shuffle, so
what moves grows with the distinct lengths only.  Sums over all longer
documents then answer, for every context limit: how many documents exceed it,
how many tokens they hold, and what is left when each is cut at the limit.
Those sums run over ranges of ``RANGE`` lengths first and inside each range
next, so no task holds the whole histogram.

Defined cases: null and empty text has length 0; rows that repeat count each;
other columns are ignored; an empty table gives an empty histogram, no
quantiles and limits answered by zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm import tokens
from setlist.llm.common import materialize, table

ship_by_value(__name__)
ship_by_value(tokens.__name__)

#: Lengths summed together in the first step.
RANGE = 1024


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([len(tokens.ids(x.as_py())) for x in batch.column(0)], dtype=np.int64)
        length, count = np.unique(found, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(count.astype(np.int64))], names=["length", "n"])


def histogram(docs: DataFrame, text: str = "text") -> DataFrame:
    """``length`` (tokens) and ``n_docs``."""
    found = docs.select(F.col(text).alias("t")).mapInArrow(_lengths, "length long, n long")
    return found.groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """The (written) histogram with, for each length L: documents and tokens
    at L or more, the total when each document is cut at L, and the share of
    documents at L or less."""
    marked = lengths.withColumn("r", F.expr(f"length div {RANGE}"))
    total = F.sum(F.col("n_docs") * F.col("length"))
    ranges = marked.groupBy("r").agg(F.sum("n_docs").alias("d"), total.alias("t"))
    above = Window.orderBy(F.col("r").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = ranges.withColumn("d_over", F.coalesce(F.sum("d").over(above), F.lit(0))).withColumn(
        "t_over", F.coalesce(F.sum("t").over(above), F.lit(0))).drop("d", "t")
    inside = Window.partitionBy("r").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    docs, toks = F.sum("n_docs").over(inside) + F.col("d_over"), F.sum(F.col("n_docs") * F.col("length")).over(inside) + F.col("t_over")
    out = marked.join(whole, "r").withColumn("docs_at_least", docs).withColumn("tokens_at_least", toks)
    ends = lengths.select(F.sum("n_docs").alias("d"), total.alias("t"))
    below = ends.select("t").scalar() - F.col("tokens_at_least")
    return out.select("length", "n_docs", "docs_at_least", "tokens_at_least",
                      (below + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
                      (1 - (F.col("docs_at_least") - F.col("n_docs")) / ends.select("d").scalar()).alias("share_at_most"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents longer than it, and the total after cutting."""
    asked = [F.struct(F.lit(int(x)).cast("long").alias("context_limit"),
                      F.coalesce(F.max(F.when(F.col("length") > x, F.col("docs_at_least"))), F.lit(0)).alias("docs_over"),
                      F.coalesce(F.sum(F.col("n_docs") * F.least("length", F.lit(int(x)))), F.lit(0)).alias("total")) for x in limits]
    return sums.agg(F.array(*asked).alias("a")).select(F.inline("a"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """Per share: the smallest length that so many documents don't exceed (inverse distribution)."""
    asked = [F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("share_at_most") >= q - 1e-12, F.col("length"))).alias("length"))
             for q in shares]
    return sums.agg(F.array(*asked).alias("a")).select(F.inline("a")).where("length is not null")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(materialize(histogram(table(spark, sf_dir, "documents"))))


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
