"""The corpus pipeline: rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before
wrote, and returns a DataFrame; all but the last return the columns of docs.

Defined cases are those of the operators; ``n_chars`` follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.llm.common import materialize, table
from setlist.llm.line_dedup import dedup_lines
from setlist.llm.mixing import mixed_documents
from setlist.llm.packing import pack
from setlist.llm.quality import keep_good
from setlist.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated content-defined chunks (op5's) and repeated passages of two lines or more, whole, go
    but for their first occurrence."""
    out = dedup_lines(docs, passages=True)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at two or fewer bits of 3-word shingles."""
    return one_of_each(docs, shingle=3, max_bits=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mix; a document stands once for each epoch that holds it."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_near_dedup),
          ("mixing sources to target weights", mixing), ("best-fit packing", best_fit_packing)]

#: Packing is a seeded search and fingerprints are bit counts: SQL states neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = materialize(docs) if i + 1 < len(STAGES) else docs
    return docs
