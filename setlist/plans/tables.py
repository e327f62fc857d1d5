"""Mapping of the driver's tables onto the playlist model.

playlist = ``orders.o_orderkey``; playlist entry = a ``lineitem`` row;
track = ``part``; artist = ``supplier``; item vector = an ``embeddings`` row,
reached from a line item by ``l_partkey % count(embeddings)``.  The count is
a scalar subquery, so the mapping stays one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.operators.similarity import array_item_vectors

SEED = 42
TEST_FRAC = 0.25
TOP_N = 5
EMBED_DIM = 64   # width of ``embeddings.embedding`` in the driver's tables


# Declared schemas of the driver's tables (no inference on reads).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read with its declared schema (no footer-inference job)."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def embedding_count(spark: SparkSession, sf_dir: str) -> F.Column:
    """``count(embeddings)`` as a lazy scalar subquery."""
    return table(spark, sf_dir, "embeddings").select(F.count(F.lit(1))).scalar()


def playlist_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (pid, item) entries: pid = order, item = embedding id of the part."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select(F.col("l_orderkey").alias("pid"),
                      (F.col("l_partkey") % embedding_count(spark, sf_dir)).alias("item"))
            .distinct())


def embedding_items(spark: SparkSession, sf_dir: str, dim: int = EMBED_DIM):
    """Item table ``(item, f0..f{dim-1})`` from the embeddings."""
    emb = table(spark, sf_dir, "embeddings")
    return array_item_vectors(emb, "vec_id", "embedding", dim)
