"""Queries on records without a schema (F9): JSON of mixed shapes made from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlist.functions import variants
from setlist.plans.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


#: A part's record, in four shapes: ``dims`` is an object, a number, a list or missing.
_RECORD = """CASE p_partkey % 4
 WHEN 0 THEN '{"id":' || p_partkey || ',"dims":{"size":' || p_size || ',"tags":["' || p_brand || '",[' || p_size || ',{"t":"' || p_type || '"}]]}}'
 WHEN 1 THEN '{"id":' || p_partkey || ',"dims":' || p_size || ',"extra":{}}'
 WHEN 2 THEN '{"id":' || p_partkey || ',"dims":[' || p_size || ',null,[],{"0":"' || p_brand || '"}],"flag":true}'
 ELSE '{"id":' || p_partkey || ',"kind":{"name":"' || p_type || '","0":' || p_size || '}}' END"""

#: What json_tree calls a path, in the form used here.
_KEY = """regexp_replace(regexp_replace(regexp_replace(j.fullkey, '\\[(\\d+)\\]', ':\\1', 'g'), '["$]', '', 'g'), '[.]', ':', 'g')[2:]"""

_SQL_LEAVES = f"""
WITH r AS (SELECT p_partkey, CAST({_RECORD} AS JSON) AS r FROM part),
leaf AS (SELECT p_partkey, {_KEY} AS key,
                CASE WHEN j.type IN ('OBJECT', 'ARRAY') THEN CAST(j.value AS VARCHAR)
                     WHEN j.type = 'NULL' THEN NULL ELSE j.value ->> '$' END AS value
         FROM r, json_tree(r.r) j
         WHERE j.type NOT IN ('OBJECT', 'ARRAY') OR CAST(j.value AS VARCHAR) IN ('{{}}', '[]'))"""


def _records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", variants.parse(F.expr(_RECORD)).alias("r"))


@register("any_json_leaves", _SQL_LEAVES + "\nSELECT p_partkey, key, value FROM leaf")
def q_any_json_leaves(spark, sf_dir):
    """every leaf of records of four shapes, no schema given."""
    return variants.leaves(_records(spark, sf_dir), ["p_partkey"], "r")


@register("any_json_paths", _SQL_LEAVES + """
SELECT key, count(value) AS n_values, count(*) FILTER (WHERE value IS NULL) AS n_null FROM leaf GROUP BY key""")
def q_any_json_paths(spark, sf_dir):
    """the columns that the records could have, counted."""
    return variants.paths(variants.leaves(_records(spark, sf_dir), ["p_partkey"], "r"))


_WANTED = ["id", "dims:size", "dims:tags:1:1:t", "dims:0", "dims:3:0", "kind:0", "kind:name", "flag", "none:here"]


@register("any_json_columns", _SQL_LEAVES + "\nSELECT p_partkey, " + ", ".join(
    f"max(value) FILTER (WHERE key = '{k}') AS \"{k}\"" for k in _WANTED) + " FROM leaf GROUP BY p_partkey")
def q_any_json_columns(spark, sf_dir):
    """named paths as columns, null where a record has another shape."""
    return variants.columns(_records(spark, sf_dir), "r", _WANTED)
