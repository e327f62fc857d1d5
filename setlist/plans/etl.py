"""ETL-side queries on the driver's tables: scalars, projections, flattening,
dedup, lookups, set operations, counts, upsert and enrichment.

Mapping (see ``tables.py``): playlist = order, entry = line item, track =
part, artist = supplier, slice = ship year.  Each query reads whole tables;
``ORACLES`` holds the same computation in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.functions.flatten import (conform, drop_sparse_columns, flatten_artist, flatten_columns,
                                       flatten_entries,
                                       id_attribute_map, prefix_columns, rename_select)
from setlist.functions.scalars import (chunk_array, epoch_to_timestamp, fill_by_type,
                                       parse_list_text, parse_timestamp, slice_dir_name,
                                       slice_name_from_raw, text_to_bool, uri_part)
from setlist.operators.counts import (count_non_null, feature_histogram, most_featured,
                                      progress_counts, reconcile_counts)
from setlist.operators.dedup import dedup_first, distinct_keys, first_seen
from setlist.operators.enrich import enrich_from_table, track_features_frame
from setlist.operators.lookup import (drop_junk_keys, join_on, lookup_found, lookup_missing,
                                      new_rows, new_slices, remaining_ids)
from setlist.operators.split import head_n, sample_n
from setlist.operators.upsert import upsert_by_key
from setlist.plans.tables import SEED, table
from setlist.schemas import TRACK_FEATURE_RECORD

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


EPOCH_NTZ = "1970-01-01 00:00:00"
PULL_TIME = "2024-01-01 00:00:00"


def _ntz(c):
    """An instant as wall-clock timestamp_ntz (session time zone both ways)."""
    return c.cast("timestamp_ntz")


def _epoch_seconds(c):
    """Whole epoch seconds of a timestamp_ntz, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c)


# ------------------------------------------------------------- A1 / A10 ----
@register("playlist_items", """
SELECT l_orderkey AS pid, l_partkey AS item, count(*) AS n_lines
FROM lineitem GROUP BY l_orderkey, l_partkey""")
def q_playlist_items(spark, sf_dir):
    """Distinct items of every playlist with their multiplicity (long form of
    the id lists; no per-playlist collect, so a huge playlist stays spread)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("pid"), F.col("l_partkey").alias("item"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("playlist_sizes", """
SELECT pid, CAST(sum(n) AS BIGINT) AS n_entries, count(*) AS n_distinct
FROM (SELECT l_orderkey AS pid, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) t
GROUP BY pid""")
def q_playlist_sizes(spark, sf_dir):
    """list length and distinct count per playlist, via two hash aggregates."""
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy(F.col("l_orderkey").alias("pid"), "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("pid").agg(F.sum("n").cast("long").alias("n_entries"),
                                  F.count(F.lit(1)).alias("n_distinct"))


# ------------------------------------------------------------- P1 F3 F4 ----
def _status_text():
    return F.when(F.col("o_orderstatus") == "F", "TRUE").when(
        F.col("o_orderstatus") == "O", "no").otherwise("Yea")


@register("select_playlist_features", f"""
SELECT o_orderkey AS pid, o_orderpriority AS name,
       lower(CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'no' ELSE 'Yea' END)
           IN ('yes', 'true', 't', '1', 'yea', 'verily') AS collaborative,
       TIMESTAMP '{EPOCH_NTZ}' + to_seconds(date_diff('second', TIMESTAMP '{EPOCH_NTZ}', o_orderdate))
           AS modified_at,
       o_custkey AS num_followers, CAST(round(o_totalprice) AS BIGINT) AS num_edits
FROM orders""")
def q_select_playlist_features(spark, sf_dir):
    """P1 + F3 + F4: the six playlist columns; text flag → boolean, epoch → time."""
    o = table(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").alias("pid"), F.col("o_orderpriority").alias("name"),
                   _status_text().alias("collaborative"),
                   _epoch_seconds(F.col("o_orderdate")).alias("modified_at"),
                   F.col("o_custkey").alias("num_followers"),
                   F.round("o_totalprice").cast("long").alias("num_edits"))
    return raw.select("pid", "name", text_to_bool("collaborative").alias("collaborative"),
                      epoch_to_timestamp("modified_at", "s", ntz=True).alias("modified_at"),
                      "num_followers", "num_edits")


# ------------------------------------------------------------- P2 P5 P7 ----
@register("select_item_features", """
SELECT CAST(p_partkey AS VARCHAR) AS track_spid, p_name AS track_name, p_brand AS track_brand,
       CAST(p_size AS DOUBLE) AS track_size, p_retailprice AS track_retailprice
FROM part""")
def q_select_item_features(spark, sf_dir):
    """P5 (rename id→spid, prefix all), P7 (drop), P2 (select the features)."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
        F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("retailprice"))
    pre = prefix_columns(p, "track_", {"id": "spid"}).drop("track_type")
    return pre.select("track_spid", "track_name", "track_brand", "track_size", "track_retailprice")


# ------------------------------------------------------------ P6 P8 P10 ----
_SUPPLIER_RENAMES = {"s_suppkey": "artist_spid", "s_name": "artist_name",
                     "s_nationkey": "artist_nation", "s_acctbal": "artist_balance"}


@register("rename_flatten_columns", """
SELECT s_suppkey AS artist_spid, s_name AS artist_name, s_nationkey AS artist_nation,
       s_acctbal AS artist_balance, 'Liked Songs' AS interaction_style, n_name AS region_name
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def q_rename_flatten_columns(spark, sf_dir):
    """P6 bulk rename + keep, P8 constant column, P10 single rename."""
    s = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    out = rename_select(s, _SUPPLIER_RENAMES, keep_first=["n_name"])
    return (out.withColumn("interaction_style", F.lit("Liked Songs"))
            .withColumnRenamed("n_name", "region_name"))


# ------------------------------------------------------------------ P12 ----
_DECLARED = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_retailprice", T.DoubleType()), T.StructField("p_size", T.LongType()),
    T.StructField("track_key", T.LongType())])


@register("conform_schema", """
SELECT p_partkey, p_name, CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice END AS p_retailprice,
       CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS BIGINT) AS track_key
FROM part""")
def q_conform_schema(spark, sf_dir):
    """Declared columns cast (price arrives as text, for some parts no
    number: null), missing ones typed null."""
    price = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("from "), F.col("p_retailprice"))).otherwise(
        F.col("p_retailprice").cast("string"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", price.alias("p_retailprice"), "p_size")
    return conform(p, _DECLARED, keep_extra=False)


# ----------------------------------------------------------- F1 F16 F2 -----
@register("parse_uri_part", """
SELECT page_id,
       CASE WHEN len(string_split(url, ':')) >= 1 THEN string_split(url, ':')[1] END AS part0,
       CASE WHEN len(string_split(url, ':')) >= 2 THEN string_split(url, ':')[2] END AS part1,
       CASE WHEN len(string_split(url, ':')) >= 3 THEN string_split(url, ':')[3] END AS part2
FROM (SELECT page_id, CASE WHEN url LIKE 'https%' THEN url || ':' || page_id ELSE url END AS url FROM pages)""")
def q_parse_uri_part(spark, sf_dir):
    """F1 on URLs, https ones with the page id appended: parts 0-2 of a
    ``:``-split; a missing part is null."""
    url = F.when(F.col("url").like("https%"), F.concat_ws(":", "url", "page_id")).otherwise(F.col("url"))
    p = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return p.select("page_id", *[uri_part("url", i).alias(f"part{i}") for i in range(3)])


@register("parse_track_uri", """
SELECT DISTINCT l_partkey, CAST(l_partkey AS VARCHAR) AS track_id,
       'mpd.slice.' || CAST(year(l_shipdate) AS VARCHAR) AS slice,
       'mpd_slice_' || CAST(year(l_shipdate) AS VARCHAR) AS slice_dir
FROM lineitem""")
def q_parse_track_uri(spark, sf_dir):
    """F1 on built track URIs (``x:track:<id>``) and F16 slice-name forms."""
    li = table(spark, sf_dir, "lineitem")
    built = li.select("l_partkey",
                      F.concat(F.lit("x:track:"), F.col("l_partkey").cast("string")).alias("uri"),
                      F.concat(F.lit("/raw/mpd.slice."), F.year("l_shipdate").cast("string"),
                               F.lit(".json")).alias("path"))
    out = built.select("l_partkey", uri_part("uri").alias("track_id"),
                       slice_name_from_raw("path").alias("slice"))
    return out.select("l_partkey", "track_id", "slice", slice_dir_name("slice").alias("slice_dir")).distinct()


# ------------------------------------------------------------------- F3 ----
def _texts():
    return (F.when(F.col("event_type") == "view", "Yes").when(F.col("event_type") == "click", "TRUE")
            .when(F.col("event_type") == "purchase", "1").when(F.col("event_type") == "signup", "verily")
            .otherwise("no"))


@register("text_to_bool", """
SELECT event_id, t AS flag_text, lower(t) IN ('yes', 'true', 't', '1', 'yea', 'verily') AS flag,
       lower(event_type) IN ('yes', 'true', 't', '1', 'yea', 'verily') AS type_flag
FROM (SELECT *, CASE event_type WHEN 'view' THEN 'Yes' WHEN 'click' THEN 'TRUE'
        WHEN 'purchase' THEN '1' WHEN 'signup' THEN 'verily' ELSE 'no' END AS t FROM events) e""")
def q_text_to_bool(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", _texts().alias("flag_text"))
    return e.select("event_id", "flag_text", text_to_bool("flag_text").alias("flag"),
                    text_to_bool("event_type").alias("type_flag"))


# ------------------------------------------------------------- F4 F5 F6 ----
@register("epoch_units", f"""
SELECT event_id,
       TIMESTAMP '{EPOCH_NTZ}' + to_seconds(date_diff('second', TIMESTAMP '{EPOCH_NTZ}', ts)) AS ts_s,
       TIMESTAMP '{EPOCH_NTZ}' + to_milliseconds(date_diff('millisecond', TIMESTAMP '{EPOCH_NTZ}', ts))
           AS ts_ms,
       TIMESTAMP '{EPOCH_NTZ}' + to_microseconds(date_diff('second', TIMESTAMP '{EPOCH_NTZ}', ts) // 1000)
           AS ts_ns,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed
FROM events""")
def q_epoch_units(spark, sf_dir):
    """F4 seconds, ms; F5 the same seconds read as nanoseconds (D14); F6 text
    → timestamp with unparsable text → null."""
    e = table(spark, sf_dir, "events")
    base = F.lit(EPOCH_NTZ).cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", base, F.col("ts"))
    ms = F.timestamp_diff("MILLISECOND", base, F.col("ts"))
    text = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.col("ts").cast("string"))
    return e.select("event_id",
                    epoch_to_timestamp(secs, "s", ntz=True).alias("ts_s"),
                    epoch_to_timestamp(ms, "ms", ntz=True).alias("ts_ms"),
                    epoch_to_timestamp(secs, "ns", ntz=True).alias("ts_ns"),
                    _ntz(parse_timestamp(text)).alias("parsed"))


# ------------------------------------------------------------------- F7 ----
@register("fill_by_type", """
SELECT o_orderkey, l_linenumber, coalesce(l_returnflag, '<NA>') AS l_returnflag,
       coalesce(l_shipdate, TIMESTAMP '1970-01-01 00:00:00') AS l_shipdate
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def q_fill_by_type(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    j = o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("l_orderkey")
    return fill_by_type(j)


# ------------------------------------------------------------ F8 F9 S7 -----
@register("json_flatten", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props:k"
FROM events""")
def q_json_flatten(spark, sf_dir):
    """S7 + F9: JSON text lines decoded with a declared schema, leaves flattened."""
    e = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "struct<k:bigint>").alias("props"))
    return flatten_columns(e, max_items=1)  # the schema holds no array


_ARTIST_SQL_IMAGES = ("CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 1000 THEN NULL "
                      "ELSE 'img/' || CAST(s_suppkey AS VARCHAR) END")


@register("artist_flatten", f"""
SELECT CAST(CASE WHEN s_acctbal >= 5000 THEN n_nationkey END AS BIGINT) AS artist_follower_total,
       CASE WHEN s_acctbal >= 0 THEN [n_name] ELSE CAST([] AS VARCHAR[]) END AS artist_genres,
       CAST(s_suppkey AS VARCHAR) AS artist_spid,
       {_ARTIST_SQL_IMAGES} AS artist_img_url,
       CAST(s_nationkey AS BIGINT) AS artist_popularity
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def q_artist_flatten(spark, sf_dir):
    """F8 on artist records built from suppliers: missing followers (null
    struct), missing genres (null → []), no images (empty list → null url)."""
    s = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    bal = F.col("s_acctbal")
    rec = F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.when(bal >= 5000, F.struct(F.col("n_nationkey").cast("long").alias("total"))).alias("followers"),
        F.when(bal >= 0, F.array("n_name")).alias("genres"),
        F.when(bal < 0, F.lit(None).cast("array<struct<url:string>>"))
         .when(bal < 1000, F.array().cast("array<struct<url:string>>"))
         .otherwise(F.array(F.struct(F.concat(F.lit("img/"), F.col("s_suppkey").cast("string")).alias("url")),
                            F.struct(F.lit("second").alias("url")))).alias("images"),
        F.col("s_nationkey").cast("long").alias("popularity"))
    return s.select(*flatten_artist(rec))


# ------------------------------------------------------------------ F10 ----
_ATTR_COLS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@register("id_attribute_map", " UNION ALL ".join(
    f"SELECT p_partkey, '{c}' AS key, CAST({c} AS VARCHAR) AS value FROM part" for c in _ATTR_COLS))
def q_id_attribute_map(spark, sf_dir):
    """Node table (id, attribute map), compared exploded."""
    p = table(spark, sf_dir, "part").select("p_partkey", *_ATTR_COLS)
    nodes = id_attribute_map(p, "p_partkey")
    return nodes.select("p_partkey", F.explode("attributes").alias("key", "value"))


# -------------------------------------------------------- F12 F14 F15 ------
@register("parse_list_text", """
SELECT l_orderkey, l_linenumber, 0 AS pos, CAST(l_partkey AS VARCHAR) AS value FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 1 AS pos, CAST(l_suppkey AS VARCHAR) AS value FROM lineitem""")
def q_parse_list_text(spark, sf_dir):
    """lists written as Python-literal text decoded without evaluation."""
    li = table(spark, sf_dir, "lineitem")
    text = F.concat(F.lit("['"), F.col("l_partkey").cast("string"), F.lit("', '"),
                    F.col("l_suppkey").cast("string"), F.lit("']"))
    return (li.select("l_orderkey", "l_linenumber", parse_list_text(text).alias("ids"))
            .select("l_orderkey", "l_linenumber", F.posexplode("ids").alias("pos", "value")))


@register("chunk_array", """
SELECT l_orderkey, l_linenumber, CAST(c AS INTEGER) AS chunk,
       CAST(least(q, c * 10 + 10) - c * 10 AS INTEGER) AS chunk_size,
       CAST(c * 10 + 1 AS INTEGER) AS first_value, CAST(q AS INTEGER) AS flat_size
FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q FROM lineitem) t,
     range(0, CAST(ceil(q / 10.0) AS BIGINT)) r(c)""")
def q_chunk_array(spark, sf_dir):
    """F14 chunks of 10 over 1..quantity per line item; F15 flattening them
    back gives the original length."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.sequence(F.lit(1), F.col("l_quantity").cast("int")).alias("v"))
    ch = li.select("l_orderkey", "l_linenumber", chunk_array("v", 10).alias("chunks"))
    return ch.select("l_orderkey", "l_linenumber", F.posexplode("chunks").alias("chunk", "c"),
                     F.size(F.flatten("chunks")).alias("flat_size")) \
        .select("l_orderkey", "l_linenumber", "chunk", F.size("c").alias("chunk_size"),
                F.get("c", 0).alias("first_value"), "flat_size")


# ------------------------------------------------------------------- A3 ----
@register("dedup_by_key", """
SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) t
WHERE rn = 1""")
def q_dedup_by_key(spark, sf_dir):
    """A3: documents deduplicated by text, the lowest doc_id kept."""
    d = table(spark, sf_dir, "documents").select(
        F.sha2("text", 256).alias("digest"), F.md5("text").alias("text_md5"), "doc_id", "lang", "source", "n_chars")
    first = dedup_first(d, ["digest"], ["doc_id"])  # digests move, texts don't
    return first.select("doc_id", "lang", "source", "n_chars", "text_md5")


_LI_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_lineitem_by_part", f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY
      {", ".join(c + " NULLS FIRST" for c in _LI_ORDER)}) AS rn FROM lineitem) t
WHERE rn = 1""")
def q_dedup_lineitem_by_part(spark, sf_dir):
    """A3 on line items: one row per part, first by a total order."""
    li = table(spark, sf_dir, "lineitem")
    keep = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]
    first = dedup_first(li.select("l_partkey", *_LI_ORDER), ["l_partkey"], _LI_ORDER, carry=keep)
    return first.select("l_partkey", *keep)


@register("first_seen_per_slice", f"""
SELECT slice, l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS slice,
         row_number() OVER (PARTITION BY year(l_shipdate), l_partkey ORDER BY
             {", ".join(c + " NULLS FIRST" for c in _LI_ORDER)}) AS rn FROM lineitem) t
WHERE rn = 1""")
def q_first_seen_per_slice(spark, sf_dir):
    """A4: first occurrence of every item within each slice (ship year)."""
    li = table(spark, sf_dir, "lineitem").withColumn("slice", F.year("l_shipdate"))
    return first_seen(li, ["slice", "l_partkey"], _LI_ORDER, ["l_orderkey", "l_linenumber", "l_suppkey"])


# ------------------------------------------------------ A1 A2 A6 A7 A8 -----
@register("distinct_keys", "SELECT DISTINCT l_partkey FROM lineitem")
def q_distinct_keys(spark, sf_dir):
    return distinct_keys(table(spark, sf_dir, "lineitem"), "l_partkey")


@register("count_non_null", """
SELECT count(*) AS n_rows, count(l_linenumber) AS n_non_null
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def q_count_non_null(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return count_non_null(o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left"), "l_linenumber")


@register("progress_counts", """
WITH t AS (SELECT DISTINCT l_partkey AS k FROM lineitem),
     d AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT (SELECT count(*) FROM t) AS n_total, (SELECT count(*) FROM d) AS n_done,
       (SELECT count(*) FROM (SELECT k FROM t EXCEPT SELECT k FROM d)) AS n_remaining""")
def q_progress_counts(spark, sf_dir):
    """Ids wanted (all parts sold), done (parts with a returned line), remaining."""
    li = table(spark, sf_dir, "lineitem")
    return progress_counts(li.select("l_partkey"),
                           li.filter(F.col("l_returnflag") == "R").select("l_partkey"), "l_partkey")


@register("reconcile_counts", """
SELECT *, n_new + n_stored = n_total AS balanced FROM (
SELECT (SELECT count(*) FROM orders o WHERE NOT EXISTS
            (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS n_new,
       (SELECT count(*) FROM orders o WHERE EXISTS
            (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS n_stored,
       (SELECT count(*) FROM orders) AS n_total)""")
def q_reconcile_counts(spark, sf_dir):
    """Orders not yet having lines + orders having lines = all orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile_counts(o.join(li, "o_orderkey", "left_anti"),
                            o.join(li, "o_orderkey", "left_semi"), o)


# ------------------------------------------------------ X1 J3 J4 J5 J8 -----
@register("remaining_ids", """
SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem""")
def q_remaining_ids(spark, sf_dir):
    """Order ids minus the ids that already have lines."""
    return remaining_ids(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                         "o_orderkey", "l_orderkey")


@register("new_rows_anti", """
SELECT o.* FROM orders o ANTI JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def q_new_rows_anti(spark, sf_dir):
    """Full rows whose key is not stored yet."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return new_rows(table(spark, sf_dir, "orders"), li, "o_orderkey")


@register("new_slices_anti", """
SELECT DISTINCT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS slice FROM lineitem
WHERE year(l_shipdate) * 100 + month(l_shipdate) NOT IN
      (SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) FROM orders)""")
def q_new_slices_anti(spark, sf_dir):
    """Raw slices (ship months) with no cleaned counterpart (order months)."""
    def ym(c):
        return (F.year(c) * 100 + F.month(c)).alias("slice")
    raw = table(spark, sf_dir, "lineitem").select(ym("l_shipdate")).distinct()
    cleaned = table(spark, sf_dir, "orders").select(ym("o_orderdate"))
    return new_slices(raw, cleaned)


@register("lookup_found", """
SELECT c.* FROM customer c SEMI JOIN (SELECT * FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') o ON o.o_custkey = c.c_custkey""")
def q_lookup_found(spark, sf_dir):
    """Stored customer rows whose key is among those of urgent filled orders."""
    urgent = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
    return lookup_found(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").filter(urgent),
                        "c_custkey", "o_custkey")


@register("lookup_missing", """
SELECT DISTINCT o_orderkey AS l_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""")
def q_lookup_missing(spark, sf_dir):
    """J8 + O2: requested ids (orders) absent from the store (line items), sorted."""
    return lookup_missing(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                          "l_orderkey", "o_orderkey").orderBy("l_orderkey")


# ------------------------------------------------------- J1 J2 O1 P8 -------
@register("three_way_inner_sorted", """
SELECT l_orderkey, l_linenumber, l_shipdate AS added_at, p_partkey AS track_spid, p_name AS track_name,
       s_suppkey AS artist_spid, s_name AS artist_name, p_retailprice AS track_price,
       'Liked Songs' AS interaction_style
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""")
def q_three_way_inner_sorted(spark, sf_dir):
    """W6 shape: items ⋈ track features ⋈ artist features, newest first, tagged."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("added_at"),
        F.col("l_partkey").alias("track_spid"), F.col("l_suppkey").alias("artist_spid"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_spid"),
                                            F.col("p_name").alias("track_name"),
                                            F.col("p_retailprice").alias("track_price"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("artist_spid"),
                                                F.col("s_name").alias("artist_name"))
    j = join_on(join_on(li, p, ["track_spid"]), s, ["artist_spid"])
    return (j.orderBy(F.desc("added_at"), "l_orderkey", "l_linenumber")
            .withColumn("interaction_style", F.lit("Liked Songs")))


# ------------------------------------------------------------------- K7 ----
@register("upsert_latest", """
WITH upd AS (
  SELECT 2 * l_partkey AS p_partkey, l_extendedprice / l_quantity AS p_retailprice,
         l_shipdate AS updated_at FROM lineitem),
latest AS (
  SELECT p_partkey, p_retailprice, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY p_partkey
        ORDER BY updated_at DESC NULLS LAST, p_retailprice DESC NULLS LAST) AS rn FROM upd) t
  WHERE rn = 1)
SELECT p_partkey, p_retailprice, CAST(NULL AS TIMESTAMP) AS updated_at
FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM latest)
UNION ALL SELECT * FROM latest""")
def q_upsert_latest(spark, sf_dir):
    """K7: prices by the latest line item of half the number: odd parts stay,
    even ones are replaced, numbers above the parts' are inserted."""
    target = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    upd = table(spark, sf_dir, "lineitem").select(
        (2 * F.col("l_partkey")).alias("p_partkey"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p_retailprice"),
        F.col("l_shipdate").alias("updated_at"))
    return upsert_by_key(target, upd, "p_partkey", "updated_at")


# ----------------------------------------------------------- T2 T4 T5 ------
@register("sample_n", f"""
SELECT * FROM orders
ORDER BY md5(concat_ws('|', '{SEED}', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 10""")
def q_sample_n(spark, sf_dir):
    """T4: exactly 10 orders by a seeded hash order (the sample is the feature)."""
    return sample_n(table(spark, sf_dir, "orders"), 10, ["o_orderkey"], SEED)


@register("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head_n(spark, sf_dir):
    """First rows by key."""
    return head_n(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


# ------------------------------------------------------------- A11 A12 -----
@register("most_featured", """
SELECT s_name, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
GROUP BY s_name ORDER BY n DESC, s_name LIMIT 10""")
def q_most_featured(spark, sf_dir):
    """The ten most featured artists (suppliers) over all entries."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("entries"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return most_featured(li.join(s, F.col("s_suppkey") == F.col("l_suppkey")), "s_name", 10, "entries")


@register("feature_histogram", """
SELECT CAST(CASE WHEN p_retailprice < 900 THEN 0 WHEN p_retailprice >= 2100 THEN 13
            ELSE floor((p_retailprice - 900.0::DOUBLE) * 12.0::DOUBLE / 1200.0::DOUBLE) + 1 END AS BIGINT) AS bin,
       count(*) AS n
FROM part GROUP BY 1""")
def q_feature_histogram(spark, sf_dir):
    """Distribution of one feature (retail price) over 12 equal bins."""
    return feature_histogram(table(spark, sf_dir, "part"), "p_retailprice", 900.0, 2100.0, 12)


@register("feature_histogram_sizes", """
SELECT CAST(CASE WHEN p_size < 5 THEN 0 WHEN p_size >= 45 THEN 9
            ELSE floor((p_size - 5.0::DOUBLE) * 8.0::DOUBLE / 40.0::DOUBLE) + 1 END AS BIGINT) AS bin,
       count(*) AS n
FROM part GROUP BY 1""")
def q_feature_histogram_sizes(spark, sf_dir):
    """A12 over a feature that fills every bin, those below and above the range too."""
    return feature_histogram(table(spark, sf_dir, "part"), "p_size", 5.0, 45.0, 8)


# ----------------------------------------------------------- P22 P19 -------
@register("drop_junk_rows", """
SELECT l_orderkey, l_linenumber, lower(l_returnflag) AS flag_key FROM lineitem
WHERE lower(l_returnflag) NOT IN ('a', '<NA>') OR l_returnflag IS NULL""")
def q_drop_junk_rows(spark, sf_dir):
    """Rows keyed ``a`` or ``<NA>`` removed (keys: lower-cased return flag)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lower("l_returnflag").alias("flag_key"))
    return drop_junk_keys(li, "flag_key")


@register("drop_sparse_columns", """
SELECT o_orderkey, l_linenumber, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def q_drop_sparse_columns(spark, sf_dir):
    """Columns with under 60 % non-null values dropped (the high-discount
    column is mostly null; the 257 orders without lines do not matter)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_discount") > 0.08, F.col("l_discount")).alias("high_discount"))
    j = o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("l_orderkey")
    return drop_sparse_columns(j, 0.6)


# ------------------------------------------------------- B2 B4 P13 P9 ------
@register("enrich_in_batches", f"""
SELECT CAST(p_partkey AS VARCHAR) AS track_spid, 'x:track:' || p_partkey AS track_uri, p_type AS track_type,
       p_size / CAST(50 AS DOUBLE) AS track_danceability, p_retailprice / 2000 AS track_energy,
       CAST(p_size % 12 AS BIGINT) AS track_key, CAST(p_size % 2 AS BIGINT) AS track_mode,
       CAST(60 + p_size AS DOUBLE) AS track_tempo, TIMESTAMP '{PULL_TIME}' AS time_pulled
FROM part WHERE p_partkey IN (SELECT 2 * l_partkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_enrich_in_batches(spark, sf_dir):
    """Records of the wanted ids (twice the returned part numbers: half
    of them have no record) from the stored record table (``part``), renamed,
    prefixed, stamped and conformed."""
    ids = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        (2 * F.col("l_partkey")).cast("string").alias("id"))
    size = F.col("p_size")
    records = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("x:track:"), F.col("p_partkey")).alias("uri"),
        F.col("p_type").alias("type"), (size / F.lit(50.0)).alias("danceability"),
        (F.col("p_retailprice") / 2000).alias("energy"), (size % 12).alias("key"), (size % 2).alias("mode"),
        (size + 60).alias("tempo"))
    rec = enrich_from_table(ids, "id", records, "id", TRACK_FEATURE_RECORD)
    feats = track_features_frame(rec, PULL_TIME)
    return feats.select("track_spid", "track_uri", "track_type", "track_danceability", "track_energy",
                        "track_key", "track_mode", "track_tempo", _ntz(F.col("time_pulled")).alias("time_pulled"))


# ---------------------------------------------------------- F9 long form ---
_NESTED_LEAVES = [
    ("order:key", "CAST(l_orderkey AS VARCHAR)"),
    ("order:line", "CAST(l_linenumber AS VARCHAR)"),
    ("track:id", "CAST(l_partkey AS VARCHAR)"),
    ("track:artists:0:id", "CAST(l_suppkey AS VARCHAR)"),
    ("track:artists:0:flag", "l_returnflag"),
    ("track:artists:1:id", "CAST(l_suppkey + 1 AS VARCHAR)"),
    ("track:artists:1:flag", "l_linestatus"),
    ("tags:status", "l_linestatus"),
]


@register("flatten_entries", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{k}' AS key, {v} AS value FROM lineitem" for k, v in _NESTED_LEAVES))
def q_flatten_entries(spark, sf_dir):
    """F9 (long form): every leaf of a nested record — structs, an array of
    artist structs and a map — as (key, value) rows, all list elements kept."""
    li = table(spark, sf_dir, "lineitem")
    rec = li.select(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line")).alias("order"),
        F.struct(F.col("l_partkey").alias("id"),
                 F.array(F.struct(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("flag")),
                         F.struct((F.col("l_suppkey") + 1).alias("id"), F.col("l_linestatus").alias("flag")))
                 .alias("artists")).alias("track"),
        F.create_map(F.lit("status"), F.col("l_linestatus")).alias("tags"))
    ents = flatten_entries(rec.withColumn("_id", F.struct("l_orderkey", "l_linenumber"))
                           .drop("l_orderkey", "l_linenumber"), "_id")
    return ents.select(F.col("_id.l_orderkey").alias("l_orderkey"),
                       F.col("_id.l_linenumber").alias("l_linenumber"), "key", "value")
