"""Queries on stored files: slices, JSON, CSV, text, parquet and the keyed store.

Each query derives files from whole driver tables, writes them below the
session's checkpoint folder through the library's sinks, reads them back
through its sources and returns rows whose SQL needs no files at all.
A slice here holds the orders of one block of 1000 keys, so a slice document
is bounded whatever the table's size.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.functions.flatten import flatten_paths, rename_select
from setlist.functions.scalars import ceil_div, to_json_text
from setlist.operators import store
from setlist.operators.clean import collect_items, playlist_items_long
from setlist.operators.ledger import enrich_with_ledger, ledger_schema, report
from setlist.operators.split import holdout_split, range_layout
from setlist.operators.upsert import read_store, write_upsert
from setlist.plans.jobs import LIKED_RENAMES, select_playlist_features
from setlist.plans.tables import SEED, TABLE_SCHEMAS, TEST_FRAC, table
from setlist.schemas import CLEANED_PLAYLIST, CLEANED_TRACK
from setlist.session import checkpoint_dir, materialize
from setlist.sinks.writers import (append_parquet, save_csv, save_json_lines, save_model_table,
                                   save_parquet, save_sample)
from setlist.sources.readers import (read_csv, read_json_lines, read_liked_pages, read_or_empty,
                                     read_parquet, read_raw_files, read_text_lines)
from setlist.streaming.incremental import DONE, clean_files, clean_new_slices, clean_slices_stream
from setlist._workers import ship_by_value

ship_by_value(__name__)

QUERIES: dict = {}
ORACLES: dict = {}

SLICE_ORDERS = 1000
PAGE_ROWS = 50


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _folder(spark) -> str:
    """A new folder on the storage that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/setlist-files/{uuid.uuid4().hex}"


def _schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_SCHEMAS[name])


# ----------------------------------------------------------- slice files ---
def _write_slices(spark, sf_dir, path: str, parity: int | None = None) -> None:
    """Raw slice files: one JSON document of at most SLICE_ORDERS playlists each;
    ``parity`` adds those of even or odd number only."""
    def block(key: str):
        return F.floor(F.col(key) / SLICE_ORDERS)

    # Narrow rows of both tables are dealt by block in one shuffle; playlists and documents are put
    # together where they lie.
    orders = table(spark, sf_dir, "orders").select(block("o_orderkey").alias("block"), F.col("o_orderkey").alias("pid"), F.struct(
        "o_orderpriority", "o_orderstatus", "o_orderdate", "o_custkey").alias("o"))
    entries = table(spark, sf_dir, "lineitem").select(block("l_orderkey").alias("block"), F.col("l_orderkey").alias("pid"), F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity").alias("l"))
    rows = orders.unionByName(entries, allowMissingColumns=True).where("pid IS NOT NULL")
    dealt = (rows if parity is None else rows.where(F.col("block") % 2 == parity)).repartition("block")
    entry = F.struct(
        F.col("l.l_linenumber").alias("pos"), F.format_string("x:track:%d", "l.l_partkey").alias("track_uri"),
        F.format_string("part %d", "l.l_partkey").alias("track_name"),
        F.format_string("supplier %d", "l.l_suppkey").alias("artist_name"),
        F.format_string("x:artist:%d", "l.l_suppkey").alias("artist_uri"),
        F.col("l.l_returnflag").alias("album_name"), F.format_string("x:album:%s", "l.l_returnflag").alias("album_uri"),
        F.col("l.l_quantity").cast("long").alias("duration_ms"))
    # An order that stands twice is two playlists of the same entries; one without entries is none.
    lists = (dealt.groupBy("block", "pid").agg(F.collect_list("o").alias("o"),
                                               F.array_sort(F.collect_list(F.when(F.col("l").isNotNull(), entry))).alias("tracks"))
             .where(F.size("tracks") > 0).select("block", "pid", F.explode("o").alias("o"), "tracks"))
    playlist = F.struct(
        F.col("pid"), F.col("o.o_orderpriority").alias("name"),
        F.when(F.col("o.o_orderstatus") == "F", "true").otherwise("false").alias("collaborative"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("o.o_orderdate")).alias("modified_at"),
        F.col("o.o_custkey").alias("num_followers"), F.size("tracks").cast("long").alias("num_edits"), "tracks")
    docs = lists.groupBy("block").agg(to_json_text(F.array_sort(F.collect_list(playlist)).alias("playlists")).alias("value"))
    (docs.select(F.format_string("mpd.slice.%d", "block").alias("file"), "value")
     .write.mode("append").partitionBy("file").option("compression", "gzip").text(path))


def _cleaned(spark, sf_dir) -> str:
    """Raw slices written, read, cleaned and stored; the store's folder."""
    path = _folder(spark)
    _write_slices(spark, sf_dir, f"{path}/raw")
    # Spark names the files; the slice's name is that of the folder.
    clean_files(read_raw_files(spark, f"{path}/raw", lambda p: F.regexp_extract(p, "file=([^/]+)/", 1)), f"{path}/clean")
    return f"{path}/clean"


_SLICE = f"concat('mpd.slice.', CAST(l_orderkey // {SLICE_ORDERS} AS VARCHAR))"


@register("cleaned_playlists", f"""
SELECT {_SLICE} AS slice, o_orderkey AS pid, o_orderpriority AS name, o_orderstatus = 'F' AS collaborative,
       TIMESTAMP '1970-01-01' + to_seconds(date_diff('second', TIMESTAMP '1970-01-01', o_orderdate)) AS modified_at,
       o_custkey AS num_followers, count(*) AS num_edits,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS track_ids
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def q_cleaned_playlists(spark, sf_dir):
    """Raw JSON slices cleaned into the playlist table;
    its ids in long form and back to one ordered list."""
    stored = read_parquet(spark, f"{_cleaned(spark, sf_dir)}/playlists", CLEANED_PLAYLIST)
    ids = collect_items(playlist_items_long(stored))
    typed = select_playlist_features(stored).withColumn("modified_at", F.col("modified_at").cast("timestamp_ntz"))
    return (typed.join(stored.select("pid", "slice"), "pid")
            .join(ids.select("pid", F.array_join("track_ids", ",").alias("track_ids")), "pid"))


@register("cleaned_tracks", f"""
SELECT slice, track_id, artist_name, album_uri, pos, duration_ms FROM (
  SELECT {_SLICE} AS slice, CAST(l_partkey AS VARCHAR) AS track_id, concat('supplier ', l_suppkey) AS artist_name,
         concat('x:album:', l_returnflag) AS album_uri, l_linenumber AS pos,
         CAST(trunc(l_quantity) AS BIGINT) AS duration_ms,
         row_number() OVER (PARTITION BY {_SLICE}, l_partkey ORDER BY l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR),
             l_returnflag, trunc(l_quantity)) AS rn
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey) t
WHERE rn = 1""")
def q_cleaned_tracks(spark, sf_dir):
    """First occurrence of every track in each slice."""
    stored = read_parquet(spark, f"{_cleaned(spark, sf_dir)}/tracks", CLEANED_TRACK)
    return stored.select("slice", "track_id", "artist_name", "album_uri", "pos", "duration_ms")


@register("slices_stream_then_batch", f"""
SELECT step, count(DISTINCT s) AS n_slices, count(DISTINCT o_orderkey) AS n_playlists FROM (
  SELECT o_orderkey, o_orderkey // {SLICE_ORDERS} AS s FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) o,
  (VALUES ('1 stream'), ('2 batch'), ('3 stream again'), ('4 batch again')) v(step)
WHERE s % 2 = 0 OR step <> '1 stream' GROUP BY step""")
def q_slices_stream_then_batch(spark, sf_dir):
    """The stream cleans the slices of even number, 30 files a core in a step; the odd ones
    arrive and the batch form cleans those only; a stream with a new checkpoint and a
    second batch run find every slice done."""
    path = _folder(spark)
    raw, out, seen = f"{path}/raw", f"{path}/clean", []
    files = {"pattern": "part-*", "name": lambda p: F.regexp_extract(p, "file=([^/]+)/", 1)}

    def count(step: str) -> DataFrame:
        stored = read_parquet(spark, f"{out}/playlists", CLEANED_PLAYLIST).agg(F.count(F.lit(1)).alias("n"))
        # Rows of the table of done slices: one that was cleaned twice would count twice.
        done = spark.read.schema(DONE).parquet(f"{out}/done")
        return materialize(done.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n_slices"))
                           .select("step", "n_slices", stored.scalar().alias("n_playlists")))

    _write_slices(spark, sf_dir, raw, parity=0)
    clean_slices_stream(spark, raw, out, f"{path}/checkpoint1", **files)
    seen.append(count("1 stream"))
    _write_slices(spark, sf_dir, raw, parity=1)
    clean_new_slices(spark, raw, out, **files)
    seen.append(count("2 batch"))
    clean_slices_stream(spark, raw, out, f"{path}/checkpoint2", **files)
    seen.append(count("3 stream again"))
    clean_new_slices(spark, raw, out, **files)
    seen.append(count("4 batch again"))
    return reduce(DataFrame.unionAll, seen)


# ----------------------------------------------------------- other files ---
@register("json_lines_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_json_lines_round_trip(spark, sf_dir):
    """K4 + S6: customers as JSON lines."""
    path = _folder(spark)
    save_json_lines(table(spark, sf_dir, "customer"), path)
    return read_json_lines(spark, path, _schema("customer"))


@register("text_lines_round_trip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_text_lines_round_trip(spark, sf_dir):
    """F17 + S7: customers as JSON text, one line a row, decoded again."""
    path = _folder(spark)
    customers = table(spark, sf_dir, "customer")
    customers.select(to_json_text(*customers.columns).alias("value")).write.text(path)
    return read_text_lines(spark, path, _schema("customer"))


@register("csv_round_trip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_csv_round_trip(spark, sf_dir):
    """K6 + S11: parts as CSV with a header."""
    path = _folder(spark)
    save_csv(table(spark, sf_dir, "part"), path)
    return read_csv(spark, path, _schema("part"))


@register("appended_parquet", """
SELECT o_orderkey, o_orderstatus, 0 AS n_before FROM orders""")
def q_appended_parquet(spark, sf_dir):
    """Nothing stored reads as empty; orders saved by
    status, two writes, read with two columns."""
    path, orders = _folder(spark), table(spark, sf_dir, "orders")
    before = read_or_empty(spark, path, orders.schema).agg(F.count(F.lit(1)).cast("int").alias("n_before"))
    before = before.first()[0]
    save_parquet(orders.filter("o_orderstatus = 'F'"), path)
    append_parquet(orders.filter("o_orderstatus <> 'F' OR o_orderstatus IS NULL"), path)
    return (read_parquet(spark, path, orders.schema, ["o_orderkey", "o_orderstatus"])
            .withColumn("n_before", F.lit(before)))


@register("stored_or_empty", """
SELECT 'missing' AS kind, 0 AS n_rows, CAST(NULL AS BIGINT) AS keys
UNION ALL SELECT 'stored', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'stored, no rows', 0, NULL""")
def q_stored_or_empty(spark, sf_dir):
    """A path that does not exist, one with all customers, one that was saved without rows."""
    path, rows = _folder(spark), table(spark, sf_dir, "customer")
    save_parquet(rows, f"{path}/all")
    save_parquet(rows.where("false"), f"{path}/none")
    def told(kind, name):
        return read_or_empty(spark, f"{path}/{name}", rows.schema).agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("keys"))
    return told("missing", "nowhere").unionAll(told("stored", "all")).unionAll(told("stored, no rows", "none"))


@register("model_and_sample_tables", """
SELECT 'model' AS kept, s_suppkey, s_name FROM supplier
UNION ALL (SELECT 'sample', s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 5)""")
def q_model_and_sample_tables(spark, sf_dir):
    """K8/K10 (a model table is never overwritten) and K9 (the sample is the feature)."""
    path, rows = _folder(spark), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    save_model_table(rows, f"{path}/model")
    save_sample(rows, f"{path}/sample", "s_suppkey", 5)
    return read_parquet(spark, f"{path}/model", rows.schema).select(F.lit("model").alias("kept"), "*").unionByName(
        read_parquet(spark, f"{path}/sample", rows.schema).select(F.lit("sample").alias("kept"), "*"))


@register("range_layout", """
SELECT o_orderkey, o_totalprice, 0 AS n_out_of_order FROM orders""")
def q_range_layout(spark, sf_dir):
    """O3: orders laid out by key ranges; every row carries the number of
    files whose range begins before that of the file before it ends."""
    path = _folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    save_parquet(range_layout(orders, "o_orderkey", 8), path)
    stored = spark.read.schema(orders.schema).parquet(path)
    span = (stored.groupBy(F.col("_metadata.file_path"))
            .agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")))
    spans = span.agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("s"))  # eight files
    faults = F.filter("s", lambda x, i: (i > 0) & (F.get("s", i - 1)["hi"] >= x["lo"]))
    return stored.withColumn("n_out_of_order", spans.select(F.size(faults)).scalar())


@register("upsert_store", """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 ELSE p_retailprice END AS price,
       CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM part
UNION ALL SELECT -1 - p_partkey, NULL, p_retailprice * 2, 2 FROM part WHERE p_partkey % 3 = 0""")
def q_upsert_store(spark, sf_dir):
    """K7 on the stored table: a third of the parts replaced, as many new keys
    inserted, the update applied twice; the names of new keys are null."""
    path = _folder(spark)
    first = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price"),
                                                F.lit(1).alias("version"))
    write_upsert(spark, path, first, "p_partkey", first.schema, "version")
    third = first.filter("p_partkey % 3 = 0").withColumn("price", F.col("price") * 2).withColumn("version", F.lit(2))
    fresh = third.unionByName(third.select((-1 - F.col("p_partkey")).alias("p_partkey"),
                                           F.lit(None).cast("string").alias("p_name"), "price", "version"))
    for _ in range(2):
        write_upsert(spark, path, fresh, "p_partkey", fresh.schema, "version")
    return read_store(spark, path)


_WANTED_IDS = "SELECT DISTINCT 2 * l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'"


def _by_id(ids: list, rows) -> list:
    """The stored records of the ids of one call, in their order."""
    found = {r["id"]: r for r in rows.to_dict("records")}
    return [found.get(i) for i in ids]


def _ledgered(spark, sf_dir) -> tuple[DataFrame, str, T.StructType]:
    """Two runs that share half of their ids over one ledger: the second asks for the rest only."""
    path = _folder(spark)
    ids = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select((2 * F.col("l_partkey")).alias("id"))
    records = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_type", "p_size")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("p_type", T.StringType()), T.StructField("p_size", T.IntegerType())])
    for some in (ids.where("id % 4 = 0"), ids):
        out = enrich_with_ledger(some, "id", _by_id, schema, path, ids_per_partition=1000, wave_ids=2000, records=records, record_key="id")
    return out, path, ledger_schema(T.LongType(), schema)


@register("enrich_with_ledger", f"SELECT p_partkey AS id, p_type, p_size FROM part WHERE p_partkey IN ({_WANTED_IDS})")
def q_enrich_with_ledger(spark, sf_dir):
    """Records fetched in calls of 100 ids, in waves, answers kept in a ledger."""
    return _ledgered(spark, sf_dir)[0]


@register("enrich_ledger_report", f"""
SELECT CASE WHEN p_partkey IS NULL THEN 'none' ELSE 'found' END AS status, count(*) AS n_ids, count(*) AS n_rows
FROM ({_WANTED_IDS}) w LEFT JOIN part ON p_partkey = w.id GROUP BY 1""")
def q_enrich_ledger_report(spark, sf_dir):
    """After both runs every id stands in the ledger once: it was asked for once."""
    _, path, schema = _ledgered(spark, sf_dir)
    return report(spark, path, schema)


#: Rows of a range of the stored parts, so that the table is split and split again as it grows.
STORE_ROWS = 500


def _versioned(spark, sf_dir) -> str:
    """Three versions: the parts, a third of them replaced and as many keys added, one key changed."""
    path = _folder(spark)
    first = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price"),
                                                F.lit(1).alias("version"))
    store.upsert(spark, path, first, "p_partkey", "version", max_rows=STORE_ROWS)
    third = first.filter("p_partkey % 3 = 0").withColumn("price", F.col("price") * 2).withColumn("version", F.lit(2))
    more = third.unionByName(third.select((-1 - F.col("p_partkey")).alias("p_partkey"), "price", "version"), allowMissingColumns=True)
    store.upsert(spark, path, more, "p_partkey", "version", max_rows=STORE_ROWS)
    store.upsert(spark, path, first.where("p_partkey = 1").select("p_partkey", F.lit(3).alias("version"), F.lit("new").alias("note")), "p_partkey",
                 max_rows=STORE_ROWS)
    return path


@register("versioned_store", """
SELECT p_partkey, CASE WHEN p_partkey = 1 THEN NULL ELSE p_name END AS p_name,
       CASE WHEN p_partkey = 1 THEN NULL WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 ELSE p_retailprice END AS price,
       CASE WHEN p_partkey = 1 THEN 3 WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS version,
       CASE WHEN p_partkey = 1 THEN 'new' END AS note FROM part
UNION ALL SELECT -1 - p_partkey, NULL, p_retailprice * 2, 2, NULL FROM part WHERE p_partkey % 3 = 0""")
def q_versioned_store(spark, sf_dir):
    """K7 with a manifest: the newest version after three upserts."""
    return store.read(spark, _versioned(spark, sf_dir))


@register("versioned_store_history", """
SELECT 1 AS of_version, count(*) AS n_rows, CAST(sum(1) AS BIGINT) AS marks, round(sum(p_retailprice), 2) AS price FROM part
UNION ALL SELECT 2, count(*) + count(*) FILTER (WHERE p_partkey % 3 = 0),
       CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 4 ELSE 1 END) AS BIGINT),
       round(sum(CASE WHEN p_partkey % 3 = 0 THEN 4 * p_retailprice ELSE p_retailprice END), 2) FROM part
UNION ALL SELECT 3, count(*) + count(*) FILTER (WHERE p_partkey % 3 = 0),
       CAST(sum(CASE WHEN p_partkey = 1 THEN 3 WHEN p_partkey % 3 = 0 THEN 4 ELSE 1 END) AS BIGINT),
       round(sum(CASE WHEN p_partkey = 1 THEN 0 WHEN p_partkey % 3 = 0 THEN 4 * p_retailprice ELSE p_retailprice END), 2) FROM part""")
def q_versioned_store_history(spark, sf_dir):
    """K7: what a reader of each version sees after all upserts."""
    path = _versioned(spark, sf_dir)
    seen = [store.read(spark, path, v).agg(F.lit(v).alias("of_version"), F.count(F.lit(1)).alias("n_rows"), F.sum("version").alias("marks"),
                                           F.round(F.sum("price"), 2).alias("price")) for v in store.versions(spark, path)]
    return seen[0].unionAll(seen[1]).unionAll(seen[2])


@register("split_by_position", f"""
SELECT pid, entry, item, CASE WHEN rk <= ceil(sz * {TEST_FRAC}) THEN 'test' ELSE 'train' END AS part FROM (
  SELECT pid, entry, item,
         row_number() OVER (PARTITION BY pid ORDER BY
             md5(concat_ws('|', '{SEED}', CAST(pid AS VARCHAR), entry)), entry) AS rk,
         count(*) OVER (PARTITION BY pid) AS sz
  FROM (SELECT l_orderkey AS pid, concat_ws('-', l_linenumber, l_partkey) AS entry, l_partkey AS item
        FROM lineitem) e) t WHERE sz >= 2""")
def q_split_by_position(spark, sf_dir):
    """The entries of a list are split, items that repeat in it
    included; line numbers repeat in the table, so the item tells them apart."""
    entries = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pid"), F.concat_ws("-", "l_linenumber", "l_partkey").alias("entry"),
        F.col("l_partkey").alias("item"))
    return holdout_split(entries, "pid", "entry", TEST_FRAC, SEED)


@register("saved_item_pages", f"""
SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS added_at, concat(l_orderkey, '-', l_linenumber) AS track_spid,
       p_name AS track_name, CAST(p_size AS BIGINT) AS track_popularity, CAST(l_suppkey AS VARCHAR) AS artist_spid,
       CASE WHEN l_linenumber > 1 THEN s_name END AS album_artist_name, NULL AS album_img_url,
       l_returnflag = 'R' AS track_explicit,
       CAST(ceil((SELECT count(*) FROM lineitem WHERE l_orderkey = l.l_orderkey) / {PAGE_ROWS}.0) AS BIGINT) AS n_pages
FROM lineitem l JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""")
def q_saved_item_pages(spark, sf_dir):
    """Pages of saved items (one per order) read back,
    flattened by path and renamed; the pages a listing of the order needs."""
    path = _folder(spark)
    li = table(spark, sf_dir, "lineitem")
    rows = (li.join(table(spark, sf_dir, "part"), li.l_partkey == F.col("p_partkey"))
            .join(table(spark, sf_dir, "supplier"), li.l_suppkey == F.col("s_suppkey")))
    artist = F.struct(F.col("l_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    album = F.struct(F.col("l_returnflag").alias("id"),
                     F.when(F.col("l_linenumber") > 1, F.array(artist)).alias("artists"))
    track = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("p_name").alias("name"),
                     (F.col("l_returnflag") == "R").alias("explicit"),
                     F.col("p_size").cast("long").alias("popularity"), F.array(artist).alias("artists"),
                     album.alias("album"))
    item = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"), track.alias("track"))
    # Flat rows are dealt by block once; pages and documents are put together where they lie.
    flat = (rows.select(F.floor(F.col("l_orderkey") / SLICE_ORDERS).alias("block"), "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                        "l_shipdate", "p_name", "p_size", "s_name").repartition("block"))
    pages = flat.groupBy("block", "l_orderkey").agg(F.collect_list(item).alias("items"))
    # A file holds the pages of one block of orders, as one array document.
    docs = pages.groupBy("block").agg(F.to_json(F.collect_list(F.struct("items"))).alias("value"))
    docs.write.partitionBy("block").option("compression", "gzip").text(path)
    flat = flatten_paths(read_liked_pages(spark, path), ["added_at", *LIKED_RENAMES])
    saved = rename_select(flat, LIKED_RENAMES, keep_first=["added_at"])
    sizes = li.groupBy(F.col("l_orderkey").cast("string").alias("o")).agg(
        ceil_div(F.count(F.lit(1)), F.lit(PAGE_ROWS)).alias("n_pages"))
    return (saved.join(sizes, F.substring_index("track_spid", "-", 1) == F.col("o"))
            .select("added_at", "track_spid", "track_name", "track_popularity", "artist_spid", "album_artist_name",
                    "album_img_url", "track_explicit", "n_pages"))
