"""Recommendation-chain queries on the driver's tables.

Every function takes ``(spark, sf_dir)`` and reads whole tables.  The oracle
SQL next to each is the same computation written plainly for DuckDB (brute
force cosine over all pairs, which is fine at the check's scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlist.operators.evaluate import evaluate
from setlist.operators.similarity import (item_matrix_bytes, item_vectors, query_means_from_pairs,
                                          recommend_from_pairs)
from setlist.operators.segments import segment_items, segments
from setlist.operators.split import holdout_split, inference_example, sample_n, split_two_tables
from setlist.plans.jobs import batch_recommend
from setlist.session import materialize
from setlist.plans.tables import (EMBED_DIM, SEED, TEST_FRAC, TOP_N, embedding_items,
                                  playlist_pairs, table)

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ SQL ----
_DIMS = range(1, EMBED_DIM + 1)

SQL_SPLIT = f"""
pairs AS (
  SELECT DISTINCT l_orderkey AS pid, l_partkey % (SELECT count(*) FROM embeddings) AS item
  FROM lineitem),
ranked AS (
  SELECT pid, item,
         row_number() OVER (PARTITION BY pid ORDER BY
             md5(concat_ws('|', '{SEED}', CAST(pid AS VARCHAR), CAST(item AS VARCHAR))), item) AS rk,
         count(*) OVER (PARTITION BY pid) AS sz
  FROM pairs),
split AS (
  SELECT pid, item, CASE WHEN rk <= ceil(sz * {TEST_FRAC}) THEN 'test' ELSE 'train' END AS part
  FROM ranked WHERE sz >= 2)"""

_AVG_LIST = ", ".join(f"avg(CAST(e.embedding[{i}] AS DOUBLE))" for i in _DIMS)

SQL_QV = f"""
qv AS (
  SELECT s.pid, list_value({_AVG_LIST}) AS q, count(*) AS n_known
  FROM split s JOIN embeddings e ON e.vec_id = s.item
  WHERE s.part = 'train' GROUP BY s.pid)"""


def _sql_topn(n_expr: str, exclude: bool, extra_ctes: str = "", qv_join: str = "") -> str:
    excl = ("LEFT JOIN split x ON x.pid = qv.pid AND x.item = e.vec_id AND x.part = 'train' "
            "WHERE x.pid IS NULL") if exclude else ""
    return f"""
scored AS (
  SELECT qv.pid, e.vec_id AS item, {n_expr} AS n_req,
         list_cosine_similarity(qv.q, CAST(e.embedding AS DOUBLE[])) AS cos
  FROM qv {qv_join} CROSS JOIN embeddings e {excl}),
top AS (
  SELECT pid, item, cos, n_req,
         row_number() OVER (PARTITION BY pid ORDER BY cos DESC, item) AS rank
  FROM scored)"""


SQL_COSINE_TOPN = ("WITH" + SQL_SPLIT + "," + SQL_QV + "," + _sql_topn(str(TOP_N), False) +
                   "\nSELECT pid, rank, item, round(cos, 6) AS cosine FROM top WHERE rank <= n_req")
SQL_COSINE_TOPN_EX = ("WITH" + SQL_SPLIT + "," + SQL_QV + "," + _sql_topn(str(TOP_N), True) +
                      "\nSELECT pid, rank, item, round(cos, 6) AS cosine FROM top WHERE rank <= n_req")
SQL_VARIABLE_N = ("WITH" + SQL_SPLIT + "," + SQL_QV + "," +
                  _sql_topn("qv.n_known", False) +
                  "\nSELECT pid, rank, item, round(cos, 6) AS cosine FROM top WHERE rank <= n_req")

_SQL_EVAL_TAIL = """,
nt AS (SELECT pid, count(*) AS n_test FROM split WHERE part = 'test' GROUP BY pid),
{topn},
hits AS (
  SELECT t.pid, count(DISTINCT t.item) AS hits FROM top t
  JOIN split s ON s.pid = t.pid AND s.item = t.item AND s.part = 'test'
  WHERE t.rank <= t.n_req GROUP BY t.pid),
pl AS (SELECT DISTINCT pid FROM split {sample})
SELECT pl.pid, coalesce(nt.n_test, 0) AS n_test, coalesce(qv.n_known, 0) AS n_known,
       coalesce(hits.hits, 0) AS hits,
       CASE WHEN coalesce(nt.n_test, 0) = 0 THEN NULL
            WHEN coalesce(qv.n_known, 0) = 0 THEN 0.0
            ELSE coalesce(hits.hits, 0) / nt.n_test END AS hit_rate
FROM pl LEFT JOIN nt ON nt.pid = pl.pid LEFT JOIN qv ON qv.pid = pl.pid
LEFT JOIN hits ON hits.pid = pl.pid"""

SQL_HIT_RATE = ("WITH" + SQL_SPLIT + "," + SQL_QV + _SQL_EVAL_TAIL.format(
    topn=_sql_topn("nt.n_test", False, qv_join="JOIN nt ON nt.pid = qv.pid"), sample=""))
SQL_HIT_RATE_EX = ("WITH" + SQL_SPLIT + "," + SQL_QV + _SQL_EVAL_TAIL.format(
    topn=_sql_topn("nt.n_test", True, qv_join="JOIN nt ON nt.pid = qv.pid"), sample=""))

EVAL_SAMPLE = 100
_SAMPLE_ORDER = f"md5(concat_ws('|', '{SEED}', CAST(pid AS VARCHAR))), pid"
SQL_EVAL_SAMPLE = ("WITH" + SQL_SPLIT + "," + SQL_QV + _SQL_EVAL_TAIL.format(
    topn=_sql_topn("nt.n_test", False, qv_join="JOIN nt ON nt.pid = qv.pid"),
    sample=f"ORDER BY {_SAMPLE_ORDER} LIMIT {EVAL_SAMPLE}"))

SQL_HOLDOUT = "WITH" + SQL_SPLIT + "\nSELECT pid, item, part FROM split"

_WIDE = ", ".join(f"round(avg(CAST(e.embedding[{i}] AS DOUBLE)), 6) AS f{i - 1}" for i in _DIMS)
SQL_QUERY_VECTOR_TABLE = ("WITH" + SQL_SPLIT + f""",
nt AS (SELECT pid, count(*) FILTER (WHERE part = 'test') AS n_test,
              count(*) FILTER (WHERE part = 'train') AS n_train FROM split GROUP BY pid)
SELECT s.pid, nt.n_train, nt.n_test, count(*) AS n_known, {_WIDE}
FROM split s JOIN embeddings e ON e.vec_id = s.item JOIN nt ON nt.pid = s.pid
WHERE s.part = 'train' GROUP BY s.pid, nt.n_train, nt.n_test""")

SQL_QUERY_VECTORS = ("WITH" + SQL_SPLIT + f""",
long AS (
  SELECT s.pid, CAST(g.d - 1 AS INTEGER) AS dim, CAST(e.embedding[g.d] AS DOUBLE) AS v
  FROM split s JOIN embeddings e ON e.vec_id = s.item
  CROSS JOIN (SELECT range AS d FROM range(1, {EMBED_DIM + 1})) g
  WHERE s.part = 'train')
SELECT pid, dim, round(avg(v), 6) AS value FROM long GROUP BY pid, dim""")

SQL_SPLIT_TRAIN = "WITH" + SQL_SPLIT + "\nSELECT pid, item FROM split WHERE part = 'train'"
SQL_SPLIT_TEST = "WITH" + SQL_SPLIT + "\nSELECT pid, item FROM split WHERE part = 'test'"

SQL_INFERENCE_EXAMPLE = ("WITH" + SQL_SPLIT + """,
first3 AS (SELECT DISTINCT pid FROM split ORDER BY pid LIMIT 3)
SELECT s.pid, string_agg(CAST(s.item AS VARCHAR), ',' ORDER BY s.item) AS track_ids, 5 AS n
FROM split s JOIN first3 f ON f.pid = s.pid WHERE s.part = 'train' GROUP BY s.pid""")


# ---------------------------------------------------------------- Spark ----
def _split(spark, sf_dir) -> DataFrame:
    """The hold-out split, written once to the session's checkpoint folder.

    Every recommendation query reads it several times (pairs, sizes, train,
    test); a reliable checkpoint computes the windowed ranking once and
    lets a lost executor's downstream tasks re-read files instead of
    recomputing the split."""
    return materialize(holdout_split(playlist_pairs(spark, sf_dir), "pid", "item", TEST_FRAC, SEED))


def _rounded(recs: DataFrame) -> DataFrame:
    return recs.select("pid", "rank", "item", F.round("cosine", 6).alias("cosine"))


def _train(split: DataFrame) -> DataFrame:
    return split.filter(F.col("part") == "train").drop("part")


def _qv(train: DataFrame, items: DataFrame, cols, stats, carry=()) -> DataFrame:
    """Query vectors of split train pairs (already distinct by construction)."""
    return query_means_from_pairs(train, items, cols, pairs_distinct=True, item_stats=stats, carry=carry)


def _items(spark, sf_dir):
    """Item table, its columns and its checked size (one count job)."""
    items, cols = embedding_items(spark, sf_dir)
    return items, cols, item_matrix_bytes(items, cols)


@register("holdout_split", SQL_HOLDOUT)
def q_holdout_split(spark, sf_dir):
    return holdout_split(playlist_pairs(spark, sf_dir), "pid", "item", TEST_FRAC, SEED)


@register("cosine_topn", SQL_COSINE_TOPN)
def q_cosine_topn(spark, sf_dir):
    items, cols, stats = _items(spark, sf_dir)
    train = _train(_split(spark, sf_dir))
    return _rounded(recommend_from_pairs(train, items, TOP_N, cols, pairs_distinct=True, item_stats=stats))


@register("cosine_topn_excluding_seen", SQL_COSINE_TOPN_EX)
def q_cosine_topn_excluding_seen(spark, sf_dir):
    items, cols, stats = _items(spark, sf_dir)
    train = _train(_split(spark, sf_dir))
    return _rounded(recommend_from_pairs(train, items, TOP_N, cols, pairs_distinct=True,
                                         exclude_seen=True, item_stats=stats))


#: Tiles that the catalogue is cut into where a query shows the path for any size.
TILES = 4


@register("cosine_topn_tiled", SQL_COSINE_TOPN)
def q_cosine_topn_tiled(spark, sf_dir):
    """R3 + R4 with a broadcast bound of a quarter of the catalogue."""
    items, cols, stats = _items(spark, sf_dir)
    train = _train(_split(spark, sf_dir))
    return _rounded(recommend_from_pairs(train, items, TOP_N, cols, pairs_distinct=True, item_stats=stats,
                                         broadcast_max_bytes=-(-stats[1] // TILES)))


@register("cosine_topn_excluding_seen_tiled", SQL_COSINE_TOPN_EX)
def q_cosine_topn_excluding_seen_tiled(spark, sf_dir):
    items, cols, stats = _items(spark, sf_dir)
    train = _train(_split(spark, sf_dir))
    return _rounded(recommend_from_pairs(train, items, TOP_N, cols, pairs_distinct=True, exclude_seen=True,
                                         item_stats=stats, broadcast_max_bytes=-(-stats[1] // TILES)))


@register("recommend_batch_variable_n", SQL_VARIABLE_N)
def q_recommend_batch_variable_n(spark, sf_dir):
    """Per-row n — each playlist asks for as many items as it has known train items."""
    items, cols, stats = _items(spark, sf_dir)
    train = _train(_split(spark, sf_dir))
    n_known = (train.join(items.select("item"), "item")
               .groupBy("pid").agg(F.count(F.lit(1)).alias("n")))
    return _rounded(recommend_from_pairs(train, items, n_known, cols, pairs_distinct=True,
                                         item_stats=stats))


@register("hit_rate", SQL_HIT_RATE)
def q_hit_rate(spark, sf_dir):
    items, cols, stats = _items(spark, sf_dir)
    return evaluate(_split(spark, sf_dir), items, cols, item_stats=stats)


@register("hit_rate_excluding_seen", SQL_HIT_RATE_EX)
def q_hit_rate_excluding_seen(spark, sf_dir):
    items, cols, stats = _items(spark, sf_dir)
    return evaluate(_split(spark, sf_dir), items, cols, exclude_seen=True, item_stats=stats)


@register("evaluate_sample", SQL_EVAL_SAMPLE)
def q_evaluate_sample(spark, sf_dir):
    """Evaluate a seeded sample of EVAL_SAMPLE playlists (the sample is the feature)."""
    items, cols, stats = _items(spark, sf_dir)
    split = _split(spark, sf_dir)
    chosen = sample_n(split.select("pid").distinct(), EVAL_SAMPLE, ["pid"], SEED)
    return evaluate(split.join(chosen, "pid", "left_semi"), items, cols, item_stats=stats)


# Playlists whose items are alike, so that held-out items are found: a part is described by its
# brand, type and size, a playlist holds the parts of one brand and one length of type.
_BRAND, _KIND = "CAST(replace(p_brand, 'Brand#', '') AS INT)", "length(p_type)"
_LIST = f"CAST({_BRAND} * 10 + {_KIND} AS BIGINT)"
KIND_DIMS = 11
_KIND_FEATURES = [f"CAST(({_BRAND} * {j + 3}) % 11 - 5 + ({_KIND} * {j + 1}) % 5 * 0.5 + p_size * {j % 3} * 0.01 AS DOUBLE)"
                  for j in range(KIND_DIMS)]

_SQL_KIND = f"""WITH embeddings AS (SELECT p_partkey AS vec_id, list_value({", ".join(_KIND_FEATURES)}) AS embedding FROM part),
pairs AS (SELECT DISTINCT {_LIST} AS pid, p_partkey AS item FROM part),""" + SQL_SPLIT.split("FROM lineitem),")[1] + f""",
qv AS (SELECT s.pid, list_value({", ".join(f"avg(e.embedding[{i + 1}])" for i in range(KIND_DIMS))}) AS q, count(*) AS n_known
       FROM split s JOIN embeddings e ON e.vec_id = s.item WHERE s.part = 'train' GROUP BY s.pid)"""


def _sql_kind(exclude: bool, sample: str = "") -> str:
    return _SQL_KIND + _SQL_EVAL_TAIL.format(topn=_sql_topn("nt.n_test", exclude, qv_join="JOIN nt ON nt.pid = qv.pid"), sample=sample)


def _kind_split(spark, sf_dir):
    """Split, items, feature names and checked size of the playlists by kind."""
    part = table(spark, sf_dir, "part")
    split = holdout_split(part.select(F.expr(_LIST).alias("pid"), F.col("p_partkey").alias("item")).distinct(), "pid", "item", TEST_FRAC, SEED)
    cols = [f"f{j}" for j in range(KIND_DIMS)]
    wide = part.select("p_partkey", *[F.expr(e).alias(c) for e, c in zip(_KIND_FEATURES, cols)])
    items = item_vectors(wide, "p_partkey", cols)
    return materialize(split), items, cols, item_matrix_bytes(items, cols)


@register("hit_rate_by_kind", _sql_kind(False))
def q_hit_rate_by_kind(spark, sf_dir):
    """A9, R7 where recommendations hit: its own train items compete."""
    split, items, cols, stats = _kind_split(spark, sf_dir)
    return evaluate(split, items, cols, item_stats=stats)


@register("hit_rate_by_kind_excluding_seen", _sql_kind(True))
def q_hit_rate_by_kind_excluding_seen(spark, sf_dir):
    split, items, cols, stats = _kind_split(spark, sf_dir)
    return evaluate(split, items, cols, exclude_seen=True, item_stats=stats)


@register("hit_rate_by_kind_tiled", _sql_kind(True))
def q_hit_rate_by_kind_tiled(spark, sf_dir):
    """The same with a broadcast bound of a quarter of the catalogue: joins over the operators for
    catalogues that no broadcast may hold; these playlists are few, so they go to the items."""
    split, items, cols, stats = _kind_split(spark, sf_dir)
    return evaluate(split, items, cols, exclude_seen=True, item_stats=stats, broadcast_max_bytes=-(-stats[1] // TILES))


# Requests: eight neighbouring parts ask for their like; a key stands on many rows, and each row is answered by itself.
_SQL_REQUESTS = f"""WITH embeddings AS (SELECT p_partkey AS vec_id, list_value({", ".join(_KIND_FEATURES)}) AS embedding FROM part),
request AS (SELECT p_partkey // 8 AS block, (p_partkey // 8) % 50 AS pid, 1 + (p_partkey // 8) % 4 AS n, p_partkey AS id FROM part),
qv AS (SELECT block, pid, n, list_value({", ".join(f"avg(e.embedding[{i + 1}])" for i in range(KIND_DIMS))}) AS q
       FROM request r JOIN embeddings e ON e.vec_id = r.id GROUP BY ALL),
scored AS (SELECT qv.*, e.vec_id AS item, list_cosine_similarity(q, embedding) AS cos FROM qv CROSS JOIN embeddings e),
top AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY round(cos, 12) DESC, item) AS rank FROM scored)
SELECT pid, rank, item, round(cos, 6) AS cosine FROM top WHERE rank <= n"""


@register("batch_requests", _SQL_REQUESTS)
def q_batch_requests(spark, sf_dir):
    """Every request row answered by itself, with its own n."""
    part = table(spark, sf_dir, "part")
    cols = [f"f{j}" for j in range(KIND_DIMS)]
    features = part.select(F.col("p_partkey").alias("track_spid"), *[F.expr(e).alias(c) for e, c in zip(_KIND_FEATURES, cols)])
    block = F.expr("p_partkey div 8")
    requests = part.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list("p_partkey")).alias("track_ids")).select(
        (F.col("block") % 50).alias("pid"), "track_ids", (1 + F.col("block") % 4).alias("n"))
    out = batch_recommend(requests, features, "pid", cols)
    return out.select("pid", "rank", "item", F.round("cosine", 6).alias("cosine"))


KIND_SAMPLE = 20


@register("evaluate_sample_by_kind", _sql_kind(True, f"ORDER BY {_SAMPLE_ORDER} LIMIT {KIND_SAMPLE}"))
def q_evaluate_sample_by_kind(spark, sf_dir):
    """A seeded sample of KIND_SAMPLE playlists (the sample is the feature)."""
    split, items, cols, stats = _kind_split(spark, sf_dir)
    chosen = sample_n(split.select("pid").distinct(), KIND_SAMPLE, ["pid"], SEED)
    return evaluate(split.join(chosen, "pid", "left_semi"), items, cols, exclude_seen=True, item_stats=stats)


@register("query_vectors", SQL_QUERY_VECTORS)
def q_query_vectors(spark, sf_dir):
    """R3 in long form (pid, dim, value)."""
    items, cols, stats = _items(spark, sf_dir)
    qv = _qv(_train(_split(spark, sf_dir)), items, cols, stats)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(c).alias("value"))
                                for i, c in enumerate(cols)]))
    return (qv.select("pid", cells.alias("c"))
            .select("pid", F.col("c.dim").alias("dim"), F.round("c.value", 6).alias("value")))


@register("query_vector_table", SQL_QUERY_VECTOR_TABLE)
def q_query_vector_table(spark, sf_dir):
    """One query vector per playlist with its train/test sizes, wide form."""
    items, cols, stats = _items(spark, sf_dir)
    split = _split(spark, sf_dir)
    sizes = split.groupBy("pid").agg(
        F.count(F.when(F.col("part") == "train", 1)).alias("n_train"),
        F.count(F.when(F.col("part") == "test", 1)).alias("n_test"))
    # The sizes meet the narrow pairs, so neither the driver nor a shuffle by playlist sees wide rows.
    train = _train(split).hint("merge").join(sizes, "pid")
    qv = _qv(train, items, cols, stats, carry=("n_train", "n_test"))
    return qv.select(
        "pid", "n_train", "n_test", "n_known", *[F.round(c, 6).alias(c) for c in cols])


@register("split_train_table", SQL_SPLIT_TRAIN)
def q_split_train_table(spark, sf_dir):
    return split_two_tables(_split(spark, sf_dir))[0]


@register("split_test_table", SQL_SPLIT_TEST)
def q_split_test_table(spark, sf_dir):
    return split_two_tables(_split(spark, sf_dir))[1]


#: Ids of a stored segment.
SEGMENT = 256
_SQL_FLAG_SPLIT = "WITH pairs AS (SELECT DISTINCT l_returnflag AS pid, l_partkey AS item FROM lineitem)," + SQL_SPLIT.split("FROM lineitem),")[1]


@register("split_segments", _SQL_FLAG_SPLIT + f"""
SELECT pid, part, segment, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS ids FROM (
  SELECT pid, part, item, (row_number() OVER (PARTITION BY pid, part ORDER BY item) - 1) // {SEGMENT} AS segment FROM split) t
GROUP BY pid, part, segment""")
def q_split_segments(spark, sf_dir):
    """The halves of three playlists that share all rows, as lists in rows of SEGMENT ids."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("pid"), F.col("l_partkey").alias("item")).distinct()
    cut = segments(holdout_split(pairs, "pid", "item", TEST_FRAC, SEED), ["pid", "part"], "item", rows=SEGMENT)
    return cut.select("pid", "part", "segment", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@register("split_segments_items", _SQL_FLAG_SPLIT + """
SELECT pid, part, row_number() OVER (PARTITION BY pid, part ORDER BY item) - 1 AS pos, item FROM split""")
def q_split_segments_items(spark, sf_dir):
    """A10: the segments, stored, read back as one long list each."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("pid"), F.col("l_partkey").alias("item")).distinct()
    cut = segments(holdout_split(pairs, "pid", "item", TEST_FRAC, SEED), ["pid", "part"], "item", rows=SEGMENT)
    return segment_items(materialize(cut), ["pid", "part"], rows=SEGMENT)


@register("inference_example", SQL_INFERENCE_EXAMPLE)
def q_inference_example(spark, sf_dir):
    """First three playlists' train lists as ``track_ids`` with n = 5."""
    rows = inference_example(_split(spark, sf_dir), "pid", 3, 5)
    return rows.select("pid", F.array_join(F.col("track_ids").cast("array<string>"), ",").alias("track_ids"),
                       "n")
