"""Mixing sources to target weights by hierarchical budgets (native).

Levels (domain, language, source) span a tree whose leaves hold tokens.  A
leaf can give its tokens ``max_epochs`` times, an inner node what its children
can.  From the root down, a node's budget is split among its children by
weight; a child that cannot give its share gives all it has and its siblings
share the rest by weight.  As no node is asked for more than its subtree can
give, a shortage reaches an ancestor's siblings only once its own siblings are
exhausted.  All amounts are integers (shares round down).

A leaf's budget is so many whole epochs and a prefix of one more, in the order
of md5(seed, epoch, doc_id).  The prefix is kept as one digest per leaf, the
last that fits; sums by leaf and leading digest bits find the one bucket that
holds it, and only that bucket's documents are ordered.  So texts are never
shuffled and a leaf with a third of all rows is never in one task.

Defined cases: a null level value is a node of its own; null or empty text has
no tokens and is chosen with the epoch or prefix around it; rows with one
doc_id in one leaf are chosen together; a value without a weight has weight 1;
a weight of 0 is never asked; other columns pass through; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist.llm.common import fresh, materialize, small_side, table, words

#: Leading hex digits of a digest that make a bucket (4096 buckets a leaf).
DIGITS = 3


def _node(level: str) -> Column:
    """A level's value as a key that tells null from text."""
    return F.coalesce(F.concat(F.lit("="), F.col(level).cast("string")), F.lit(""))


def _weight(node: Column, of: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in sorted(of.items()):
        out = F.when(node == f"={value}", F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def _digest(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(key.cast("string"), F.lit("null"))))


def split_budget(children: DataFrame, parent: list[str]) -> DataFrame:
    """``children`` (parent columns, ``w``, ``cap``, ``asked`` of the parent)
    with ``budget``: ``asked`` split by ``w``, none above its ``cap``."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    names = [c for c in children.columns if c.startswith("n")]
    # Children fill up in the order of cap / w; the level at which each is full tells whether it will be.
    order = by.orderBy(F.col("cap") / F.col("w"), *names).rowsBetween(Window.unboundedPreceding, -1)
    known = (children.where("w > 0")
             .withColumn("before", F.coalesce(F.sum("cap").over(order), F.lit(0)))
             .withColumn("rest", F.sum("w").over(by) - F.coalesce(F.sum("w").over(order), F.lit(0)))
             .withColumn("full", F.expr("(asked - before) * w >= cap * rest")))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(by)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0))
    return (known.withColumn("open_w", open_w).withColumn("taken", taken)
            .withColumn("budget", F.expr("CASE WHEN full THEN cap ELSE ((asked - taken) * w) div open_w END"))
            .drop("before", "rest", "full", "open_w", "taken"))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]],
            total: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (n0.., ``tokens``) with ``budget``."""
    nodes = [f"n{i}" for i in range(len(levels))]
    below = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for i, level in enumerate(levels):  # a weight of 0 takes the whole subtree out
        below = below.withColumn(f"w{i}", _weight(F.col(f"n{i}"), weights.get(level, {})))
    below = materialize(below.where(" and ".join(f"w{i} > 0" for i in range(len(levels)))))
    root = below.select(F.least(total, F.sum("cap")))
    for i in range(len(levels)):
        level = below.groupBy(*nodes[:i + 1]).agg(F.sum("cap").alias("cap"), F.first(f"w{i}").alias("w"))
        level = level.join(asked, nodes[:i]) if i else level.withColumn("asked", root.scalar())
        asked = materialize(split_budget(level, nodes[:i])).select(*nodes[:i + 1], F.col("budget").alias("asked"))
    return leaves.join(asked.withColumnRenamed("asked", "budget"), nodes)


def plan_mix(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], tokens: Column,
             total: Column, max_epochs: int = 2, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """One row per leaf with a budget: n0.., ``tokens``, ``budget``, ``epochs``
    (whole ones) and ``last`` (digest that ends the prefix, null for none)."""
    nodes = [f"n{i}" for i in range(len(levels))]
    narrow = materialize(docs.select(*[_node(c).alias(n) for c, n in zip(levels, nodes)],
                                     F.col(key).alias("k"), tokens.cast("long").alias("t")))
    leaves = materialize(narrow.groupBy(*nodes).agg(F.sum("t").alias("tokens")))
    allowed = materialize(budgets(leaves, levels, weights, total, max_epochs)).withColumn(
        "epochs", F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget div tokens END")).withColumn(
        "part", F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END"))
    partial = small_side(materialize(allowed.where("part > 0").select(*nodes, "epochs", "part")), 256)
    dealt = (narrow.join(partial, nodes).withColumn("d", _digest(seed, F.col("epochs"), F.col("k")))
             .withColumn("b", F.substring("d", 1, DIGITS)))
    sums = dealt.groupBy(*nodes, "part", "b").agg(F.sum("t").alias("t"))
    run = Window.partitionBy(*nodes).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("before", F.coalesce(F.sum("t").over(run), F.lit(0)))
    # The first bucket that doesn't fit whole holds the prefix's end.
    edge = materialize(placed.where("before <= part and before + t > part").select(*nodes, "b", "before"))
    inside = (dealt.join(small_side(edge, 256), [*nodes, "b"]).groupBy(*nodes, "b", "before", "part", "d")
              .agg(F.sum("t").alias("t")))
    each = Window.partitionBy(*nodes, "b").orderBy("d")
    ends = (inside.withColumn("upto", F.col("before") + F.sum("t").over(each))
            .groupBy(*nodes, "b").agg(F.max(F.when(F.col("upto") <= F.col("part"), F.col("d"))).alias("d"))
            # none of the bucket fits: the prefix ends before it, at its bare leading digits
            .withColumn("last", F.coalesce("d", F.col("b"))).select(*nodes, "last"))
    return allowed.join(ends, nodes, "left").select(*nodes, "tokens", "budget", "epochs", "last")


def mix(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], tokens: Column,
        total: Column | None = None, max_epochs: int = 2, seed: int = 42, key: str = "doc_id",
        epoch: str | None = None) -> DataFrame:
    """The rows of ``docs`` chosen, once per epoch that holds them; ``total``
    (an aggregate over leaf ``cap`` / ``tokens``) defaults to all tokens there
    are; ``epoch`` names a column for the epoch, from 0."""
    leaf = plan_mix(docs, levels, weights, tokens, F.sum("tokens") if total is None else total,
                    max_epochs, seed, key)
    names = {n: fresh(docs, n) for n in leaf.columns}
    leaf = small_side(materialize(leaf.select(*[F.col(a).alias(b) for a, b in names.items()])), 256)
    match = F.lit(True)
    for i, level in enumerate(levels):
        match = match & (_node(level) == F.col(names[f"n{i}"]))
    whole, last = F.col(names["epochs"]), F.col(names["last"])
    e = fresh(docs, epoch or "epoch")
    all_of = F.when(whole > 0, F.sequence(F.lit(0).cast("long"), whole - 1)).otherwise(F.array().cast("array<long>"))
    more = F.when(_digest(seed, whole, F.col(key)) <= last, F.array(whole)).otherwise(F.array().cast("array<long>"))
    chosen = docs.join(leaf, match).withColumn(e, F.explode(F.concat(all_of, F.coalesce(more, F.array().cast("array<long>")))))
    return chosen.select(*docs.columns, *([F.col(e).cast("int").alias(epoch)] if epoch else []))


#: Production mix: domains are the source number modulo four.
LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"0": 10, "1": 40, "2": 30, "3": 20}, "lang": {"en": 50, "de": 20, "fr": 20, "es": 10}}


def domain(source: Column) -> Column:
    """The domain of a source: its trailing number modulo four, else null."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    return F.when(number != "", F.pmod(number.cast("int"), F.lit(4)).cast("string"))


def mixed_documents(docs: DataFrame, max_epochs: int = 2, seed: int = 42, epoch: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, ...) in the production mix; tokens are words."""
    d, g = fresh(docs, "domain"), F.size(words(F.col("text")))
    weights = WEIGHTS | {d: WEIGHTS["domain"]}
    out = mix(docs.withColumn(d, domain(F.col("source"))), [d, "lang", "source"], weights, g, None,
              max_epochs, seed, "doc_id", epoch)
    return out.select(*docs.columns, *([F.col(d).alias("domain"), epoch] if epoch else []))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mixed_documents(docs, epoch="epoch")
    return out.select("doc_id", "domain", "lang", "source", "epoch",
                      F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


QUERIES = {"op7_mixing": op7_mixing}


def _sql_level(i: int, weight: str) -> str:
    names = [f"n{j}" for j in range(i + 1)]
    up, own = names[:-1], names[-1]
    part = f"PARTITION BY {', '.join(up)}" if up else ""
    source = f"JOIN b{i - 1} USING ({', '.join(up)})" if up else "CROSS JOIN (SELECT sum(tokens) AS budget FROM leaf) AS r"
    return f"""c{i} AS (SELECT {', '.join(names)}, sum(tokens) * 2 AS cap, {weight.format(n=own)} AS w
  FROM leaf GROUP BY ALL),
p{i} AS (SELECT c.*, {'b' + str(i - 1) if up else 'r'}.budget AS asked FROM c{i} c {source}),
f{i} AS (SELECT *, (asked - coalesce(sum(cap) OVER o, 0)) * w >= cap * (sum(w) OVER (a) - coalesce(sum(w) OVER o, 0)) AS done
  FROM p{i} WINDOW a AS ({part}), o AS ({part} ORDER BY cap / w, {', '.join(names)}
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b{i} AS (SELECT {', '.join(names)}, CAST(CASE WHEN done THEN cap ELSE
  ((asked - coalesce(sum(cap) FILTER (WHERE done) OVER a, 0)) * w) // sum(w) FILTER (WHERE NOT done) OVER a END AS HUGEINT) AS budget
  FROM f{i} WINDOW a AS ({part}))"""


def _sql_weight(of: dict[str, int]) -> str:
    return "CASE {n} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(of.items())) + " ELSE 1 END"


ORACLES = {"op7_mixing": f"""
WITH doc AS (SELECT doc_id, lang, source, CAST(CAST(regexp_extract(source, '(\\d{{1,9}})$', 1) AS INT) % 4 AS VARCHAR) AS domain,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS t FROM documents),
leaf AS (SELECT domain AS n0, lang AS n1, source AS n2, sum(t) AS tokens FROM doc GROUP BY ALL),
{_sql_level(0, _sql_weight(WEIGHTS['domain']))},
{_sql_level(1, _sql_weight(WEIGHTS['lang']))},
{_sql_level(2, '1')},
plan AS (SELECT leaf.*, b2.budget // tokens AS whole, b2.budget % tokens AS part FROM leaf JOIN b2 USING (n0, n1, n2)),
dealt AS (SELECT doc.*, whole, part, sum(t) OVER (PARTITION BY domain, lang, source
  ORDER BY md5('42|' || whole || '|' || doc_id)) AS upto
  FROM doc JOIN plan ON domain = n0 AND lang = n1 AND source = n2)
SELECT doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, t AS n_tokens FROM dealt, unnest(range(0, whole::BIGINT)) AS r(e)
UNION ALL
SELECT doc_id, domain, lang, source, CAST(whole AS INTEGER), t FROM dealt WHERE part > 0 AND upto <= part
"""}
