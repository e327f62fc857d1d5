"""Sharding by balanced label propagation.

Equal texts are one node (a node too large for a shard's slack is cut into
linked parts).  Nodes that share a long line are linked, each to the smallest
node of that line, so links stay linear in the lines.  Every round joins the
links with the current shards, counts each node's neighbours by shard, and
lets nodes move to the shard that holds more of them while the target has
room: movers are summed by (target, hash bucket) and whole buckets are let in
until the quota is full.  Last, shards above the mean hand nodes, unlinked ones
first, to those below it, in passes that move ever smaller nodes.

Only the loads of the shards (as many rows as shards) reach the driver.  Each
round is a written table.

Law ``bytes``: sizes near equal (UTF-8 bytes of the text, plus 1 a row).

Defined cases: null text has size 1 and forms a group of its own; rows that
repeat each get a slot; ties are broken by hashes; other columns pass
unseen; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist.llm.common import lines, materialize, table

SHARDS = 8
#: Shortest line, in characters, that links documents.
LINK_LINE = 64
ROUNDS = 3
#: Share over the mean that a shard may hold while nodes move.
SLACK = 0.04
#: A node above this share of a shard is cut into parts.
PART = 0.25
BUCKETS = 1024
PASSES = 8


def shared_line_links(docs: DataFrame, text: str = "text", least: int = LINK_LINE) -> DataFrame:
    """Links ``a``, ``b`` (text hashes) of texts that share a long line: each to the line's smallest."""
    found = (docs.select(F.xxhash64(text).alias("g"), F.explode(F.array_distinct(lines(F.col(text)))).alias("l"))
             .where(F.length("l") >= least).select("g", F.xxhash64("l").alias("l")))
    shared = materialize(found.groupBy("l").agg(F.min("g").alias("a"), F.max("g").alias("z")).where("a != z").select("l", "a"))
    return found.join(shared, "l").where("a != g").select("a", F.col("g").alias("b")).distinct()


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["s"]: r["w"] for r in state.groupBy("s").agg(F.sum("w").alias("w")).collect()}
    return [int(found.get(i, 0)) for i in range(shards)]


def _pick(values: list, of) -> F.Column:
    """The entry of ``values`` at a shard number."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), of + 1)


def _propagate(state: DataFrame, edges: DataFrame, shards: int, turn: int) -> DataFrame:
    """One round: nodes move towards their neighbours' shards where quotas allow."""
    loads = _loads(state, shards)
    room = [max(0, int(sum(loads) / shards * (1 + SLACK)) - x) for x in loads]
    seen = (edges.join(state.select(F.col("node").alias("a"), "s"), "a").groupBy("b", "s").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("b").agg(F.max_by("s", F.struct("c", -F.col("s"))).alias("to"),
                              F.max("c").alias("most"), F.map_from_entries(F.collect_list(F.struct("s", "c"))).alias("by")))
    # Half of the nodes may move in a round, else neighbours would swap places.
    want = (state.join(seen.withColumnRenamed("b", "node"), "node")
            .where((F.col("to") != F.col("s")) & (F.col("most") > F.coalesce(F.element_at("by", F.col("s")), F.lit(0)))
                   & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0))
            .select("node", "w", "to", F.pmod(F.xxhash64("node", F.lit(turn + 100)), F.lit(BUCKETS)).alias("bucket")))
    want = materialize(want)
    fill = Window.partitionBy("to").orderBy("bucket")
    let_in = (want.groupBy("to", "bucket").agg(F.sum("w").alias("sum")).withColumn("upto", F.sum("sum").over(fill))
              .where(F.col("upto") <= _pick(room, F.col("to"))).select("to", "bucket"))
    moved = want.join(let_in, ["to", "bucket"]).select("node", "to")
    return state.join(moved, "node", "left").withColumn("s", F.coalesce("to", "s")).drop("to")


def _level(state: DataFrame, shards: int, turn: int, loads: list[int], most: int) -> DataFrame:
    """One pass: nodes of at most ``most`` bytes go from shards over the mean to those under it."""
    mean = sum(loads) / shards
    over = [max(0, int(x - mean)) for x in loads]
    under = [max(0, int(mean - x)) for x in loads]
    bucket = F.pmod(F.xxhash64("node", F.lit(turn + 1000)), F.lit(BUCKETS))
    free = state.where((F.col("w") <= most) & (_pick(over, F.col("s")) > 0)).select(
        "node", "w", "s", F.col("linked").cast("int").alias("l"), bucket.alias("bucket"))
    run = Window.partitionBy("s").orderBy("l", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    open_ = (free.groupBy("s", "l", "bucket").agg(F.sum("w").alias("sum"))
             .withColumn("before", F.coalesce(F.sum("sum").over(run), F.lit(0)))
             .where(F.col("before") < _pick(over, F.col("s"))).drop("sum"))
    inside = Window.partitionBy("s", "l", "bucket").orderBy("w", "node").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (free.join(open_, ["s", "l", "bucket"]).withColumn("upto", F.col("before") + F.sum("w").over(inside))
              .where(F.col("upto") <= _pick(over, F.col("s"))))
    # The moved nodes lie on one line, donor after donor; stretches of it belong to the receivers.
    at = F.col("upto") + _pick([sum(over[:i]) for i in range(shards)], F.col("s"))
    takers = [i for i in range(shards) if under[i]] or [loads.index(min(loads))]
    to, edge = F.lit(takers[-1]), sum(under)
    for i in reversed(takers):
        to = F.when(at <= edge, F.lit(i)).otherwise(to)
        edge -= under[i]
    moved = chosen.select("node", to.cast("int").alias("to"))
    return state.join(moved, "node", "left").withColumn("s", F.coalesce("to", "s")).drop("to")


def balance(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``node``, ``w`` and ``s`` (its shard) for ``nodes`` (node, w) linked by ``links`` (a, b)."""
    edges = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = materialize(nodes.join(edges.select(F.col("a").alias("node")).distinct().withColumn("linked", F.lit(True)), "node", "left")
                        .select("node", "w", F.coalesce("linked", F.lit(False)).alias("linked"),
                                F.pmod(F.xxhash64("node", F.lit(7)), F.lit(shards)).cast("int").alias("s")))
    for turn in range(rounds):
        state = materialize(_propagate(state, edges, shards, turn))
    loads = _loads(state, shards)
    for turn in range(PASSES):
        gap = max(loads, default=0) - sum(loads) / shards
        most = int(gap) if turn == 0 else int(gap / 3)
        if most < 1 or gap * 2000 < sum(loads) / shards:
            break
        after = materialize(_level(state, shards, turn, loads, most))
        changed = _loads(after, shards)
        if max(changed) >= max(loads) and turn:
            break
        state, loads = after, changed
    return state.select("node", "w", "s")


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, size, text_crc32, shard and slot."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    rows = materialize(docs.select(F.col(key).alias("k"), size.alias("size"), F.xxhash64(text).alias("g"),
                                   F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc")))
    groups = materialize(rows.groupBy("g").agg(F.sum("size").alias("w")))
    slack = max(1, int((groups.agg(F.sum("w")).first()[0] or 0) / shards * PART))
    large = materialize(groups.where(F.col("w") > slack).select("g", F.ceil(F.col("w") / slack).cast("long").alias("parts")))
    part = F.pmod(F.xxhash64("k", F.lit(3)), F.coalesce("parts", F.lit(1).cast("long")))
    placed = rows.join(F.broadcast(large), "g", "left").select(  # under 4 x shards rows
        "*", F.when(part == 0, F.col("g")).otherwise(F.xxhash64("g", part)).alias("node")).drop("parts")
    nodes = placed.groupBy("node").agg(F.sum("size").alias("w"))
    parts = placed.where("node != g").select(F.col("g").alias("a"), F.col("node").alias("b")).distinct()
    links = shared_line_links(docs, text).unionByName(parts)
    links = links.join(nodes.select(F.col("node").alias("a")), "a", "left_semi")
    state = balance(nodes, links, shards)
    out = placed.join(state.select("node", F.col("s").alias("shard")), "node")
    out = materialize(out.select("k", "size", "crc", "g", "shard", F.pmod(F.xxhash64("k", "g"), F.lit(4 * BUCKETS)).alias("bucket")))
    # Slots: counts by bucket first, rows inside a bucket next.
    run = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = out.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("c")).withColumn(
        "at", F.coalesce(F.sum("c").over(run), F.lit(0))).drop("c")
    inside = Window.partitionBy("shard", "bucket").orderBy("k", "g")
    return out.join(starts, ["shard", "bucket"]).select(
        F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.row_number().over(inside) - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {"op6_sharding": op6_sharding}
ORACLES: dict[str, str] = {}
