"""Prefix trie of conversations, rolled up by centroid decomposition.

A conversation's prefixes are named by their length and two 60-bit halves of an
xor over md5 digests of (place, role, text); equal names are taken for equal
prefixes.  An xor can be summed in pieces, so a conversation of any length is
named chunk by chunk.  One row per name is a node; counts of members, and the
sum over members of the turns that they have from the node on, come from one
aggregation.  That sum is the weight of the node's subtree if every node weighs
its members.

Subtree totals are rolled up without walking the trie by depth.  In a
connected component the nodes that carry more than half of its weight are the
path from its top to its centroid.  The component's totals below the
centroid are aggregated and added along that path; then the centroid goes,
each child's subtree is a component of its own, and the rest keeps the top.
Weights halve each time.  A node finds its piece by the name of its prefix one
turn below the centroid.  Components of ``SMALL`` weight or less are finished
in one task each by the same steps, many to a task and one after another.

The digest of a node's members is a running one over text chunks of at most
``CHUNK`` members, in order.  Such a digest cannot be computed in parallel, so a
node that holds a third of all conversations has its chunks read by one
task; they are built in all.

Defined cases: rows without a conversation id belong to none and are left
out; null role and text are empty; a null turn stands first; equal turns stand
in the order of the digest of role and text; other columns are ignored; an
empty table gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm.common import materialize, shuffle_width, small_side, table
from setlist.llm.ranks import positions

ship_by_value(__name__)

#: Components up to this weight are finished inside a task.
SMALL = 4096
#: Turns, or members, handled together.
CHUNK = 1024
#: The textless root.
ROOT = "0"

_ENDS = "node string, ends_sha256 string"
_DONE = "node string, n_leaves long, saved_tokens long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """Per turn ``conv``, ``pos`` (from 0), ``digest``, ``chars`` and ``size`` (turns of the conversation)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).cast("long").alias("chars"))
    ranked = positions(said, ["conv"], ["turn", "digest", "chars"])
    place = F.explode(F.sequence("start", F.col("start") + F.col("copies") - 1))
    return materialize(ranked.select("conv", "digest", "chars", "size", place.alias("pos")))


def rebuild(turns: DataFrame, base: Column, lead: Column, longest: int) -> DataFrame:
    """Turns of ``conv`` as (``conv``, ``depth`` from 1, ``digest``, ``chars``, ``size``) when it starts with
    the first ``lead`` (at most ``longest``) turns of ``base``, its own first ``lead`` turns left out;
    and one row of depth 0 for each conversation."""
    convs = turns.where("pos = 0").select("conv", "size", base.alias("base"), lead.alias("lead"))
    bases = turns.where("pos = 0").select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    shift = F.least("lead", F.coalesce("base_size", F.lit(0)))
    plan = materialize(convs.join(bases, "base", "left").select(
        "conv", "base", "lead", shift.alias("taken"), (shift + F.greatest(F.col("size") - F.col("lead"), F.lit(0))).alias("size")))
    heads = turns.where(F.col("pos") < longest).select(F.col("conv").alias("base"), "pos", "digest", "chars")
    first = plan.join(heads, "base").where("pos < taken").select("conv", (F.col("pos") + 1).alias("depth"), "digest", "chars", "size")
    rest = turns.drop("size").join(plan, "conv").where("pos >= lead").select(
        "conv", (F.col("pos") - F.col("lead") + F.col("taken") + 1).alias("depth"), "digest", "chars", "size")
    start = plan.select("conv", F.lit(0).cast("long"), F.lit(""), F.lit(0).cast("long"), "size")
    return first.unionAll(rest).unionAll(start)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """Per conversation and depth the ``node`` its prefix is and the ``parent`` (written)."""
    both = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    half = [F.when(F.col("depth") > 0, F.conv(F.substring(both, at, 15), 16, 10).cast("long")).otherwise(F.lit(0)) for at in (1, 16)]
    rows = rebuilt.select("conv", "depth", "chars", "size", half[0].alias("x"), half[1].alias("y"), F.expr(f"depth div {CHUNK}").alias("chunk"))
    chunks = rows.groupBy("conv", "chunk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select("conv", "chunk", F.bit_xor("x").over(earlier).alias("cx"), F.bit_xor("y").over(earlier).alias("cy")).where("chunk > 0")
    so_far = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({"px": F.bit_xor("x").over(so_far), "py": F.bit_xor("y").over(so_far)})
    whole = inside.join(carried, ["conv", "chunk"], "left").withColumns(
        {c: F.col(c).bitwiseXOR(F.coalesce(o, F.lit(0))) for c, o in (("px", "cx"), ("py", "cy"))})
    node = F.when(F.col("depth") > 0, F.concat_ws(".", "depth", "px", "py")).otherwise(F.lit(ROOT))
    before = [F.col(p).bitwiseXOR(F.col(own)) for p, own in (("px", "x"), ("py", "y"))]
    parent = F.when(F.col("depth") > 1, F.concat_ws(".", F.col("depth") - 1, *before)).when(F.col("depth") == 1, F.lit(ROOT))
    return materialize(whole.select("conv", "depth", "chars", "size", node.alias("node"), parent.alias("parent")))


def nodes_of(named: DataFrame) -> DataFrame:
    """Per node its smallest member ``conv``, ``depth``, ``parent``, ``n_convs``, ``chars`` and ``weight``
    (of its subtree), ``n_children`` and ``parent_conv`` (written)."""
    own = materialize(named.groupBy("node", "depth").agg(
        F.min("conv").alias("conv"), F.min("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("weight")))
    children = own.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = own.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    return materialize(own.join(children, "node", "left").join(above, "parent", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))


def end_digests(named: DataFrame) -> DataFrame:
    """Per node with members that end there the sha256 of their ids, ascending and comma-joined."""
    ends = positions(named.where("size = depth").select("node", "conv"), ["node"], ["conv"])
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = ends.groupBy("node", F.expr(f"start div {CHUNK}").alias("chunk")).agg(ids.alias("ids"))
    return (chunks.repartition(shuffle_width(named), "node").sortWithinPartitions("node", "chunk")
            .select("node", "ids").mapInArrow(_running_digest, _ENDS))


def _running_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, running = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node == name:
                running.update(("," + ids).encode())
                continue
            if name is not None:
                out.append((name, running.hexdigest()))
            name, running = node, hashlib.sha256(ids.encode())
        yield _arrow(out, ["node", "ends_sha256"], [pa.string(), pa.string()])
    if name is not None:
        yield _arrow([(name, running.hexdigest())], ["node", "ends_sha256"], [pa.string(), pa.string()])


def _arrow(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*rows)) or [()] * len(names), kinds)], names=names)


def roll_up(nodes: DataFrame, named: DataFrame, small: int = SMALL) -> DataFrame:
    """Per node the sums ``n_leaves`` and ``saved_tokens`` over its subtree.

    ``nodes``: ``node``, ``parent``, ``depth``, ``conv`` (any member), ``weight``, ``leaf`` and ``saved`` (the
    values to sum); ``named``: the prefixes of the members."""
    steps = named.where("depth > 0").select("conv", F.col("depth").alias("step"), F.col("node").alias("below"), F.col("parent").alias("over"))
    live = nodes.select("*", F.lit(ROOT).alias("comp"), F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    done: list[DataFrame] = []
    while True:
        totals = live.groupBy("comp").agg(F.max("weight").alias("total"))  # the top's weight is the component's
        state = materialize(live.join(totals, "comp"))
        done.append(_finished(state.where(F.col("total") <= small)))
        large = state.where(F.col("total") > small)
        path = large.where("2 * weight > total")
        centroids = materialize(path.groupBy("comp").agg(F.min_by(F.struct("node", "depth", "weight"), "weight").alias("c"))
                                .select("comp", F.col("c.node").alias("c"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")))
        if centroids.isEmpty():
            return _union(done)
        placed = large.join(small_side(centroids, 160), "comp")
        step = F.col("c_depth") + 1
        found = placed.withColumn("step", F.when(F.col("depth") >= step, step)).join(steps, ["conv", "step"], "left")
        piece = F.when(F.col("over") == F.col("c"), F.col("below")).when(F.col("node") != F.col("c"), F.col("comp"))
        cut = materialize(found.withColumn("piece", piece).drop("below", "over", "step"))
        under = (F.col("piece") != F.col("comp")) | F.col("piece").isNull()
        sums = materialize(cut.where(under).groupBy("comp").agg(F.sum("leaf").alias("d_leaf"), F.sum("saved").alias("d_saved")))
        added = cut.join(small_side(sums, 80), "comp")
        on_path, is_c = F.expr("2 * weight > total"), F.col("piece").isNull()
        changed = {"n_leaves": F.col("n_leaves") + F.when(is_c, F.col("d_leaf") - F.col("leaf")).when(on_path, F.col("d_leaf")).otherwise(0),
                   "saved_tokens": F.col("saved_tokens") + F.when(is_c, F.col("d_saved") - F.col("saved")).when(on_path, F.col("d_saved")).otherwise(0),
                   "weight": F.col("weight") - F.when(on_path & ~is_c, F.col("c_weight")).otherwise(0)}
        after = added.withColumns(changed).select(*nodes.columns, "piece", "n_leaves", "saved_tokens")
        done.append(after.where("piece is null").select("node", "n_leaves", "saved_tokens"))
        live = after.where("piece is not null").withColumnRenamed("piece", "comp")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _finished(state: DataFrame) -> DataFrame:
    rows = (state.select("comp", "depth", "node", "parent", "weight", "leaf", "saved", "n_leaves", "saved_tokens")
            .repartition(shuffle_width(state), "comp").sortWithinPartitions("comp", "depth"))
    return rows.mapInArrow(_finish, _DONE)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["node", "n_leaves", "saved_tokens"], [pa.string(), pa.int64(), pa.int64()]
    held: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                out += decompose(held)
                held = []
            held.append(row)
        yield _arrow(out, names, kinds)
    if held:
        yield _arrow(decompose(held), names, kinds)


def decompose(rows: list[tuple]) -> list[tuple]:
    """One component's sums; its rows (comp, depth, node, parent, weight, leaf, saved, sums so far), parents first."""
    at = {r[2]: i for i, r in enumerate(rows)}
    parent = [at.get(r[3], -1) for r in rows]
    weight, own = [r[4] for r in rows], [r[5:7] for r in rows]
    sums = [list(r[7:9]) for r in rows]
    todo = [list(range(len(rows)))]
    while todo:
        comp = todo.pop()
        total = weight[comp[0]]
        path = [v for v in comp if 2 * weight[v] > total]
        c = path[-1]
        below, pieces, rest, cut = {c}, {}, [], [0, 0]
        for v in comp:
            if v != c and parent[v] not in below:
                rest.append(v)
                continue
            cut = [cut[0] + own[v][0], cut[1] + own[v][1]]
            if v != c:
                below.add(v)
                top = v if parent[v] == c else piece_of[parent[v]]
                pieces.setdefault(top, []).append(v)
                piece_of[v] = top
            else:
                piece_of = {}
        for v in path:
            mine = own[c] if v == c else (0, 0)
            sums[v] = [sums[v][0] + cut[0] - mine[0], sums[v][1] + cut[1] - mine[1]]
            weight[v] -= weight[c] if v != c else 0
        todo += [p for p in (rest, *pieces.values()) if p]
    return [(r[2], *s) for r, s in zip(rows, sums)]


def trie(conversations: DataFrame, base: Callable[[Column], Column] | None = None, lead: Callable[[Column], Column] | None = None,
         longest: int = 0, small: int = SMALL) -> DataFrame:
    """Per node of the trie: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.  ``base`` and ``lead`` name, from a
    conversation's id, the one it starts like and for how many turns (at most ``longest``); by default it is itself."""
    conv = F.col("conv")
    turns = turns_of(conversations)
    named = prefixes(rebuild(turns, base(conv) if base else conv, (lead(conv) if lead else F.lit(0)).cast("long"), longest))
    nodes = nodes_of(named)
    values = nodes.select("node", "parent", "depth", "conv", "weight", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    out = nodes.join(roll_up(values, named, small), "node").join(end_digests(named), "node", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"), lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6, 5)


QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLES = {"op12_prefix_trie": r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
             lambda x, b: list_reduce([xor(x, b)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END), 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth, role, text FROM (
    SELECT conv.c, 0 AS own, t.pos, t.role, t.text FROM conv JOIN t ON t.c = conv.c - conv.c % 100 AND t.pos < conv.h
    UNION ALL
    SELECT conv.c, 1, t.pos, t.role, t.text FROM conv JOIN t ON t.c = conv.c AND t.pos >= conv.h)),
member AS (
  SELECT c, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM conv
  UNION ALL
  SELECT c, depth, string_agg(sha256(length(role) || ':' || role || text), '') OVER w, coalesce(string_agg(sha256(length(role) || ':' || role || text), '') OVER e, ''), length(text)
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY depth), e AS (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
size AS (SELECT c, max(depth) AS size FROM member GROUP BY c),
node AS (
  SELECT node, depth, min(c) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(chars) AS chars,
         coalesce(string_agg(CASE WHEN size = depth THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
  FROM member JOIN size USING (c) GROUP BY node, depth),
child AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (node)),
rolled AS (
  SELECT m.node, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.chars) AS saved_tokens
  FROM own o JOIN member m ON m.c = o.conv_id AND m.depth <= o.depth GROUP BY m.node)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, r.n_leaves::BIGINT AS n_leaves,
       r.saved_tokens::BIGINT AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN rolled r USING (node) LEFT JOIN node p ON p.node = o.parent
"""}
