"""Merkle manifest as a postorder append log, with proofs.

Leaves of a tree stand in the order of a key.  A builder takes an aligned
block of 2^``BITS`` consecutive ones and appends nodes as they complete: a
leaf, then every parent whose last child it was.  Nodes on the ragged right
edge have one child.  The tops of full blocks are the leaves of the next
round, so a tree of N leaves takes log(N) / ``BITS`` rounds, each one shuffle
by block.

The place of a node in the whole log has a closed form in the tree's size:
with m leaves at its end, 2m - popcount(m) nodes are complete, less the parents
that complete with the same leaf and stand behind it.  So builders know their
places without waiting for each other, and a sibling is addressed by
arithmetic, not searched.  Proofs are taken from the top round down: a
block reads its stretch of the log and the path of its own top, and hands
each of its leaves a path; what moves is one path a block.

Positions come from ``ranks.positions``: no tree, key or set of equal rows
meets in one task.  A builder holds one block.  Trees are then leaves of one
more tree, in the order of their names.

Defined cases: any column may be null (its part is ``-``); the null tree stands
first; equal keys stand in the order of their leaves, null keys first; rows
that repeat are leaves each; a tree of one leaf is that leaf; an empty table
gives an empty log and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm.common import BROADCAST_BYTES, materialize, table
from setlist.llm.ranks import positions

ship_by_value(__name__)

#: A block has 2^BITS leaves.
BITS = 12
#: Columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, size long, block long, position long, digest string, top boolean"
_CARRIED = ("key", "name", "leaf", "seen")
_PATH = "tree string, key string, name string, leaf string, seen string, index long, path array<string>"
_PATH_NAMES = ["tree", *_CARRIED, "index", "path"]


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the values: ``-`` for null, else byte count, ``:`` and value."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def height(size: int) -> int:
    return max(0, size - 1).bit_length()


def place(size: int, level: int, index: int) -> int:
    """Position in the log, from 0, of a node of a tree with ``size`` leaves."""
    if index == ((size - 1) >> level):  # on the right edge: only its parents follow
        return sum(-(-size // (1 << k)) for k in range(height(size) + 1)) - 1 - (height(size) - level)
    m = (index + 1) << level
    with_it = (m & -m).bit_length() - 1 - level
    return 2 * m - m.bit_count() - with_it - 1


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def append(leaves: list[str], size: int, base: int, block: int, bits: int) -> Iterator[tuple[int, str]]:
    """Nodes of one block as (level, digest), in completion order.  ``leaves``:
    its nodes of level ``base``, which are appended only if that is 0."""
    last, up = (size - 1) >> base, min(bits, height(size) - base)
    waiting: dict[int, str] = {}
    for i, node in enumerate(leaves, block << bits):
        if base == 0:
            yield 0, node
        for k in range(up):
            if not (i >> k) & 1:
                if i != last:
                    waiting[k] = node
                    break
                node = _hash(node)
            else:
                node = _hash(waiting.pop(k) + node)
            yield base + k + 1, node


def _builder(base: int, bits: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        size, block = int(rows["size"].iloc[0]), int(rows["block"].iloc[0])
        leaves = [x for x, n in zip(rows["digest"], rows["copies"]) for _ in range(n)]
        at = {level: block << bits >> (level - base) for level in range(base, base + bits + 1)}
        top = min(base + bits, height(size))
        out = []
        for level, node in append(leaves, size, base, block, bits):
            out.append((place(size, level, at[level]), node, level == top))
            at[level] += 1
        out = pd.DataFrame(out, columns=["position", "digest", "top"]).assign(tree=rows["tree"].iloc[0], size=size, block=block)
        return out[["tree", "size", "block", "position", "digest", "top"]]
    return build


def _extractor(base: int, bits: int):
    def extract(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        size, block = int(rows["size"].iloc[0]), int(rows["block"].iloc[0])
        above = [list(p) for p in nodes["path"] if p is not None]
        log = dict(zip(nodes["position"], nodes["digest"]))
        steps = []  # per level, of every node in the block: the step beside it
        for level in range(base, min(base + bits, height(size))):
            first, end = block << bits >> (level - base), (size - 1) >> level
            beside = [i ^ 1 for i in range(first, min(end, ((block + 1 << bits) - 1) >> (level - base)) + 1)]
            steps.append(["" if i > end else "LR"[i & 1] + log[place(size, level, i)] for i in beside])
        out = []
        for *carried, start, copies in zip(*(rows[c] for c in _CARRIED), rows["start"], rows["copies"]):
            for i in range(start, start + copies):
                local = i - (block << bits)
                out.append((*carried, i, [x[local >> k] for k, x in enumerate(steps)] + (above[0] if above else [])))
        return pd.DataFrame(out, columns=[*_CARRIED, "index", "path"]).assign(tree=rows["tree"].iloc[0])[_PATH_NAMES]
    return extract


def _pieces(ranked: DataFrame, bits: int) -> DataFrame:
    """Runs of equal leaves cut at block borders."""
    ends = F.col("start") + F.col("copies")
    blocks = ranked.select("*", F.explode(F.sequence(F.shiftright("start", bits), F.shiftright(ends - 1, bits))).alias("block"))
    low = F.greatest("start", F.shiftleft("block", bits))
    high = F.least(ends, F.shiftleft(F.col("block") + 1, bits))
    return blocks.select("tree", "size", "block", low.alias("start"), (high - low).alias("copies"),
                         F.col("key").cast("string").alias("key"), "name", "leaf", "seen")


def build(leaves: DataFrame, bits: int = BITS) -> tuple[list[DataFrame], list[DataFrame]]:
    """``leaves``: ``tree``, ``key`` and ``name`` (their order), ``leaf``, and ``seen``, carried along.
    The rounds of the log and what each was built from, all written."""
    given = materialize(_pieces(positions(leaves, ["tree"], ["key", "name", "leaf", "seen"]), bits))
    largest = given.agg(F.max("size")).first()[0] or 0
    logs, inputs, base = [], [], 0
    while True:
        rows = given.select("tree", "size", "block", "start", "copies", F.col("leaf").alias("digest"))
        logs.append(materialize(rows.groupBy("tree", "block").applyInPandas(_builder(base, bits), _NODE)))
        inputs.append(given)
        base += bits
        if base >= height(largest):
            return logs, inputs
        # The tops of this round's blocks are the next round's leaves; their places in the log come along as keys.
        none = F.lit(None).cast("string")
        given = (logs[-1].where(F.col("top") & (F.col("size") > F.lit(1 << base)))
                 .select("tree", "size", F.shiftright("block", bits).alias("block"), F.col("block").alias("start"),
                         F.lit(1).cast("long").alias("copies"), F.col("position").cast("string").alias("key"), none.alias("name"),
                         F.col("digest").alias("leaf"), none.alias("seen")))


def roots(logs: list[DataFrame], bits: int = BITS) -> DataFrame:
    """``tree`` and ``digest`` of its root."""
    ended = [log.where(F.col("top") & (F.col("size") <= F.lit(1 << min(62, (r + 1) * bits)))).select("tree", "digest")
             for r, log in enumerate(logs)]
    return reduce(DataFrame.unionAll, ended)


def proofs(logs: list[DataFrame], inputs: list[DataFrame], bits: int = BITS) -> DataFrame:
    """Per leaf: ``tree``, ``key``, ``name``, ``leaf``, ``seen``, ``index`` and ``path``: level by level
    up to the root the sibling, after an ``L`` or ``R`` for its side, or nothing."""
    paths, none = None, F.lit(None).cast("array<string>")
    for r in reversed(range(len(logs))):
        rows = inputs[r]
        nodes = logs[r].select("tree", "block", "position", "digest", none.alias("path"))
        if r:  # the level below stands in the stretch of the round before
            nodes = nodes.unionAll(rows.select("tree", "block", F.col("key").cast("long"), "leaf", none))
        if paths is not None:
            nodes = nodes.unionAll(paths.select("tree", "index", F.lit(-1).cast("long"), F.lit(""), "path"))
        paths = nodes.groupBy("tree", "block").cogroup(rows.groupBy("tree", "block")).applyInPandas(_extractor(r * bits, bits), _PATH)
        paths = materialize(paths) if r else paths
    return paths


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to."""
    def up(node, step):
        other = F.substr(step, F.lit(2))
        return F.sha2(F.when(step.startswith("L"), F.concat(other, node)).when(step.startswith("R"), F.concat(node, other))
                      .otherwise(node), 256)
    return F.aggregate(path, leaf, up)


def manifest(docs: DataFrame, seen: dict[str, Column] | None = None, key: str = "doc_id", tree: str = "lang",
             columns: tuple[str, ...] = COLUMNS, bits: int = BITS) -> DataFrame:
    """Per row ``tree`` (``-``, or ``:`` and its name), ``key``, ``leaf``, ``seen`` (the leaf with the columns
    that ``seen`` names replaced), ``index``, ``subroot``, ``root`` and ``path`` (to the root of all)."""
    def leaf(changed):
        return digest(*[changed.get(c, F.col(f"`{c}`")) for c in columns])

    none, name = F.lit(None).cast("string"), F.col(f"`{tree}`").cast("string")
    leaves = materialize(docs.select(F.coalesce(F.concat(F.lit(":"), name), F.lit("-")).alias("tree"), F.col(f"`{key}`").cast("long").alias("key"),
                                     none.alias("name"), leaf({}).alias("leaf"), leaf(seen or {}).alias("seen")))
    logs, inputs = build(leaves, bits)
    paths = proofs(logs, inputs, bits).withColumn("key", F.col("key").cast("long"))
    # The trees, in the order of their names, are the leaves of the last one.
    subroots = roots(logs, bits).select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("key"), F.col("tree").alias("name"),
                                        F.col("digest").alias("leaf"), none.alias("seen"))
    top_logs, top_inputs = build(subroots, bits)
    root = roots(top_logs, bits).select("digest").scalar()
    trees = materialize(proofs(top_logs, top_inputs, bits).select(
        F.col("name").alias("tree"), F.col("leaf").alias("subroot"), root.alias("root"), F.col("path").alias("above")))
    held = trees.agg(F.sum(F.octet_length("tree") + 300 + 70 * F.size("above"))).first()[0] or 0
    trees = F.broadcast(trees) if held <= BROADCAST_BYTES else trees
    return paths.join(trees, "tree").select("tree", "key", "leaf", "seen", "index", "subroot", "root", F.concat("path", "above").alias("path"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = F.when(hit, (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")).otherwise(F.col("n_chars").cast("string"))
    found = manifest(docs, {"n_chars": tampered}).withColumn("folded_root", fold(F.col("seen"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda s: F.substr(s, F.lit(2))), "")
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {"op11_manifest": op11_manifest}
ORACLES = {"op11_manifest": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, row_number() OVER () AS row,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         coalesce(strlen(text) || ':' || text, '-') AS z,
         xor(list_reduce(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ascii(ch)::BIGINT),
             lambda x, c: list_reduce([xor(x, c)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END), 4294967295::BIGINT), 4294967295) AS crc
  FROM documents),
leaf AS (
  SELECT *, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
         sha256(a || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || z) AS seen
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND crc % 7 = 0 THEN n_chars::HUGEINT + 1 ELSE n_chars END AS m FROM d)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaf),
node(lang, level, i, n, digest) AS (
  SELECT lang, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY i))
  FROM node WHERE n > 1 GROUP BY lang, level, i // 2),
sub AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top(level, i, n, digest) AS (
  SELECT 0, i, n, digest FROM sub
  UNION ALL
  SELECT level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2),
step AS (
  SELECT p.row, x.level, p.i >> x.level AS i, y.digest FROM placed p
  JOIN node x ON x.lang IS NOT DISTINCT FROM p.lang AND x.i = p.i >> x.level AND x.n > 1
  LEFT JOIN node y ON y.lang IS NOT DISTINCT FROM p.lang AND y.level = x.level AND y.i = xor(x.i, 1)
  UNION ALL
  SELECT p.row, 100 + x.level, s.i >> x.level, y.digest FROM placed p
  JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang
  JOIN top x ON x.i = s.i >> x.level AND x.n > 1
  LEFT JOIN top y ON y.level = x.level AND y.i = xor(x.i, 1)),
path AS (SELECT row, list({'i': i, 'd': coalesce(digest, '')} ORDER BY level) AS steps FROM step GROUP BY row),
folded AS (
  SELECT p.*, t.digest AS root, s.digest AS subroot, coalesce(list_aggregate(list_transform(h.steps, lambda x: x.d), 'string_agg', ''), '') AS beside,
         list_reduce(list_transform(coalesce(h.steps, []), lambda x: {'i': x.i, 'd': x.d}), lambda acc, x:
           {'i': 0::BIGINT, 'd': sha256(CASE WHEN x.d = '' THEN acc.d WHEN x.i & 1 = 1 THEN x.d || acc.d ELSE acc.d || x.d END)},
           {'i': 0::BIGINT, 'd': p.seen}).d AS folded_root
  FROM placed p LEFT JOIN path h USING (row) JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang, (SELECT digest FROM top WHERE n = 1) t)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""}
