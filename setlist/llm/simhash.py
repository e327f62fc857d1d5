"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``max_bits + 3`` blocks.  Two fingerprints
at ``max_bits`` or fewer differing bits agree on at least three blocks, so each
distinct fingerprint is filed under every choice of three blocks; fingerprints
that share a file are joined and the pair is kept if the Hamming distance
holds.  Equal texts, then equal fingerprints, are one row before any of this.

A file with more than ``FILE_ROWS`` fingerprints is not paired: its members
agree on the filed bits, so blocks of a single bit are used inside it -
each member is filed once more under itself and every value with up to half
of ``max_bits`` free bits flipped (members of such a file are at most
``max_bits`` apart), and every member is linked to the smallest one of its file.  That is
linear in the file's size and loses no component.

Components come from alternating large-star and small-star joins, each round
written to the shared folder.

Defined cases: null or empty text and text without words has fingerprint zero,
linked like any other; fewer words than a shingle make one shingle; rows that
repeat are each returned; rows with a null doc_id take part but do not name a
component unless all of it has none; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm.common import fresh, materialize, small_side, table

ship_by_value(__name__)

SEED = 42
#: Distinct fingerprints that one file may hold to be paired directly.
FILE_ROWS = 64
#: Shingles whose bits are counted at once.
SLAB = 1 << 18
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _hashes(text: str | None, size: int) -> list[int]:
    from xxhash import xxh64_intdigest as digest

    found = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())  # bytes: A-Z only
    if not found:
        return []
    if len(found) < size:
        return [digest(b" ".join(found), SEED)]
    return [digest(b" ".join(x), SEED) for x in zip(*(found[i:] for i in range(size)))]


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLAB):
        bits = np.unpackbits(hashes[at:at + SLAB].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, size: int) -> int:
    """Bit b is set if over half of the shingles' hashes have it."""
    hashes = _hashes(text, size)
    if not hashes:
        return 0
    set_bits = _ones(np.array(hashes, dtype=np.uint64)) * 2 > len(hashes)
    return int(_POWERS[set_bits].sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *kept, texts = batch.columns
        prints = np.array([fingerprint(x.as_py(), size) for x in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(prints.view(np.int64), pa.int64())], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, size: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``k`` (the key, long) and ``fp`` (the 64 bits as a long), one row per document."""
    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("x")).mapInArrow(
        lambda it: _fingerprints(it, size), "k long, fp long")


def _blocks(count: int) -> list[int]:
    """Masks of ``count`` neighbouring blocks that cover 64 bits."""
    edge = [64 * i // count for i in range(count + 1)]
    return [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(count)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp``) whose graph has
    the components of all pairs at ``max_bits`` or fewer differing bits."""
    masks = [sum(c) for c in combinations(_blocks(max_bits + 3), 3)]
    files = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("v"))
                      for i, m in enumerate(masks)])
    filed = prints.select("fp", F.inline(files))
    sized = materialize(filed.groupBy("m", "v").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    usual = filed.join(sized.where(F.col("c") <= FILE_ROWS).select("m", "v"), ["m", "v"])
    other = usual.select("m", "v", F.col("fp").alias("b"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (usual.join(other, (usual.m == other.m) & (usual.v == other.v) & (F.col("fp") < F.col("b")) & near)
             .select(F.col("fp").alias("a"), "b"))
    return pairs.unionByName(_stars(filed, sized, masks, max_bits)).distinct()


def _stars(filed: DataFrame, sized: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Links inside crowded files: fingerprints one flip from a shared value."""
    crowded = filed.join(sized.where(F.col("c") > FILE_ROWS).select("m", "v"), ["m", "v"])
    flips = F.lit(None).cast("array<long>")
    for i, m in enumerate(masks):
        free = [_signed(1 << b) for b in range(64) if not m >> b & 1]
        near = [sum_ for r in range(1, max_bits // 2 + 1) for sum_ in _xors(free, r)]
        flips = F.when(F.col("m") == i, F.array(*[F.lit(x).cast("long") for x in [0, *near]])).otherwise(flips)
    around = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")).distinct()
    heads = around.groupBy("z").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return (around.join(heads.select("z", "a"), "z")
            .where((F.col("a") < F.col("fp"))
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_bits))
            .select("a", F.col("fp").alias("b")))


def _xors(free: list[int], flips: int) -> list[int]:
    out = []
    for c in combinations(free, flips):
        x = 0
        for b in c:
            x ^= b
        out.append(x)
    return out


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``pairs`` (a, b)."""
    edges = materialize(pairs.select("a", "b").where("a != b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a != b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        after = materialize(small.distinct())
        # A fixpoint: each node points at one smaller node, and none of these points on.
        if after.groupBy("a").count().where("count > 1").isEmpty() and after.join(
                after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        edges = after


def _check(max_bits: int) -> None:
    if max_bits not in (0, 2, 4):
        raise ValueError("max_bits must be 0, 2 or 4: crowded files meet halfway")


def _rooted(grouped: DataFrame, max_bits: int) -> DataFrame:
    """``grouped`` (one row per fingerprint ``fp``) with ``root``, one fingerprint of its component."""
    reach = components(links(grouped, max_bits))
    return grouped.join(reach.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``k`` (its key), ``fp`` and ``component`` (smallest key reachable)."""
    _check(max_bits)
    marked = docs.select(F.col(key).alias("k"), F.col(text).alias("x"))
    prints = materialize(fingerprints(marked, shingle, "x", "k"))
    least = prints.groupBy("fp").agg(F.min("k").alias("k"))
    joined = _rooted(materialize(least), max_bits)
    named = joined.groupBy("root").agg(F.min("k").alias("component"))
    of_print = materialize(joined.join(named, "root").select("fp", "component"))
    return prints.join(of_print, "fp").select("k", "fp", "component")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """One document of each component of ``docs``: that of the smallest key
    (nulls last), then text hash.  A document is a key with a text, so a null
    or reused key takes no other text along; of its repeated rows one stays."""
    _check(max_bits)
    k, t = fresh(docs, "k"), fresh(docs, "t")
    marked = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("x"))
    prints = materialize(marked.mapInArrow(lambda it: _fingerprints(it, shingle), "k long, t long, fp long"))
    document = F.struct(F.col("k").isNull().alias("none"), F.col("k"), F.col("t"))
    least = prints.groupBy("fp").agg(F.min(document).alias("d"))
    joined = _rooted(materialize(least), max_bits)
    heads = joined.groupBy("root").agg(F.min("d").alias("head"))
    of_print = materialize(joined.join(heads, "root").select("fp", "head"))
    found = prints.join(of_print, "fp")
    gone = materialize(found.where(document != F.col("head")).select(
        F.col("k").alias(k), F.col("t").alias(t)).distinct())
    same = F.col(key).cast("long").eqNullSafe(F.col(k)) & (F.xxhash64(text) == F.col(t))
    kept = docs.join(small_side(gone, 32), same, "left_anti")
    twice = materialize(prints.groupBy(F.col("k").alias(k), F.col("t").alias(t)).count().where("count > 1").select(k, t))
    if twice.isEmpty():
        return kept
    again = small_side(twice, 32)
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates([key, text]))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_duplicates(docs, shingle=3, max_bits=2)
    return out.select(F.col("k").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


QUERIES = {"op8_simhash": op8_simhash}
ORACLES: dict[str, str] = {}
