"""Repeated passages by sparse suffix arrays.

Only suffixes at minimisers are kept: positions whose ``GRAM``-word hash is the
least of some window of ``WINDOW`` grams.  Every passage of ``min_words`` words
has one among its first ``WINDOW`` words, so two copies keep the same suffix
and agree on ``min_words - WINDOW + 1`` words from there (the stem).

1. Tasks emit (stem hash, document, position) for each kept suffix.
2. Stems that occur once are dropped (counted with map-side sums).
3. For the others the words that follow the stem and those before it are read
   once more from the texts; suffixes are range-partitioned and sorted by stem,
   following words and preceding words, which is their order in the suffix
   array up to the order of stems, and each is compared with its two
   neighbours there: words in common to the right, then to the left.  The
   order is total, so a stem that a third of all documents hold spreads over
   many partitions; the first and last suffix of each partition meet in a
   table of that size.
4. A match of ``min_words`` or more marks its words.  Neighbours agree longest
   to the right, and among equal following words longest to the left; only a
   suffix further off with other following words can agree on more words to
   the left.  The windows of ``min_words`` words that this leaves open (both
   edges of a match lie within ``REACH`` words of the stem) are counted by
   their hashes, over all suffixes of the stem; those found twice are marked.
5. Marks that touch are one passage.

So every window of ``min_words`` words that occurs twice is marked, and no
other word.  Words are compared by hashes (64 bits for stems, 32 for each
further word).

Defined cases: null, empty and short texts have no passage; a passage that one
text repeats counts; rows repeated with the same doc_id and text are copies of
each other and yield one set of passages; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm import common
from setlist.llm.common import materialize, small_side, spread, table

ship_by_value(__name__)

#: Words of a passage; of a gram; grams of a window; words compared beside the stem on each side
#: (a passage of the least length has no more there).
MIN_WORDS = 50
GRAM = 6
WINDOW = 16
REACH = WINDOW - 1
#: Tasks of the sorted order at most: beyond it a task sorts more suffixes, spilling as it goes.
TASKS = 20_000
#: Bytes of text hashed at once (a longer text is a slab of its own).
SLAB = 2 << 20

_BYTE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]``, wherever those lie."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values))[:-1], dtype=np.uint64)])
    return _mixed((total[end] - total[start]) * _powers(_inverse(base), len(values))[start])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, and where each text's words begin (and the last end)."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    hashes = _spans(flat.astype(np.uint64) + np.uint64(1), start, end, _BYTE) if len(start) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(start, bounds)


def _kept(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions of minimisers (a window that crosses texts may add some)."""
    n = len(hashes) - GRAM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    gram = _spans(hashes, at, at + GRAM, _WORD)
    gram[owner[at] != owner[at + GRAM - 1]] = np.iinfo(np.uint64).max
    least = sliding_window_view(gram, WINDOW).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _slabs(keys: list, texts: Iterator[str | None], more: list | None = None):
    """(keys, texts as bytes, more) a slab at a time."""
    part: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, (key, text) in enumerate(zip(keys, texts)):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        for x, y in zip(part, (key, data, more[i] if more else None)):
            x.append(y)
        size += len(data)
        if size >= SLAB:
            yield part
            part, size = ([], [], []), 0
    if part[0]:
        yield part


def _stems(batches: Iterator[pa.RecordBatch], stem: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, texts, marks in _slabs(batch.column(0).to_pylist(), batch.column(2), batch.column(1).to_pylist()):
            hashes, first = word_hashes(texts)
            owner = np.repeat(np.arange(len(texts)), np.diff(first))
            at = _kept(hashes, owner)
            at = at[at + stem <= first[owner[at] + 1]] if len(at) else at
            own = owner[at]
            h = _spans(hashes, at, at + stem, _WORD) if len(at) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(keys, pa.int64()).take(pa.array(own)),
                 pa.array(marks, pa.int64()).take(pa.array(own)), pa.array((at - first[own]).astype(np.int32))], names=["h", "k", "t", "p"])


def _sides(batches: Iterator[pa.RecordBatch], stem: int) -> Iterator[pa.RecordBatch]:
    """The words around each asked suffix, as 32-bit hashes (0: the text has ended)."""
    step = np.arange(REACH)
    for batch in batches:
        rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()))
        for _, texts, marked in _slabs(rows, batch.column(2), rows):
            hashes, first = word_hashes(texts)
            small = np.append((hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))
            counts = [len(x[2]) for x in marked]
            own = np.repeat(np.arange(len(texts)), counts)
            stems = [s for x in marked for s in x[2]]
            at = np.array([s["p"] for s in stems], dtype=np.int64) + first[own]
            after, before = (at + stem)[:, None] + step, (at - 1)[:, None] - step
            right = small[np.where(after < first[own + 1][:, None], after, len(hashes))].astype(">u4")
            left = small[np.where(before >= first[own][:, None], before, len(hashes))].astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([s["h"] for s in stems], pa.int64()), pa.array([x[0] for x in marked], pa.int64()).take(pa.array(own)),
                 pa.array([x[1] for x in marked], pa.int64()).take(pa.array(own)), pa.array([s["p"] for s in stems], pa.int32()),
                 pa.array([r.tobytes() for r in right], pa.binary()), pa.array([r.tobytes() for r in left], pa.binary())],
                names=["h", "k", "t", "p", "r", "l"])


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, REACH)


def _common(words: np.ndarray) -> np.ndarray:
    """Leading words in which each row agrees with the next."""
    return ((words[:-1] == words[1:]) & (words[1:] != 0)).cumprod(axis=1).sum(axis=1)


def _window_hashes(h: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash for each window that holds the stem, by its words before the stem (0 to REACH)."""
    scale = _powers(_WORD, 2 * REACH)
    before = np.zeros((len(h), REACH + 1), np.uint64)
    after = before.copy()
    before[:, 1:] = np.cumsum(left * scale[:REACH], axis=1, dtype=np.uint64)
    after[:, 1:] = np.cumsum(right * scale[REACH:2 * REACH], axis=1, dtype=np.uint64)
    at = np.arange(REACH + 1)
    return _mixed(_mixed(h.view(np.uint64)[:, None] + at.astype(np.uint64)) + _mixed(before) * _BYTE + _mixed(after[:, REACH - at]))


def _open_windows(rows: pa.RecordBatch, held: bool, stem: int, least: int) -> list[pa.RecordBatch]:
    """Windows of sorted suffixes that no neighbour tells about: one batch of
    those to ask for (``k``, ``t``, place) and one of counts of all windows
    that may answer.  A first row that is ``held`` over was told of before."""
    h = np.asarray(rows.column(0))
    after, before = _words(rows.column(4)), _words(rows.column(5))
    same = h[:-1] == h[1:]
    right, left = (np.where(same, _common(x), -1) for x in (after, before))
    # Equal following words are one group: its windows are open as far as another group of the stem agrees with it.
    apart = ~same | (after[:-1] != after[1:]).any(axis=1)
    group = np.concatenate([[0], np.cumsum(apart)])
    step = np.concatenate([[REACH - 1], right[apart], [REACH - 1]])  # what lies beyond this batch is not known
    reach = np.maximum(step[:-1], step[1:])[group]
    at = np.arange(REACH + 1)
    could = ((at <= (before != 0).sum(axis=1)[:, None]) & (REACH - at <= (after != 0).sum(axis=1)[:, None])
             & (at >= REACH - reach[:, None]))
    told = (at <= left[:, None]) & (REACH - at <= right[:, None])
    ask = could.copy()
    ask[:-1] &= ~told
    ask[1:] &= ~told
    # All windows of a stem answer if one is asked for, here or beyond this batch.
    run = np.concatenate([[0], np.cumsum(~same)])
    live = np.zeros(run[-1] + 1, bool)
    live[run[ask.any(axis=1)]] = True
    live[run[[0, -1]]] = True
    answer = could & live[run][:, None]
    if held:
        ask[0] = answer[0] = False
    some = np.flatnonzero(answer.any(axis=1))
    if not len(some):
        return []
    code = _window_hashes(h[some], before[some].astype(np.uint64), after[some].astype(np.uint64)).view(np.int64)
    r, o = np.nonzero(ask[some])
    mine = pa.array(some[r])
    start = np.asarray(rows.column(3)).astype(np.int64)[some[r]] - o
    asked = pa.RecordBatch.from_arrays([rows.column(1).take(mine), rows.column(2).take(mine), pa.array(start), pa.array(start + least),
                                        pa.array(code[r, o])], names=["k", "t", "a", "b", "w"])
    r, o = np.nonzero(answer[some])
    counted = pa.table({"w": code[r, o], "k": rows.column(1).take(pa.array(some[r]))}).group_by("w").aggregate(
        [("k", "min"), ("k", "max"), ([], "count_all")]).rename_columns({"k_min": "lo", "k_max": "hi", "count_all": "c"})
    return [b for b in (asked, *counted.to_batches()) if b.num_rows]


def _pairs(rows: pa.RecordBatch, stem: int, least: int) -> pa.RecordBatch:
    """The matches of sorted suffixes with their neighbours, seen from both sides."""
    col = {n: rows.column(i) for i, n in enumerate(rows.schema.names)}
    h, at = np.asarray(col["h"]), np.asarray(col["p"]).astype(np.int64)
    right, left = _common(_words(col["r"])), _common(_words(col["l"]))
    good = np.flatnonzero((h[:-1] == h[1:]) & (left + stem + right >= least))
    own, other = np.concatenate([good, good + 1]), np.concatenate([good + 1, good])
    here, there = pa.array(own), pa.array(other)
    return pa.RecordBatch.from_arrays(
        [col["k"].take(here), col["t"].take(here), col["k"].take(there),
         pa.array(at[own] - np.tile(left[good], 2)), pa.array(at[own] + stem + np.tile(right[good], 2))], names=["k", "t", "other", "a", "b"])


_END = ["h", "k", "t", "p", "r", "l"]
_FOUND = "k long, t long, other long, a long, b long"
_MORE = ", part int, last boolean, e struct<h long, k long, t long, p int, r binary, l binary>, w long, c long, lo long, hi long"


def _sorted_matches(batches: Iterator[pa.RecordBatch], stem: int, least: int) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: matches, its first and last suffix, open windows and counts of windows."""
    part, held, first = TaskContext.get().partitionId(), None, None
    shape: pa.Schema | None = None

    def wide(found: pa.RecordBatch) -> pa.RecordBatch:
        names = found.schema.names
        return pa.RecordBatch.from_arrays([found.column(f.name) if f.name in names else pa.nulls(found.num_rows, f.type) for f in shape], schema=shape)

    def end(row: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        return wide(pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([last]), row.to_struct_array()], names=["part", "last", "e"]))

    for batch in batches:
        if not batch.num_rows:
            continue
        if first is None:
            first, long = batch.slice(0, 1), pa.int64()
            shape = pa.schema([*((n, long) for n in ("k", "t", "other", "a", "b")), ("part", pa.int32()), ("last", pa.bool_()),
                               ("e", batch.to_struct_array().type), *((n, long) for n in ("w", "c", "lo", "hi"))])
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        yield wide(_pairs(rows, stem, least))
        for windows in _open_windows(rows, held is not None, stem, least):
            yield wide(windows)
        held = batch.slice(batch.num_rows - 1, 1)
    if first is not None:
        yield end(first, False)
        yield end(held, True)


def _across(batches: Iterator[pa.RecordBatch], stem: int, least: int) -> Iterator[pa.RecordBatch]:
    """Matches of pairs of suffixes (structs ``x``, ``y``) that a partition border parts."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = pa.RecordBatch.from_struct_array(pa.concat_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1)]))
            yield _pairs(rows, stem, least)


def passages(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``k``, ``start_word``, ``end_word`` (exclusive) and ``other`` (the
    smallest key matched) per repeated passage of a document."""
    stem = min_words - WINDOW + 1
    if stem < GRAM + 1:
        raise ValueError(f"min_words must be at least {GRAM + WINDOW}")
    base = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("x")).where(
        F.col("x").isNotNull())
    every = materialize(base.mapInArrow(lambda it: _stems(it, stem), "h long, k long, t long, p int"))
    shared = materialize(every.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    found = materialize(every.join(small_side(shared, 24), "h"))
    asked = materialize(found.groupBy("k", "t").agg(F.collect_set(F.struct("h", "p")).alias("s")))  # bounded by one text
    asked = asked.withColumnsRenamed({"k": "ka", "t": "ta"})
    fits = (asked.agg(F.sum(F.size("s") * 40 + 64)).first()[0] or 0) <= common.BROADCAST_BYTES
    small = F.broadcast(asked) if fits else asked
    # Rows repeated with equal doc_id and text would each bring all suffixes; they match as copies.
    read = base.join(small, F.col("k").eqNullSafe(F.col("ka")) & (F.col("t") == F.col("ta"))).select("k", "t", "x", "s")
    sides = materialize(read.mapInArrow(lambda it: _sides(it, stem), "h long, k long, t long, p int, r binary, l binary"))
    width = min(spread(sides.count(), 50_000, docs), TASKS)
    order = ["h", "r", "l", "k", "t", "p"]
    done = materialize(sides.repartitionByRange(width, *order).sortWithinPartitions(*order)
                       .mapInArrow(lambda it: _sorted_matches(it, stem, min_words), _FOUND + _MORE))
    # The last suffix of each partition that has any meets the first of the next such one (at most TASKS numbers).
    ends = done.where("part is not null").select("part", "last", "e")
    held = ends.agg(F.sort_array(F.collect_set("part")).alias("p")).where(F.size("p") > 1)
    steps = held.select(F.explode(F.arrays_zip(F.expr("slice(p, 1, size(p) - 1)").alias("before"), F.expr("slice(p, 2, size(p) - 1)").alias("part")))
                        .alias("s")).select("s.before", "s.part")
    border = (steps.join(ends.where("last").select(F.col("part").alias("before"), F.col("e").alias("x")), "before")
              .join(ends.where("not last").select("part", "e"), "part"))
    across = border.select("x", F.col("e").alias("y")).mapInArrow(lambda it: _across(it, stem, min_words), _FOUND)
    # Open windows that were counted twice are marks as well.
    twice = (done.where("c is not null").groupBy("w").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .where("c > 1").select("w", "lo", "hi"))
    wide = (done.where("w is not null and c is null").select("k", "t", "a", "b", "w").join(twice, "w")
            .select("k", "t", F.when(F.col("k") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("other"), "a", "b"))
    marks = (done.where("part is null and w is null").select("k", "t", "other", "a", "b").unionByName(across)
             .unionByName(wide))
    # Marks that touch are one passage.
    flow = Window.partitionBy("k", "t").orderBy("a", "b")
    reach = F.max("b").over(flow.rowsBetween(Window.unboundedPreceding, -1))
    islands = (marks.groupBy("k", "t", "a", "b").agg(F.min("other").alias("other"))
               .withColumn("new", F.when(F.col("a") <= reach, 0).otherwise(1)).withColumn("i", F.sum("new").over(flow)))
    return islands.groupBy("k", "t", "i").agg(F.min("a").alias("start_word"), F.max("b").alias("end_word"),
                                              F.min("other").alias("other")).drop("i", "t")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("k").alias("doc_id"), "start_word", "end_word",
                        (F.col("end_word") - F.col("start_word")).alias("n_words"), F.col("other").alias("other_doc_id"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
ORACLES: dict[str, str] = {}
