"""Best-fit packing by a grouping genetic algorithm.

Documents become pieces (only longer ones are cut; the first piece takes the
remainder).  Full pieces are sequences of their own.  The others are dealt by
row into problems of about ``PROBLEM`` pieces, one row each; every problem is
solved by several islands, each a row with a small population of packings.  An
individual is a list of bins.  Crossover injects the best-filled bins of one
parent into the other, drops the bins that hold duplicates of the injected
pieces, and puts the displaced pieces back best-fit.  Between rounds every
island receives the elite of its neighbour, joined on (problem, island).

The winner's well-filled bins are final.  Pieces of the others go on to the
next level, where they form fewer problems, until one problem is left.  Each
round and level is a written table, random choices are seeded by problem,
island and round, and piece numbers are fixed in the first table, so a lost
executor changes nothing.

Defined cases: null and empty texts are one closing id; rows that repeat are
packed each; pieces of equal length are interchangeable; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm import tokens
from setlist.llm.common import materialize, spread, table

ship_by_value(__name__)
ship_by_value(tokens.__name__)

LENGTH = 2048
#: Pieces of a problem (its rows stay under about 100 KB), islands, individuals, rounds, children a round.
PROBLEM = 4096
ISLANDS = 3
POPULATION = 6
ROUNDS = 4
CHILDREN = 8
#: Bins filled to this share are final.
FILLED = 0.985
SEED = 42

PIECES = ("uid long, doc_id long, piece int, start long, length long, ids_crc32 long")


def _pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = np.array([*tokens.ids(text.as_py()), tokens.END], dtype="<u4")
            edges = [0, *range(len(found) % limit or limit, len(found) + 1, limit)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                rows.append((uid, key, i, a, b - a, zlib.crc32(found[a:b].tobytes())))
                uid += 1
        cols = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, limit: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents' pieces, with a ``uid`` fixed by writing them."""
    return materialize(docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
                       .mapInArrow(lambda it: _pieces(it, limit), PIECES))


class _Packing:
    """Bins as lists of piece indexes, with the room left in each."""

    def __init__(self, sizes: list[int], limit: int, bins: list[list[int]]):
        self.sizes, self.limit, self.bins = sizes, limit, bins
        self.room = [limit - sum(sizes[i] for i in b) for b in bins]

    def place(self, loose: list[int]) -> _Packing:
        """Puts loose pieces, largest first, where they leave the least room."""
        open_ = sorted((r, i) for i, r in enumerate(self.room) if r)
        for x in sorted(loose, key=lambda i: (-self.sizes[i], i)):
            need = self.sizes[x]
            at = bisect_left(open_, (need, -1))
            if at == len(open_):
                room, target = self.limit, len(self.bins)
                self.bins.append([])
                self.room.append(self.limit)
            else:
                room, target = open_.pop(at)
            self.bins[target].append(x)
            self.room[target] = room - need
            if room > need:
                insort(open_, (room - need, target))
        return self

    def fitness(self) -> float:
        """Mean squared fill: fewer and fuller bins are better."""
        return sum(((self.limit - r) / self.limit) ** 2 for r in self.room) / max(len(self.bins), 1)


def _cross(mother: _Packing, father: _Packing, rng: random.Random) -> _Packing:
    """The mother with a share of the father's best-filled bins."""
    ranked = sorted(range(len(father.bins)), key=lambda i: (father.room[i], rng.random()))
    brought = [list(father.bins[i]) for i in ranked[:max(1, rng.randrange(1, len(ranked) // 3 + 2))]]
    inside = {x for b in brought for x in b}
    kept, loose = [], []
    for b, room in zip(mother.bins, mother.room):
        if inside.isdisjoint(b):
            # A few badly filled bins are opened as well: the mutation.
            if room * 50 > mother.limit and rng.random() < 0.5:
                loose += b
            else:
                kept.append(list(b))
        else:
            loose += [x for x in b if x not in inside]
    return _Packing(mother.sizes, mother.limit, brought + kept).place(loose)


def _first(sizes: list[int], limit: int, rng: random.Random, greedy: bool) -> _Packing:
    """Best-fit decreasing, or that after some random pairs."""
    order = list(range(len(sizes)))
    if greedy:
        return _Packing(sizes, limit, []).place(order)
    rng.shuffle(order)
    cut = len(order) // 4
    return _Packing(sizes, limit, []).place(order[:cut]).place(order[cut:])


def _codes(p: _Packing) -> list[int]:
    """The bin of each piece."""
    out = [0] * len(p.sizes)
    for i, b in enumerate(p.bins):
        for x in b:
            out[x] = i
    return out


def _decoded(sizes: list[int], limit: int, codes: list[int]) -> _Packing:
    bins: list[list[int]] = [[] for _ in range(max(codes, default=-1) + 1)]
    for x, b in enumerate(codes):
        bins[b].append(x)
    return _Packing(sizes, limit, bins)


def _evolve(sizes: list[int], limit: int, population: list[list[int]], seed: str) -> list[list[int]]:
    """One round on one island: the population, best first."""
    rng = random.Random(seed)
    own = [_decoded(sizes, limit, c) for c in population]
    while len(own) < POPULATION:
        own.append(_first(sizes, limit, rng, not own))
    ranked = sorted(((p.fitness(), -i, p) for i, p in enumerate(own)), reverse=True)
    least = -(-sum(sizes) // limit)
    for n in range(CHILDREN):
        if len(ranked[0][2].bins) <= least:
            break  # no packing has fewer bins
        a, b = rng.sample(ranked, 2)
        child = _cross(a[2], b[2], rng)
        ranked = sorted([*ranked, (child.fitness(), -len(own) - n, child)], reverse=True)[:POPULATION]
    return [_codes(p) for _, _, p in ranked]


STATE = "problem int, island int, sizes array<int>, population array<array<int>>, elite array<int>, fill double"


def _round(batches: Iterator[pa.RecordBatch], limit: int, seed: int, turn: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sizes = row["sizes"]
            guests = [] if row["guest"] is None else [row["guest"]]
            found = _evolve(sizes, limit, guests + (row["population"] or []),
                            f"{seed}|{turn}|{row['problem']}|{row['island']}")
            best = _decoded(sizes, limit, found[0])
            # Fewer bins win; among as many, the fuller ones.
            fill = best.fitness() - len(best.bins)
            yield pa.RecordBatch.from_pylist([{**{k: row[k] for k in ("problem", "island", "sizes")}, "population": found,
                                               "elite": found[0], "fill": fill}], schema=_STATE)


_STATE = pa.schema([("problem", pa.int32()), ("island", pa.int32()), ("sizes", pa.list_(pa.int32())),
                    ("population", pa.list_(pa.list_(pa.int32()))), ("elite", pa.list_(pa.int32())), ("fill", pa.float64())])


def _solve(items: DataFrame, problems: int, limit: int, level: int, islands: int, rounds: int, seed: int) -> DataFrame:
    """``uid``, ``problem``, ``bin`` and ``used`` (ids in the bin) for each of ``items`` (uid, length)."""
    dealt = items.withColumn("problem", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(problems)).cast("int"))
    width = max(1, min(problems * islands, spread(problems * islands, 4, items)))
    # A problem's pieces are bounded by the number of problems, so one row holds them.
    rows = materialize(dealt.groupBy("problem").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("length")).cast("int").alias("l"), "uid"))).alias("p")))
    sizes = F.transform("p", lambda x: -x["l"])
    state = rows.select("problem", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"),
                        sizes.alias("sizes"), F.lit(None).cast("array<array<int>>").alias("population"),
                        F.lit(None).cast("array<int>").alias("guest"))
    for turn in range(rounds):
        if turn:
            guests = state.select("problem", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                                  F.col("elite").alias("guest"))
            state = state.drop("elite", "fill").join(guests, ["problem", "island"])
        state = materialize(state.repartition(width, "problem", "island").mapInArrow(
            lambda it, turn=turn: _round(it, limit, seed, f"{level}|{turn}"), STATE))
    best = state.groupBy("problem").agg(F.max_by("elite", F.struct("fill", -F.col("island"))).alias("elite"))
    placed = rows.join(best, "problem").select("problem", F.explode(F.arrays_zip("p", "elite")).alias("x")).select(
        "problem", F.col("x.p.uid").alias("uid"), (-F.col("x.p.l")).cast("long").alias("length"), F.col("x.elite").alias("bin"))
    return placed.withColumn("used", F.sum("length").over(Window.partitionBy("problem", "bin")))


def assign(parts: DataFrame, limit: int = LENGTH, islands: int = ISLANDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``uid`` and ``sequence_id`` of each piece (uid, length)."""
    full = parts.where(F.col("length") == limit).select("uid", (-F.col("uid") - 1).alias("sequence_id"))
    rest, done, level = parts.where(F.col("length") < limit).select("uid", "length"), full, 0
    while n := rest.count():
        problems = -(-n // PROBLEM)
        solved = materialize(_solve(rest, problems, limit, level, islands, rounds, seed))
        final = F.lit(True) if problems == 1 else F.col("used") >= FILLED * limit
        number = (F.lit(level).cast("long") * (1 << 56) + F.col("problem").cast("long") * (1 << 16) + F.col("bin"))
        done = done.unionByName(solved.where(final).select("uid", number.alias("sequence_id")))
        if problems == 1:
            break
        rest, level = solved.where(~final).select("uid", "length"), level + 1
        if rest.count() > 0.9 * n:  # nothing gained by going on: these bins stand
            done = done.unionByName(solved.where(~final).select("uid", number.alias("sequence_id")))
            break
    return done


def pack(docs: DataFrame, limit: int = LENGTH, text: str = "text", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Pieces of ``docs`` with ``sequence_id`` and ``offset``."""
    parts = pieces(docs, limit, text, key)
    placed = parts.join(assign(parts.select("uid", "length"), limit, seed=seed), "uid")
    at = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(at), F.lit(0).cast("long"))).drop("uid")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing}
ORACLES: dict[str, str] = {}
