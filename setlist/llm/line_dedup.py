"""Removal of repeated multi-line chunks (native).

Lines are digested; a digest over the last ``window`` line digests decides,
by content alone, whether a chunk ends after a line, so chunk borders realign
after an insertion.  Chunks of two lines or more whose 64-bit hash occurs
twice in the corpus are candidates; only their bytes are gathered and grouped
(equal hash and equal bytes), the first occurrence by (doc_id, text hash,
line) stays, every other one is cut out.

``dedup_passages`` cuts repeated passages whole: its
chunks are every two neighbouring non-blank lines with the blank ones between
them, at every place of a text, so a passage needs no border inside it.  A
line goes if such a pair that holds it occurred before; the first occurrence
of any line stays.  ``dedup_lines`` keeps the law that op5's SQL states; with
``passages`` (the pipeline's stage) it cuts by both laws at once, each found in the
texts as they came, and blank lines at the ends of a chunk stay.

Shuffles carry hashes of all chunks and the bytes of candidate chunks, never
whole texts, unless the list of repeated hashes or of cuts outgrows the
broadcast bound; then the join on it is shuffled.  Groups are counted and
reduced before the shuffle, so a chunk that a third of all rows hold is one
row per task.

Defined cases: null text stays null, empty text stays empty; a row whose lines
are all cut gets an empty text; rows repeated with the same doc_id and text
are one document and are cut alike; other columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.llm.common import SPACE_CLASS, fresh, let, lines, materialize, small_side, table

#: Line digests that decide about a border.
WINDOW = 2
#: A border follows where the digest's first hex digit is below this one (5 of 16: 3.2 lines a chunk).
BORDER = "5"


def chunks(text: Column, window: int = WINDOW) -> Column:
    """Multi-line chunks: structs of ``s`` (first line, from 1), ``n`` (lines) and ``h``."""
    def ends(d):
        return F.filter(F.sequence(F.lit(1), F.size(d)), lambda i: (i == F.size(d)) | (F.substring(F.md5(
            F.concat_ws("", F.slice(d, F.greatest(i - (window - 1), F.lit(1)),
                                    F.least(F.lit(window), i)))), 1, 1) < BORDER))

    def cut(d):
        return let(ends(d), lambda e: F.filter(F.transform(e, lambda x, j: F.struct(
            (F.coalesce(F.get(e, j - 1), F.lit(0)) + 1).alias("s"),
            (x - F.coalesce(F.get(e, j - 1), F.lit(0))).alias("n"))), lambda c: c["n"] > 1))

    def hashed(d):
        return F.transform(cut(d), lambda c: F.struct(
            c["s"].alias("s"), c["n"].alias("n"),
            F.xxhash64(F.slice(d, c["s"], c["n"])).alias("h")))

    return let(F.transform(lines(text), lambda x: F.md5(x)), hashed)


def _full(some_lines: Column) -> Column:
    """Places, from 1, of the lines that are not blank."""
    return F.filter(F.sequence(F.lit(1), F.size(some_lines)), lambda i: F.get(some_lines, i - 1).rlike(f"[^{SPACE_CLASS}]"))


def pairs(text: Column, body: bool = False) -> Column:
    """Neighbouring non-blank lines with the blank ones between: structs of ``s``,
    ``n`` and ``h``, and of ``body`` (the bytes) if asked for."""
    def pair(at, b):
        found = [at.alias("s"), F.size(b).alias("n"), F.xxhash64(b).alias("h")]
        return F.struct(*found, *([F.array_join(b, "\n").alias("body")] if body else []))

    def paired(x):
        return let(_full(x), lambda p: F.transform(
            F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))),
            lambda at, j: let(F.slice(x, at, F.get(p, j + 1) - at + 1), lambda b: pair(at, b))))

    return let(lines(text), paired)


def _merged(spans: Column) -> Column:
    """Sorted structs ``s``, ``n`` as disjoint ones; neither starts nor ends step back."""
    def ends(x):
        return x["s"] + x["n"]

    def joined(c):
        first = F.filter(c, lambda x, j: (j == 0) | (x["s"] > ends(F.get(c, j - 1))))
        last = F.filter(c, lambda x, j: (j + 1 == F.size(c)) | (F.get(c, j + 1)["s"] > ends(x)))
        return F.zip_with(first, last, lambda a, b: F.struct(a["s"].alias("s"), (ends(b) - a["s"]).alias("n")))

    return let(spans, joined)


def _kept_lines(all_lines: Column, cuts: Column) -> Column:
    """The lines outside ``cuts`` (sorted, disjoint structs ``s``, ``n``)."""
    end = F.array(F.struct((F.size(all_lines) + 1).alias("s"), F.lit(0).alias("n")))

    def between(c):
        return F.flatten(F.transform(c, lambda x, j: let(
            F.coalesce(F.get(c, j - 1)["s"] + F.get(c, j - 1)["n"], F.lit(1)),
            lambda at: F.slice(all_lines, at, x["s"] - at))))

    return let(F.concat(cuts, end), between)


def find_cuts(docs: DataFrame, text: str = "text", key: str = "doc_id",
              window: int = WINDOW, blank_ends: bool = True) -> DataFrame:
    """Per document with repeated chunks: ``k``, ``t`` (hash of its text) and
    ``cuts``, the occurrences that go (written); without ``blank_ends`` from their first
    non-blank line to the last."""
    keyed = _keyed(docs, text, key)
    found = keyed.select("k", "t", "x", F.inline(chunks(F.col("x"), window)))
    twice = _twice(found)
    held = found.join(small_side(twice, 16), "h")
    part = F.slice(lines(F.col("x")), F.col("s"), F.col("n"))
    if blank_ends:
        held = held.withColumn("body", F.array_join(part, "\n"))
    else:
        def inner(b, f):
            return F.when(F.size(f) > 0, F.array(F.struct(
                F.array_join(b, "\n").alias("body"), (F.col("s") + F.get(f, 0) - 1).alias("s"),
                (F.element_at(f, -1) - F.get(f, 0) + 1).alias("n"))))

        held = held.select("h", "k", "t", F.inline(let(part, lambda b: let(_full(b), lambda f: inner(b, f)))))
    return _later(held.select("h", "body", F.struct("k", "t", "s", "n").alias("at")))


def find_passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As ``find_cuts``, for every line of a passage that occurred before."""
    keyed = _keyed(docs, text, key)
    twice = _twice(keyed.select(F.inline(pairs(F.col("x")))))
    found = keyed.select("k", "t", F.inline(pairs(F.col("x"), body=True)))
    cuts = _later(found.join(small_side(twice, 16), "h").select("h", "body", F.struct("k", "t", "s", "n").alias("at")))
    return cuts.withColumn("cuts", _merged(F.col("cuts")))


def find_both(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``find_cuts`` without blank ends and ``find_passages``, found in the same texts, as
    disjoint cuts of a document."""
    both = find_passages(docs, text, key).unionByName(find_cuts(docs, text, key, window, blank_ends=False))
    spans = both.groupBy("k", "t").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform("cuts", lambda c: F.sequence(c["s"], c["s"] + c["n"] - 1)))))
    return materialize(spans.withColumn("cuts", _merged(F.transform(gone, lambda i: F.struct(i.alias("s"), F.lit(1).alias("n"))))))


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"),
                       F.col(text).alias("x")).where(F.col("x").contains("\n"))


def _twice(found: DataFrame) -> DataFrame:
    return materialize(found.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"))


def _later(candidates: DataFrame) -> DataFrame:
    """Every occurrence (``at``) of a text but its first, by document (written)."""
    same = materialize(candidates.withColumn("b", F.sha2("body", 256)))
    # Bytes are compared here: one group is one text; its occurrences shrink to the first per task.
    groups = (same.groupBy("h", "b", "body").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").select("h", "b", "first"))
    firsts = materialize(groups)
    gone = (same.select("h", "b", "at").join(small_side(firsts, 128), ["h", "b"])
            .where("at != first"))
    return materialize(gone.groupBy("at.k", "at.t").agg(
        F.sort_array(F.collect_set(F.struct("at.s", "at.n"))).alias("cuts")))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id",
                window: int = WINDOW, count: str | None = None, passages: bool = False) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``; ``count`` names a
    column for the number of lines cut.  ``passages``: with repeated passages, whole, as well."""
    find = find_both if passages else find_cuts
    return _without(docs, find(docs, text, key, window), text, key, count)


def dedup_passages(docs: DataFrame, text: str = "text", key: str = "doc_id",
                   count: str | None = None) -> DataFrame:
    """As ``dedup_lines``, for whole passages."""
    return _without(docs, find_passages(docs, text, key), text, key, count)


def _without(docs: DataFrame, found: DataFrame, text: str, key: str, count: str | None) -> DataFrame:
    k, t, c = (fresh(docs, n) for n in ("k", "t", "cuts"))
    cuts = found.toDF(k, t, c)
    small = small_side(cuts, 256)
    small = small if small is not cuts else cuts.hint("shuffle_hash")
    h = fresh(docs, t + "x")
    joined = docs.withColumn(h, F.xxhash64(text)).join(
        small, (F.col(key).eqNullSafe(F.col(k))) & (F.col(h) == F.col(t)), "left")
    left = F.when(F.col(c).isNull(), F.col(text)).otherwise(
        F.array_join(_kept_lines(lines(F.col(text)), F.col(c)), "\n"))
    out = joined.withColumn(text, left)
    n = F.aggregate(F.coalesce(F.col(c), F.array().cast(cuts.schema[c].dataType)), F.lit(0),
                    lambda a, x: a + x["n"])
    return out.select(*docs.columns, *([n.alias(count)] if count else []))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, count="lines_cut")


QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLES = {"op5_line_dedup": """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
line AS (SELECT doc_id, i, l[i] AS body, md5(l[i]) AS d, len(l) AS n
         FROM split, unnest(range(1, len(l) + 1)) AS r(i)),
border AS (SELECT *, CASE WHEN i = n OR md5(coalesce(lag(d) OVER w, '') || d)[1] < '5' THEN 1 ELSE 0 END AS e
           FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, coalesce(sum(e) OVER (PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM border),
chunk AS (SELECT doc_id, c, min(i) AS s, count(*) AS n, string_agg(body, chr(10) ORDER BY i) AS body
          FROM placed GROUP BY doc_id, c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS k FROM chunk WHERE n > 1),
gone AS (SELECT doc_id, c FROM ranked WHERE k > 1),
kept AS (SELECT p.doc_id, string_agg(p.body, chr(10) ORDER BY p.i) FILTER (WHERE g.c IS NULL) AS t,
                count(g.c) AS lines_cut
         FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.c = g.c GROUP BY p.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.t, '') END AS text,
       CAST(coalesce(k.lines_cut, 0) AS INTEGER) AS lines_cut
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""}
