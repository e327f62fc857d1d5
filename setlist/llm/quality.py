"""Quality rules as a short-circuit cascade (native).

Each rule is one boolean expression over the text.  ``plan_cascade`` measures,
on a bounded sample, what each rule costs and what share of rows it rejects,
and orders the rules by rejection per cost; ``cascade`` chains them in that
order in one ``CASE``, so a row that an early rule rejects never pays for the
later ones.  The verdict is the conjunction of all rules and so does not
depend on the order: the sample only decides speed.

Defined cases: null or empty text has no words and fails ``min_words``; rows
that repeat are judged one by one; other columns are passed through; an empty
table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist.llm.common import SPACES, let, lines, materialize, table, words

#: Words in a window whose repetition counts.
GRAM = 5
#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Facts:
    """What rules look at: the text, its words and figures made of them.
    Any of them may be an expression or a column made before."""

    text: Column
    words: Column
    figures: dict[str, Column] = field(default_factory=dict)

    def __getattr__(self, name: str) -> Column:
        return self.figures[name] if name in self.figures else FIGURES[name](self)


def _matches(text: Column, char_class: str) -> Column:
    """How many characters of the class the text holds."""
    return F.size(F.split(F.coalesce(text, F.lit("")), f"[{char_class}]", -1)) - 1


def n_dup_lines(text: Column) -> Column:
    """Lines holding a word that equal an earlier line of the text."""
    full = F.filter(lines(text), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(full, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _covered(grams: Column) -> Column:
    """Positions covered by windows whose hash occurs at least twice."""
    def spans(s):
        twice = F.transform(s, lambda x, j: F.when(
            (x["g"] == F.get(s, j - 1)["g"]) | (x["g"] == F.get(s, j + 1)["g"]), x["i"]))
        at = F.sort_array(F.filter(twice, lambda i: i.isNotNull()))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda i, j: F.least(
                F.lit(GRAM), F.coalesce(F.get(p, j + 1) - i, F.lit(GRAM)))),
            F.lit(0), lambda a, b: a + b))

    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return let(ordered, spans)


def n_repeat_words(of_words: Column) -> Column:
    """Words inside a 5-word window that the text holds twice or more.

    Windows are compared by the 64-bit hash of their words' 64-bit hashes.  A
    text whose windows all differ (the usual case) costs one hash set; only
    the others sort their windows."""
    def grams(h):
        return F.transform(F.slice(h, 1, F.size(h) - (GRAM - 1)), lambda x, i: F.xxhash64(
            x, *[F.get(h, i + k) for k in range(1, GRAM)]))

    def count(h):
        return F.when(F.size(h) <= GRAM, F.lit(0)).otherwise(let(grams(h), lambda g: F.when(
            F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(g))))

    return let(F.transform(of_words, lambda w: F.xxhash64(w)), count)


FIGURES: dict[str, Callable[[Facts], Column]] = {
    "n_words": lambda f: F.size(f.words),
    "word_chars": lambda f: F.length(F.array_join(f.words, "")),
    "n_symbols": lambda f: _matches(f.text, SYMBOLS),
    "n_dup_lines": lambda f: n_dup_lines(f.text),
    "n_repeat_words": lambda f: n_repeat_words(f.words),
}


@dataclass(frozen=True)
class Rule:
    """``passes(facts)``: true for a text that this rule accepts, never null."""

    name: str
    passes: Callable[[Facts], Column]


#: Texts with under 10 words, or over a fifth of their words in repeated windows.
BASE_RULES = (
    Rule("min_words", lambda f: f.n_words >= 10),
    Rule("repeat_words", lambda f: f.n_repeat_words * 100 <= f.n_words * 20),
)

#: Shouted, symbol-ridden, tabular, run-on and line-repeating texts.
VERDICT_RULES = (
    Rule("word_length", lambda f: let(f.word_chars, lambda n:
         (n >= f.n_words * 2) & (n <= f.n_words * 25))),
    Rule("symbols", lambda f: f.n_symbols * 100 <= f.n_words * 25),
    Rule("upper_case", lambda f: let(_matches(f.text, "A-Z"), lambda up:
         (up * 5 <= f.word_chars) | (up <= _matches(f.text, "a-z")))),
    Rule("wordless", lambda f: F.size(F.filter(f.words, lambda w: w.rlike(r"\p{L}"))) * 100
         >= f.n_words * 60),
    Rule("dup_lines", lambda f: f.n_dup_lines * 2 <= F.size(lines(f.text))),
)


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text",
                 sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` ordered by rejected rows per second, measured on about
    ``sample_rows`` rows drawn by a hash of the text (ties by name)."""
    total = docs.count()
    bound = max(1, int(min(1.0, sample_rows / max(total, 1)) * 1_000_000))
    drawn = docs.select(F.col(text).alias("t")).where(
        F.pmod(F.xxhash64("t", F.length("t")), F.lit(1_000_000)) < bound)
    sample = materialize(drawn.withColumn("w", words(F.col("t"))).coalesce(
        docs.sparkSession.sparkContext.defaultParallelism))
    facts = Facts(F.col("t"), F.col("w"))

    def measured(rule: Rule) -> float:
        began = time.perf_counter()
        out = sample.agg(F.count(F.when(~rule.passes(facts), True)).alias("bad")).first()
        return out["bad"] / max(time.perf_counter() - began, 1e-6)

    sample.agg(F.sum(F.size("w"))).first()  # start-up is charged to no rule
    return sorted(rules, key=lambda r: (-measured(r), r.name))


def cascade(rules: list[Rule], facts: Facts) -> Column:
    """True where every rule passes; evaluation stops at the first that fails."""
    chain = None
    for rule in rules:
        fails = ~rule.passes(facts)
        chain = F.when(fails, False) if chain is None else chain.when(fails, False)
    return F.lit(True) if chain is None else chain.otherwise(True)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + VERDICT_RULES,
              text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass every rule, columns unchanged."""
    order = plan_cascade(docs, rules, text, sample_rows)
    # The words are bound inside the predicate: a column would be copied into every rule by the filter.
    return docs.where(let(words(F.col(text)), lambda w: cascade(order, Facts(F.col(text), w))))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = VERDICT_RULES) -> DataFrame:
    """Per row: doc_id, the base figures, ``base_failed`` and ``kept``."""
    read = Facts(F.col("text"), F.col("words"))
    staged = docs.select("doc_id", "text", words(F.col("text")).alias("words")).select(
        "*", *[getattr(read, n).cast("long").alias(n) for n in FIGURES])
    facts = Facts(F.col("text"), F.col("words"), {n: F.col(n) for n in FIGURES})
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    verdict = cascade(plan_cascade(docs, rules), facts)
    return (staged.withColumn("base_failed", failed)
            .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict))
            .select("doc_id", *FIGURES, "base_failed", "kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES: dict[str, str] = {}
