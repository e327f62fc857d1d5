"""Quality rules, line dedup, SimHash and suffix dedup against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from setlist.llm import line_dedup, quality, simhash, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, k long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None):
    rows = [(i, t, "en", "src1", len(t or ""), "extra", 5) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    bank = ["w%02d" % i for i in range(60)]
    para = lambda n: " ".join(rng.choice(bank) for _ in range(n))
    shared = [para(rng.randrange(55, 90)) for _ in range(4)]
    out = [None, "", "  \t", "one", "a b c d e", para(20000), "x " * 400, "A! B! C! D! E! F! G! H! I! J! K! L!", "äöü ÄÖÜ\x0bß\x0cç " * 6]
    for i in range(60):
        lines = [para(rng.randrange(1, 14)) for _ in range(rng.randrange(1, 9))]
        if i % 5 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared[i % 4])
        if i % 7 == 0:
            lines += ["same line one here", "same line two here", "same line three here"]
        if i % 9 == 0:
            lines += [lines[0], lines[0]]
        out.append("\n".join(lines))
    return out + out[10:14] + [out[20] + " tail", out[5]]


def base(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered))


def test_quality_figures(spark, texts):
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base(t)
        r = got[i]
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_order_changes_nothing(spark, texts):
    docs = frame(spark, texts)
    rules = quality.BASE_RULES + quality.VERDICT_RULES
    kept = quality.keep_good(docs, rules)
    assert kept.columns == docs.columns
    facts = quality.Facts(F.col("text"), F.col("w"))
    whole = docs.withColumn("w", quality.words(F.col("text")))
    for order in (rules, rules[::-1]):
        same = whole.where(quality.cascade(list(order), facts))
        assert {r["doc_id"] for r in same.collect()} == {r["doc_id"] for r in kept.collect()}
    loud = "THIS IS ALL SHOUTED!! " * 3 + " ".join("WORD%s!!" % c for c in "ABCDEFGHIJKLMN")
    noisy = " ".join(f"word{i}###" for i in range(40))
    cells = " | ".join(f"cell{i}" for i in range(40))
    clean = " ".join(f"word{i}" for i in range(40))
    verdicts = quality.keep_good(frame(spark, [loud, noisy, cells, clean, None]))
    assert [r["doc_id"] for r in verdicts.collect()] == [3]
    assert quality.keep_good(docs.limit(0)).count() == 0


def brute_line_dedup(rows):
    import hashlib

    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    chunks = {}
    for i, t in rows:
        if t is None:
            continue
        lines, start = t.split("\n"), 0
        d = [md5(x) for x in lines]
        for j in range(len(lines)):
            if j + 1 == len(lines) or md5((d[j - 1] if j else "") + d[j])[0] < "5":
                if j + 1 - start > 1:
                    chunks.setdefault("\n".join(lines[start:j + 1]), []).append((i, start, j + 1))
                start = j + 1
    gone = {x for spots in chunks.values() for x in sorted(spots)[1:]}
    out = {}
    for i, t in rows:
        cut = {j for a, b, e in gone if a == i for j in range(b, e)}
        out[i] = t if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in cut)
    return out


def test_line_dedup_leaves_columns_of_any_name(spark):
    names = ["t", "tx", "k", "cuts", "h", "Tx_"]
    rows = [(i, "line one\nline two\nline three\nline four", *(f"{n}{i}" for n in names)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for dedup in (line_dedup.dedup_lines, line_dedup.dedup_passages):
        out = dedup(docs)
        assert out.columns == docs.columns
        assert sorted(tuple(r)[2:] for r in out.collect()) == sorted(r[2:] for r in rows)


def test_line_dedup(spark, texts, monkeypatch):
    docs = frame(spark, texts)
    want = brute_line_dedup(list(enumerate(texts)))
    assert any(want[i] != t for i, t in enumerate(texts))
    for bound in (None, 0):  # broadcast and shuffled joins
        if bound is not None:
            monkeypatch.setattr("setlist.llm.common.BROADCAST_BYTES", -1)
        out = line_dedup.dedup_lines(docs)
        assert out.columns == docs.columns
        assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    twice = line_dedup.dedup_lines(docs.where("doc_id = 30").unionByName(docs.where("doc_id = 30")))
    assert len({r["text"] for r in twice.collect()}) == 1 and twice.count() == 2


def brute_components(prints, bits):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_fingerprint_matches_spark_hash(spark):
    text = "The quick Ärger fox"
    shingles = ["the quick Ärger", "quick Ärger fox"]
    hashes = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([(x,) for x in shingles], "x string").select(F.xxhash64("x")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 2)
    assert simhash.fingerprint(text, 3) == want
    assert simhash.fingerprint(None, 3) == 0 == simhash.fingerprint(" \t", 3)


def test_simhash_components(spark, texts):
    got = simhash.near_duplicates(frame(spark, texts), 3, 2).collect()
    prints = {i: simhash.fingerprint(t, 3) for i, t in enumerate(texts)}
    assert {r["k"]: r["fp"] & (1 << 64) - 1 for r in got} == prints
    assert {r["k"]: r["component"] for r in got} == brute_components(prints, 2)


@pytest.mark.parametrize("bits", [2, 4])
def test_crowded_files(spark, bits, monkeypatch):
    monkeypatch.setattr(simhash, "FILE_ROWS", 4)
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(30):
            x = s
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(20)
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(prints)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, bits)).collect()}
    of = {x & (1 << 64) - 1: x for x in signed}
    want = brute_components({x: x for x in of}, bits)
    groups, found = {}, {}
    for x, y in want.items():
        groups.setdefault(y, set()).add(of[x])
    for x in signed:
        found.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_one_of_each(spark, texts):
    docs = frame(spark, texts)
    both = docs.unionByName(docs.where("doc_id = 30"))
    out = simhash.one_of_each(both)
    want = {r["component"] for r in simhash.near_duplicates(docs).collect()}
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_suffix_dedup(spark, texts):
    got = {}
    for r in suffix_dedup.passages(frame(spark, texts)).collect():
        assert r["end_word"] - r["start_word"] >= 50
        got.setdefault(r["k"], set()).update(range(r["start_word"], r["end_word"]))
    split = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i:i + 50]) for w in split for i in range(len(w) - 49))
    total = missed = 0
    for k, w in enumerate(split):
        want = {j for i in range(len(w) - 49) if seen[tuple(w[i:i + 50])] > 1 for j in range(i, i + 50)}
        assert got.get(k, set()) <= want
        assert bool(want) == bool(got.get(k))
        total, missed = total + len(want), missed + len(want - got.get(k, set()))
    assert total and not missed
    assert suffix_dedup.passages(frame(spark, texts).limit(0)).count() == 0


def test_suffix_borders(spark, monkeypatch):
    """Sorted neighbours that partitions part still meet."""
    monkeypatch.setattr(suffix_dedup, "spread", lambda *a: 40)
    passage = " ".join(f"p{i}" for i in range(90))
    docs = [" ".join(f"d{n}x{i}" for i in range(70)) + " " + passage + f" end{n}" for n in range(40)]
    got = {r["k"]: (r["start_word"], r["end_word"]) for r in suffix_dedup.passages(frame(spark, docs + ["lone text " * 3])).collect()}
    assert got == {n: (70, 160) for n in range(40)}


@pytest.mark.parametrize("tasks", [1, 12])
def test_suffix_dedup_of_short_passages(spark, monkeypatch, tasks):
    """Parts of 50 to 70 words of a few passages, cut and joined at any place: no word is missed."""
    monkeypatch.setattr(suffix_dedup, "spread", lambda *a: tasks)
    rng = random.Random(tasks)
    sources = [[f"s{n}w{rng.randrange(40)}x{i}" for i in range(130)] for n in range(3)] + [["a", "b", "c"] * 30]
    texts = []
    for n in range(160):
        out = []
        for m in range(rng.randrange(1, 4)):
            s = rng.choice(sources)
            size = rng.randrange(45, 70)
            at = rng.randrange(len(s) - size)
            part = s[at:at + size]
            if rng.random() < 0.3:
                part[rng.randrange(size)] = f"odd{n}"
            out += part + [f"n{n}m{m}"] * rng.randrange(2)
        texts.append(" ".join(out))
    texts += texts[:20] + ["", None, "short"]
    got = {}
    for r in suffix_dedup.passages(frame(spark, texts)).collect():
        got.setdefault(r["k"], set()).update(range(r["start_word"], r["end_word"]))
    split = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i:i + 50]) for w in split for i in range(len(w) - 49))
    want = {k: {j for i in range(len(w) - 49) if seen[tuple(w[i:i + 50])] > 1 for j in range(i, i + 50)} for k, w in enumerate(split)}
    assert got == {k: w for k, w in want.items() if w}
