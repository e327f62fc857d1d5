"""Merkle manifest, prefix trie and URL rules against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from setlist.llm import manifest, ranks, trie, url_rules


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ ranks

def test_positions_of_equal_and_hot_rows(spark):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.5 else rng.choice(["b", None, "c"]), rng.choice([None, 1, 2, 3, 4])) for _ in range(500)] + [("hot", 7)] * 400
    got = defaultdict(list)
    for r in ranks.positions(spark.createDataFrame(rows, "g string, o int"), ["g"], ["o"]).collect():
        got[r["g"]].append((r["start"], r["o"], r["copies"], r["size"]))
    for g, found in got.items():
        want = sorted((o for x, o in rows if x == g), key=lambda o: (o is not None, o or 0))
        assert [o for _, o, n, _ in sorted(found) for _ in range(n)] == want
        assert all(size == len(want) and want[start] == o for start, o, _, size in found)


# --------------------------------------------------------------- manifest

def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels



def leaf_of(row, columns):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))


def manifest_by_hand(rows):
    cols = manifest.COLUMNS
    trees = defaultdict(list)
    for r in rows:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        seen = dict(r, n_chars=r["n_chars"] + 1) if hit and r["n_chars"] is not None else r
        trees[r["lang"]].append((r["doc_id"], leaf_of(r, cols), leaf_of(seen, cols)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    forest = {}
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        forest[lang] = levels_of([leaf for _, leaf, _ in trees[lang]])
    top = levels_of([forest[lang][-1][0] for lang in order])
    out = Counter()
    for t, lang in enumerate(order):
        for i, (doc, leaf, seen) in enumerate(trees[lang]):
            node, beside = seen, ""
            for levels, at in ((forest[lang], i), (top, t)):
                for x in levels[:-1]:
                    other = x[at ^ 1] if (at ^ 1) < len(x) else ""
                    node = sha(node + other) if at % 2 == 0 else sha(other + node)
                    beside += other
                    at >>= 1
            root = top[-1][0]
            out[doc, leaf, forest[lang][-1][0], root, sha(beside), node, node == root] += 1
    return out


DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, path string"


def documents():
    rng = random.Random(8)
    out = [dict(doc_id=i, text=rng.choice([None, "", "x" * rng.randrange(50), "é日本 " * 3, "t" * 5000]), lang=rng.choice(["en"] * 6 + ["de", "Ärger", None, ""]),
                source=rng.choice([None, "s"]), n_chars=rng.choice([None, 5, 77])) for i in rng.sample(range(10**6), 150)]
    out += [dict(out[3], text="other"), dict(out[4]), dict(out[4], doc_id=None), dict(out[5], doc_id=None, text="u"), dict(out[6], lang="alone")]
    return out + [dict(doc_id=11, text="copy", lang="en", source=None, n_chars=2)] * 60


def frame(spark, rows):
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "mine", "mine") for r in rows], DOCS)


def found(spark, rows, bits):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = manifest.manifest(frame(spark, rows), {"n_chars": tampered}, bits=bits).withColumn("folded", manifest.fold(F.col("seen"), F.col("path")))
    beside = F.array_join(F.transform("path", lambda s: F.substr(s, F.lit(2))), "")
    return out.select("key", "leaf", "subroot", "root", F.sha2(beside, 256), "folded", F.col("folded") == F.col("root"))


@pytest.mark.parametrize("bits", [2, 3, 12])
def test_manifest_equals_brute_force(spark, bits):
    rows = documents()
    assert rows_of(found(spark, rows, bits)) == manifest_by_hand(rows)


def test_manifest_small_tables(spark):
    one = documents()[:1]
    assert rows_of(found(spark, one, 12)) == manifest_by_hand(one)
    assert found(spark, one, 12).first()["subroot"] == found(spark, one, 12).first()["root"]
    assert frame(spark, one).limit(0).transform(lambda d: manifest.manifest(d)).count() == 0


def test_log_places_are_those_of_one_builder():
    for size in [1, 2, 3, 5, 8, 13, 31, 32, 33, 100]:
        at, log = Counter(), []
        for level, _ in manifest.append([str(i) for i in range(size)], size, 0, 0, 40):
            log.append((level, at[level]))
            at[level] += 1
        assert [manifest.place(size, level, i) for level, i in log] == list(range(len(log)))
        assert len(log) == sum(len(x) for x in levels_of(["x"] * size))


def test_log_is_gapless(spark):
    leaves = spark.range(1000).select(F.lit("t").alias("tree"), F.col("id").alias("key"), F.lit(None).cast("string").alias("name"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("leaf"), F.lit(None).cast("string").alias("seen"))
    logs, _ = manifest.build(leaves, bits=3)
    assert len(logs) == 4
    places = sorted(r["position"] for log in logs for r in log.select("position").collect())
    assert places == list(range(sum(len(x) for x in levels_of(["x"] * 1000))))


# ------------------------------------------------------------------- trie

def trie_by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    for c in convs:
        convs[c] = [x[3:] for x in sorted(convs[c])]
    members, size, ids = defaultdict(list), {}, {(): 0}
    above, last, depth = {0: None}, {0: ""}, {0: 0}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        turns = convs.get(c - c % 100, [])[:h] + own[h:]
        size[c], node = len(turns), 0
        members[0].append(c)
        for turn in turns:
            up, node = node, ids.setdefault((node, turn), len(ids))
            above[node], last[node], depth[node] = up, turn[1], depth[up] + 1
            members[node].append(c)
    kids = Counter(above.values())
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        at = p
        while at is not None:
            leaves[at] += p not in kids
            saved[at] += (len(m) - 1) * len(last[p])
            at = above[at]
    return Counter((min(m), depth[p], min(members[above[p]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    sha(",".join(map(str, sorted(c for c in m if size[c] == depth[p]))))) for p, m in members.items())


def conversations():
    rng = random.Random(4)
    said = ["hi", "hello", "", None, "日本語 text", "bye " * 5]
    out = []
    for c in [*range(0, 60), *range(100, 130), 205, 207]:
        out += [(c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(said)) for t in range(rng.choice([1, 2, 4, 7]))]
    out += [(c, t, "user", "same") for c in range(300, 380) for t in range(6)]
    out += [(400, t, "user", f"long {t % 7}") for t in range(2500)] + [(417, t, "user", "a") for t in range(40)]
    out += [(5, 1, "user", "tie"), (5, 1, "user", "other"), (5, 1, "user", "tie"), (None, 0, "user", "lost")]
    return out


@pytest.mark.parametrize("small", [1, 50, 4096])
def test_trie_equals_brute_force(spark, small):
    rows = conversations()
    if small == 1:  # a round of joins for every halving
        rows = [r for r in rows if r[0] is None or r[0] < 320]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int")
    got = trie.trie(df, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6, 5, small=small)
    assert rows_of(got) == trie_by_hand(rows)


def test_trie_of_nothing_and_plain(spark):
    df = spark.createDataFrame([(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "c")], "conv_id long, turn long, role string, text string")
    assert trie.trie(df.limit(0)).count() == 0
    got = {(r["conv_id"], r["depth"]): (r["n_convs"], r["n_leaves"], r["saved_tokens"]) for r in trie.trie(df).collect()}
    assert got == {(1, 0): (3, 2, 1), (1, 1): (2, 1, 1), (1, 2): (1, 1, 0), (3, 1): (1, 1, 0)}


def test_components_halve():
    rows = [("c", i, str(i), str(i - 1), 1000 - i, 1, i, 0, 0) for i in range(1000)]  # one chain
    got = {r[0]: r[1:] for r in trie.decompose(rows)}
    assert all(got[str(i)] == (1000 - i - 1 * (1), sum(range(i + 1, 1000))) for i in range(1000))


# -------------------------------------------------------------------- urls

def judge_by_hand(url, rules):
    at = (url or "").find("://")
    rest = (url or "")[at + 3:] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    path = rest[cut:max(cut, end)]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in ((h.lower(), p or "", v) for h, p, v in rules if h)
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, 0, None, "allow")
    return host, path, best[3], best[4]


URLS = [None, "", "no scheme/en/", "http://", "http://NET", "http://net/", "http://example.net/en/x", "http://a.EXAMPLE.net/en/", "https://example.net/en",
        "ftp://xnet/en/", "http://b.example.com/de/?q=/x", "http://org?/fr/", "http://a.org/fr/#", "http://a.org/fr", "://net/x", "a://b://net/",
        "http://net.example.net./en/", "http://.net/", "http://éxample.net/ÉN/en/", "http://a.b.c.d.e.net/" + "p/" * 4000, "http://net/en://x", "http://net:80/"]
MANY = [*url_rules.RULES, ("a.org", None, "block"), ("org", "/", "allow"), ("org", "/fr/x", "block"), ("b.org", "/f", "allow"), ("org", "/fr/x", "allow"),
        (None, "/", "block"), ("", "/", "block"), ("net", "/en", "allow"), ("net", "/e", "block"), ("Example.NET", "/en/x", "block"), ("net", "/z", "block")]


@pytest.mark.parametrize("rules", [url_rules.RULES, MANY, []])
def test_urls_equal_brute_force(spark, rules):
    rng = random.Random(6)
    hosts, paths = ["net", "org", "a.org", "b.org", "c.b.org", "example.net", "x.example.net", "com"], ["", "/", "/en", "/en/x", "/fr/x", "/fr/", "/f", "/e", "/ez", "/zz"]
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + ["http://hot.example.net/en/x/1"] * 200
    df = spark.createDataFrame([(i, u, "mine", "kept", {"k": i}) for i, u in enumerate(urls)] + [(0, URLS[0], "mine", "kept", {"k": 0})],
                               "page_id long, url string, Host string, salt string, extra map<string,int>")
    table = spark.createDataFrame([(*r, "x") for r in rules], "host string, path string, verdict string, open string")
    got = url_rules.judge(df, table, salts=7)
    assert got.columns == ["page_id", "url", "salt", "extra", "host", "path", "rule", "verdict"]
    rows = got.drop("extra").collect()
    assert Counter(tuple(r) for r in rows) == Counter((i, u, "kept", *judge_by_hand(u, rules)) for i, u in [*enumerate(urls), (0, URLS[0])])
    assert url_rules.judge(df.limit(0), table).count() == 0


def test_url_query_reads_two_columns(spark):
    plan = url_rules.op13_url_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "Python" not in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
