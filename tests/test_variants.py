"""F9 without a schema: leaves of arbitrary JSON against a plain recursive walk."""

import json
import random
from collections import Counter

from setlist.functions import variants


def walk(value, path=()):
    inside = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    found = [leaf for k, v in inside for leaf in walk(v, (*path, str(k)))]
    if found:
        return found
    return [(":".join(path), None if value is None else json.dumps(value) if not isinstance(value, str) else value)]


def made(rng, depth=0):
    kind = rng.randrange(8 if depth < 6 else 4)
    if kind < 4:
        return rng.choice([None, True, 7, -3, "", "OBJECT<a>", "[]", "{}", "é:\"\n", "x" * 3000])
    if kind < 6:
        return [made(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {k: made(rng, depth + 1) for k in rng.sample(["a", "b", "0", "7", "x y", "q\"", "c.d", "new\nline", "$"], rng.randrange(5))}


def test_leaves_of_any_shape(spark):
    rng = random.Random(12)
    records = [made(rng) for _ in range(200)] + [[[[[[[[[1]]]]]]]]]
    rows = [(i % 150, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(records)] + [(900, None), (901, "{broken"), (902, "")]
    df = spark.createDataFrame(rows, "key long, record string").withColumn("record", variants.parse("record"))
    got = variants.leaves(df.withColumnRenamed("key", "rec id"), ["rec id"], "record")
    assert got.columns == ["rec id", "key", "value"]
    want = Counter((i % 150, *leaf) for i, r in enumerate(records) for leaf in walk(r))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert variants.leaves(df.limit(0), ["key"], "record").count() == 0
    counts = {r["key"]: r["n_values"] + r["n_null"] for r in variants.paths(got).collect()}
    assert counts == Counter(k for (_, k, _), n in want.items() for _ in range(n))


def test_columns_take_members_and_elements(spark):
    rows = [(1, '{"a":{"b":[1,{"c":"x"}]},"0":"zero"}'), (2, '{"a":5}'), (3, "7"), (4, None), (5, '[{"0":1},null]')]
    df = spark.createDataFrame(rows, "id long, j string").withColumn("j", variants.parse("j"))
    got = variants.columns(df, "j", ["a:b:0", "a:b:1:c", "a", "0", "0:0", "1"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, "1", "x", '{"b":[1,{"c":"x"}]}', "zero", None, None), (2, None, None, "5", None, None, None),
        (3, *[None] * 6), (4, *[None] * 6), (5, None, None, None, '{"0":1}', "1", None)]
