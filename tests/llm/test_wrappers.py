"""Wrappers that decide by alignment alone, junk pages, long pages, many layouts."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from setlist.llm import common, wrappers


def texts(spark, pages):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(wrappers.extract(df).collect(), key=lambda r: r["page_id"])]


def bare_page(n, rng, menu):
    """A page of divisions without a class, an id, a role or a telling tag."""
    story = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(4, 12))) for _ in range(rng.randrange(1, 6))]
    html = ("<div>" + "".join(f"<div>{x}</div>" for x in menu) + "</div><div><div>" + f"<h1>Story {n}</h1>"
            + "".join(f"<p>{x}</p>" for x in story) + "</div></div><div><table><tr><td>Imprint<td>Contact<td>Jobs</table></div>")
    return html, "\n".join([f"Story {n}", *story])


def test_wrapper_alone_tells_menu_from_text(spark):
    rng = random.Random(2)
    made = {host: [bare_page(n, rng, [f"{host} start", f"{host} offers", f"{host} about us"]) for n in range(40)] for host in ("x", "y")}
    pages = [(f"http://{host}.example.org/{n}", html) for host in made for n, (html, _) in enumerate(made[host])]
    want = [text for host in made for _, text in made[host]]
    assert texts(spark, pages) == want
    # One page alone has nothing to be held against.
    alone = made["x"][0]
    assert texts(spark, [("http://z.example.org/", alone[0])])[0].endswith("Jobs")


def test_a_run_that_changes_stays(spark):
    """A page's own run in the place of the template's is content."""
    menu = ["start", "offers", "about us"]
    rng = random.Random(3)
    made = [bare_page(n, rng, menu) for n in range(30)]
    other, text = bare_page(99, rng, ["first item", "second item", "third item"])
    got = texts(spark, [(f"http://x.example.org/{n}", html) for n, (html, _) in enumerate(made)] + [("http://x.example.org/o", other)])
    assert got[-1].startswith("\n".join(["first item", "second item", "third item", text]))
    assert all(t in g for (_, t), g in zip(made, got))


def plain_pairs(x, y):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        x, y = ([rng.choice("abcd"[:rng.randrange(1, 5)]) for _ in range(rng.randrange(50))] for _ in range(2))
        pairs = wrappers._pairs(*([["<", c, "b", False, 1, []] for c in z] for z in (x, y)))
        assert all(x[i] == y[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert len(pairs) == plain_pairs(x, y)


@pytest.mark.parametrize("piece", ["<a ", "<a", "<", "<!", "<!-- ", '<a "', '<a "<a " "', "<a '<b \"", "<b c='", "<title>", "</script ",
                                   "<script><!--", "<div><svg></div>", "<svg><g></x>", "</p>"])
def test_junk_takes_linear_time(piece):
    begin = time.process_time()
    wrappers.stream(piece * ((1 << 20) // len(piece)))
    assert time.process_time() - begin < 10


def test_tags_with_quotes_and_unclosed_ends():
    found = wrappers.stream("<p title='a > b' class=\"x<y\">one</p><p>1 < 2 <p>two<!-- <p>no</p> --><p>three <b")[1]
    assert found == ["one", "1 < 2", "two", "three <b"]
    assert wrappers.stream("<p>x</p><!-- open <p>no</p>")[1] == ["x"]
    assert wrappers.stream("<p>x</p><![CDATA[a < b]]><p>y")[1] == ["x", "a < b", "y"]


def test_twenty_thousand_blocks_align_in_bounded_memory():
    rng = random.Random(5)
    made = [[e for k in range(20_000) for t in [rng.choice(["p", "h2", "li", "pre"])]
             for e in (["<", t, "b", False, 1, []], ["x", str(k), "b", False, 1, []], [">", t, "", False, 1, []])] for _ in range(2)]
    pairs = wrappers._pairs(*made)
    assert len(pairs) > 30_000


def test_host_of_many_layouts_keeps_a_bounded_wrapper(spark, monkeypatch):
    rng = random.Random(6)
    pages = []
    for n in range(80):
        blocks = [(rng.choice(["p", "h2", "pre", "li", "dd"]), f"text {n} {i}") for i in range(rng.randrange(5, 40))]
        pages.append(("http://h.example.org/", "".join(f"<{t}>{x}</{t}>" for t, x in blocks)))
    want = texts(spark, pages)
    monkeypatch.setattr(wrappers, "MOST", 20)
    df = spark.createDataFrame([("h", h) for _, h in pages], "host string, html string")
    assert all(len(json.loads(r["shape"])) <= 20 for r in wrappers.wrappers(df).collect())
    assert texts(spark, pages) == want == ["\n".join(wrappers.stream(h)[1]) for _, h in pages]


def test_wrappers_above_the_broadcast_bound(spark, monkeypatch):
    rng = random.Random(7)
    pages = [(f"http://{'hot' if n % 3 else 'h%d' % (n % 7)}.example.org/{n}", bare_page(n, rng, ["a", "b", "c"])[0]) for n in range(60)]
    want = texts(spark, pages + pages[:5])
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(wrappers, "COPY_ROWS", 8)
    assert texts(spark, pages + pages[:5]) == want
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string").withColumn("copies", F.lit(1))
    assert wrappers.extract(df).count() == 60


def test_every_layout_of_a_host_keeps_its_template(spark, monkeypatch):
    """Two layouts that one wrapper of ``MOST`` elements does not hold: each page meets its own."""
    rng = random.Random(8)
    made = [bare_page(n, rng, ["start", "offers", "about us"]) for n in range(30)]
    for n in range(9):
        story = [" ".join(f"w{rng.randrange(900)}" for _ in range(6)) for _ in range(3)]
        menu = "".join(f"<dd>{x}</dd>" for x in ("home", "shop", "help"))
        made.append((f"<section><dl>{menu}</dl></section><section><h2>Piece {n}</h2>" + "".join(f"<pre>{x}</pre>" for x in story)
                     + "</section><section><ul><li>Terms<li>Press</ul></section>", "\n".join([f"Piece {n}", *story])))
    pages = [(f"http://x.example.org/{n}", html) for n, (html, _) in enumerate(made)]
    want = [text for _, text in made]
    assert texts(spark, pages) == want
    monkeypatch.setattr(wrappers, "MOST", 24)
    df = spark.createDataFrame([("x", h) for _, h in pages], "host string, html string")
    rows = wrappers.wrappers(df).collect()
    assert len({r["part"] for r in rows}) > 1 and all(len(json.loads(r["shape"])) <= 24 for r in rows)
    assert texts(spark, pages + pages[:2]) == want + want[:2]
