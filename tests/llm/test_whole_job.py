"""Cases that the operators did less than wholly."""

import random

import pytest

import corpus_pipeline
from setlist.llm import line_dedup, simhash, wrappers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], SCHEMA)


def brute_passages(rows):
    """Lines held by a pair of neighbouring non-blank lines that occurred before."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = (t or "").split("\n")
        full = [j for j, x in enumerate(lines) if x.strip()]
        cut = set()
        for a, b in zip(full, full[1:]):
            body = "\n".join(lines[a:b + 1])
            if body in seen:
                cut.update(range(a, b + 1))
            seen.add(body)
        out[i] = None if t is None else "\n".join(x for j, x in enumerate(lines) if j not in cut)
    return out


def test_pipeline_cuts_whole_passages(spark, monkeypatch):
    rng = random.Random(8)
    planted = [[f"passage {p} line {j} " + "w" * rng.randrange(9) for j in range(n)] for p, n in enumerate([2, 3, 4, 4, 7])]
    rows = [(900, None), (901, ""), (902, "lone"), (903, "x\n\n\ny"), (904, "x\n\ny"), (905, "same\nsame\nsame")]
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randrange(1, 6))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + planted[i % 5] + ([""] if i % 2 else []) + own[at:])))
    want = brute_passages(rows)
    for bound in (None, 0):  # broadcast and shuffled joins
        if bound is not None:
            monkeypatch.setattr("setlist.llm.common.BROADCAST_BYTES", -1)
        got = {r["doc_id"]: r for r in corpus_pipeline.line_dedup(spark, frame(spark, rows), "").collect()}
        assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values() if r["text"] is not None)
    left = [x for r in got.values() for x in (r["text"] or "").split("\n") if x.startswith("passage")]
    assert sorted(left) == sorted(x for p in planted for x in p)


def test_one_of_each_keeps_a_document_of_every_group(spark):
    rng = random.Random(6)
    far = [" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(60)) for c in "abcdef"]
    near = " ".join(f"n{i}" for i in range(3000))
    assert simhash.fingerprint(near, 3) != 0
    rows = [(1, far[0]), (None, far[0]), (None, far[1]), (None, far[2]),  # a null id beside an id, and alone
            (5, far[3]), (7, far[3]), (7, far[4]), (8, far[4]),  # id 7 with two texts
            (None, near), (None, near + "  "), (None, near + "\n"),  # null ids only
            (None, far[5]), (None, far[5])]
    for bound in (1 << 20, -1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr("setlist.llm.common.BROADCAST_BYTES", bound)
            got = simhash.one_of_each(frame(spark, rows)).collect()
        assert sorted((r["doc_id"] or 0, r["text"].strip()) for r in got) == sorted(
            [(1, far[0]), (0, far[1]), (0, far[2]), (5, far[3]), (7, far[4]), (0, near), (0, far[5])])


def texts(spark, pages):
    """The main text of each of ``pages`` (url, html), in order."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(wrappers.extract(df).collect(), key=lambda r: r["page_id"])]


def test_html_main_region_is_the_pages_own(spark):
    inner = ["<article><p>Art {}</p></article>", "<main><p>Main {}</p></main>", "<div class=content><p>Div {}</p></div>", "<p>Body {}</p>"]
    pages = [(url, "<body><nav>Menu</nav>" + inner[n % 4].format(n) + "</body>")
             for url in ("http://mixed.example.org/", None) for n in range(40)]
    want = [f"{('Art', 'Main', 'Div', 'Body')[n % 4]} {n}" for n in range(40)]
    assert texts(spark, pages) == want * 2


def test_html_texts_that_meet_no_wrapper_element_stay(spark):
    rng = random.Random(2)
    pages, want = [], []
    for n in range(150):
        body, lines = "", [f"Title {n}"]
        for j in range(rng.randrange(1, 6)):
            for tag in rng.choice([["p"], ["h2", "p"], ["p", "h2", "p"], ["p", "p", "h2", "p"]]):
                lines.append(f"{tag} {n} {j} {len(lines)}")
                body += f"<{tag}>{lines[-1]}</{tag}>"
        pages.append(("http://large.example.org/", f"<body><nav>Menu</nav><article><h1>{lines[0]}</h1>{body}</article><footer>End</footer></body>"))
        want.append("\n".join(lines))
    assert texts(spark, pages) == want


def test_html_copies_make_no_text_template(spark):
    def page(n, extra="", ad=""):
        return f"<body><div class=ad>Buy {ad}</div><article><h1>Head {n}</h1><p>Text {n}</p>{extra}</article></body>"

    quote = "<blockquote>Quoted once</blockquote>"
    pages = [page(1, quote)] * 9 + [page(1, quote, ad) for ad in range(9)] + [page(n) for n in range(2, 9)]
    steady = [page(n, "<pre>Follow us</pre>") for n in range(30, 40)]
    got = texts(spark, [("http://copies.example.org/", p) for p in pages] + [("http://steady.example.org/", p) for p in steady])
    assert got == ["Head 1\nText 1\nQuoted once"] * 18 + [f"Head {n}\nText {n}" for n in (*range(2, 9), *range(30, 40))]


@pytest.mark.parametrize("before, after", [
    ("<head><title>t</title><meta charset=utf-8>", ""),  # no </head>
    ("<head><script>for(i=0;i<n;i++)s='it';t=\"don't\";</script></head>", ""),
    ("<head><script>if(i<n)s=\"don't\";</script></head>", ""),
    ("<head><noscript><link rel=x href=y></noscript><style>p{}</style>", ""),
    ("<head><noscript><img src=x></head>", "<noscript>No script</noscript>"),
    ("<head><title>t</title></head>", "<div><noscript><i>unclosed</div>"),
    ("<head></head>", "<div><iframe src=x></div><iframe src=y></iframe>"),
    ("<head></head>", "<svg><path d=z>"),
    ("<head></head>", "<div><select><option>a<option>b</div><select></select>"),
    ("<head></head>", "<div><canvas></div><canvas></canvas>"),
    ("<head></head>", "<ul><li><noscript><ul><li>No script</li></ul></noscript></li></ul><svg><svg></svg><text>No</text></svg>"),
    ("<head></head>", "<template><script>'</template>'</script><p>No</p></template>"),
])
def test_html_silent_elements_end(before, after):
    page = f"<html>{before}<body>{after}<p>It's the first.</p><p>The second, don't miss it.</p></body></html>"
    found = wrappers.stream(page)[1]
    assert found[-2:] == ["It's the first.", "The second, don't miss it."]
    assert not {"No", "No script", "t", "a", "b"} & set(found)


@pytest.mark.parametrize("opening, closing", [
    ("<form id=aspnetForm>", "</form>"), ("<div class='layout has-sidebar'>", "</div>"), ("<div class=no-sidebar>", "</div>"),
    ("<div class='page-with-banner'>", "</div>"), ("<div class='sidebar'><form>", "</form></div>"),
])
@pytest.mark.parametrize("inner", ["<main>{}</main>", "<article>{}</article>", "<div><h1>Title</h1>{}</div>", "{}"])
def test_html_page_wide_wrappers_are_not_apart(opening, closing, inner):
    story = "<p>The story is told here at some length.</p><p>It ends.</p>"
    apart = ("<nav>Menu</nav><aside><p>Aside</p></aside><div class=newsletter><p>Mail us</p></div>"
             "<div id=comments><article><p>Nice</p></article></div>")
    out, found = wrappers.stream(f"<body>{opening}{apart}{inner.format(story)}{closing}</body>")
    main = wrappers._main(out)
    kept = [e[1] for e in out if e[0] == "x" and e[2] == main]
    assert [x for x in kept if x != "Title"] == ["The story is told here at some length.", "It ends."]


def test_html_small_forms_and_comments_stay_apart():
    for page in ("<p>Body text here</p><form><label>Mail</label><p>Subscribe now to a long list of news</p></form>",
                 "<article><p>Body text here</p></article><div id=comments><article><p>Longer than the article by far</p></article></div>",
                 "<p>Body text here</p><div class=related><article>Teaser</article></div>"):
        out, _ = wrappers.stream(page)
        assert [e[1] for e in out if e[0] == "x" and e[2] == wrappers._main(out)] == ["Body text here"]


def test_pipeline_cuts_the_chunks_of_op5(spark, monkeypatch):
    """A line that op5 cuts goes in the pipeline too, also where no other non-blank line stands in its chunk."""
    rng = random.Random(3)
    rows = [(None, "Title 1\n\nof a null id"), (200, "Title 1\n"), (201, "\n\n"), (202, "\n\n\n")]
    for i in range(40):
        body = "\n".join(f"own {i} {j}" for j in range(rng.randrange(1, 4)))
        rows.append((i, f"Title {i % 5}" + "\n" * rng.randrange(2, 4) + body + rng.choice(["", "\n\nNote\n"])))
    docs = frame(spark, rows)
    op5 = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(docs).collect()}
    lone = [x for i, t in rows for x in t.split("\n") if x.startswith(("Title", "Note"))]
    assert sum(x in lone for t in op5.values() for x in t) < len(lone)  # op5 cuts some
    for bound in (None, 0):  # broadcast and shuffled joins
        if bound is not None:
            monkeypatch.setattr("setlist.llm.common.BROADCAST_BYTES", -1)
        got = {r["doc_id"]: r["text"].split("\n") for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
        for i, t in rows:
            assert [x for x in got[i] if x] == [x for x in op5[i] if x]  # no passage repeats in these rows
    assert {x for t in got.values() for x in t if x} == {x for _, t in rows for x in t.split("\n") if x}
