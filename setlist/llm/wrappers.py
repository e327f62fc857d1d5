"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of block tags and texts (inline tags are part of the
text around them).  Tandem repeats in the stream fold into repeated groups.
Streams of one host are aligned pairwise: equal tags match, texts that differ
become slots, a group meets the runs of its unit in the other stream, and what
only one side has becomes optional.  The result aligns with the next stream,
so a host ends with one union-free expression, its wrapper.

Pages of a host are dealt into batches of ``BATCH``, each batch is aligned by
one task, then the batches' wrappers, and so on, so a host with a third of all
pages is a tree of small groups.  Identical streams meet once: the shape
(stream with its texts as hashes) is made distinct before the first batch.

Alignment is by longest common subsequences, rows of the table as bit sets,
in memory linear in the streams' lengths; tags are read in one pass whatever
stands between them.  Where a wrapper would grow beyond ``MOST`` elements the host
gets several, its parts: the larger side of that alignment is done, the other goes
on.  Each page then meets the part that its own stream went into, so every element of
it is there; nothing is left out.  Parts are given in rows of at most ``MOST`` elements.

A wrapper's texts are template or content: template are those in navigation,
headers, footers, asides, forms, notices, adverts or comments (by tag, role,
class or id), those outside the article if the page has one, and texts that
stay the same beside ``STEADY`` different main texts or more while others of
the region vary, so copies of a page make nothing template; a repeated group is
one such text if its whole run stays.  A page's text goes only if it equals the
template's.  A form or a block
apart by class or id that holds the page itself (a main, or most of the text of
a page without a main region) is not apart.
Each page is aligned with its host's wrapper once more and gives the texts
of its own main region (the article's, else the likely main one's, else the
body's) but those that met template.

Defined cases: null and empty html and pages without text give an empty text;
a null url is a host of its own; rows that repeat are each returned; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.llm import common
from setlist.llm.common import materialize, small_side, table

ship_by_value(__name__)

#: Streams or wrappers aligned in one group; longest unit of a repeat; different pages that make a text steady.
BATCH = 32
UNIT = 12
STEADY = 4
#: Elements that a wrapper grows to and that a row of one holds; a host of many layouts has several.
MOST = 1 << 14
#: Pages of a host that one copy of its wrapper meets where wrappers are too large for a broadcast.
COPY_ROWS = 1 << 14

# Names from the HTML standard and usual class names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg math title textarea select canvas".split())
RAW = frozenset("script style textarea title".split())
APART = frozenset("nav footer aside form menu button dialog fieldset".split())
HINTS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                  "disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
                  "overlay pager pagination popup promo related share sharing sidebar signup social sponsor sponsored subscribe "
                  "teaser toolbar topbar widget".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
MAIN_HINTS = frozenset("article content entry main post story".split())
#: What follows tells what a block holds, not what it is: has-sidebar, page-with-banner.
HOLDING = frozenset("has no not with without".split())
#: Tags that tell that a block around them holds the page, may hold it, or holds running text.
TELLS = {"main": "main", "h1": "page", "nav": "page", "article": "part", "header": "part", "footer": "part", "aside": "part",
         "p": "text", "h2": "text", "h3": "text"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: Silent elements that hold no blocks: one ends them.
LEAVES = frozenset("svg math select".split())
#: Blocks that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                   "section table ul li dt dd".split())

#: Comment, literal text, declaration, or a tag up to its first quote: a tag holds no "<" outside quotes.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*+)([^\"'<>]*+)", re.S)
_QUOTED = re.compile(r"(?:\"[^\"]*+\"|'[^']*+')[^\"'<>]*+")
#: What still counts after the last ">" of a page.
_LAST = re.compile(r"<!--.*|<!\[CDATA\[.*", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CUT = re.compile(r"[^a-z0-9]+")

_PRIME = (1 << 61) - 1
_BASE = 0x1D8E4E27C47D124F % _PRIME

# A stream is a list of [kind, value, region, optional, pages, children]: kind "<" tag, ">" end, "x" text, "+" group.
# A group also has what its whole run says.
KIND, VALUE, REGION, MAYBE, PAGES, UNITS, SAID = range(7)


def _hints(names: str) -> set[str]:
    """Parts of class and id names; of has-sidebar or page-with-banner, which tell what a block holds, those before."""
    found: set[str] = set()
    for name in names.lower().split():
        for part in _CUT.split(name):
            if part in HOLDING:
                break
            found.add(part)
    return found


class _Tags:
    """The marks of a page in time linear in its length, whatever it holds."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")
        self.dead: set[int] = set()  # quotes after which no tag ends

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes of the next mark from ``at`` on."""
        page = self.page
        while at <= self.last and (m := _TAG.search(page, at, self.last + 1)):
            end = m.end()
            if m[2] is None:
                return m.start(), end if m[0].endswith(">") else len(page), "", "", ""
            if page[end:end + 1] != ">":
                met = []
                while page[end:end + 1] in ('"', "'") and end not in self.dead and (q := _QUOTED.match(page, end)):
                    met.append(end)
                    end = q.end()
                if page[end:end + 1] != ">":
                    self.dead.update(met, (end,))
                    at = m.start() + 1
                    continue
            return m.start(), end + 1, m[1], m[2].lower(), page[m.start(3):end]
        if m := _LAST.search(page, at):
            return m.start(), m.end(), "", "", ""
        return None


def _region(tag: str, attrs: str, outer: str, whole: bool = False) -> str:
    """Where a tag's texts belong: "-" apart, "?" apart by form or hint (not if
    ``whole``, a wrapper of the page), "a" article, "m" likely main, "b" body."""
    own = {}
    if attrs:
        for n, a, b, c in _ATTR.findall(attrs):
            own[n.lower()] = a or b or c
    role = own.get("role", "").lower()
    hints = _hints(f"{own.get('class', '')} {own.get('id', '')}") if own else set()
    main = tag == "main" or role == "main"
    hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
    if hidden or (tag in APART and tag != "form") or (role in ROLES and role != "form"):
        return "-"
    if tag == "header" and outer != "a":
        return "-"
    if not whole and ("form" in (tag, role) or hints & HINTS and not main and tag not in ("html", "body")):
        return "?"
    if tag == "article" or outer == "a":
        return "a"
    if main or (tag in ("div", "section", "td") and hints & MAIN_HINTS) or outer == "m":
        return "m"
    return "b"


def stream(page: str | None) -> tuple[list, list[str]]:
    """A page's stream, and its texts in order."""
    whole: set[int] = set()
    while True:
        out, texts, more = _read(page or "", whole)
        if not more:
            return out, texts
        whole |= more


def _page_wide(blocks: dict[int, list], outside: dict[str, int]) -> set[int]:
    """Which blocks apart by form or hint (characters, what tells, the block around) hold the page itself."""
    main = outside["a"] + outside["m"]
    total = main + outside["b"] + sum(size for size, _, _ in blocks.values())
    nested = dict.fromkeys(blocks, 0)
    for at, (size, _, outer) in reversed(blocks.items()):
        if outer is not None:
            nested[outer] += size + nested[at]
    for at, (size, tells, outer) in blocks.items():  # outer ones first
        if size and ("main" in tells or not main and size * 2 > total - nested[at] and (
                "page" in tells or "part" in tells and outside["b"] * 4 <= size or "text" in tells and not outside["b"])):
            found = {at}
            while outer is not None:
                found.add(outer)
                outer = blocks[outer][2]
            return found
    return set()


def _read(page: str, whole: set[int]) -> tuple[list, list[str], set[int]]:
    """Stream and texts, the blocks at ``whole`` as parts of the page, and those found to be so as well."""
    out: list = []
    texts: list[str] = []
    stack: list[tuple[str, str, int | None]] = []  # tag, region, the block apart by form or hint whose own it is
    opened: Counter = Counter()  # tags in it
    blocks: dict[int, list] = {}
    outside = dict.fromkeys("ablm", 0)
    held: list[str] = []
    links = [0, 0]  # open links, characters in them

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            region, block = stack[-1][1:] if stack else ("b", None)
            if links[1] * 2 > len(text) and region == "b":
                region = "l"  # mostly links
            if region != "-":
                outside[region] += len(text)
            elif block is not None:
                blocks[block][0] += len(text)
            out.append(["x", text, region, False, 1, [len(texts)]])
            texts.append(text)
        links[1] = 0

    def close(upto: int) -> None:
        flush()
        while len(stack) > upto:
            tag = stack.pop()[0]
            opened[tag] -= 1
            out.append([">", tag, "", False, 1, []])

    at, silent = 0, ""
    inner: list[str] = []  # open elements inside the silent one
    within: Counter = Counter()
    tags = _Tags(page)
    ends_at: dict[str, int] = {}  # where the next end tag of a silent element was seen; the page's length: none

    def has_end(name: str, at: int) -> bool:
        if ends_at.get(name, -1) < at:
            stop = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            ends_at[name] = stop.start() if stop else len(page)
        return ends_at[name] < len(page)

    def raw_end(name: str, at: int) -> int:
        """Where the content of a raw element ends; an open title or textarea has none."""
        stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at, tags.last + 1) if has_end(name, at) else None
        return stop.end() if stop else at if name in ("title", "textarea") else len(page)

    while mark := tags.find(at):  # from where raw content ends, which may hold what looks like a tag
        start, end, slash, name, attrs = mark
        if not silent and start > at:
            held.append(page[at:start])
            if links[0]:
                links[1] += start - at
        at = end
        if not name:
            if page.startswith("<![CDATA[", start) and not silent:
                held.append(html.escape(page[start + 9:end].removesuffix("]]>")))
            continue
        ends = slash == "/"
        if silent:
            if ends:
                if within[name]:
                    while inner:
                        last = inner.pop()
                        within[last] -= 1
                        if last == name:
                            break
                    continue
                if name == silent:
                    silent = ""
                    continue
                if name != "head" and not opened[name]:
                    continue
                silent = ""  # the block around it closes
            elif name in RAW:
                at = at if attrs.endswith("/") else raw_end(name, at)
                continue
            elif name == "body" or silent in LEAVES and name in ENDS_P and not within["foreignobject"]:
                silent = ""
            else:
                if name not in VOID and not attrs.endswith("/"):
                    inner.append(name)
                    within[name] += 1
                continue
        if name == "head":  # what shows nothing in it is silent by itself, so its end, often left out, tells nothing
            held.append(" ")
            continue
        if name in SILENT:
            if not ends and not attrs.endswith("/"):
                if name in RAW:  # its content is no markup
                    at = raw_end(name, at)
                elif has_end(name, at):
                    silent = name
                    inner.clear()
                    within.clear()
            held.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links[0] = 0 if ends else 1
            elif name == "br":
                held.append(" ")
            continue
        if ends:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            else:
                flush()
            continue
        if stack and (stack[-1][0] in CLOSES.get(name, ()) or stack[-1][0] == "p" and name in ENDS_P):
            close(len(stack) - 1)
        flush()
        outer, block = stack[-1][1:] if stack else ("b", None)
        region = "-" if outer == "-" and block is None else _region(name, attrs, outer, start in whole)
        if region == "?":
            blocks[start] = [0, {"part"} if _region(name, attrs, outer, True) in "am" else set(), block]
            block, region = start, "-"
        elif block is not None:
            if name in TELLS or region in "am":
                blocks[block][1].add(TELLS.get(name, "part"))
            block, region = block if region != "-" else None, "-"
        if name not in VOID and not attrs.endswith("/"):
            stack.append((name, region, block))
            opened[name] += 1
            out.append(["<", name, region, False, 1, []])
    if not silent and at < len(page):
        held.append(page[at:])
    close(0)
    return out, texts, _page_wide(blocks, outside)


def _key(e: list) -> tuple:
    """What must agree for two elements to match."""
    if e[KIND] == "+":
        return ("+", *(_key(c) for c in e[UNITS]))
    return (e[KIND], e[VALUE] if e[KIND] != "x" else "", e[REGION])


def _join(a: list, b: list) -> list:
    """Two elements of one key as one; texts that differ leave a slot."""
    if a[KIND] == "+":
        units = [_join(x, y) for x, y in zip(a[UNITS], b[UNITS])]
    else:
        units = a[UNITS] + b[UNITS] if a[KIND] == "x" else []
    same = a[KIND] != "x" or a[VALUE] == b[VALUE]
    said = [a[SAID] if a[SAID] == b[SAID] else None] if a[KIND] == "+" else []
    return [a[KIND], a[VALUE] if same else None, a[REGION], a[MAYBE] or b[MAYBE], a[PAGES] + b[PAGES], units, *said]


def _said(items: list) -> list | None:
    """Number and digest of the texts of ``items``, those of a run that is cut anywhere; None if any is a slot."""
    n, digest = 0, 0
    for e in items:
        if e[KIND] == "+":
            if e[SAID] is None:
                return None
            n, digest = n + e[SAID][0], (digest * pow(_BASE, e[SAID][0], _PRIME) + e[SAID][1]) % _PRIME
        elif e[KIND] == "x":
            if e[VALUE] is None:
                return None
            n, digest = n + 1, (digest * _BASE + xxhash.xxh64_intdigest(e[VALUE])) % _PRIME
    return [n, digest]


def _joined(units: list[list]) -> list:
    """Units of one key as one, in pairs, so that a long run copies no list of it often."""
    while len(units) > 1:
        units = [[_join(x, y) for x, y in zip(units[i], units[i + 1])] if i + 1 < len(units) else units[i]
                 for i in range(0, len(units), 2)]
    return units[0]


def fold(items: list) -> list:
    """The stream with tandem repeats of up to ``UNIT`` elements as groups."""
    keys = [_key(e) for e in items]
    for size in range(1, UNIT + 1):
        out, of, i = [], [], 0
        while i < len(items):
            if i + size < len(keys) and keys[i] == keys[i + size] and keys[i:i + size] == keys[i + size:i + 2 * size] and _closed(items[i:i + size]):
                n = 2
                while keys[i:i + size] == keys[i + n * size:i + (n + 1) * size]:
                    n += 1
                run = items[i:i + n * size]
                unit = _joined([run[r:r + size] for r in range(0, n * size, size)])
                out.append(["+", None, unit[0][REGION], False, 1, _one(unit), _said(run)])
                of.append(("+", *keys[i:i + size]))
                i += n * size
            else:
                out.append(items[i])
                of.append(keys[i])
                i += 1
        items, keys = out, of
    return items


def _closed(unit: list) -> bool:
    """Whether the unit closes what it opens, and nothing else."""
    depth = 0
    for e in unit:
        depth += {"<": 1, ">": -1}.get(e[KIND], 0)
        if depth < 0:
            return False
    return depth == 0


def _one(unit: list) -> list:
    """Repeats inside one page count as one page."""
    return [[*e[:PAGES], 1, _one(e[UNITS]) if e[KIND] == "+" else e[UNITS], *e[SAID:]] for e in unit]


def _regroup(items: list, groups: dict) -> list:
    """Runs of a group's unit become that group, single ones as well; long units
    first, then by key, so equal streams give equal groups at any time."""
    keys = [_key(e) for e in items]
    for key in sorted(groups, key=lambda k: (-len(k), repr(k))):
        size, want = len(key) - 1, list(key[1:])
        out, of, i = [], [], 0
        while i < len(items):
            if keys[i] == want[0] and keys[i:i + size] == want:
                unit = items[i:i + size]
                out.append(["+", None, unit[0][REGION], False, unit[0][PAGES], unit, _said(unit)])
                of.append(key)
                i += size
            else:
                out.append(items[i])
                of.append(keys[i])
                i += 1
        items, keys, i = [], [], 0
        while i < len(out):
            n = 1
            while out[i][KIND] == "+" and i + n < len(out) and of[i + n] == of[i]:
                n += 1
            run = out[i:i + n]
            items.append(run[0] if n == 1 else [
                "+", None, run[0][REGION], any(e[MAYBE] for e in run), max(e[PAGES] for e in run), _joined([e[UNITS] for e in run]), _said(run)])
            keys.append(of[i])
            i += n
    return items


def _groups(items: list) -> dict:
    return {_key(e): e[UNITS] for e in items if e[KIND] == "+"}


def _rows(x: list, marks: dict, m: int, row: int) -> Iterator[int]:
    """Rows of the table of longest common subsequences of what ``x`` and the other stream end with, from ``row``, the
    one after the last of ``x``, back to the first: bit p is 0 where the length grows with the p-th element from the end."""
    full = (1 << m) - 1
    for key in reversed(x):
        hit = row & marks.get(key, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _pairs(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of two streams' keys.

    A row of the table is one integer of a bit per element.  Every ``step``-th
    row is kept and the rows between are made again on the way back, so a table of
    n x m takes about 2 * sqrt(n) rows of m bits."""
    x, y = [_key(e) for e in a], [_key(e) for e in b]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    out = [(i, i) for i in range(head)]
    end = [(len(x) - tail + i, len(y) - tail + i) for i in range(tail)]
    x, y = x[head:len(x) - tail], y[head:len(y) - tail]
    n, m = len(x), len(y)
    if not n or not m:
        return out + end
    at_end: dict[tuple, list[int]] = {}
    for p, key in enumerate(reversed(y)):
        at_end.setdefault(key, []).append(p)
    marks = {}
    for key in set(x) & at_end.keys():
        mark = bytearray(m // 8 + 1)
        for p in at_end[key]:
            mark[p >> 3] |= 1 << (p & 7)
        marks[key] = int.from_bytes(mark, "little")
    step = max(1, math.isqrt(n))
    kept = {n: (1 << m) - 1}
    for i, row in zip(range(n - 1, -1, -1), _rows(x, marks, m, kept[n])):
        if i % step == 0:
            kept[i] = row
    held: dict[int, tuple[int, bytes]] = {}

    def row_at(i: int) -> tuple[int, bytes]:
        if i not in held:
            held.clear()
            top = min(n, (i // step + 1) * step)
            for r, row in zip(range(top, i - 1, -1), [kept[top], *_rows(x[i:top], marks, m, kept[top])]):
                held[r] = row, row.to_bytes(m // 8 + 1, "little")
        return held[i]

    def length(i: int, j: int) -> int:
        return m - j - (row_at(i)[0] & ((1 << (m - j)) - 1)).bit_count()

    def grows(row: bytes, j: int) -> int:
        return 1 - (row[(m - j - 1) >> 3] >> ((m - j - 1) & 7) & 1)

    i = j = 0
    here, below = row_at(0)[1], row_at(1)[1]
    best, under = length(0, 0), length(1, 0)  # at (i, j) and at (i + 1, j)
    while i < n and j < m and best:
        met = x[i] == y[j]
        if met:
            out.append((head + i, head + j))
            under -= grows(below, j)
            j += 1
        elif under < best - grows(here, j):
            best, under, j = best - grows(here, j), under - grows(below, j), j + 1
            continue
        i += 1
        if i < n:
            here, below, best = below, row_at(i + 1)[1], under
            under = length(i + 1, j)
    return out + end


def align(a: list, b: list) -> list:
    """One stream that covers both."""
    both = _groups(a) | _groups(b)
    a, b = _regroup(a, both), _regroup(b, both)
    out, i, j = [], 0, 0
    for p, q in [*_pairs(a, b), (len(a), len(b))]:
        out += [[*e[:MAYBE], True, *e[PAGES:]] for e in [*a[i:p], *b[j:q]]]
        if p < len(a):
            out.append(_join(a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def _contents(wrapper: list) -> list:
    """The wrapper with its text as the value of each text and run that is template, None for content."""
    flat: list = []

    def visit(items: list, repeated: bool, heading: bool) -> None:
        for e in items:
            heading = e[VALUE] in ("h1", "h2", "h3", "h4", "h5", "h6") if e[KIND] == "<" else heading and e[KIND] == "x"
            if e[KIND] == "+":
                visit(e[UNITS], True, False)
            elif e[KIND] == "x":
                flat.append((e, repeated, heading))

    visit(wrapper, False, False)
    varies = {e[REGION] for e, repeated, _ in flat if e[VALUE] is None}
    # What changes from page to page, not from item to item of a run that stays.
    moving = {e[REGION] for e, repeated, _ in flat if e[VALUE] is None and not repeated}
    moving |= {r for e in wrapper if e[KIND] == "+" and e[SAID] is None for r in _regions(e[UNITS])}
    steady = {id(e) for e, repeated, heading in flat
              if e[REGION] in varies and e[VALUE] is not None and e[PAGES] >= STEADY and not repeated and not heading}
    # A whole run that stays; an article's own tag is trusted with its lists.
    steady |= {id(e) for e in wrapper if e[KIND] == "+" and e[SAID] is not None and e[PAGES] >= STEADY
               and _regions(e[UNITS]) <= moving - {"a"}}

    def marked(items: list) -> list:
        return [[e[KIND], e[VALUE] if e[KIND] != "x" or id(e) in steady else None, *e[REGION:UNITS],
                 *([marked(e[UNITS]), e[SAID] if id(e) in steady else None] if e[KIND] == "+" else [e[UNITS]])] for e in items]

    return marked(wrapper)


def _regions(items: list) -> set:
    """The regions of the texts in ``items``."""
    return set().union(*(_regions(e[UNITS]) if e[KIND] == "+" else {e[REGION]} for e in items if e[KIND] in "+x"))


def _main(items: list) -> str:
    """The region of a page's main text: the first of article, likely main and body that has texts."""
    found = _regions(items)
    return next((r for r in "am" if r in found), "b")


def _chosen(page: list, wrapper: list) -> list[int]:
    """Numbers of the page's main texts but those that meet template."""
    main = _main(page)
    both = _groups(page) | _groups(wrapper)
    page, wrapper = _regroup(page, both), _regroup(wrapper, both)
    out: list[int] = []

    def take(a: list, b: list | None) -> None:
        text = SAID if a[KIND] == "+" else VALUE
        if b is not None and a[KIND] in "x+" and b[text] is not None and a[text] == b[text]:
            return
        if a[KIND] == "+":
            for x, y in zip(a[UNITS], b[UNITS] if b else [None] * len(a[UNITS])):
                take(x, y)
        elif a[KIND] == "x" and a[REGION] == main:
            out.extend(a[UNITS])

    met = dict(_pairs(page, wrapper))
    for p, e in enumerate(page):
        take(e, wrapper[met[p]] if p in met else None)
    return sorted(out)


def _hashed(items: list) -> list:
    """A stream's texts as short hashes."""
    return [[e[KIND], xxhash.xxh64_hexdigest(e[VALUE]), *e[REGION:]] if e[KIND] == "x" else e for e in items]


def _bare(items: list) -> list:
    """Without text numbers."""
    return [[*e[:UNITS], _bare(e[UNITS]) if e[KIND] == "+" else [], *e[SAID:]] for e in items]


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes, mains = [], []
        for page in batch.column(1):
            items = stream(page.as_py())[0]
            main = _main(items)
            mains.append(xxhash.xxh64_hexdigest("\n".join(e[VALUE] for e in items if e[KIND] == "x" and e[REGION] == main)))
            shapes.append(json.dumps(_bare(fold(_hashed(items)))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mains, pa.string()), pa.array(shapes, pa.string())],
                                         names=["host", "main", "shape"])


def _times(items: list, n: int) -> list:
    return [[*e[:PAGES], e[PAGES] * n, _times(e[UNITS], n) if e[KIND] == "+" else [], *e[SAID:]] for e in items]


def _aligned(pdf: pd.DataFrame) -> pd.DataFrame:
    ordered = sorted(zip(pdf["shape"], pdf["n"], pdf["part"]))
    done: list[tuple[list, list[int], bool]] = []
    wrapper: list | None = None
    kids: list[int] = []
    for shape, n, part in ordered:
        items = _times(json.loads(shape), int(n))
        joined = items if wrapper is None else align(wrapper, items)
        if wrapper is None or len(joined) <= max(MOST, len(wrapper), len(items)):
            wrapper, kids = joined, [*kids, int(part)]
        elif len(items) > len(wrapper):
            done.append((items, [int(part)], True))
        else:
            done.append((wrapper, kids, True))
            wrapper, kids = items, [int(part)]
    done.append((wrapper, kids, False))
    return pd.DataFrame([{"host": pdf["host"].iloc[0], "shape": json.dumps(_bare(w)), "n": 1, "part": _part(k), "full": full, "kids": k}
                         for w, k, full in done])


def _part(kids: list[int]) -> int:
    """The number of what went into a part of the numbers ``kids``."""
    return kids[0] if len(kids) == 1 else xxhash.xxh64_intdigest(",".join(map(str, sorted(kids)))) - (1 << 63)


_STATE = "host string, shape string, n long, part long, full boolean, kids array<long>"


def _inferred(pages: DataFrame, batch: int) -> list[DataFrame]:
    """The levels of alignment for ``pages`` (host, html): the distinct streams first, each
    host's parts (host, part, shape) last; ``kids`` are a row's parts of the level before."""
    shapes = pages.select("host", "html").mapInArrow(_shapes, "host string, main string, shape string")
    once = materialize(shapes.distinct())
    # Copies make nothing steady: of shapes with the same main texts one counts as a page.
    alike = materialize(once.groupBy("host", "main").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.xxhash64("shape")).alias("first")).where("c > 1").drop("c"))
    leaf = F.xxhash64("shape")
    levels = [materialize(once.join(small_side(alike, 64), ["host", "main"], "left").select(
        "host", "shape", F.coalesce(leaf == F.col("first"), F.lit(True)).cast("long").alias("n"), leaf.alias("part"),
        F.lit(False).alias("full"), F.array(leaf).alias("kids")))]
    while True:
        state = levels[-1]
        counts = materialize(state.where("not full").groupBy("host").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
        if counts.isEmpty():
            return levels
        # Groups of about a batch, by the shapes' hashes; a host with one shape is done.
        dealt = state.where("not full").join(small_side(counts, 64), "host", "left").withColumn(
            "g", F.pmod(F.xxhash64("shape"), F.ceil(F.coalesce("c", F.lit(1)) / batch).cast("long")))
        met = dealt.select("host", "shape", "n", "part", "g").groupBy("host", "g").applyInPandas(_aligned, _STATE)
        levels.append(materialize(met.unionByName(state.where("full").withColumn("kids", F.array("part")))))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for host, part, shape in zip(*(batch.column(i).to_pylist() for i in range(3))):
            items = json.loads(shape)
            out += [(host, part, at, json.dumps(items[at:at + MOST])) for at in range(0, max(len(items), 1), MOST)]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                         names=["host", "part", "at", "shape"])


def _as_rows(parts: DataFrame) -> DataFrame:
    return parts.select("host", "part", "shape").mapInArrow(_rows_of, "host string, part long, at long, shape string")


def wrappers(pages: DataFrame, batch: int = BATCH) -> DataFrame:
    """``host``, ``part``, ``at`` and ``shape`` (the elements of the part's wrapper from ``at`` on, as JSON)
    for ``pages`` (host, html)."""
    return _as_rows(_inferred(pages, batch)[-1])


def _whole(rows: DataFrame) -> DataFrame:
    """Each part's wrapper from its rows."""
    listed = F.array_sort(F.collect_list(F.struct("at", "shape")))
    inner = F.transform("l", lambda x: F.substr(x["shape"], F.lit(2), F.length(x["shape"]) - 2))
    return rows.groupBy("host", "part").agg(listed.alias("l")).select(
        "host", "part", F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]")).alias("shape"))


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes = [json.dumps(_bare(fold(_hashed(stream(page.as_py())[0])))) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shapes, pa.string())], names=["page_id", "url", "html", "host", "stream"])


def _by_part(read: DataFrame, levels: list[DataFrame], found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages and wrappers with ``host`` naming the part as well, where a host has several."""
    several = materialize(found.groupBy("host").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("host"))
    if several.isEmpty():
        return read, found.select("host", "shape")
    few = small_side(several, 64)
    # From each host's parts down to the streams that went into them.
    into = levels[-1].join(few, "host", "left_semi").select("host", F.col("part").alias("own"), F.explode("kids").alias("part"))
    for level in levels[-2:0:-1]:
        kids = level.select("host", "part", F.explode("kids").alias("kid"))
        into = into.join(kids, ["host", "part"]).select("host", "own", F.col("kid").alias("part"))
    into = materialize(into.groupBy("host", "part").agg(F.min("own").alias("own")))
    named = F.concat_ws("\n", "host", F.col("own").cast("string"))
    many = (read.join(few, "host", "left_semi").select("page_id", "url", "html", "host")
            .mapInArrow(_leaves, "page_id long, url string, html string, host string, stream string")
            .withColumn("part", F.xxhash64("stream")).drop("stream").join(small_side(into, 64), ["host", "part"])
            .select("page_id", "url", "html", named.alias("host")))
    pages = read.join(few, "host", "left_anti").select("page_id", "url", "html", "host").unionByName(many)
    parts = found.withColumn("own", F.col("part")).join(few, "host", "left_semi").select(named.alias("host"), "shape")
    return pages, found.join(few, "host", "left_anti").select("host", "shape").unionByName(parts)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read: dict[str, list] = {}
    for batch in batches:
        found = []
        for page, shape in zip(batch.column(2), batch.column(3)):
            shape = shape.as_py()
            if shape not in read:
                if len(read) > 256:
                    read.clear()
                read[shape] = _contents(json.loads(shape))
            items, texts = stream(page.as_py())
            found.append("\n".join(texts[i] for i in _chosen(fold(_hashed(items)), read[shape])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())],
                                         names=["page_id", "url", "text"])


def _with_wrapper(read: DataFrame, found: DataFrame) -> DataFrame:
    """Each page beside its host's wrapper: by broadcast if the wrappers' summed
    length allows, else by shuffle, a large host's pages over as many copies of its wrapper as it takes."""
    cols = ("page_id", "url", "html", "shape")
    size = found.agg(F.sum(F.octet_length("shape") + F.octet_length("host") + 16)).first()[0] or 0
    if size <= common.BROADCAST_BYTES:
        return read.join(F.broadcast(found), "host").select(*cols)
    large = materialize(read.groupBy("host").agg((F.floor(F.count(F.lit(1)) / COPY_ROWS) + 1).cast("int").alias("copies"))
                        .where("copies > 1"))  # at most a host per COPY_ROWS rows
    copies = F.coalesce("copies", F.lit(1))
    spread = read.join(small_side(large, 64), "host", "left").withColumn("copy", F.pmod(F.xxhash64("page_id", "html"), copies).cast("int"))
    each = found.join(small_side(large, 64), "host", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return spread.drop("copies").join(each.drop("copies"), ["host", "copy"]).select(*cols)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of ``pages`` (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    levels = _inferred(read, BATCH)
    found = materialize(_whole(_as_rows(levels[-1])))
    out = _with_wrapper(*_by_part(read, levels, found)).mapInArrow(_texts, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op4_html_text": op4_html_text}
ORACLES: dict[str, str] = {}
