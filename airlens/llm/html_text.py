"""Main text of HTML pages by tag-path ratios.

A page is scanned into blocks of text, each with its path of block elements
from the root. Per path the text length and the punctuation of its blocks are
averaged; a block takes the two ratios of its path, both are smoothed over the
neighbouring blocks, and their product (the fusion) is compared with a
threshold from the page's own spread. Paths whose blocks pass select the content
nodes. The article is the <article> or <main> that holds nearly all of the selected text, else the lowest
common ancestor of all selected blocks: never a list, table, quotation, section or paragraph, but what
contains it, and a headline beside it belongs to it. Its blocks are the text, short ones included, save what
an element marks as no part of it: navigation, headers and footers of the page, asides, forms, scripts, styles, and
elements whose class, id or role is the name of an advert, a sidebar or reader comments. A name that may mean
something else (``section-header``, ``related-work``, ``notice``; a footer inside an article) only makes its element
doubtful: it never steers the choice of the article, and inside the article the element goes only if the ratios of
its own paths are below the threshold too and it holds no headline.

Character references are decoded, white space inside a block (a line break
too) becomes one space, blocks are trimmed and joined by one line feed. A null or
empty page has the empty text. Unclosed and stray tags are tolerated; a tag or
comment that never ends runs to the end of the page. Repeated pages each get a row; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, map_arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…，。、；：！？]")

RAW = frozenset("script style noscript template iframe svg title textarea xmp noembed noframes annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var object "
    "math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace mpadded "
    "mphantom menclose merror mmultiscripts mprescripts none".split())
NOISE_TAGS = frozenset("nav header footer aside form button select menu dialog head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FIRM_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion breadcrumb breadcrumbs "
    "comment comments respond replies cookie cookies consent popup modal masthead nav navbar navigation pagination pager "
    "sharing sidebar newsletter subscribe signup login toolbar".split())
# also names of an article's own parts
LOOSE_NAMES = frozenset(
    "discussion notice notices alert overlay footer header menu related recommended share social search widget widgets".split())
# words that add nothing to a firm name: ``ad-slot``, ``comment-list``
ADDED = LOOSE_NAMES | frozenset(
    "list box slot wrapper container area block inner outer top bottom left right bar form links buttons unit".split())
WHOLE = frozenset("html body main article".split())   # their classes tell of the page's layout, not of themselves
# parts of an article, never the whole of it
PARTS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption "
    "details summary section address".split())
# an opening tag closes these open elements, searched up to one of the bounds
_P_ENDERS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
           "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
_P_BOUNDS = frozenset("table td th caption button object".split())

NEARLY = 0.9      # share of the selected text that an <article> or <main> holds to be the article
SPREAD = 0.5      # the threshold is the mean less so many standard deviations of the fused ratios
SMOOTH = np.array([0.05, 0.25, 0.4, 0.25, 0.05])


@dataclass
class Block:
    path: tuple[int, ...]       # numbers of the open block elements
    names: str                  # their tag names
    noise: bool
    doubts: tuple[int, ...]     # numbers of the open elements of a doubtful name
    plain: bool = False         # has text outside inline elements of a doubtful name
    parts: list[str] = field(default_factory=list)
    text: str = ""


def _noise(name: str, rest: str, within: bool) -> int:
    """0: none, 1: doubtful, 2: noise. ``within`` tells whether the element is inside an article."""
    if name in NOISE_TAGS:
        return 2 if not within or name not in ("header", "footer") else int(name == "footer")
    if "=" not in rest or name in WHOLE or name in HEADINGS:
        return 0
    out = 0
    for m in _ATTRIBUTE.finditer(rest):
        if m[1].lower() not in ("class", "id", "role"):
            continue
        for token in (m[2] or m[3] or m[4] or "").lower().split():
            words = set(re.split(r"[^a-z]+", token)) - {""}
            if not words.isdisjoint(FIRM_NAMES) and words <= FIRM_NAMES | ADDED:
                return 2
            if not (words.isdisjoint(FIRM_NAMES) and words.isdisjoint(LOOSE_NAMES)):
                out = 1
    return out


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    stack: list[tuple[str, int, int]] = []   # open elements: name, number, noise
    out: list[Block] = []
    current: Block | None = None
    number = at = 0

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            own = [s for s in stack if s[0] not in INLINE]
            current = Block(tuple(s[1] for s in own), "/".join(s[0] for s in own), any(s[2] == 2 for s in stack),
                            tuple(s[1] for s in own if s[2] == 1))
            out.append(current)
        elif current.noise != any(s[2] == 2 for s in stack):
            current = None
            add(text)
            return
        current.parts.append(text)
        current.plain = current.plain or bool(text.strip()) and not any(s[2] == 1 and s[0] in INLINE for s in stack)

    def close(k: int) -> None:
        nonlocal current
        if any(s[0] not in INLINE or s[2] == 2 for s in stack[k:]):
            current = None
        del stack[k:]

    def close_open(names, bounds) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                close(k)
                return
            if stack[k][0] in bounds:
                return

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            else:
                if name == "br":
                    add(" ")
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = stop.start() if stop else n
            continue
        if name in VOID:
            if name == "hr":
                close_open({"p"}, _P_BOUNDS)
                current = None
            elif name == "br":
                add(" ")
            continue
        if name in _P_ENDERS:
            close_open({"p"}, _P_BOUNDS)
        if name in _CLOSES:
            close_open(*_CLOSES[name])
        noise = _noise(name, m["rest"], any(s[0] in ("article", "main") for s in stack))
        if name not in INLINE or noise == 2:
            current = None
        if m["rest"].endswith("/") and name not in INLINE and name not in _P_ENDERS:
            continue
        number += 1
        stack.append((name, number, noise))
    for k, b in enumerate(out):
        if not b.plain:
            b.doubts += (-k - 1,)     # all its text is in inline elements of a doubtful name
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    return [b for b in out if b.text]


def _smoothed(x: np.ndarray) -> np.ndarray:
    around = np.convolve(x, SMOOTH)[2:2 + len(x)]
    return around / np.convolve(np.ones(len(x)), SMOOTH)[2:2 + len(x)]


def _article(selected: list[Block], clean: list[Block]) -> int:
    """The element that holds the article; 0 is the page."""
    name = {e: n for b in clean for e, n in zip(b.path, b.names.split("/"))}
    inside = defaultdict(int)
    for b in selected:
        for element in b.path:
            inside[element] += len(b.text)
    most = NEARLY * sum(len(b.text) for b in selected)
    marked = [e for e, n in inside.items() if name[e] in ("article", "main") and n >= most]
    if marked:
        return min(marked)
    above = list(selected[0].path)
    for b in selected:
        k = 0
        while k < min(len(above), len(b.path)) and above[k] == b.path[k]:
            k += 1
        del above[k:]
    while above and name[above[-1]] in PARTS:
        above.pop()
    held = [b for b in clean if above and above[-1] in b.path]
    if held and len(held) < len(clean) and name[above[-1]] not in WHOLE and all(b.path[-1] == above[-1] for b in held):
        above.pop()     # one element of bare text: its container is the article, so its headline and short blocks stay
        while above and name[above[-1]] in PARTS:
            above.pop()
    first = min((b.path for b in clean if not above or above[-1] in b.path), default=())
    if above and not any("h1" in b.names.split("/") for b in clean if above[-1] in b.path):
        for b in clean:
            beside = list(b.path[:-1])
            if b.names.endswith("h1") and b.path < first and above[:len(beside)] == beside:
                above = beside
                break
    return above[-1] if above else 0


def content_blocks(found: list[Block]) -> list[Block]:
    """The blocks of the article."""
    rest = [b for b in found if not b.noise]
    if not rest:
        return []
    held = defaultdict(int)
    for b in rest:
        for element in b.doubts:
            held[element] += len(b.text)
    # an element with most of the page's text has its name from the page's layout
    layout = {e for e, n in held.items() if 2 * n > sum(len(b.text) for b in rest)}
    doubt = [next((e for e in b.doubts if e not in layout), 0) for b in rest]
    clean = [b for b, d in zip(rest, doubt) if not d]
    # ratios per path over the page, noise included: a path used for menus and text alike has a low ratio
    size, marks, times = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        size[b.names] += len(b.text)
        marks[b.names] += len(_PUNCTUATION.findall(b.text))
        times[b.names] += 1
    text = np.array([size[b.names] / times[b.names] for b in rest])
    stops = np.array([marks[b.names] / times[b.names] for b in rest])
    fused = np.log1p(_smoothed(text)) * np.log1p(1 + _smoothed(stops))
    least = fused.mean() - SPREAD * fused.std()
    paths = {b.names for b, x, d in zip(rest, fused, doubt) if x >= least and not d}
    root = _article([b for b in clean if b.names in paths] or clean, clean) if clean else 0
    # a doubtful element is judged as a whole, by the ratios of its own paths
    own, parts = np.log1p(text) * np.log1p(1 + stops) >= least, defaultdict(list)
    for b, d, good in zip(rest, doubt, own):
        parts[d].append((b.names.split("/"), bool(good)))
    kept = {d for d, x in parts.items() if not d or any(good or "h1" in names for names, good in x)
            or all(not HEADINGS.isdisjoint(names) for names, _ in x)}
    return [b for b, d in zip(rest, doubt) if d in kept and (not root or root in b.path)]


def main_text(page: str | None) -> str:
    return "\n".join(b.text for b in content_blocks(blocks(page or "")))


def extract_pages(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: ``id``, ``url``, text, n_chars (code points of the text)."""
    def rows(batches):
        for batch in batches:
            text = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["id", "url", "text", "n_chars"])

    one = columns(pages, id, url, html)
    kind = one.schema[id].dataType.simpleString()
    return (one.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
            .transform(map_arrow, rows, f"id {kind}, url string, text string, n_chars long")
            .withColumnsRenamed({"id": id, "url": url}))
