"""Main text of web pages: the contiguous region where words outweigh tags most."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|svg|iframe|object|canvas|select|button)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?P<key>class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s"'>]+)))?""", re.S | re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
CONTENT = {"article", "main"}
ASIDE = set("nav footer aside form dialog menu header".split())
#: Words in a class, id or role that mark an element as beside the article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer contentinfo complementary masthead cookie cookies consent gdpr notice popup modal overlay dialog alert"
    " comment comments respond disqus reply replies share sharing social related recommended recommendations newsletter subscribe signup login"
    " pagination pager toolbar skip".split()
)
#: These do so only where no word says that the element belongs to the article.
WEAK = set("header top bottom side search tags widget".split())
OWN = set("article entry post content main body story text".split())
READERS = {"comment", "comments", "reply", "replies", "respond", "disqus"}
#: One such part is enough for a class, unless another says that it belongs to the article or only tells a state.
STRONG = READERS | {"review", "reviews", "ad", "ads", "advert", "adverts", "advertisement", "adsbygoogle"}
STATES = set("no without has with open closed on off enabled disabled count allowed".split())
#: Children of one element that go with the text beside them.
FLOW = set("p ul ol dl table pre blockquote figure h1 h2 h3 h4 h5 h6 hr".split())
#: Words that may stand beside a mark in one class name: ``site-footer`` is a footer, ``no-sidebar`` is not a sidebar.
FILLING = set("area bar block box button buttons container global group inner item items left link links list outer page panel primary right row secondary section site slot top unit wrap wrapper".split())

WORDS = {"word", "link"}

#: Open elements that a start tag ends, up to the elements that hold them.
ENDS = {
    **dict.fromkeys(["li"], ({"li"}, {"ul", "ol", "menu"})),
    **dict.fromkeys(["dt", "dd"], ({"dt", "dd"}, {"dl"})),
    **dict.fromkeys(["td", "th"], ({"td", "th"}, {"table", "tr"})),
    "tr": ({"tr"}, {"table"}),
    **dict.fromkeys(["tbody", "thead", "tfoot"], ({"tbody", "thead", "tfoot", "tr"}, {"table"})),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Start tags that end an open paragraph.
BLOCKS = set(
    "address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr"
    " main menu nav ol p pre section table ul li dt dd td th tr tbody thead tfoot".split()
)

#: The weight of one tag, of one word and of one word beside the article is kept within these limits.
LIMITS = ((-2.0, -0.05), (-1.0, 1.0), (-1.0, -0.05))

#: Weights of what no labelled page shows.
UNSEEN = {"word": 1.0, "link": -0.5, "tag": -0.3, "aside": -0.3, "aside word": -1.0, "aside link": -1.0}


def beside(name: str, attrs: str, within: bool) -> str:
    """``aside`` for a menu, header, footer, sidebar, notice, advert, form or comments, ``hidden`` for what is not shown.

    A class counts as a whole: each of its parts must be a mark or go with one, but for
    readers' words and adverts, which need one part.
    """
    tokens: list[set[str]] = []
    for m in ATTRIBUTE.finditer(attrs) if attrs and name not in ("body", "html") else ():
        key, value = m["key"].lower(), m["a"] or m["b"] or m["c"] or ""
        if key in ("class", "id", "role"):
            tokens += [{p.lower() for p in PART.findall(t) if not p.isdigit()} for t in value.split()]
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return "hidden"
    if name in ASIDE and not (name == "header" and within):
        return "aside"
    if name in CONTENT:
        return "aside" if any(t & READERS and t <= READERS | FILLING for t in tokens) else ""
    own = any(t & OWN and t <= OWN | FILLING for t in tokens)
    marked = any(t & MARKS and t <= MARKS | WEAK | FILLING or t & WEAK and t <= WEAK | FILLING and not own for t in tokens)
    strong = any(t & STRONG and not t & (OWN | STATES) for t in tokens)
    return "aside" if marked or strong and not own else ""


def items(page: str) -> tuple[list[tuple[str, str, bool, int]], bool, list[list]]:
    """The page as (text or tag, kind, inside the article, aside), whether it marks an article, and its elements.

    Kinds are ``word``, ``link`` (words of a link) and ``tag``; an end tag has a slash.
    ``aside`` is 0, or the number of the element beside the article that an item is in.
    Text of hidden elements, of scripts, styles, comments and the like is left out.
    Elements whose end tags may be omitted end where the next one or their parent's end is.
    An element is its name, the number of its parent (-1: none), and the first item of it
    and the first one after it; inline elements are not among them.
    """
    out: list[tuple[str, str, bool, int]] = []
    # open elements: name, what ``beside`` says where it is the outermost such one, and its number
    stack: list[tuple[str, str, int]] = []
    elements: list[list] = []
    names: Counter = Counter()
    state, number, within, link, marked, at = "", 0, 0, False, False, 0

    def text_until(end: int) -> None:
        if end > at and state != "hidden":
            out.append((page[at:end], "link" if link else "word", within > 0, number if state else 0))

    def close_to(n: int) -> None:
        nonlocal state
        while len(stack) > n:
            closed, said, which = stack.pop()
            elements[which][3] = len(out)
            names[closed] -= 1
            state = "" if said else state

    for m in MARKUP.finditer(page):
        text_until(m.start())
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        ends, was = bool(m["end"] or m["end2"]), state
        if ends:
            if names[name]:
                n = len(stack) - 1
                while stack[n][0] != name:
                    n -= 1
                which = stack[n][2]
                close_to(n)
                elements[which][3] += 1  # its end tag comes next
            elif name in ("body", "html"):
                close_to(0)
        else:
            if name in BLOCKS and names["p"]:
                n = len(stack) - 1
                while n >= 0 and stack[n][0] in INLINE:
                    n -= 1
                if n >= 0 and stack[n][0] == "p":
                    close_to(n)
            same, holders = ENDS.get(name, ((), ()))
            if any(names[x] for x in same):
                n, found = len(stack) - 1, -1
                while n >= 0 and stack[n][0] not in holders:
                    found = n if stack[n][0] in same else found
                    n -= 1
                if found >= 0:
                    close_to(found)
            if name in CONTENT and state and not within:
                # an element that was never closed ends where the article begins
                n = next(k for k, (_, said, _) in enumerate(stack) if said)
                if stack[n][0] not in CONTENT:
                    close_to(n)
            said = "" if state or name in VOID else beside(name, m["attrs"] or m["attrs2"] or "", within > 0)
            if said:
                state, number = said, number + 1
            if name not in VOID and (said or name not in INLINE):
                elements.append([name, stack[-1][2] if stack else -1, len(out), 0])
                stack.append((name, said, len(elements) - 1))
                names[name] += 1
        if state == "hidden":
            continue
        if name in CONTENT and not state and not was:
            within, marked = max(0, within + (-1 if ends else 1)), True
        elif name == "a":
            link = not ends
        out.append((("/" if ends else "") + name, "tag", within > 0, number if state or was else 0))
    text_until(len(page))
    close_to(0)
    return out, marked, elements


def widened(start: int, end: int, elements: list[list]) -> tuple[int, int]:
    """The items ``start`` to ``end - 1``, and what belongs to them in the element that holds them all.

    Where that is in an article, all of the article.  Elsewhere the children that the
    region cuts are taken whole, and next to them paragraphs, lists, tables, headings and
    the like, as far as nothing else stands between.
    """
    holder = -1
    for n, (_, _, first, after) in enumerate(elements):  # outer elements come first
        if first < start and end <= after:
            holder = n
    up = holder
    while up >= 0:
        name, parent, first, after = elements[up]
        if name in CONTENT:
            return first, after
        up = parent
    children = [e for e in elements if e[1] == holder]
    for _, _, first, after in children:
        if first < end and start < after:
            start, end = min(start, first), max(end, after)
    for name, _, first, after in children:
        if first == end and name in FLOW:
            end = after
    for name, _, first, after in reversed(children):
        if after == start and name in FLOW:
            start = first
    return start, end


def feature(text: str, kind: str, aside: int, size: int) -> str:
    """What the weight of an item depends on: the name of a tag, or a word's element and the words in its block."""
    if kind == "tag":
        name = text.removeprefix("/")
        return f"tag {text if name in NAMES else 'other'}"
    return f"{'aside ' if aside else ''}{kind} {'short' if size < 4 else 'line' if size < 16 else 'long'}"


def wider(name: str) -> str:
    """The feature that stands in for one that no labelled page shows."""
    return name.replace("tag /", "tag ") if name.startswith("tag") else name.rpartition(" ")[0]


def described(found: list[tuple[str, str, bool, int]]) -> list[tuple[str, int]]:
    """The feature and the number of words (1 for a tag) of each item."""
    counts = [len(text.split()) if kind in WORDS else 1 for text, kind, _, _ in found]
    out: list[tuple[str, int]] = []
    n = 0
    while n < len(found):
        end, size = n, 0
        while end < len(found) and found[end][3] == found[n][3]:
            text, kind = found[end][:2]
            if kind == "tag" and text.removeprefix("/") not in INLINE:
                break
            size += counts[end] if kind in WORDS else 0
            end += 1
        end = max(end, n + 1)
        out += [(feature(*found[k][:2], found[k][3], size), counts[k]) for k in range(n, end)]
        n = end
    return out


#: Names of tags that have a weight of their own; others share one, so weights stay few.
NAMES = set(
    "a article b blockquote body br code dd div dl dt em figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html i img input"
    " li main meta nav ol p pre section span strong table tbody td th thead tr u ul".split()
)


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights from labelled pages: those that mark one region as their article.

    The mark is the label: words and tags are counted inside and outside of it by the
    features that every page has, over all pages, for the log odds.  What comes back is
    one row per feature, of which there are a fixed number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for page in batch.column(0).to_pylist():
                found, marked, _ = items(page)
                if not marked:
                    continue
                for (_, _, within, _), (name, n) in zip(found, described(found)):
                    for seen in {name, wider(name)}:
                        counts[seen, within] += n
            keys = list(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array([k for k, _ in keys], pa.string()),
                    "inside": pa.array([counts[k] if k[1] else 0 for k in keys], pa.int64()),
                    "outside": pa.array([0 if k[1] else counts[k] for k in keys], pa.int64()),
                }
            )

    read = pages.select(text_or_empty(html_col).alias("html"))
    counts = read.mapInArrow(run, "feature string, inside long, outside long").groupBy("feature")
    weights = {}
    for r in counts.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect():
        odds = math.log((r.inside + 0.5) / (r.outside + 0.5))
        low, high = LIMITS[2 if r.feature.startswith("aside") else not r.feature.startswith("tag")]
        weights[r.feature] = min(max(odds, low), high)
    return weights


def weigh(name: str, weights: dict[str, float]) -> float:
    for known in (weights, UNSEEN):
        for asked in (name, wider(name)):
            if asked in known:
                return known[asked]
    return UNSEEN["tag"]


def main_text(page: str, weights: dict[str, float]) -> str:
    """Text of the contiguous region with the largest sum of weights, found in one scan.

    An element beside the article whose own words sum to less than nothing is left out
    and weighs as one item; another takes part by its weights.  The region is then
    ``widened`` to whole elements.
    """
    found, _, elements = items(page)
    scores: list[float] = []
    asides: Counter = Counter()
    known: dict[str, float] = {}
    for (_, kind, _, aside), (name, n) in zip(found, described(found)):
        if name not in known:
            known[name] = weigh(name, weights)
        scores.append(n * known[name])
        if aside and kind in WORDS:
            asides[aside] += scores[-1]
    best, best_at, total, start, last = 0.0, (0, 0), 0.0, 0, 0
    for n, (_, _, _, aside) in enumerate(found):
        if aside and asides[aside] <= 0:
            total += UNSEEN["aside"] if aside != last else 0.0
        else:
            total += scores[n]
        last = aside
        if total <= 0:
            total, start = 0.0, n + 1
        elif total > best:
            best, best_at = total, (start, n + 1)
    if best:
        best_at = widened(*best_at, elements)
    parts = []
    for text, kind, _, aside in found[best_at[0] : best_at[1]]:
        if aside and asides[aside] <= 0:
            parts.append(" ")
        elif kind in WORDS:
            parts.append(entities.unescape(text))
        elif text.removeprefix("/") not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def extract_text(
    pages: DataFrame, weights: dict[str, float] | None = None, html_col: str = "html"
) -> DataFrame:
    """``pages`` without the html, with ``text``, the main text of each whole page.

    Words and tags are weighed by name and context with weights that ``learn`` takes from
    the pages that mark their article, unless ``weights`` are given; ``<article>`` and
    ``<main>`` themselves weigh like any other tag.  A linear scan finds the best
    contiguous region, which is widened to the article that holds it or else to whole
    elements and the paragraphs and lists beside it; within it menus, headers, footers, sidebars, notices, adverts,
    forms and readers' comments are left out where their words, which weigh less, sum to
    less than nothing, and hidden elements always.  Character references are decoded, white
    space becomes one space, blocks are joined by one space.  Both passes are without a
    shuffle of pages.

    A NULL or empty page, and one without words outside such elements, gives the empty
    text.  Markup that never ends is closed where the page does.  Other columns
    stay, but one named ``text`` is replaced; repeated rows are extracted each, an empty table gives an empty result.
    """
    weights = learn(pages, html_col) if weights is None else weights
    rest = [f for f in pages.schema.fields if f.name not in (html_col, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch.column(0).to_pylist()]
            names = [f.name for f in rest] + ["text"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=names)

    read = pages.select(text_or_empty(html_col).alias("html"), *(F.col(f"`{f.name}`") for f in rest))
    return read.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", text string")
