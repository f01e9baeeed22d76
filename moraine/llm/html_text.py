"""HTML extraction by minimum-cut labelling of a page's blocks.

A page becomes a list of blocks in page order, each with its place in the
document tree. A linear classifier over tag context, class names, link share
and text shape says how much each block looks like main text; its cost is the
capacity to source or sink. Edges between neighbours in page order and between
blocks of one parent carry smoothness, more the closer they are in the tree.
The maximum flow separates content from boilerplate.

Pages are independent, so this is one pass without a shuffle. The classifier's
text part is fitted on a bounded sample of pages whose own markup tells what
their blocks are.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

MAX_PAGES = 1_000  # pages the classifier's text part is fitted on, at most
SEED = 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe)(?=[\s/>])[^>]*>(.*?)(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|itemprop|aria-hidden|aria-label)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img input br math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover "
    "mmultiscripts mprescripts none mtable mtr mtd mspace mstyle mpadded mphantom menclose merror semantics annotation".split()
)
# Elements left out with all they enclose, if their end tag comes; the first ones do not end a line of text.
_SKIPPED_INLINE = frozenset("svg select button noscript template".split())
_SKIPPED = _SKIPPED_INLINE | frozenset("object canvas video audio".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSE_LIMIT = frozenset("ul ol dl table article section div nav aside footer header main body form blockquote".split()) | _SKIPPED
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)

# Bits of a block's context, inherited by what it encloses.
ARTICLE, MAIN, NAV, FOOTER, HEADER, ASIDE, FORM, BAD_NAME, GOOD_NAME, HIDDEN, HEAD, LINK = (1 << i for i in range(12))
_TAG_BITS = {
    "article": ARTICLE, "main": MAIN, "nav": NAV, "menu": NAV, "footer": FOOTER, "header": HEADER, "aside": ASIDE, "form": FORM,
    "fieldset": FORM, "dialog": ASIDE, "head": HEAD, "a": LINK, "label": FORM,
}
_ROLE_BITS = {
    "navigation": NAV, "banner": HEADER, "contentinfo": FOOTER, "complementary": ASIDE, "search": FORM, "form": FORM, "main": MAIN,
    "article": ARTICLE, "alert": BAD_NAME, "dialog": BAD_NAME, "menu": NAV, "menubar": NAV, "alertdialog": BAD_NAME,
}
_BAD = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|notification|alert|comments?|comment\w*|"
    r"disqus|replies|reply|respond|sidebar|side|widget\w*|menu\w*|nav\w*|footer|foot|header|masthead|breadcrumb\w*|crumbs|share|sharing|social|"
    r"related|recommend\w*|popular|trending|newsletter|subscribe|subscription|signup|login|popup|modal|overlay|toolbar|pagination|pager|"
    r"tagcloud|legal|copyright|disclaimer|skip|search\w*|form|toc)(?=$|[^a-z])",
    re.I,
)
_GOOD = re.compile(r"(?:^|[^a-z])(?:article\w*|content|post|entry|story|body|main|text|page)(?=$|[^a-z])", re.I)
# Names such as "with-sidebar" say what lies beside an element, not what it is.
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|with|no|is)-\S+", re.I)
# Parts of an article by name: its own heading is no page header.
_OWN_PART = re.compile(r"(?<![a-z])(?:entry|article|post|story|content)-(?:header|heading|title|body|text|main|content)(?![a-z])", re.I)
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Block:
    """A text, its element's number, depth and parent, and how many open elements it shares with the block before."""

    __slots__ = ("text", "bits", "tag", "depth", "parent", "shared", "link_chars")

    def __init__(self, text, bits, tag, depth, parent, shared, link_chars):
        self.text, self.bits, self.tag, self.link_chars = text, bits, tag, link_chars
        self.depth, self.parent, self.shared = depth, parent, shared


class _Open:
    """The open elements, each with tag, bits and number; where a tag was last opened is known without a search."""

    def __init__(self):
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]
        self.places: dict[str, list[int]] = {}
        self.solid = [0]  # places of elements that are not inline
        self.low = 1  # fewest open elements since the last block

    def push(self, tag: str, bits: int, number: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in _INLINE:
            self.solid.append(len(self.stack))
        self.stack.append((tag, bits, number))

    def cut(self, k: int) -> None:
        for tag, _, _ in self.stack[k:]:
            self.places[tag].pop()
        while self.solid[-1] >= k:
            self.solid.pop()
        del self.stack[k:]
        self.low = min(self.low, k)

    def last(self, tags) -> int:
        """The place of the innermost open element of these, 0 if there is none."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)


def _bits(tag: str, attributes: str, above: int) -> int:
    bits = _TAG_BITS.get(tag, 0)
    if tag == "header" and above & (ARTICLE | MAIN):
        bits = 0  # a heading of the article itself
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "aria-label"):
                value = _OWN_PART.sub("content", _MODIFIER.sub(" ", value.replace("_", "-")))
                if _BAD.search(value):
                    bits |= BAD_NAME
                elif _GOOD.search(value):
                    bits |= GOOD_NAME
            elif name == "role":
                bits |= _ROLE_BITS.get(value.lower(), 0)
            elif name == "itemprop":
                bits |= ARTICLE if value.lower() == "articlebody" else 0
            elif name == "style":
                bits |= HIDDEN if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) else 0
            else:
                bits |= HIDDEN if name == "hidden" or value.lower() == "true" else 0
    if tag in ("body", "html"):
        bits &= ~(BAD_NAME | GOOD_NAME)
    return bits


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order.

    What an element of ``_SKIPPED`` encloses is taken back when its end tag
    comes; one that is never closed hides nothing.
    """
    out: list[tuple] = []  # texts, characters in links, bits, tag, depth, parent, shared
    opened = _Open()
    stack = opened.stack
    skips: list[list] = []  # place, blocks before, texts and link characters before, where these are in ``out``
    parts: list[str] = []
    linked, count, at = 0, 0, 0

    def emit(texts: list[str], chars: int, upto: int) -> None:
        k = upto - 1
        if stack[k][0] in _INLINE:
            k = opened.solid[bisect_left(opened.solid, upto) - 1]
        shared, opened.low = opened.low, len(stack)
        out.append((texts, chars, stack[k][1], stack[k][0], k + 1, stack[k - 1][2] if k else -1, shared))

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            for skip in skips[first_held() :]:
                skip[4] = len(out)
                if skip[2]:
                    emit(skip[2], skip[3], skip[0])
            emit(parts, linked, len(stack))
            parts, linked = [], 0

    def first_held() -> int:
        k = len(skips)
        while k and skips[k - 1][4] is None:
            k -= 1
        return k

    def cut(k: int, own: bool = False) -> None:
        nonlocal parts, linked
        while skips and skips[-1][0] >= k:
            place, before, texts, chars, held = skips.pop()
            if own and place == k:
                opened.low = min([opened.low, *(b[6] for b in out[before:])])
                del out[before:]
                for skip in reversed(skips):
                    if skip[4] is None or skip[4] < before:
                        break
                    skip[4] = None
                parts, linked = texts, chars
            elif held is None:
                texts.extend(parts)
                parts, linked = texts, chars + linked
        opened.cut(k)

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        raw, _, close, tag, attributes, close2, tag2, attributes2, text = m.groups()
        if text is not None:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if stack[-1][1] & LINK:
                linked += len(text)
            continue
        if raw:
            if page[m.start(2) - 2] == "/" and opened.last(("svg", "math")):
                at = m.start(2)  # empty by the rules of XML
            elif raw.lower() not in ("script", "style"):
                flush()
            continue
        if tag is None:
            close, tag, attributes = close2, tag2, attributes2
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in _INLINE
        if tag == "br":
            parts.append(" ")
            continue
        if close:
            k = opened.last((tag,))
            if tag in _SKIPPED:
                if k:
                    cut(k, True)
                continue
            if not inline:
                flush()
            if k and (not inline or k > opened.solid[-1]):
                cut(k)
            continue
        if not inline and tag not in _SKIPPED_INLINE:
            flush()
            # Inline elements left open do not reach into the next block.
            if stack[-1][0] in _INLINE:
                cut(opened.solid[-1] + 1)
            closes = _CLOSES_ITSELF.get(tag) or ({"p"} if tag in _ENDS_P else None)
            if closes:
                while (k := opened.last(closes)) > opened.last(_CLOSE_LIMIT):
                    cut(k)
                    if tag not in ("tr", "dt", "dd"):
                        break
        if tag in _VOID:
            continue
        if attributes.endswith("/") and (tag in ("p", "div", "span") or tag in _SKIPPED or tag == "math" or opened.last(("svg", "math"))):
            continue
        count += 1
        above = stack[-1][1]
        if tag in _SKIPPED:
            skips.append([len(stack), len(out), parts, linked, None])
            parts, linked = [], 0
        opened.push(tag, above | _bits(tag, attributes, above), count)
    while skips and skips[-1][4] is None:
        cut(skips[-1][0])
    flush()
    blocks, low = [], len(page) + 2
    for texts, chars, bits, tag, depth, parent, shared in out:
        low = min(low, shared)
        text = " ".join("".join(texts).split())
        if text:
            blocks.append(Block(text, bits, tag, depth, parent, low, min(chars, len(text))))
            low = len(page) + 2
    return blocks


_TEXT_FEATURES = 6


def _text_features(b: Block) -> list[float]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    return [
        1.0,
        math.log1p(words) / 4,
        min(len(_SENTENCE.findall(b.text)), 10) / 5,
        b.link_chars / n,
        float(b.tag == "li"),
        float(b.tag in ("p", "h1", "h2", "h3", "blockquote", "pre")),
    ]


_OUT = NAV | FOOTER | HEADER | ASIDE | FORM | BAD_NAME | HIDDEN | HEAD


def _context_cost(bits: int) -> float:
    """What markup says of a block; evidence against outweighs evidence for."""
    cost = 0.0
    if bits & (ARTICLE | MAIN):
        cost += 4.0
    elif bits & GOOD_NAME:
        cost += 2.0
    if bits & _OUT:
        cost -= 12.0
    return cost


def minimum_cut(costs: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source; a positive cost pulls there.

    Nodes whose own cost exceeds all their edges are settled first and hand
    their edges on to their neighbours, which leaves the cut as it is. The
    rest is cut by augmenting shortest paths.
    """
    n = len(costs)
    costs = list(costs)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(costs[i]) < sum(near[i].values()):
            continue
        side[i] = costs[i] > 0
        for j, c in near[i].items():
            costs[j] += c if side[i] else -c
            del near[j][i]
            if side[j] is None:
                queue.append(j)
        near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        source, sink = n, n + 1
        room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
        room[source], room[sink] = {}, {}
        for i in rest:
            if costs[i] > 0:
                room[source][i] = costs[i]
                room[i][source] = 0.0
            else:
                room[i][sink] = -costs[i]
                room[sink][i] = 0.0
        while True:
            parent = {source: source}
            line = deque([source])
            while line and sink not in parent:
                a = line.popleft()
                for b, c in room[a].items():
                    if c > 1e-9 and b not in parent:
                        parent[b] = a
                        line.append(b)
            if sink not in parent:
                break
            path, b = [], sink
            while b != source:
                path.append((parent[b], b))
                b = parent[b]
            flow = min(room[a][b] for a, b in path)
            for a, b in path:
                room[a][b] -= flow
                room[b][a] = room[b].get(a, 0.0) + flow
        for i in rest:
            side[i] = i in parent
    return [bool(s) for s in side]


SMOOTH = 1.5


def _edges(blocks: list[Block]) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last_of: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            apart = a.depth + b.depth - 2 * min(a.depth, b.depth, b.shared)
            edges[i - 1, i] = SMOOTH / (1 + apart)
        parent = b.parent
        j = last_of.get(parent)
        if j is not None:
            edges[j, i] = edges.get((j, i), 0.0) + SMOOTH / 3
        last_of[parent] = i
    return edges


def _around_article(blocks: list[Block]) -> int:
    """Marks of boilerplate that hold for the page's whole article, such as a form around the page.

    They say nothing against it: they count as its surroundings if every block
    of an article or main element has them and what lies outside of boilerplate
    is shorter than these blocks. Marks inside the article stay.
    """
    inside = [b for b in blocks if b.bits & (ARTICLE | MAIN)]
    shared = _OUT
    for b in inside:
        shared &= b.bits
    clean = sum(len(b.text) for b in blocks if not b.bits & _OUT)
    return shared if inside and clean < sum(len(b.text) for b in inside) else 0


def extract(page: str | None, weights: np.ndarray) -> str:
    """The main text: content blocks in page order, joined by one space."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    shape = np.array([_text_features(b) for b in blocks]) @ weights
    around = _around_article(blocks)
    bits = [b.bits & ~around if b.bits & (ARTICLE | MAIN) else b.bits for b in blocks]
    costs = [_context_cost(b) + s for b, s in zip(bits, np.clip(shape, -3, 3).tolist())]
    keep = minimum_cut(costs, _edges(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


# Used where no page's markup tells content from boilerplate.
_PRIOR = np.array([-2.0, 2.0, 1.0, -4.0, -1.0, 1.0])


def fit(pages: DataFrame, html_column: str, max_pages: int = MAX_PAGES) -> np.ndarray:
    """Weights of the text part, from at most ``max_pages`` pages.

    Blocks inside an article or main element are examples of content, blocks
    inside navigation, footers, sidebars, forms and the like of boilerplate.
    """
    hashed = pages.select(F.col(html_column).alias("html")).where("html is not null").withColumn("h", F.xxhash64(F.lit(SEED), "html"))
    # Hashes alone are ordered; the pages stay where they are. Copies of a page count as one.
    last = hashed.select("h").orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    if last is None:
        return _PRIOR
    sample = hashed.where(F.col("h") <= last).select("html")

    def examples(batches):
        for batch in batches:
            rows = []
            for page in batch.column("html").to_pylist():
                for b in blocks_of(page):
                    good, bad = bool(b.bits & (ARTICLE | MAIN)), bool(b.bits & _OUT)
                    if good != bad:
                        rows.append([float(good), *_text_features(b)])
            x = np.array(rows).reshape(-1, _TEXT_FEATURES + 1)
            # Like rows are counted together, so what is collected stays small.
            x, n = np.unique(np.round(x, 1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(n)], names=["x", "n"])

    rows = sample.mapInArrow(examples, "x array<double>, n bigint").groupBy("x").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return _PRIOR
    x = np.array([r.x for r in rows])
    n, y, x = np.array([r.n for r in rows], float), x[:, 0], x[:, 1:]
    if len(set(y)) < 2:
        return _PRIOR
    # Both classes weigh the same.
    n = n * np.where(y == 1, 0.5 / n[y == 1].sum(), 0.5 / n[y == 0].sum())
    order = np.lexsort(x.T)
    x, y, n = x[order], y[order], n[order]
    w = _PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + 0.01 * (w - _PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def extract_pages(pages: DataFrame, html_column: str = "html", carry: list[str] | None = None, max_pages: int = MAX_PAGES) -> DataFrame:
    """One row per input row: (page struct, text, n_chars).

    ``page`` holds every input column, or those in ``carry``. A null or empty
    page, and a page without content, has an empty text of 0 characters.
    Repeated pages repeat; a page is read whole whatever its length.
    """
    weights = fit(pages, html_column, max_pages)

    def run(batches):
        for batch in batches:
            texts = [extract(page, weights) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page", "text", "n_chars"],
            )

    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or pages.columns]).alias("page"), F.col(html_column).alias("html")
    )
    schema = StructType().add("page", rows.schema["page"].dataType).add("text", StringType()).add("n_chars", LongType())
    return rows.mapInArrow(run, schema)


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_pages(pages, carry=["page_id", "url"]).select("page.page_id", "page.url", "text", "n_chars")
