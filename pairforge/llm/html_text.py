"""Main text of HTML pages by minimum-cut labelling of text blocks.

A page is read into text blocks with their place in the element tree. Costs from
tags, class and id names, link share, length and punctuation become capacities
to the two terminals, content and boilerplate. Neighbouring blocks, and blocks
with the same container, are tied by smoothness edges. The minimum cut is the
cheapest labelling. Blocks whose own cost outweighs their edges keep their side
in every minimum cut, so they are settled first and their edges folded into the
neighbours' costs; max-flow runs on what is left.

Scripts, styles, markup, comments and form controls never become text; character
references are decoded; white space in a block becomes one space. A null or empty
html, or one without text, gives an empty text. Unclosed and crossed tags are
closed by the next enclosing end tag, form controls and embedded contents too (or by
a <main> or <article> inside); a tag cut off at the end is dropped. Rows
are independent, so repeated rows give equal rows and an empty table none. Other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import column, frugal, pick, table, tune

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?)", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*+)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
# contents that are not markup: without its end tag such an element takes the rest of the page
RAW = {"script", "style", "title", "textarea"}
# contents that are not text: skipped up to the end tag, boxes of boilerplate without one
SKIPPED = {"template", "noscript", "iframe", "object", "svg", "select", "button", "xmp", "noframes", "canvas", "audio", "video", "datalist"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var img wbr picture map nobr center".split()
) - {"center"}
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = set("address article aside blockquote dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
STRONG = 12.0
TAG_COST = {"nav": -STRONG, "footer": -STRONG, "aside": -STRONG, "form": -STRONG, "menu": -STRONG, "dialog": -STRONG, "fieldset": -STRONG, "article": 3.0, "main": 2.5}
BLOCK_COST = {"p": 1.0, "h1": 1.5, "h2": 0.8, "h3": 0.8, "h4": 0.6, "blockquote": 1.0, "pre": 1.0, "li": -0.6, "td": -0.4, "th": -0.4, "address": -1.0}
BAD_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|side-?bar|widget|menu|navi?|navbar|navigation|bread-?crumbs?|footer|foot|copyright|legal|disclaimer|comments?|commentlist|replies|reply|respond|disqus|share|sharing|social|related|recommend\w*|login|signup|search\w*|masthead|site-?header|topbar|toolbar|pagination|pager|tags?|skip-?link)(?:$|[-_\s\d])",
    re.I,
)
GOOD_NAME = re.compile(r"(?:^|[-_\s])(?:article\w*|main\w*|content|entry\w*|post|post-?(?:body|content|text)|story\w*|text|body)(?:$|[-_\s])", re.I)
# said of a page's layout, not of what the element is: has-sidebar, content-sidebar-wrap
LAYOUT = re.compile(r"(?<![^\s_-])(?:has|no|with|without)[-_]\S*|(?<!\S)(?=\S*(?:content|layout|page|body))\S*[-_]wrap(?:per)?(?!\S)", re.I)
# boxes that hold articles of their own
LISTING = re.compile(r"(?:^|[-_\s])(?:comments?|commentlist|replies|reply|respond|disqus|related|recommend\w*|sponsor\w*|promo\w*)(?:$|[-_\s\d])", re.I)
# a bad name on such an element speaks against its blocks, and no more than this
BOXES, NAMED = {"div", "section", "center", "table", "tbody", "tr", "td"}, 5.0
ADJACENT, SAME_BOX = 0.5, 1.0


@dataclass(slots=True)
class Block:
    text: str
    links: int  # characters inside links
    tag: str
    cost: float  # of the enclosing elements; positive speaks for content
    box: int  # the container
    depth: int


def _element_cost(tag: str, attrs: str, inherited: float, in_article: bool, listing: bool) -> tuple[float, bool]:
    """(cost of the blocks inside, whether they lie in a listing). Tags, roles and
    hidden elements of boilerplate settle all that they hold. A bad name on a box
    costs ``NAMED``, until a <main> or <article> inside begins anew."""
    cost, main, named, lists = TAG_COST.get(tag, 0.0), tag == "main", False, False
    if tag == "header" and not in_article:
        cost = -STRONG
    if attrs and not attrs.isspace():
        for name, value in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                plain = LAYOUT.sub(" ", value)
                if BAD_NAME.search(plain) and tag not in ("html", "body", "main"):
                    named, lists = True, lists or bool(LISTING.search(plain))
                elif GOOD_NAME.search(value) and cost >= 0 and not listing:
                    cost += 1.5
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                cost = min(cost, -2 * STRONG)
            elif name == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"):
                cost = min(cost, -STRONG)
            elif name == "role" and value in ("main", "article") and cost >= 0:
                cost += 2.5
                main = main or value == "main"
    if named and not main and tag != "article" and tag not in BOXES:
        cost = min(cost, -STRONG)
    # what lies inside a box of boilerplate stays there
    if inherited <= -STRONG / 2:
        return min(inherited, 0.0) + cost if cost <= 0 else inherited, listing
    if cost <= -STRONG / 2:
        return cost, listing
    if main or tag == "article" and not named and not listing:
        inherited, listing = max(inherited, 0.0), False
    elif named and tag != "article":
        return -NAMED, listing or lists
    elif inherited < 0 and tag == "article":
        cost = 0.0
    return min(inherited + cost, 6.0), listing


def _after(page: str, at: int, tag: str, around: set[str]) -> int:
    """Where the contents of a skipped element end: after its end tag, or else at an
    end tag of the elements ``around`` it, or at a <main> or <article> before that."""
    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
    if end and "</" not in (inner := page[at : end.start()]) and f"<{tag}" not in inner.lower():
        return end.end()
    inside: list[str] = []
    anew = stop = -1
    while m := TAG.search(page, at):
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in inside:
                while inside.pop() != name:
                    pass
            elif name == tag:
                return at
            elif name in around:
                stop = m.start()
                break
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif not m[3].endswith("/") and name not in VOID and (name == "a" or name not in INLINE):
            inside.append(name)
            if anew < 0 and name in ("main", "article"):
                anew = m.start()
    return anew if anew >= 0 else stop if stop >= 0 else len(page)


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    # (tag, cost, container number, inside an article, inside a listing)
    stack: list[tuple[str, float, int, bool, bool]] = [("", 0.0, 0, False, False)]
    parts: list[str] = []
    links = in_link = boxes = 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1]
                k = len(stack) - 1
                while k and (stack[k][0] in BLOCK_COST):
                    k -= 1
                out.append(Block(text, links, top[0], top[1], stack[k][2], len(stack)))
            parts.clear()
        links = 0

    while at < n:
        m = TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            piece = page[at:stop]
            if "&" in piece:
                piece = html.unescape(piece)
            parts.append(piece)
            if in_link:
                links += len(piece)
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:  # a comment, declaration or instruction
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in INLINE:
                pass
            elif tag in ("p", "br"):
                flush()
                if stack[-1][0] == tag:
                    stack.pop()
            else:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        in_link = 0
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            parts.append(" ")
            continue
        if tag in SKIPPED:
            if tag != "svg" or not m[3].endswith("/"):
                at = _after(page, at, tag, {x[0] for x in stack[1:]} | ({"a"} if in_link else set()))
            if tag not in ("svg", "canvas"):
                parts.append(" ")
            continue
        if tag == "a":
            in_link += 1
        elif tag == "br" or tag == "wbr":
            if tag == "br":
                parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag not in INLINE:
            flush()
            closes = SELF_CLOSING.get(tag, ())
            if stack[-1][0] in closes or tag in CLOSES_P and stack[-1][0] == "p":
                stack.pop()
                if tag == "tr" and stack[-1][0] == "tr":
                    stack.pop()
            if not m[3].endswith("/"):
                boxes += 1
                _, cost, _, article, listing = stack[-1]
                cost, listing = _element_cost(tag, m[3], cost, article, listing)
                stack.append((tag, cost, boxes, article or tag in ("article", "main"), listing))
    flush()
    return out


def cost_of(b: Block) -> float:
    """Evidence for content less evidence for boilerplate."""
    n = len(b.text)
    score = b.cost + BLOCK_COST.get(b.tag, 0.0)
    score += -0.8 if n < 25 else 0.0 if n < 60 else 0.8 if n < 150 else 1.6
    score -= 4.0 * min(1.0, b.links / n)
    if n >= 25 and b.text[-1] in ".!?…:;\"'”»)":
        score += 0.6
    return score


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            edges.append((i - 1, i, ADJACENT / (1 + abs(a.depth - b.depth))))
        if b.box in last:
            edges.append((last[b.box], i, SAME_BOX))
        last[b.box] = i
    return edges


def minimum_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut: the sum of the
    costs given up (a positive cost if False, a negative one if True) and of the
    edges cut is least."""
    n = len(cost)
    t, tie = list(cost), [0.0] * n
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
        tie[i] += w
        tie[j] += w
    label: list[bool | None] = [None] * n
    todo = [i for i in range(n) if abs(t[i]) >= tie[i] - 1e-12]
    while todo:
        i = todo.pop()
        if label[i] is not None:
            continue
        label[i] = side = t[i] >= 0
        for j, w in near[i].items():
            if label[j] is None:
                t[j] += w if side else -w
                tie[j] -= w
                if abs(t[j]) >= tie[j] - 1e-12:
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        side = _max_flow(rest, t, near, label)
        for i in rest:
            label[i] = i in side
    return label  # type: ignore[return-value]


def _max_flow(nodes: list[int], t: list[float], near: list[dict[int, float]], label: list[bool | None]) -> set[int]:
    """Shortest augmenting paths; returns the nodes the source still reaches."""
    s, e = -1, -2
    cap: dict[int, dict[int, float]] = {s: {}, e: {}}
    for i in nodes:
        cap[i] = {j: w for j, w in near[i].items() if label[j] is None}
    for i in nodes:
        cap[i][s] = cap[i][e] = cap[e][i] = 0.0
        cap[s][i] = max(0.0, t[i])
        cap[i][e] = max(0.0, -t[i])
    while True:
        back = {s: s}
        queue = deque([s])
        while queue and e not in back:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 1e-12 and v not in back:
                    back[v] = u
                    queue.append(v)
        if e not in back:
            return {v for v in back if v >= 0}
        path, v = [], e
        while v != s:
            path.append((back[v], v))
            v = back[v]
        f = min(cap[u][v] for u, v in path)
        for u, v in path:
            cap[u][v] -= f
            cap[v][u] += f


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    keep = minimum_cut([cost_of(b) for b in blocks], edges_of(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x) for x in column(b, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [column(b, "page_id"), column(b, "url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tune(pages.sparkSession)
    rows = pick(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("bigint"))
    return rows.mapInArrow(frugal(_extract), "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
