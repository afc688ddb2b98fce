"""Main text of HTML pages by tag-path ratios.

A page's text is split into nodes, each with its path of tags from the root. For every path the text length, the
punctuation marks, the nodes and the spread of the nodes' lengths are aggregated; text per node and punctuation per node
are fused with the spread into one ratio, lowered by the share of linked text. The ratios are smoothed with a Gaussian
over the page's order of nodes, and nodes above a threshold from the page's own ratios are selected: the content is the
deepest element that holds all of them, or the outermost article or main element around it. Its blocks are the main text,
without parts that a tag, class, id or role marks as no part of an article, and without blocks of links that hold no
selected node. A word does not drop the element that holds most of the selected text.

Rows: a null page is an empty one and has an empty text. Pages without any text node above the threshold give the text
of their article, main or body element. Repeated rows get a row each, and an empty table none. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, rows_of

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S).finditer
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""").findall
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？¿¡]").findall

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noscript iframe".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that are pieces of a text and never the whole.
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 hgroup li ul ol dl dt dd blockquote pre address figure figcaption details summary table caption thead tbody tfoot tr td th".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html li tbody td tfoot th thead tr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}}
#: Elements whose text is no part of an article.
DROPPED = frozenset("head script style noscript template iframe object svg math nav footer aside form button select textarea input label dialog menu canvas audio video search".split())
#: The same by words in class, id or role: names that say it as a whole, and names made with a word that says it.
_MARKED = re.compile(
    r"(?:^|\s)(?!(?:has|have|with|without|no|not|is|can|show|hide|toggle|overflow)[_-])(?:(?:side|notices?|alert|modal|overlay|widget|skip|dialog|form|hidden)(?=$|\s)"
    r"|(?:[^\s]*[_-])?(?:ads?|adv|advert\w*|banner|sponsor\w*|promo\w*|sidebar|nav\w*|menu|breadcrumbs?|toolbar|pagination|pager|footer|masthead|topbar|cookies?|consent|gdpr|popup|subscri\w*|newsletter|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|replies|reply|discussion|copyright|complementary|contentinfo|navigation)(?=$|[\s_-]))",
    re.I,
).search
#: Names that say how a page is laid out around its article.
_LAYOUT = re.compile(r"(?:^|\s)(?:has|have|with|without|no|not|is|can|show|hide|toggle|overflow)[_-]", re.I).search
#: Words that a part of an article does not have, even if it is long.
_FOREIGN = re.compile(r"(?:^|\s)(?:comment|advert|cookie|sidebar)|(?:^|[\s_-])(?:adv|sponsor\w*|sidebar|nav\w*|menu|breadcrumbs?|pagination|pager|footer|masthead|cookies?|gdpr|newsletter|related|comments?|commentlist|disqus|replies)(?=$|[\s_-])", re.I).search

DEEPEST = 512  #: elements beyond hang on the last one above, so that no way up is longer
WHOLE = ("html", "body", "article", "main")


class Element:
    __slots__ = ("tag", "parent", "holder", "path", "dropped", "marked", "foreign", "weight", "depth", "in_article", "order", "list")

    def __init__(self, tag: str, holder: "Element | None", marked: bool, foreign: bool, hidden: bool, order: int, paths: dict):
        parent = holder.parent if holder and holder.depth >= DEEPEST else holder
        self.tag, self.parent, self.holder, self.order = tag, parent, holder, order
        self.path = paths.setdefault((parent.path if parent else -1, tag), len(paths))  # a number for the tags from the root
        self.list = order if tag in ("ul", "ol", "menu") else holder.list if holder else 0
        self.depth = parent.depth + 1 if parent else 0
        self.in_article = bool(holder and holder.in_article) or tag in ("article", "main")
        self.dropped = bool(holder and holder.dropped) or tag in DROPPED or hidden and tag not in WHOLE or tag == "header" and not (holder and holder.in_article)
        self.marked = marked and tag not in WHOLE  # a word alone; settle() says what it drops
        self.foreign = foreign
        self.weight = 0.0


def parse(page: str, made: list[Element] | None = None) -> Iterator[tuple[str, Element, int, bool]]:
    """(text, element, block, linked) of each text node in page order; block numbers change at block elements. Elements are added to ``made``."""
    paths: dict[tuple[int, str], int] = {}
    root = top = Element("", None, False, False, False, 0, paths)
    stack, block, links, order = [root], 0, 0, 0
    raw_end = None
    at = 0
    lower = None
    for m in _TOKEN(page):
        if m.start() < at:
            continue
        name = m[2]
        if name is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                yield text, top, block, links > 0
            elif text.startswith("<![CDATA["):
                yield text[9:].removesuffix("]]>"), top, block, links > 0
            continue
        name = name.lower()
        if m[1]:
            if name in ("br", "hr"):
                yield " ", top, block, links > 0
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    for x in stack[k:]:
                        links -= x.tag == "a"
                    del stack[k:]
                    top = stack[-1]
                    break
                if stack[k].tag in ("td", "th", "table", "body") and name not in BLOCK:
                    break
            block += name in BLOCK
            continue
        if name in BLOCK:
            block += 1
        if name in CLOSES_P or name in CLOSED_BY:
            closed, stops = CLOSED_BY.get(name, ()), STOPS.get(name, ())
            cut = None
            for k in range(len(stack) - 1, 0, -1):
                tag = stack[k].tag
                if tag in closed or tag == "p" and name in CLOSES_P:
                    cut = k
                    if tag == "p" or name not in ("tr", "tbody", "tfoot"):
                        break
                if tag in stops or tag in ("article", "body", "main", "section", "table", "blockquote"):
                    break
                if name not in CLOSED_BY and tag in BLOCK:
                    break
            if cut is not None:
                for x in stack[cut:]:
                    links -= x.tag == "a"
                del stack[cut:]
                top = stack[-1]
        attrs = m[3]
        if name in VOID:
            yield " ", top, block, links > 0
            continue
        if name in RAW:
            if lower is None:
                lower = page.lower()
            end = lower.find("</" + name, m.end())
            at = len(page) if end < 0 else end
            continue
        if attrs.endswith("/") and name not in BLOCK:
            continue
        marked = foreign = hidden = False
        if attrs and not attrs.isspace():
            said = {k.lower(): x or y or z for k, x, y, z in _ATTR(attrs)}
            words = " ".join(said.get(k, "") for k in ("class", "id", "role"))
            foreign = bool(_FOREIGN(words))
            marked = bool(_MARKED(words)) or foreign and not _LAYOUT(words)
            hidden = "hidden" in said or said.get("aria-hidden") == "true" or "display:none" in said.get("style", "").replace(" ", "")
        order += 1
        top = Element(name, top, marked, foreign, hidden, order, paths)
        if made is not None:
            made.append(top)
        stack.append(top)
        links += name == "a"


def path_ratios(nodes: list[tuple[str, Element, int, bool]]) -> np.ndarray:
    """The fused ratio of each node's path."""
    paths: dict[int, list[int]] = {}
    for k, (_, e, _, _) in enumerate(nodes):
        paths.setdefault(e.path, []).append(k)
    length = np.array([len(t) for t, _, _, _ in nodes], float)
    marks = np.array([len(_PUNCT(t)) for t, _, _, _ in nodes], float)
    linked = np.array([len(t) if a else 0 for t, _, _, a in nodes], float)
    out = np.zeros(len(nodes))
    for own in paths.values():
        n, text, punct = len(own), length[own].sum(), marks[own].sum()
        out[own] = text / n * (1 + punct / n) * (1 + length[own].std() / max(1.0, text / n)) * (1 - linked[own].sum() / text) ** 2
    return out


def smooth(x: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian over neighbours, renormalised at the ends."""
    r = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(x, kernel)[r : r + len(x)] / np.convolve(np.ones(len(x)), kernel)[r : r + len(x)]


def common(elements: list[Element]) -> Element:
    """The deepest element that holds all of ``elements``."""
    held = elements[0]
    for e in elements[1:]:
        while held is not e:
            if held.depth >= e.depth:
                held = held.parent
            else:
                e = e.parent
    return held


def weights(nodes: list[tuple[str, Element, int, bool]], threshold: float) -> tuple[list[float], list[bool]]:
    """The weight of each node, 0 if it is not selected, and whether its path alone, without its neighbours, selects it."""
    ratios = path_ratios(nodes)
    inner = np.array([3.0 if e.in_article else 1.0 for _, e, _, _ in nodes])
    smoothed = np.maximum(smooth(ratios), ratios * 0.5) * inner
    least = threshold * smoothed.mean()
    return np.where(smoothed >= least, smoothed * np.array([len(t) for t, _, _, _ in nodes]), 0.0).tolist(), (ratios * inner >= least).tolist()


def around(e: Element | None) -> Iterator[Element]:
    """The element and all around it."""
    while e is not None:
        yield e
        e = e.parent


def settle(made: list[Element], nodes: list[tuple[str, Element, int, bool]], threshold: float) -> None:
    """Drop what words mark, but not what holds the page's article: around its main or article elements nothing is, and
    within them, or on the whole page if it has none, no element with most of the text that the ratios select, unless it
    stands in an article and its words are no article's.
    """
    if any(e.marked for e in made):
        outer = [next((x for x in reversed([*around(e)]) if x.tag in ("article", "main")), None) for _, e, _, _ in nodes]
        for (t, *_), x in zip(nodes, outer, strict=True):
            if x:
                x.weight += len(t)
        held = {x.order: x for x in outer if x}
        scope = {k for k, x in held.items() if not any(y.marked for y in around(x))}
        if not scope and held:
            best = max(held.values(), key=lambda x: (x.tag == "main", x.weight, -x.depth))
            if best.tag == "main" or 2 * best.weight >= sum(len(t) for t, *_ in nodes):  # else such as a comment in an article element of its own
                scope = {best.order}
                for x in around(best):
                    x.marked = False
        own = [n for n, x in zip(nodes, outer, strict=True) if x and x.order in scope] if scope else nodes
        total: dict[Element, float] = {}
        every = weights(own, threshold)[0] if own else []
        for (_, e, _, _), w in zip(own, every, strict=True):
            for x in around(e):
                total[x] = total.get(x, 0.0) + w
        for x in made:
            if x.marked and total.get(x, 0.0) > 0.5 * sum(every) and not (scope and x.foreign):
                x.marked = False
    for x in made:  # holders come first
        x.dropped = x.dropped or x.marked or bool(x.holder and x.holder.dropped)


def menus_in(container: Element, nodes: list[tuple[str, Element, int, bool]], alone: list[bool]) -> set[Element]:
    """Blocks within the container that hold no node whose path is selected, and three or more links that make up most of their text."""
    held: dict[Element, list[float]] = {}
    for (t, e, _, linked), w in zip(nodes, alone, strict=True):
        way = [*around(e)]
        if container in way:
            for x in way[: way.index(container)]:
                if x.tag in BLOCK and (x.tag not in PIECES or x.tag in ("ul", "ol", "dl", "table")):
                    n = held.setdefault(x, [0, 0, 0, 0])
                    n[0], n[1], n[2], n[3] = n[0] + len(t), n[1] + len(t) * linked, n[2] + linked, n[3] + w
    return {x for x, (n, a, links, w) in held.items() if links >= 3 and 2 * a > n and not w}


def extract(page: str | None, threshold: float = 0.5) -> str:
    """The main text of one page."""
    if not page:
        return ""
    made: list[Element] = []
    every = [*parse(page, made)]
    nodes = [(x, e, b, a) for t, e, b, a in every if not e.dropped and (x := " ".join(html.unescape(t).split()))]
    settle(made, nodes, threshold)
    nodes = [x for x in nodes if not x[1].dropped]
    if not nodes:
        return ""
    weight, alone = weights(nodes, threshold)
    chosen = [e for (_, e, _, _), w in zip(nodes, weight, strict=True) if w]
    container = common(chosen or [e for _, e, _, _ in nodes])  # no node counts if all text is linked
    while container.parent is not None and (container.tag in PIECES or container.tag not in BLOCK):  # its neighbours belong to the text too
        container = container.parent
    up = container
    while up is not None:  # the outermost article or main element around it is the natural bound
        if up.tag in ("article", "main") or up.tag == "body" and not chosen and container.tag not in ("article", "main"):
            container = up
        up = up.parent
    menus = menus_in(container, nodes, alone) if chosen else set()
    blocks: dict[int, list[str]] = {}
    inside: dict[Element, bool] = {}
    for t, e, b, _ in every:
        if e not in inside:
            way = [*around(e)]
            inside[e] = container in way and not e.dropped and menus.isdisjoint(way)
        if inside[e]:
            blocks.setdefault(b, []).append(html.unescape(t))
    out = [" ".join("".join(parts).split()) for parts in blocks.values()]
    return "\n".join(x for x in out if x)


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    prepare(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [extract(x) for (x,) in rows_of(b, "html")]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
