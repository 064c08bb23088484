"""Main text of web pages by tree scoring.

A page is parsed into a tree.  Elements that are never article text (menus,
scripts, adverts and the like, by element, role or class) are taken out; a form is, unless it
holds most of the page's text.  A class speaks against an element only as a whole, as in `share` or
`cookie-banner`; a mere part of it, as in `share-price`, or an id inside an article (other than that of readers' comments) is a weak
vote: it takes points off, and the element goes only if it is list-like or full of links.  If nothing is left without
the elements taken out by class or id, they come back.  Each
paragraph then gives points for being there, for its commas and for its length
to its ancestors, less to the more distant ones; an ancestor's points are
discounted by its link density, the share of its text inside links.  The best
container is kept, widened to the article or main part it lies in, together with siblings
that score nearly as well or read like paragraphs; articles side by side are judged by their own points.

Defined cases: null and empty html give the empty text, and so does a page without
any text in its body; unclosed elements end where HTML ends them, an unclosed svg, math,
template or noscript at once; a page that breaks
off inside a tag, comment or script ends before it; repeated rows give repeated results.
"""

from __future__ import annotations

import re
import sys
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 1 << 22

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
CLOSES_P = BLOCKS - frozenset("caption dd dt li option tbody td tfoot th thead tr body html".split())
P_SCOPE = frozenset("button caption html object table td th".split())
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])), "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])), "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
NEVER = frozenset("head nav footer aside button select input dialog menu object embed audio video canvas map dir".split())
NEVER_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert menu menubar toolbar tablist form".split())
KEPT = frozenset("html body article main".split())

# Words in class and id names of what is no article text.
NEVER_NAMES = frozenset(
    """ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies
    disclaimer disqus footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay pager
    pagination paywall popup promo promoted promotion recommendations recommended related replies responses rss search share sharebar sharing sidebar
    signup skip social sponsor sponsored subscribe subscription taboola toolbar widget""".split()
)
#: Words that may stand beside them in a class that is made of several words.
NEUTRAL_NAMES = frozenset(
    """area bar block bottom box button buttons card cell col container content div first form global group header holder icon icons id inline inner
    item items js last layer left link links list main message meta module outer page panel post posts right row section site slot sm text
    title top ui unit user view wrap wrapper zone""".split()
)
#: Of these a page keeps nothing, whatever else it holds.
READERS = frozenset("comment commentlist comments disqus replies responses".split())
GOOD_NAMES = frozenset("article body content entry main post story text".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd section div article main body".split())
BASE = {"article": 15.0, "main": 10.0, "div": 5.0, "section": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}
BASE |= dict.fromkeys("address ol ul dl dd dt li".split(), -3.0) | dict.fromkeys("h1 h2 h3 h4 h5 h6 th".split(), -5.0)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

LEAST_PARAGRAPH = 25
SENTENCE_END = re.compile("""[.!?:;\u2026\u3002\uff01\uff1f]["'\u2019\u201d\u00bb)]*$""")
COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("by_name", "children", "commas", "doubted", "links", "names", "parent", "score", "size", "tag")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.parent, self.names = tag, parent, names
        self.by_name = self.doubted = False
        self.children: list[Node | str] = []
        self.score, self.size, self.links, self.commas = 0.0, 0, 0, 0


def _words(token: str) -> list[str]:
    return [w.lower() for w in NAME_WORD.findall(token)]


def _speaks_against(token: str) -> bool:
    """Whether a whole class or id is the name of what is no article text: its words are, but for neutral ones."""
    words = set(_words(token))
    return bool(words & NEVER_NAMES) and words <= NEVER_NAMES | NEUTRAL_NAMES


def _judged(tag: str, attributes: str, in_article: bool) -> tuple[str, frozenset[str]]:
    """What tag and attributes say of an element ("gone", "named", "doubted" or nothing), and the words of its class and id."""
    if tag in NEVER or (tag == "header" and not in_article):
        return "gone", frozenset()
    if not attributes or attributes.isspace():
        return "", frozenset()
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    classes, own = unescape(found.get("class", "")).split(), unescape(found.get("id", "")).split()
    names = frozenset(w for t in classes + own for w in _words(t))
    if tag in KEPT:
        return "", names
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or INVISIBLE.search(found.get("style", ""))
    if hidden or found.get("role", "").lower() in NEVER_ROLES:
        return "gone", names
    if in_article:  # ids of headings are made of their text, but a container of readers' comments is named for them
        own = [t for t in own if tag in ("div", "section", "ol", "ul") and set(_words(t)) & READERS]
    if any(map(_speaks_against, classes + own)) or (not in_article and "header" in names):
        return "named", names
    return "doubted" if names & NEVER_NAMES else "", names


def parse(html: str) -> Node:
    """The tree of a page, with marks (score -1) on elements that are never article text."""
    root = Node("html", None)
    stack, at, lowered = [root], 0, None
    articles = 0
    while at < len(html):
        m = TOKEN.search(html, at)
        if not m:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag or not m[4]:  # a comment or the like; a page that ends inside a tag
            continue
        tag = tag.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    articles -= sum(n.tag in ("article", "main") for n in stack[k:])
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            if m[3].endswith("/") and tag in ("svg", "math"):
                continue
            lowered = html.lower() if lowered is None else lowered
            end = lowered.find(f"</{tag}", at) if len(lowered) == len(html) else _find(html, tag, at)
            if end < 0:
                if tag in ("svg", "math", "template", "noscript"):  # never closed: taken as empty
                    continue
                break
            at = html.find(">", end) + 1 or len(html)
            stack[-1].children.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        close = None
        if tag in CLOSES_P:
            close = (frozenset(["p"]), P_SCOPE)
        elif tag in CLOSED_BY:
            close = CLOSED_BY[tag]
        if close:
            cut = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in close[1]:
                    break
                if stack[k].tag in close[0]:
                    cut = k
                    if stack[k].tag == tag or tag not in ("tr",):
                        break
            if cut:
                articles -= sum(n.tag in ("article", "main") for n in stack[cut:])
                del stack[cut:]
        verdict, names = _judged(tag, m[3], articles > 0)
        node = Node(tag, stack[-1], names)
        node.by_name, node.doubted = verdict == "named", verdict == "doubted"
        if verdict in ("gone", "named") or tag == "form":
            node.score = -1.0
        stack[-1].children.append(node)
        if tag not in VOID:
            stack.append(node)
            articles += tag in ("article", "main")
    return root


def _find(html: str, tag: str, at: int) -> int:
    m = re.compile(f"</{tag}", re.I).search(html, at)
    return m.start() if m else -1


def _ordered(root: Node) -> list[Node]:
    """All elements that are not dropped, parents first and in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str) and c.score >= 0]
    return out


def _size(node: Node) -> int:
    """Length of the text of an element and all below it that is not taken out, links left out."""
    size, todo = 0, [node]
    while todo:
        for c in todo.pop().children:
            if isinstance(c, str):
                size += len(c.strip())
            elif c.score >= 0 and c.tag != "a":
                todo.append(c)
    return size


def _prune(root: Node) -> None:
    """Take the mark off elements that hold an article or the main part, and off a form with most of the page's text."""
    todo, forms = [root], []
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main"):
            up = node.parent
            while up is not None:
                if up.score < 0 and up.tag not in ("nav", "footer", "aside", "head") and not up.names & {"comment", "comments", "related", "sidebar", "recommended"}:
                    up.score = 0.0
                up = up.parent
        if node.tag == "form" and node.score < 0 and not node.by_name:
            forms.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    for form in forms:
        if 2 * _size(form) > _size(root) + _size(form):
            form.score = 0.0


def _drop_doubted(nodes: list[Node]) -> bool:
    """Take out the elements with a weak vote against them that are full of links or lists of short items; whether there were any."""
    found = False
    for node in nodes:
        if node.doubted and node.tag not in KEPT and node.size and (density(node) > 0.4 or _list_like(node)):
            node.score, node.by_name, found = -1.0, True, True
    return found


def _list_like(node: Node) -> bool:
    items = [c for c in node.children if not isinstance(c, str) and c.score >= 0]
    inner = [g for c in items if c.tag in ("ul", "ol") for g in c.children if not isinstance(g, str)]
    items = inner if node.tag not in ("ul", "ol") else items
    return len(items) >= 2 and sum(i.size for i in items) >= 0.8 * node.size and node.size < 40 * len(items) and node.links > 0


def measure(nodes: list[Node]) -> None:
    """Length of text, of text in links, and commas, of every element with all below it."""
    for node in reversed(nodes):
        for c in node.children:
            if isinstance(c, str):
                text = c.strip()
                node.size += len(text)
                node.commas += len(COMMAS.findall(text)) if "," in text or not text.isascii() else 0
            elif c.score >= 0:
                node.size += c.size
                node.links += c.links
                node.commas += c.commas
        if node.tag == "a":
            node.links = node.size


def _own_text(node: Node) -> tuple[int, int]:
    """Length and commas of the text of an element outside the blocks in it."""
    size = commas = 0
    for c in node.children:
        if isinstance(c, str):
            size += len(c.strip())
            commas += len(COMMAS.findall(c))
        elif c.score >= 0 and c.tag not in BLOCKS and c.tag != "a":
            size += c.size
            commas += c.commas
    return size, commas


def density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def best(nodes: list[Node]) -> Node | None:
    """The container with the most points; of equal ones the first in page order."""
    points: dict[int, float] = {}
    named: dict[int, Node] = {}
    for node in nodes:
        if node.tag not in PARAGRAPHS:
            continue
        size, commas = _own_text(node)
        if size < LEAST_PARAGRAPH:
            continue
        gain = 1 + commas + min(size / 100, 3.0)
        up, level = (node.parent if node.tag not in ("article", "main", "div", "section") else node), 0
        while up is not None:
            share = 1.0 if level == 0 else 0.5 if level == 1 else 1 / (3 * level)
            if id(up) not in points:
                named[id(up)] = up
                points[id(up)] = BASE.get(up.tag, 0.0) + (10.0 if up.names & GOOD_NAMES else 0.0) - (10.0 if up.doubted else 0.0)
            points[id(up)] += gain * share
            up, level = up.parent, level + 1
    top, most = None, 0.0
    for node in nodes:
        if id(node) in points:
            node.score = max(0.0, points[id(node)] * (1 - density(node)))
            if node.score > most and node.tag != "html":
                top, most = node, node.score
    return top


def _reads_like_text(node: Node) -> bool:
    if node.tag in ("div", "section", "blockquote") and not node.doubted:
        return node.size > 80 and density(node) < 0.25 and bool(SENTENCE_END.search(blocks(node)[-1]))
    return node.tag == "p" and (density(node) < 0.25 if node.size > 80 else node.links == 0 and 0 < node.size)


def _beside(part: Node, least: float) -> list[Node]:
    """An article or main part with the articles beside it that have enough points of their own, in page order."""
    if part.parent is None or part.tag != "article":
        return [part]
    return [c for c in part.parent.children if not isinstance(c, str) and c.score >= 0 and (c is part or (c.tag == "article" and density(c) < 0.25 and c.score - BASE["article"] >= least))]


def chosen(root: Node, nodes: list[Node]) -> list[Node]:
    """The elements whose text is the article, in page order."""
    top = best(nodes)
    if top is None:
        return [next((n for n in nodes if n.tag in ("article", "main") and n.size), root)]
    least = max(10.0, top.score * 0.2)
    up = top
    while up is not None:
        if up.tag in ("article", "main"):
            return _beside(up, least)
        up = up.parent
    if top.parent is None:
        return [top]
    return [c for c in top.parent.children if not isinstance(c, str) and c.score >= 0 and (c is top or (c.score >= least and density(c) < 0.5) or _reads_like_text(c) or re.fullmatch("h[1-6]", c.tag))]


def blocks(node: Node) -> list[str]:
    """Texts of the blocks of an element, white space turned into single spaces."""
    out: list[str] = []
    line: list[str] = []

    def close():
        text = " ".join(unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            line.append(item)
        elif item.score >= 0:
            if item.tag == "br":
                line.append(" ")
            elif item.tag in BLOCKS:
                close()
                todo.append(None)
            todo += reversed(item.children)
    close()
    return out


def main_text(html: str | None) -> str:
    """Blocks of the article joined by line feeds."""
    if not html:
        return ""
    root = parse(html)
    _prune(root)
    text = _article(root)
    if not text and (named := [n for n in _all(root) if n.by_name and not n.names & READERS]):
        for node in named:
            node.score, node.by_name, node.doubted = 0.0, False, False
        text = _article(root)
    return text


def _all(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        out.append(todo.pop())
        todo += [c for c in out[-1].children if not isinstance(c, str)]
    return out


def _measured(root: Node) -> list[Node]:
    nodes = _ordered(root)
    for node in nodes:
        node.score, node.size, node.links, node.commas = 0.0, 0, 0, 0
    measure(nodes)
    return nodes


def _article(root: Node) -> str:
    nodes = _measured(root)
    if any(n.doubted for n in nodes) and _drop_doubted(nodes):
        nodes = _measured(root)
    return "\n".join(text for node in chosen(root, nodes) for text in blocks(node))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, `text` and `n_chars` (its code points) of every page."""

    def run(batches):
        for batch in batches:
            texts, size, first = [], 0, 0
            html = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                texts.append(main_text(html[i].as_py()))
                size += len(texts[-1]) + 16
                if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                    kept = [batch.column(k).slice(first, len(texts)) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)
                    texts, size, first = [], 0, i + 1

    rows = pages.select(*[pages[f"`{c}`"].alias(f"kept {i}") for i, c in enumerate(keep)], pages[f"`{html_col}`"].alias("html of a row"))
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names
    return rows.mapInArrow(run, schema)
