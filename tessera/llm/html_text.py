"""HTML extraction by composite text density.

A lenient parser builds the tree, in time linear in the page. Elements that are never article text go
(scripts, styles, forms, menus, and what its class, id or role calls an advert, a notice, a sidebar or
reader comments), but not where they wrap the article. For each node left, characters per tag are adjusted
by the share of link characters and link tags (the composite text density); the node whose children's
densities sum highest holds the main text. The least density on its path to the body is the threshold: the
selection widens to an ancestor as long as some other block beside it reaches that threshold or is a
headline. Where the page marks one article, the selection widens to that.

A wrapper is an element that holds the unmarked article or main element or, on a page without one, more
than half of all characters outside links; menus, footers and headers only by the first. Inside the
article, a block of text (a paragraph, a headline, a list item) goes only if each name of a class, id or
role says so in all its parts: "ad-box" does, "legal-history" doesn't.

Text: character references are decoded once, within each run of text; white space in a block (no-break
spaces too) becomes one space, blocks are trimmed, empty ones go, one newline joins them. A line break is
white space.

Defined cases: null and empty pages, and pages without text, give an empty text; text outside any element
is in the body; unclosed and misnested tags close with their parent; a quote that nothing closes ends a tag
at the next ">"; repeated rows give repeated texts; nesting deeper than DEEP is flattened, losing no text;
an empty table gives no rows; a kept column named like the output is refused.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEEP = 400
#: Fixed values of HTML: elements by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
ENDS_P = BLOCK - {"body", "html", "caption", "dd", "dt", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "figcaption"} | {"li", "dd", "dt"}
#: Elements that are never article text, and words in class, id or role that mark them.
DROP = frozenset("script style noscript template iframe object embed svg canvas audio video form button select option textarea input label fieldset nav footer aside dialog menu head title xmp noembed noframes map".split())
MARKS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adbox adsense sponsor sponsored sponsors promo promos promotion banner banners nav navbar navigation menu menus menubar breadcrumb breadcrumbs toolbar pagination pager footer foot header masthead topbar sidebar side aside rail complementary contentinfo comment comments commentlist commentary disqus respond replies reply discussion discuss cookie cookies consent gdpr notice notices notification notifications alert disclaimer popup modal overlay lightbox dialog newsletter subscribe subscription signup signin login register paywall share sharing social related recommended recommendations teaser teasers trending popular search searchbox form widget widgets skip hidden tooltip outbrain taboola copyright legal".split())
WHOLE = frozenset(("html", "body", "article", "main"))
#: Elements that may wrap an article, by holding it or most text, and by holding it only.
WRAPS = frozenset("form fieldset label dialog button video audio object".split())
FRAMES = frozenset("nav footer aside menu header".split())
#: Blocks of text, and parts of names that say nothing of an element's kind.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption span em strong b i a q cite code".split())
NEUTRAL = frozenset("box container wrap wrapper block inner outer slot list area section bar unit content link links item items title text label row col column left right top bottom main new js c l u s m the this it is in on of article articles post posts page site".split())

_EVENT = re.compile(r"[>\"']")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("article", "chars", "density", "kids", "link_chars", "link_tags", "marked", "parent", "sum", "tag", "tags", "title", "wholly")

    def __init__(self, tag: str, parent: Node | None, marked: bool = False, wholly: bool = False):
        self.tag, self.parent, self.marked, self.wholly = tag, parent, marked, wholly
        self.kids: list[Node | str] = []


def _marks(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element isn't article text by its attributes, and whether all of a name says so."""
    if not attrs or tag in WHOLE:
        return False, False
    some = False
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        if name == "hidden":
            return True, True
        value = m[2] or m[3] or m[4] or ""
        if name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, True
        if name in ("class", "id", "role"):
            for part in html.unescape(value).split():
                words = [w.lower() for w in _WORD.findall(part)]
                if any(w in MARKS for w in words):
                    some = True
                    if all(w in MARKS or w in NEUTRAL for w in words):
                        return True, True
    return some, False


def tokens(page: str) -> Iterator[tuple[str, bool, str, int]]:
    """("", False, text, end) for text and (name, closes, attributes, end) for tags; a caller may send where to go on.

    Each quote opens a quoted stretch once at most in all tags that find no end, so the time is linear.
    """
    n, at, text = len(page), 0, 0
    dead: set[int] = set()  # where a tag that found no end had a quote open
    ahead: dict[str, tuple[int, int]] = {}  # from where a string was sought, and where it is; n if nowhere

    def find(what: str, start: int) -> int:
        since, k = ahead.get(what, (n, -1))
        if not since <= start <= k:
            k = page.find(what, start)
            k = n if k < 0 else k
            ahead[what] = (start, k)
        return k if k < n else -1

    def tag_end(start: int) -> int:
        """Where the > is that ends the tag whose attributes begin here, -1 if none does."""
        if find(">", start) < 0:
            return -1
        k, met = start, []
        while m := _EVENT.search(page, k):
            i = m.start()
            if m[0] == ">":
                return i
            if i in dead:
                break
            met.append(i)
            close = find(m[0], i + 1)
            k = close + 1 if close >= 0 else i + 1
        dead.update(met)
        return find(">", start)

    while at < n:
        i = page.find("<", at)
        if i < 0:
            break
        following = page[i + 1 : i + 2]
        name, closes, attrs, stop = "", False, "", -1
        if page.startswith("<!--", i):
            if page.startswith((">", "->"), i + 4):
                stop = page.find(">", i)
            else:
                ends = [(k, len(x)) for x in ("-->", "--!>") if (k := find(x, i + 4)) >= 0]
                stop = min(k + size - 1 for k, size in ends) if ends else n
        elif following in ("!", "?") or following == "/" and not _NAME.match(page, i + 2):
            stop = find(">", i)
            stop = n if stop < 0 else stop
        else:
            closes = following == "/"
            m = _NAME.match(page, i + 1 + closes)
            stop = tag_end(m.end()) if m else -1
            if stop < 0:  # a mere < in the text
                at = i + 1
                continue
            name, attrs = m[0].lower(), page[m.end() : stop]
        if i > text:
            yield "", False, page[text:i], i
        at = text = min(stop + 1, n)
        if name:
            moved = yield name, closes, attrs, at
            if moved is not None:
                at = text = moved
    if text < n:
        yield "", False, page[text:], n


def parse(page: str) -> Node:
    """The tree under one root; strings among the children are raw text."""
    root = top = Node("html", None)
    depth, n = 0, len(page)
    names: dict[str, int] = {}

    def shut(to: Node) -> None:
        nonlocal top, depth
        while top is not to:
            names[top.tag] -= 1
            top = top.parent
            depth -= 1

    def close(tags, stops=()) -> None:
        if not any(names.get(t) for t in tags):
            return
        x = top
        while x is not root and x.tag not in stops:
            if x.tag in tags:
                shut(x.parent)
                return
            x = x.parent

    source, moved = tokens(page), None
    while True:
        try:
            tag, closes, attrs, at = source.send(moved)
        except StopIteration:
            return root
        moved = None
        if not tag:
            top.kids.append(html.unescape(attrs))
            continue
        if closes:
            if tag == "p" and not names.get("p"):
                top.kids.append(Node("p", top))
            elif tag == "br":
                top.kids.append(Node("br", top))
            elif tag not in ("html", "body"):
                close((tag,), () if tag in BLOCK else ("td", "th", "article", "main", "section"))
            continue
        if tag == "html" or tag == "body" and names.get("body"):
            continue
        if tag in ENDS_P:
            close(("p",), ("td", "th", "article", "section", "main", "li", "button", "object") if tag == "p" else ("td", "th", "button", "object"))
        if tag in CLOSES:
            close(*CLOSES[tag])
        node = Node(tag, top, *_marks(tag, attrs))
        top.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            if stop > at:
                node.kids.append(html.unescape(page[at:stop]))
            moved = (page.find(">", stop) + 1 or n) if end else n
        elif tag not in VOID and not attrs.rstrip().endswith("/") or tag in ("p", "div", "article", "section"):
            if depth < DEEP:
                names[tag] = names.get(tag, 0) + 1
                top, depth = node, depth + 1


def _survey(root: Node) -> None:
    """Fills in, for each node, what its subtree holds without dropped elements: an unmarked article, a headline, characters outside links."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [k for k in x.kids if isinstance(k, Node)]
    for x in reversed(order):
        x.article, x.title, x.chars = x.tag in ("article", "main") and not x.marked, x.tag == "h1", 0
        for k in x.kids:
            if isinstance(k, str):
                x.chars += len("".join(k.split()))
            elif k.tag not in DROP or k.tag in WRAPS or k.tag in FRAMES:
                x.article |= k.article
                x.title |= k.title
                x.chars += k.chars
        if x.tag == "a" or x.tag in FRAMES and x.tag != "header":
            x.chars = 0


def prune(root: Node) -> None:
    """Takes out what isn't article text: by tag or by its marks, but not what wraps the article or holds its headline."""
    _survey(root)
    todo = [(root, False)]
    while todo:
        x, inside = todo.pop()
        inside |= x.tag in ("article", "main")
        kids = []
        for k in x.kids:
            if isinstance(k, Node):
                drop = k.tag in DROP
                if drop and k.tag not in WRAPS and k.tag not in FRAMES:
                    continue
                if drop or k.tag == "header" or (k.wholly if inside and k.tag in TEXT else k.marked):
                    most = not root.article and k.tag not in FRAMES and 2 * k.chars > root.chars
                    if not (k.article or most or inside and k.title and not drop):
                        continue
                todo.append((k, inside))
            kids.append(k)
        x.kids = kids


def measure(root: Node) -> tuple[Node, list[Node]]:
    """Fills in the counts and densities; returns the body (or the root) and all nodes, parents first."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [k for k in x.kids if isinstance(k, Node)]
    for x in reversed(order):
        x.chars = x.tags = x.link_chars = x.link_tags = 0
        for k in x.kids:
            if isinstance(k, str):
                x.chars += len("".join(k.split()))
            else:
                x.chars += k.chars
                x.tags += k.tags + 1
                x.link_chars += k.link_chars
                x.link_tags += k.link_tags + (k.tag == "a")
        if x.tag == "a":
            x.link_chars = x.chars
    body = next((x for x in order if x.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for x in order:
        if not x.chars:
            x.density = 0.0
            continue
        tags, link_chars, link_tags = max(x.tags, 1), max(x.link_chars, 1), max(x.link_tags, 1)
        base = math.log(x.chars / max(x.chars - x.link_chars, 1) * x.link_chars + share * x.chars + math.e)
        x.density = x.chars / tags * math.log(max(x.chars / link_chars * tags / link_tags, 1.0)) / math.log(max(base, 1.0001))
    for x in order:
        x.sum = sum(k.density for k in x.kids if isinstance(k, Node))
    return body, order


def select(body: Node, order: list[Node]) -> Node:
    """The subtree that holds the main text."""
    if not body.chars:
        return body
    best = max((x for x in order if _within(x, body)), key=lambda x: x.sum)
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    least = min(x.density for x in path)
    chosen = 0
    marked = [x for x in order if x.tag == "article"] or [x for x in order if x.tag == "main"]
    for i in range(1, len(path)):
        beside = [k for k in path[i].kids if isinstance(k, Node) and k is not path[i - 1] and k.tag in BLOCK]
        if marked == [path[i]] or any(k.chars and k.density >= least and k.link_chars * 2 < k.chars for k in beside) or any(k.tag == "h1" for k in beside):
            chosen = i
    return path[chosen]


def _within(x: Node, body: Node) -> bool:
    while x is not None and x is not body:
        x = x.parent
    return x is body


def blocks(node: Node) -> list[str]:
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split()) if line else ""
        line.clear()
        if text:
            out.append(text)

    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag in ("br", "hr"):
            line.append(" ")
        elif x.tag in BLOCK:
            end()
            todo.append(None)
            todo += reversed(x.kids)
        else:
            todo += reversed(x.kids)
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    return "\n".join(blocks(select(*measure(root))))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), out: str = "text") -> DataFrame:
    """keep and the main text of each whole page."""
    if out in keep:
        raise ValueError(f"rename {out}: the texts have a column of this name")
    schema = T.StructType([pages.schema[k] for k in keep] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(v.as_py()) for v in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(keep))] + [pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*keep, html_col).mapInArrow(run, schema)
