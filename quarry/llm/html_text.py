"""Main text of HTML pages by composite text density.

A page is parsed into a tree.  For every block node the density is its characters per tag,
adjusted by the share of characters and tags in links (composite text density); a node's density
sum adds the densities of its children.  The subtree with the largest density sum is the article;
the least density on the path from it to the body is the threshold that further subtrees, off
that path, must reach.  Menus, footers, forms, adverts and the like, which their element or
class names, are cut before.  A class or id alone cuts nothing in an ``article`` element or in
the chosen subtree but comments and what is mostly links, and never a heading.  If density lands in
an ``article`` or ``main`` element, that whole element is taken, so its short paragraphs stay.

Parsing takes time in proportion to the page, however broken it is: open tags are counted, so that no
end tag looks for a start that is not there, and a tag's end is looked for once from any place."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices, texts

TOKEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|/([a-zA-Z][^\s/>]*)|([a-zA-Z][^\s/>]*))")
OUTSIDE = re.compile("[^'\">]*")
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)

RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
         "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES_P = BLOCK - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
BARRIERS = {"ul", "ol", "menu", "dl", "table", "select", "body", "button"}     # implied ends reach no further
CUT = {"aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "iframe", "map", "menu",
       "nav", "noscript", "object", "search", "select", "svg", "template", "video"}
CUT_NAMES = {"ad", "ads", "advert", "advertisement", "adverts", "advertising", "banner", "breadcrumb", "breadcrumbs",
             "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer",
             "form", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pager",
             "pagination", "popup", "promo", "promotion", "recommended", "related", "respond", "search", "share",
             "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"}
COMMENT_NAMES = {"comment", "comments", "disqus", "respond"}
# Parts of a class or id that say where or what shape, not what: "sidebar-left" is a sidebar.
SHAPES = {"area", "bar", "block", "body", "bottom", "box", "container", "content", "entry", "group", "inner", "item",
          "items", "left", "list", "main", "outer", "page", "panel", "post", "posts", "right", "section", "site",
          "thread", "top", "wp", "wrap", "wrapper"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
TEXTUAL = {"blockquote", "dd", "dt", "figcaption", "figure", "li", "p", "pre", "td", "th"}
HOLDS = {"article", "main"}
FULL, PART, COMMENT = 1, 2, 3  # a name that is all junk, has a part that is, or is one of comments
ALONE = 4                      # cut by a full name, though it is not mostly links


class Node:
    __slots__ = ("tag", "parent", "items", "cut", "name", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, name: int = 0):
        self.tag, self.parent, self.cut, self.name = tag, parent, cut, name
        self.items: list[Node | str] = []
        self.chars = self.link_chars = 0

    def blocks(self) -> list[Node]:
        """Block nodes below, with inline elements seen through."""
        out, stack = [], self.items[::-1]
        while stack:
            x = stack.pop()
            if isinstance(x, Node) and not x.cut:
                if x.tag in BLOCK:
                    out.append(x)
                else:
                    stack += x.items[::-1]
        return out


def _cut(tag: str, attrs: str, inside: bool) -> bool:
    if tag in CUT or tag == "header" and not inside:
        return True
    if tag in HOLDS or tag in ("body", "html") or not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    return any(m[1].lower() == "role" and not CUT_NAMES.isdisjoint(_value(m).split()) for m in NAMES.finditer(attrs))


def _value(m: re.Match) -> str:
    return (m[2] or m[3] or m[4] or "").lower()


def _name(tag: str, attrs: str) -> int:
    """What the classes and the id of an element say of it."""
    if not attrs or tag in HEADINGS or tag in ("main", "body", "html"):
        return 0
    found = 0
    for word in (w for m in NAMES.finditer(attrs) if m[1].lower() != "role" for w in _value(m).split()):
        parts = {x for x in re.split(r"[_-]+", word) if x and not x.isdigit()}
        if CUT_NAMES.isdisjoint(parts):
            continue
        if not parts <= CUT_NAMES | SHAPES:
            found = found or PART
        elif tag in BLOCK and tag not in ("p", "pre") and not COMMENT_NAMES.isdisjoint(parts):
            return COMMENT
        else:
            found = FULL
    return found


class Open:
    """The path of open elements: how often a tag is on it, and on its part below the last element
    that ends the reach of implied end tags."""

    def __init__(self, root: Node):
        self.node, self.tags, self.reach = root, Counter(), [Counter()]

    def push(self, node: Node) -> None:
        self.node = node
        self.tags[node.tag] += 1
        self.reach[-1][node.tag] += 1
        if node.tag in BARRIERS:
            self.reach.append(Counter())

    def pop_to(self, node: Node) -> None:
        while self.node is not node:
            if self.node.tag in BARRIERS:
                self.reach.pop()
            self.tags[self.node.tag] -= 1
            self.reach[-1][self.node.tag] -= 1
            self.node = self.node.parent

    def close(self, tag: str) -> None:
        """Close the innermost element of that tag, which is open, and all in it."""
        up = self.node
        while up.tag != tag:
            up = up.parent
        self.pop_to(up.parent)


class Ends:
    """Where tags end: at a ``>`` outside quotes, or else at the next one.  Places outside quotes from
    which the former is not to be found are remembered, so that no part is searched twice in vain."""

    def __init__(self, page: str):
        self.page, self.failed = page, set()
        self.last = {c: page.rfind(c) for c in "'\">"}

    def of(self, start: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``start``; -1 if none follows."""
        if start > self.last[">"]:
            return -1
        page, at, seen = self.page, start, []
        while at not in self.failed:
            seen.append(at)
            at = OUTSIDE.match(page, at).end()
            if at == len(page):
                break
            if page[at] == ">":
                return at
            if at >= self.last[page[at]]:
                break                                       # a quote that is not closed
            at = page.index(page[at], at + 1) + 1
        self.failed.update(seen[1:])
        return page.index(">", start)


def parse(page: str) -> Node:
    """A tolerant tree of a page: unclosed and stray tags are closed or passed over."""
    root = Node("html", None)
    path, ends = Open(root), Ends(page)
    at = text = 0
    while m := TOKEN.search(page, at):
        if m[4] or m[5]:
            stop = ends.of(m.end())
            if stop < 0:                                    # a tag that never ends is text
                at = m.end()
                continue
        else:
            mark = "-->" if m[1] else "]]>" if m[2] else ">"
            stop = page.find(mark, m.end())
            stop = len(page) if stop < 0 else stop + len(mark) - 1
        if m.start() > text:
            path.node.items.append(page[text:m.start()])
        at = text = stop + 1
        if m[4]:
            tag = m[4].lower()
            if tag != "html" and path.tags[tag]:
                path.close(tag)
            elif tag == "p":
                path.node.items.append(Node("p", path.node))
            continue
        if not m[5]:
            continue
        tag, attrs = m[5].lower(), page[m.end():stop]
        if tag in RAW:
            new = Node(tag, path.node, True)
            path.node.items.append(new)
            path.push(new)
            end = re.compile(f"</{re.escape(tag)}", re.I | re.A).search(page, at)
            at = end.start() if end else len(page)
            if at > text:
                new.items.append(page[text:at])
            text = at
            continue
        if tag == "html" or tag == "body" and path.tags["body"]:
            continue
        for shut in (("p",) if tag in CLOSES_P else ()) + CLOSED_BY.get(tag, ()):
            if path.reach[-1][shut]:
                path.close(shut)
        if tag == "body":
            path.pop_to(root)
        inside = bool(path.tags["article"] or path.tags["main"])
        new = Node(tag, path.node, _cut(tag, attrs, inside), _name(tag, attrs))
        path.node.items.append(new)
        if tag not in VOID and not attrs.endswith("/"):
            path.push(new)
    if text < len(page):
        path.node.items.append(page[text:])
    return root


def _path(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def _linked(n: Node) -> bool:
    return n.link_chars * 2 >= n.chars


def _cut_names(root: Node) -> None:
    """Cut elements by class and id: junk names outside ``article`` elements; inside them, and for
    names that only have a junk part, what is mostly links; comments everywhere.  A cut element
    that holds the article is not cut (a named wrapper of the whole page)."""
    named, holds = [], []
    stack = [(root, False, False, False)]
    while stack:
        n, article, main, said = stack.pop()
        if n.name:
            named.append((n, article))
        said = said or n.name == COMMENT
        if n.tag == "article" and not article or n.tag == "main" and not main:
            holds.append((n, said))
        article, main = article or n.tag == "article" and not said, main or n.tag == "main"
        stack += [(x, article, main, said) for x in n.items if isinstance(x, Node)]
    plain = [n for n, said in holds if not said]     # a page of comments alone has none
    _spare(plain or [n for n, _ in holds])
    if any(n.name in (FULL, PART) for n, _ in named):
        _count(root)
    for n, article in named:
        if n.cut:
            continue
        if n.name == COMMENT:
            n.cut = bool(plain) or n.tag != "article"
        elif n.tag != "article":
            linked = _linked(n)
            if n.name == FULL and not article and not linked:
                n.name = ALONE
            n.cut = linked or n.name == ALONE
    _spare(plain or [n for n, _ in holds])


def _spare(holds: list[Node]) -> None:
    spared: set[int] = set()
    for n in holds:
        for up in _path(n.parent):
            if id(up) in spared:
                break
            spared.add(id(up))
            if up.tag not in CUT:
                up.cut = False


def _count(root: Node) -> None:
    """Characters and those in links, of everything that is not cut."""
    for n in reversed(_order(root)):
        n.chars = n.link_chars = 0
        for x in n.items:
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            elif not x.cut:
                n.chars += x.chars
                n.link_chars += x.chars if x.tag == "a" else x.link_chars


def _restore(chosen: list[Node], body: Node) -> None:
    """Inside the article a name alone cuts nothing; of a whole page or ``main``, which hold more
    than the article, only paragraphs and the like come back."""
    for top in chosen:
        whole = top is body or top.tag == "main"
        stack = [top]
        while stack:
            n = stack.pop()
            for x in n.items:
                if not isinstance(x, Node):
                    continue
                if x.cut and x.name == ALONE and not (whole and x.tag in BLOCK - TEXTUAL):
                    x.cut = False
                if not x.cut:
                    stack.append(x)


def _order(root: Node) -> list[Node]:
    """Uncut nodes, parents first."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack += [x for x in n.items if isinstance(x, Node) and not x.cut]
    return out


def _measure(body: Node) -> list[Node]:
    nodes = _order(body)
    for n in reversed(nodes):
        n.chars = n.link_chars = n.tags = n.link_tags = 0
        for x in n.items:
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            elif not x.cut:
                n.chars += x.chars
                n.link_chars += x.chars if x.tag == "a" else x.link_chars
                n.tags += x.tags + (x.tag in BLOCK or x.tag == "a")
                n.link_tags += x.link_tags + (x.tag == "a")
    links, chars = max(1, body.link_chars), max(1, body.chars)
    for n in nodes:
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        if not c:
            n.density = 0.0
            continue
        base = math.log(c / max(1, c - n.link_chars) * lc + links / chars * c + math.e)
        n.density = c / t * max(0.0, math.log(c * t / (lc * lt))) / math.log(base)
    for n in nodes:
        n.sum = sum(x.density for x in n.blocks()) if n.tag in BLOCK else 0.0
    return nodes


def content(root: Node) -> list[Node]:
    """The article's nodes in page order."""
    chosen, body = _choose(root)
    _restore(chosen, body)
    return chosen


def _choose(root: Node) -> tuple[list[Node], Node]:
    _cut_names(root)
    body = next((n for n in _order(root) if n.tag == "body"), root)
    nodes = _measure(body)
    blocks = [n for n in nodes if n.tag in BLOCK or n is body]
    best = max(blocks, key=lambda n: n.sum)
    if best.sum <= 0:
        best = body
    holders = [n for n in _path(best) if n.tag == "article"] or [n for n in _path(best) if n.tag == "main"]
    if holders:
        return [holders[-1]], body
    path = []
    for n in _path(best):
        path.append(n)
        if n is body:
            break
    threshold = min(n.density for n in path)
    above = set(map(id, path))
    chosen, stack = [], [body]
    while stack:
        n = stack.pop()
        if n is best:
            chosen.append(n)
        elif id(n) in above:
            stack += reversed(n.blocks())
        elif n.density >= threshold and n.link_chars * 2 < n.chars:
            chosen.append(n)
    return chosen, body


def text_blocks(node: Node) -> list[str]:
    """Texts of a node's blocks in page order, white space collapsed, references decoded."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        t = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if t:
            out.append(t)

    stack: list[Node | str | None] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
        elif not x.cut:
            if x.tag == "br":
                run.append(" ")
            elif x.tag in BLOCK:
                end()
                stack.append(None)
                stack += reversed(x.items)
            else:
                stack += reversed(x.items)
    end()
    return out


def main_text(page: str) -> str:
    """The article of a page, one line a block; empty if there is none."""
    if not page.strip():
        return ""
    return "\n".join(b for n in content(parse(page)) for b in text_blocks(n))


def extract(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
            out: str = "text") -> DataFrame:
    """The columns ``keep`` and the main text per row; others are left behind.

    A null or empty page and one without text give the empty string; broken markup is read as far
    as it makes sense; repeated rows give repeated results; a very long page is parsed whole, and
    no depth is too great (nothing recurses)."""
    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches):
        for b in slices(batches, "_page"):
            found = [main_text(t) for t in texts(b.column("_page"))]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(found, pa.string())], [*keep, out])

    return map_arrow(
        pages.select(F.col(page).cast("string").alias("_page"), *keep), run, ", ".join([*fields, f"`{out}` string"]))
