"""Main text of web pages by scoring the tree.

Each paragraph earns points for its length and commas and passes them to its ancestors,
the whole to its parent, half to the next, and so on. An element's points are discounted
by the share of its text that is links. The best container is kept, with the siblings
that look like part of the same article; menus, adverts, comments and the like are taken
out of the tree before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import put, ship

# Element names of HTML by their role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul", "dd", "dt",
}
SAME_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody", "thead"},
}
SCOPE = {"html", "body", "table", "td", "th", "ul", "ol", "dl", "object", "button", "template"}
DROPPED = {
    "script", "style", "noscript", "template", "head", "title", "nav", "aside", "footer", "header", "form", "button",
    "input", "select", "textarea", "iframe", "object", "embed", "applet", "svg", "math", "canvas", "audio", "video",
    "dialog", "menu", "fieldset", "xmp", "noembed", "noframes", "datalist", "map",
}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
    "menubar", "toolbar", "form", "status", "tablist", "tooltip",
}
# Our choice: words that name what is not the article, in class names and ids.
UNLIKELY = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer",
    "masthead", "header", "comment", "comments", "disqus", "reply", "replies", "cookie", "cookies", "consent",
    "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "social", "share", "sharing", "related", "recommended", "recommendations",
    "widget", "pagination", "pager", "toolbar", "skip", "search", "searchbox", "form", "copyright", "legal",
    "disclaimer", "teaser", "outbrain", "taboola", "feedback", "rating", "paywall",
}
#: What readers wrote; never the article, however much of it there is.
COMMENTS = {"comment", "comments", "disqus", "reply", "replies"}
#: What follows these in a name is only what an element has or lacks: page-with-sidebar.
NOT_REALLY = {"no", "has", "with", "without", "not"}
#: Elements that are a paragraph themselves, not what holds one.
PARAGRAPHS = {"p", "pre", "blockquote", "address", "h1", "h2", "h3", "h4", "h5", "h6"}
POINTS = {
    "article": 25, "main": 15, "section": 0, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3,
    "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5,
}
POSITIVE = {"article", "body", "content", "entry", "hentry", "main", "page", "post", "text", "blog", "story"}

#: Names that also stand for whole pages; not used on pages of which nothing else is left.
VAGUE = {
    "form", "search", "header", "widget", "notice", "notices", "alert", "legal", "banner", "promo", "promotion",
    "related", "overlay", "modal", "rating", "feedback", "teaser", "skip", "share", "sharing", "social", "aside",
}

MIN_PARAGRAPH = 25
#: Where no container outside such elements has a paragraph: shares of the page's text above
#: which an element stays although its name, or a part of it, or its being a form speaks
#: against it.
PURE, MIXED = 0.9, 0.5
#: Text right in the body that makes it a container; less may be a stray line.
STRAY = 100
#: Elements opened below this depth become siblings, as in browsers.
DEPTH = 512

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?])")
_QUOTED = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    """An element; children are nodes and strings in page order."""

    __slots__ = ("tag", "attributes", "parent", "children")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []


def parse(html: str) -> Node:
    """A tree that any text gives: unclosed elements end where their parents do."""
    root = Node("html")
    stack = [root]
    at, n, plain = 0, len(html), False

    def close(tags: set[str], scope: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < n:
        mark = _MARK.search(html, at)
        if mark is None:
            stack[-1].children.append(html[at:])
            break
        if mark.start() > at:
            stack[-1].children.append(html[at:mark.start()])
        tag = mark[2]
        if tag is None:
            if html.startswith("<!--", mark.start()):
                end = html.find("-->", mark.start() + 2)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", mark.end())
                at = n if end < 0 else end + 1
            continue
        found = None if plain else _QUOTED.match(html, mark.end())
        if found is None:
            # A quote that never ends: from here on a tag ends at the next bracket.
            plain = True
            end = html.find(">", mark.end())
            if end < 0:
                break
            end += 1
        else:
            end = found.end()
        inside, at, tag = html[mark.end():end - 1], end, tag.lower()
        if mark[1]:
            if tag == "br":
                stack[-1].children.append(Node("br", "", stack[-1]))
            elif tag not in VOID:
                close({tag}, set() if tag in ("html", "body", "table") or tag in SCOPE else {"table", "td", "th"})
            continue
        if tag in ("html", "body"):
            if inside.strip():
                root.attributes += " " + inside
            if tag == "body":
                close({"head"}, set())
            continue
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
        if tag in SAME_KIND:
            close(SAME_KIND[tag], {"ul", "ol", "dl", "select", "table"})
        if tag in CLOSES_P and stack[-1].tag == "head":
            stack.pop()
        if len(stack) >= DEPTH:
            stack.pop()
        node = Node(tag, inside, stack[-1])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
            node.children.append(html[at:end.start() if end else n])
            at = n if end is None else html.find(">", end.start()) + 1 or n
        elif tag not in VOID and not (inside.endswith("/") and tag not in INLINE | CLOSES_P | DROPPED):
            stack.append(node)
    return root


def _names(node: Node) -> list[list[str]]:
    """The words of each class name and id, less those that say what the element only has."""
    found = []
    for m in _ATTRIBUTE.finditer(node.attributes):
        if m[1].lower() not in ("class", "id"):
            continue
        for name in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _NAMES.findall(name)]
            words = words[:next((i for i, w in enumerate(words) if w in NOT_REALLY), len(words))]
            if "free" in words[1:]:  # as in ad-free
                at = words.index("free", 1)
                words[at - 1:at + 1] = []
            if words:
                found.append(words)
    return found


def _unlikely(node: Node, names: list[list[str]], in_article: bool, unlikely: set[str]) -> float:
    """0 if nothing speaks against an element, 1 if it is never the article.

    Between, what speaks against it is its name or being a form, and it may still be a
    wrapper of the whole page: the share of the text it needs where nothing else is there.
    """
    form = node.tag == "form"
    if node.tag in DROPPED and not form and not (node.tag == "header" and in_article):
        return 1
    most = MIXED if form else 0
    for m in _ATTRIBUTE.finditer(node.attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return 1
        if name == "role" and value.lower() in ROLES:
            if value.lower() != "form":
                return 1
            most = MIXED
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 1
    if node.tag in ("article", "main") and not any(COMMENTS & {*words} for words in names):
        return most
    for words in names:
        if not unlikely.isdisjoint(words):
            most = max(most, PURE if unlikely.issuperset(words) else MIXED)
    return most


def _prune(root: Node, unlikely: set[str]) -> None:
    """Take out what is not the article.

    Elements that a name speaks against go, whatever their size, if an article, a main
    element, one with a promising name or any other container has a paragraph outside
    them, and a form if it does not hold the article. Only if there is none, those stay that
    hold such an element, or failing that most of the text; what readers wrote never does.
    """
    doubtful: dict[Node, float] = {}
    gone: set[Node] = set()
    order: list[Node] = []
    within: dict[Node, Node | None] = {}  # the nearest doubtful element, itself included
    readers: set[Node] = set()
    promising: list[Node] = []
    own: dict[Node, int] = {}
    # Short articles count in the whole, so that a longer stray block isn't most of the page.
    total = 0
    stack = [(root, None, False, False)]
    while stack:
        node, around, inside, link = stack.pop()
        names = _names(node) if node is not root else []
        most = _unlikely(node, names, inside, unlikely) if node is not root else 0
        if most == 1:
            gone.add(node)
            continue
        if most:
            doubtful[node] = most
            if around in readers or any(COMMENTS & {*words} for words in names):
                readers.add(node)
            around = node
        elif node is not root:
            marked = node.tag in ("article", "main")
            if marked or (around not in readers and any(POSITIVE & {*words} for words in names)):
                promising.append(node)
        order.append(node)
        within[node], own[node] = around, 0
        inside = inside or node.tag in ("article", "main")
        link = link or node.tag == "a"
        for c in node.children:
            if not isinstance(c, str):
                stack.append((c, around, inside, link))
            elif not link:
                n = len(" ".join(c.split()))
                total += n
                own[node] += n if n >= MIN_PARAGRAPH else 0
    clean = dict(own)
    for node in reversed(order):
        if node not in doubtful and node.parent is not None:
            clean[node.parent] += clean[node]
    def wrappers(x: Node) -> list[Node]:
        out, around = [], within[x]
        while around is not None:
            out.append(around)
            around = within[around.parent]
        return out

    def rank(x: Node) -> tuple[int, bool, int]:
        """First those in no doubtful element, then articles in a mere form."""
        marked, around = x.tag in ("article", "main"), wrappers(x)
        forms = marked and all(w.tag == "form" and doubtful[w] == MIXED for w in around)
        return (2 if not around else 1 if forms else 0), marked, clean[x]

    ranked = [(rank(x), x) for x in promising if clean[x]]
    level, best = max(ranked, key=lambda r: r[0], default=((0,), None))
    outside = clean[root] >= STRAY or any(
        clean[x] for x in order
        if within[x] is None and x is not root and x.tag not in INLINE and x.tag not in PARAGRAPHS
    )
    keep: set[Node] = set()
    if best is not None and (level[0] or not outside):
        keep.update(wrappers(best))
    elif not outside:
        for node in reversed(order):
            if node in doubtful and (node in readers or own[node] <= doubtful[node] * total):
                continue
            if node in doubtful:
                keep.add(node)
            if node.parent is not None:
                own[node.parent] += own[node]
    gone |= doubtful.keys() - keep
    for node in order:
        node.children = [c for c in node.children if isinstance(c, str) or c not in gone]


class _Pieces:
    """Blocks of text in page order, each with its element and the length of its links."""

    def __init__(self, root: Node):
        self.blocks: list[tuple[Node, str, int]] = []
        self._parts: list[str] = []
        self._links = 0
        self._owner = root
        self._walk(root)

    def _end(self) -> None:
        text = " ".join(unescape("".join(self._parts)).split())
        if text:
            self.blocks.append((self._owner, text, self._links))
        self._parts, self._links = [], 0

    def _walk(self, root: Node) -> None:
        stack: list = [(root, None, 0)]  # (child or end mark, owner, depth of links)
        breaks = 0
        while stack:
            item, owner, link = stack.pop()
            if item is None:  # the end of a block
                self._end()
                self._owner, breaks = owner, 0
            elif isinstance(item, str):
                if link:
                    self._links += len(" ".join(unescape(item).split()))
                if item.strip():
                    breaks = 0
                self._parts.append(item)
            elif item.tag == "br":
                # One break is white space, two in a row end a paragraph.
                breaks += 1
                if breaks > 1:
                    self._end()
                self._parts.append(" ")
            elif item.tag in INLINE:
                link += item.tag == "a"
                stack += [(c, owner, link) for c in reversed(item.children)]
            else:
                self._end()
                before, self._owner, breaks = self._owner, item, 0
                stack.append((None, before, 0))
                stack += [(c, item, link) for c in reversed(item.children)]
        self._end()


def _words(node: Node) -> set[str]:
    found = set()
    for m in _ATTRIBUTE.finditer(node.attributes):
        if m[1].lower() in ("class", "id"):
            found |= {w.lower() for w in _NAMES.findall(m[2] or m[3] or m[4] or "")}
    return found


def _main(root: Node) -> list[str]:
    """Text blocks of the best container and of its siblings that belong to it."""
    blocks = _Pieces(root).blocks
    if not blocks:
        return []
    score: dict[Node, float] = {}
    length: dict[Node, int] = {}
    links: dict[Node, int] = {}
    above: dict[Node, list[Node]] = {}

    def ancestors(node: Node) -> list[Node]:
        if node not in above:
            found, x = [], node
            while x is not None:
                found.append(x)
                x = x.parent
            above[node] = found
        return above[node]

    simple: dict[Node, bool] = {}
    for owner, text, linked in blocks:
        chain = ancestors(owner)
        for x in chain:
            length[x] = length.get(x, 0) + len(text)
            links[x] = links.get(x, 0) + linked
        if owner.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "th", "figcaption", "caption"):
            continue
        if len(text) < MIN_PARAGRAPH and length[root] > MIN_PARAGRAPH:
            continue
        points = 1 + text.count(",") + min(len(text) // 100, 3)
        # Text right inside a container counts as a paragraph of its own there.
        if owner not in simple:
            simple[owner] = all(isinstance(c, str) or c.tag in INLINE for c in owner.children)
        for depth, x in enumerate(chain[1:] if simple[owner] and len(chain) > 1 else chain):
            if x not in score:
                w = _words(x)
                score[x] = POINTS.get(x.tag, 0) + (10 if w & POSITIVE else 0)
            score[x] += points / (depth + 1)
    if not score:
        best = root
    else:
        final = {x: s * (1 - links[x] / max(1, length[x])) for x, s in score.items()}
        best = max(final, key=final.get)
        for x in ancestors(best)[1:]:
            # The article around the best container has its headings too.
            if x.tag in ("article", "main"):
                best = x
                break
    kept = {best}
    if best.parent is not None and score:
        least = max(10.0, 0.2 * final.get(best, 0.0))
        for c in best.parent.children:
            if isinstance(c, str) or c is best or not length.get(c):
                continue
            density = links[c] / length[c]
            alike = c.tag == best.tag and c.attributes == best.attributes and best.tag != "div"
            if final.get(c, 0) >= least or (alike and density < 0.25):
                kept.add(c)
            elif c.tag == "p" and (
                length[c] > 80 and density < 0.25 or length[c] <= 80 and not density and best.tag not in ("article", "main")
            ):
                kept.add(c)

    def listed(owner: Node) -> bool:
        """Whether a block stands in a list or table that is mostly links."""
        for x in ancestors(owner):
            if x in kept:
                return False
            if x.tag in ("ul", "ol", "dl", "table", "div", "section") and links[x] > 0.5 * length[x]:
                return True
        return False

    out = []
    for owner, text, _ in blocks:
        if not kept.isdisjoint(ancestors(owner)) and not listed(owner):
            out.append(text)
    return out


def main_text(html: str | None) -> str:
    """The article of a page, one line for each block; empty if there is no text."""
    if not html:
        return ""
    for unlikely in (UNLIKELY, UNLIKELY - VAGUE):
        root = parse(html)
        _prune(root, unlikely)
        found = _main(root)
        if found:
            return "\n".join(found)
    return ""


def _extract(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("__html").to_pylist()]
        columns = [batch.column(c) for c in names]
        columns += [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
        yield pa.record_batch(columns, names=[*names, "text", "n_chars"])


def extract_text(pages: DataFrame, keep_html: bool = False) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``, and ``n_chars``, its code points.

    Blocks are joined in page order by one newline, with character references decoded and
    white space inside a block made one space. A null or empty page, or one without text
    outside menus and the like, has the empty text. Pages of any length are read whole
    and broken markup never fails. Other columns pass through, the page only with
    ``keep_html``; columns named like the new ones are replaced. Every row comes out once.
    """
    ship(pages.sparkSession)
    new = {"text", "n_chars", *(() if keep_html else ("html",))}
    names = [c for c in pages.columns if c.lower() not in new]
    given = pages.select(*(F.col(f"`{c}`") for c in names), F.col("html").alias("__html"))
    fields = put(given.drop("__html"), "text string, n_chars bigint")
    return given.mapInArrow(lambda it: _extract(it, names), fields)
