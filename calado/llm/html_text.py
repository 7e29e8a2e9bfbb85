"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of HTML elements by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark math mi mn mo q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("nav footer aside head menu dialog noscript template svg select datalist button label legend option optgroup".split())
#: Elements whose end tag is often left out at the end of a page; they end with what holds them.
LAST = frozenset(("head", "footer"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class or id, and roles, that mark what is no article.
MARKS = frozenset(
    "ad ads adbox adsbygoogle adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices outbrain pager pagination popup promo promoted promotion related "
    "recommended reply replies respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe taboola tags toolbar topbar widget widgets".split()
)
#: Marks and roles that page builders also give to what holds an article.
WEAK = frozenset("banner dialog disclaimer form header login masthead notice notices promo promoted promotion search share sharing skip social subscribe tags toolbar topbar widget widgets".split())
#: Nouns after a mark that only say what holds it (``comment-list``), and words before one that say what the page has (``has-sidebar``).
HOLDERS = frozenset("area articles bar block body bottom box buttons center col column container group holder icons inner items left links list outer panel placeholder posts region right row section slot stories text top unit wrap wrapper zone".split())
STATES = frozenset("has no is with without hide show before after below above".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKUP = re.compile(r"</?[a-zA-Z]")
_ARTICLES = ("article", "main")


class _Node:
    __slots__ = ("tag", "parent", "children", "parts", "mark", "word", "inside", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: _Node | None) -> None:
        self.tag, self.parent, self.mark, self.word, self.dropped = tag, parent, "", "", False
        self.inside = parent is not None and (parent.inside or parent.tag in _ARTICLES)  # an article or main holds it
        self.children: list[_Node] = []
        self.parts: list[_Node | str] = []  # in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marked_name(name: str, spared: frozenset[str]) -> str:
    """The mark that a class or id is as a whole, by its last word but for words that only say what holds it; else empty."""
    if name.lower() in MARKS:
        return "" if name.lower() in spared else name.lower()
    words = [x.lower() for x in _PART.findall(name)]
    if not words or words[0] in STATES:
        return ""
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    return words[-1] if words[-1] in MARKS and words[-1] not in spared else ""


def _mark(node: _Node, attributes: str) -> str:
    """``tag``, ``form``, ``hidden`` or ``name`` if this element, by its tag or by class, id, role or style, is no article text; else empty. A
    ``name`` sets the node's word."""
    tag = node.tag
    if tag in BOILERPLATE or tag == "header" and not node.inside:
        return "tag"
    kind = "form" if tag == "form" else ""
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    if not found or tag in ("body", "html", "main"):
        return kind
    if "hidden" in found or found.get("aria-hidden") == "true":
        return "hidden"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return "hidden"
    role = found.get("role", "").lower()
    spared = frozenset(("header", "masthead")) if node.inside or tag == "article" else frozenset()
    names = [role if role in ROLES else "", *(_marked_name(x, spared) for x in f"{found.get('class', '')} {found.get('id', '')}".split())]
    marks = [x for x in names if x]
    if marks:
        node.word = next((x for x in marks if x not in WEAK), marks[0])
        return "name"
    return kind


class _Tree:
    """Elements and text of a page. End tags that match nothing are left out; open elements end with their parent.

    Open elements are a stack; for every tag the places of its open elements are kept, so that nothing is searched and the
    work is in proportion to the page, however deep it nests.
    """

    def __init__(self) -> None:
        self.root = _Node("html", None)
        self.open = [self.root]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.blocks = [0]  # places of open elements that are not inline

    def add(self, text: str) -> None:
        if text:
            self.open[-1].parts.append(html.unescape(text))

    def push(self, node: _Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag not in INLINE:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def _pop_to(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def end(self, tag: str, *bounds: str) -> None:
        """Close the last open ``tag``, if no open element of ``bounds`` stands in it."""
        last = self.places.get(tag)
        if last and last[-1] > max((self.places[b][-1] for b in bounds if self.places.get(b)), default=0):
            self._pop_to(last[-1])

    def end_paragraph(self) -> None:
        """A block ends an open paragraph or heading and what is open in it."""
        while self.open[self.blocks[-1]].tag in HEADINGS or self.open[self.blocks[-1]].tag == "p":
            self._pop_to(self.blocks[-1])


# Start tags that end an open element of these tags, up to the nearest element of the bounds.
_ENDED = {"li": (("li",), ("ul", "ol", "menu")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",))}


def _parse(page: str) -> _Node:
    tree = _Tree()
    at, lower = 0, ""
    closers: dict[str, int] = {}
    while m := _TOKEN.search(page, at):
        tree.add(page[at : m.start()])
        at = m.end()
        if m[1] is not None:
            tree.open[-1].parts.append(m[1])
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag not in VOID and tag not in ("html", "body"):
                tree.end(tag, *(("table",) if tag in ("p", "li", "td", "tr") else ()))
            continue
        if tag in ("html", "body"):
            if tag == "body" and not tree.places.get("body"):
                tree._pop_to(1)
                body = _Node("body", tree.root)
                tree.root.children.append(body)
                tree.root.parts.append(body)
                tree.push(body)
            continue
        if tag not in INLINE and tag not in VOID and tag not in RAW:
            tree.end_paragraph()
            for ended in _ENDED.get(tag, ((), ()))[0]:
                tree.end(ended, *_ENDED[tag][1])
        here = tree.open[-1]
        node = _Node(tag, here)
        attributes = m[4] or ""
        node.mark = _mark(node, attributes)
        here.children.append(node)
        here.parts.append(node)
        alone = attributes.rstrip().endswith("/")
        if tag in RAW or tag in BOILERPLATE:
            # Elements without article text: one that is never ended holds nothing beyond the next tag.
            lower = lower or page.lower()
            if closers.get(tag, 0) < at and closers.get(tag) != -1:
                closers[tag] = lower.find(f"</{tag}", at)
            ends = closers[tag]
            if tag in RAW:
                node.mark = "tag"
                if ends >= 0:
                    at = page.find(">", ends) + 1 or len(page)
            if ends < 0 and not alone and tag not in LAST:
                following = _MARKUP.search(page, at)
                at = following.start() if following else len(page)
            if tag in RAW or ends < 0 and tag not in LAST:
                continue
        if tag not in VOID and not alone:
            tree.push(node)
    tree.add(page[at:])
    return tree.root


def _order(root: _Node) -> list[_Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def _unlinked(nodes: list[_Node]) -> dict[_Node, tuple[int, int]]:
    """Characters of each node outside links, and in all, without what is dropped."""
    out: dict[_Node, tuple[int, int]] = {}
    for n in reversed(nodes):  # children before their parent
        own = 0 if n.dropped else sum(len(x) - x.count(" ") for x in n.parts if isinstance(x, str))
        held = [out[c] for c in n.children] if not n.dropped else []
        out[n] = (0 if n.tag == "a" else own + sum(h[0] for h in held), own + sum(h[1] for h in held))
    return out


def _believed(nodes: list[_Node], held: set[_Node], least: int = 100) -> set[_Node]:
    """Nodes with a name that are dropped for it. All count outside an article or main that has text of its own, and so do those
    that are mostly links. Of the others, a word counts unless its nodes hold more text outside links than what then stays; a word that marks no
    article by habit (``WEAK`` are the others) counts unless they hold eight times as much and less than ``least`` characters stay."""
    named = [n for n in nodes if n.mark == "name" and n not in held]
    if not named:
        return set()
    chars = _unlinked(nodes)
    for n in nodes:  # as if all counted
        n.dropped = n.dropped or bool(n.parent and n.parent.dropped) or n.mark == "name" and n not in held
    stays = _unlinked(nodes)
    articles = [n for n in nodes if n.tag in _ARTICLES and not n.inside and not n.dropped]
    within = sum(stays[n][0] for n in articles)
    rest = within or stays[nodes[0]][0]
    out, by_word, seen = set(), {}, {}
    for n in nodes:  # parents before their children
        seen[n] = seen.get(n.parent, frozenset())
        if n.mark != "name" or n in held:
            continue
        if within and not n.inside or 2 * chars[n][0] < chars[n][1]:
            out.add(n)
            continue
        if n.word not in seen[n]:
            by_word[n.word] = by_word.get(n.word, 0) + chars[n][0]
            seen[n] |= {n.word}
    lost = {w for w, much in by_word.items() if w in WEAK and much > rest}
    rest += sum(by_word[w] for w in lost)  # what weak words do not take stays beside the others
    lost |= {w for w, much in by_word.items() if w not in WEAK and much > 8 * rest and rest < least}
    return out | {n for n in named if n.word not in lost}


def _drop(nodes: list[_Node], names: bool) -> None:
    """Drop what is marked, with all in it. A name or form around an article or main says nothing of that, nor does a form
    around most of the page; names that would take most of the text away are not believed. Without ``names`` only tags count."""
    held = set()
    for n in nodes:
        if n.tag in _ARTICLES and not n.mark:
            while n is not None and n not in held:
                held.add(n)
                n = n.parent
    gone = lambda n: n.mark == "tag" or names and n.mark == "hidden" and n not in held
    for n in nodes:  # parents before their children
        n.dropped = bool(n.parent and n.parent.dropped or gone(n))
    named = _believed(nodes, held) if names else set()
    for n in nodes:
        n.dropped = bool(n.parent and n.parent.dropped or gone(n) or n in named)
    kept: dict[_Node, int] = {}  # characters that neither tag nor name drops
    for n in reversed(nodes):
        kept[n] = 0 if n.dropped else sum(len(x) - x.count(" ") for x in n.parts if isinstance(x, str)) + sum(kept[c] for c in n.children)
    for n in nodes:
        n.dropped = n.dropped or bool(n.parent and n.parent.dropped) or (n.mark == "form" and n not in held and 2 * kept[n] <= kept[nodes[0]])


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, page_share: float) -> float:
    """Characters per tag of a node, adjusted by its links; ``page_share`` is the share of link characters in body."""
    if not chars:
        return 0.0
    tags, links, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - links, 1) * links + page_share * chars + math.e)
    return chars / tags * math.log(chars / links * tags / link_tags + 1) / math.log(base + 1)


def _weigh(nodes: list[_Node], body: _Node) -> None:
    """Counts of every node, its composite density, and the sum of its children's densities. Dropped nodes weigh nothing."""
    for n in reversed(nodes):  # children before their parent
        if n.dropped:
            continue
        n.chars = sum(len("".join(x.split())) for x in n.parts if isinstance(x, str))
        n.tags = n.link_chars = n.link_tags = 0
        for c in n.children:
            if not c.dropped:
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags + (c.tag == "a")
        if n.tag == "a":
            n.link_chars = n.chars
    share = body.link_chars / max(body.chars, 1)
    for n in nodes:
        n.density = 0.0 if n.dropped else composite_density(n.chars, n.tags, n.link_chars, n.link_tags, share)
        n.total = 0.0
    worded = set()  # nodes with text of their own, in inline elements too
    for n in reversed(nodes):
        if n.dropped or not n.chars:
            continue
        for c in n.children:
            n.total += c.total if c.tag in INLINE else c.density
        if any(c in worded for c in n.children if c.tag in INLINE) or any(isinstance(x, str) and x.strip() for x in n.parts):
            worded.add(n)
            if n.tag not in INLINE:
                n.total += n.density  # its own text counts like a child's


def _holds(outer: _Node, n: _Node | None) -> bool:
    while n is not None and n is not outer:
        n = n.parent
    return n is outer


def _linked(n: _Node) -> bool:
    return 2 * n.link_chars > n.chars


def _read(node: _Node, least: float, out: list[str]) -> None:
    """Text in page order; blocks are apart by a space. Blocks of less than the threshold's density that are mostly links go, but for those
    in an article or main, as its references."""
    stack: list[_Node | str | None] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            out.append(" ")
        elif isinstance(x, str):
            out.append(x)
        elif x.dropped or (x is not node and x.tag not in INLINE and not x.inside and x.density < least and _linked(x)):
            out.append("" if x.tag in INLINE else " ")
        else:
            block = x.tag not in INLINE
            stack.extend([None] * block + list(reversed(x.parts)) + [None] * block)


def _choose(nodes: list[_Node], body: _Node) -> tuple[list[_Node], float]:
    """(subtrees with the article in page order, least density on the path to body).

    The subtree with the largest sum of its children's densities is chosen. On its way up to body, every level's threshold is
    the least density on the path below that level; a sibling subtree belongs to the article as well if it is not mostly links and
    reaches the threshold, or half of it with at least a quarter of the chosen sum, or is a heading before it in the same wrapper,
    or stands in the same article or main element at half of the threshold.
    """
    live = [n for n in nodes if not n.dropped and n.chars and n.tag not in INLINE]
    if not live:
        return [], 0.0
    best = max(live, key=lambda n: n.total)
    if not best.inside and best.tag not in _ARTICLES:
        # An article or main of half the sum or more is preferred to a subtree that it is no part of.
        told = max((n for n in live if n.inside or n.tag in _ARTICLES), key=lambda n: n.total, default=None)
        if told is not None and 2 * told.total >= best.total and not _holds(best, told):
            best = told
    left, right = [], []
    below, here = best.density, best
    while here is not body and here.parent is not None:
        up, after = here.parent, False
        before: list[_Node] = []
        for c in up.children:
            if c is here:
                after = True
            elif not c.dropped and c.chars and c.tag not in INLINE and not _linked(c):
                near = c.density >= below or c.density >= below / 2 and (4 * c.total >= best.total or up.inside or up.tag in _ARTICLES)
                if near or not after and c.tag in HEADINGS and up is not body:
                    (right if after else before).append(c)
        left = before + left
        below, here = min(below, up.density), up
    return [*left, best, *right], below


def main_text(page: str | None) -> str:
    """The article of one page: subtrees chosen by composite text density, without what tags and names mark as no article.

    Names (class, id, role) that would take most of a page's text outside links are not believed on it, and none are where they would leave
    a page without any text.
    """
    if not page:
        return ""
    root = _parse(page)
    nodes = _order(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    for names in (True, False):
        _drop(nodes, names)
        _weigh(nodes, body)
        chosen, least = _choose(nodes, body)
        if chosen:
            break
    out: list[str] = []
    for n in chosen:
        _read(n, least, out)
        out.append(" ")
    return " ".join("".join(out).split())


def extract_text(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars) with the main text of every whole page.

    Null or empty html, and pages without article text, give empty text. Character references are decoded, white space
    inside a block becomes one space, blocks are joined in page order by one space. Nulls in other columns stay; repeated
    rows give repeated rows; an empty table an empty one.
    """
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")) + ", text string, n_chars bigint"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [main_text(h) for h in rows.column(2).to_pylist()]
            # A reference to a lone surrogate decodes to U+FFFD, so that every text is valid UTF-8.
            columns = [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
