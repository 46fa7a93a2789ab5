"""Main text of web pages by scoring their tree.

Elements that are never part of an article go first: by tag (menus, headers outside an article, footers,
sidebars, forms, scripts, styles) and by the words of their class, id or role (adverts, notices, comments).
Such words don't count after `with`, `has` or `no`, nor beside a class or id that names the content, nor on what
holds most of the text with its heading or article, nor on what holds most of a page that has no article or paragraph else.
Every paragraph then passes points for its length and its commas to its ancestors, whole to the nearest one,
half to the next, less to those above, each discounted by the paragraph's share of link text. The container
with most points after the discount of its own links wins; if it lies in an `article`, else in a `main`, that one
is taken in its place, without lists of links beside the winner. Siblings are kept if they have a fifth of the
winner's points, are paragraphs that read like text, or lists, tables, figures and `pre` that aren't lists of
links. Headings before the container are kept unless a list of links follows, later ones if a kept sibling does.

Definitions. A null or empty page gives an empty text. Without any points, the first `article` or `main`, else
what is left of the page, is the text. Ends of elements may be missing; end tags without a start are ignored.
`br` is a blank. Of equal containers the outer one wins, then the first. White space is Unicode's. Other
columns are ignored; repeated pages need no care. A long page is parsed in linear time, whatever is left open; points
go to all ancestors, so that scoring costs paragraphs times depth.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm._frame import table

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORDS = re.compile(r"[a-z]+")
INVISIBLE = re.compile(r"visibility\s*:\s*hidden", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
DROPPED = RAW | frozenset("head nav header footer aside form button select option dialog menu object canvas audio video fieldset label".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li main ol p pre section "
    "summary table tbody td tfoot th thead tr ul caption".split()
)
#: These too end an open `p`.
ENDS_P = frozenset("aside dialog fieldset footer form header menu nav".split())
#: What may stand in a `head`; anything else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: A start tag of the first kind ends an open element of the second.
ENDS_OPEN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = frozenset("ul ol dl table".split())
PARTS = LISTS | ENDS_OPEN.keys()
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article".split())
JUNK_WORDS = frozenset(
    "ad ads adv advert advertisement adverts adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "related replies respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Classes that name the article itself outweigh a junk word beside them (`article-header` in an article is its head).
ARTICLE = frozenset(("article", "main"))
HEADED = frozenset("article entry post story".split())
CONTENT = HEADED | frozenset("body content contents main page".split())
#: May stand in a class or id that names the content.
NEUTRAL = frozenset("area block col column container inner layout outer primary section site wrap wrapper".split())
#: What such a word is followed by in one class or id describes the surroundings (`with-sidebar`).
MODIFIERS = frozenset("has have no non with without".split())
COMMAS = re.compile("[,،、，]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Siblings that need no points.
PIECES = frozenset("pre ul ol dl table figure".split())
LEAST_LENGTH, SIBLING_SHARE, LINK_SHARE = 25, 0.2, 0.5


#: Kinds of junk: by tag or invisible; by words of its attributes; an article or main element with such words, which stays.
DROP, WORDY, NAMED = 1, 2, 3


class Node:
    __slots__ = ("block", "children", "junk", "links", "parent", "part", "points", "size", "tag")

    def __init__(self, tag: str, parent: Node | None, junk: int = 0):
        self.tag, self.parent, self.children, self.points, self.junk = tag, parent, [], 0.0, junk
        self.size = self.links = 0
        #: The node or the nearest one above that is a block, and one that is a list, a table or a part of them.
        self.block = self if tag in BLOCKS else parent and parent.block
        self.part = self if tag in PARTS else parent and parent.part


def junk_words(name: str) -> bool:
    """Whether one class, id, role or label has a junk word that isn't about its surroundings."""
    words = WORDS.findall(name)
    words = words[: next((k for k, w in enumerate(words) if w in MODIFIERS), len(words))]
    found = JUNK_WORDS.intersection(words)
    return bool(found) and not (found == {"header"} and not HEADED.isdisjoint(words))


def names_content(name: str) -> bool:
    words = set(WORDS.findall(name))
    return not words.isdisjoint(CONTENT) and words <= CONTENT | NEUTRAL


def junk_of(tag: str, attributes: str, in_article: bool) -> int:
    if tag in DROPPED:
        return 0 if tag == "header" and in_article else DROP
    if tag in ("html", "body") or "=" not in attributes and "hidden" not in attributes.lower():
        return 0
    names, labels = [], []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "style" and INVISIBLE.search(value) or name == "aria-hidden" and value == "true" and tag not in ARTICLE:
            return DROP
        if name in ("class", "id"):
            names += value.split()
        elif name in ("role", "aria-label"):
            labels.append(value)
    if not any(map(junk_words, labels)) and (not any(map(junk_words, names)) or any(map(names_content, names))):
        return 0
    return NAMED if tag in ARTICLE else WORDY


def parse(page: str) -> Node:
    """The tree of a page with its junk marked. Children are nodes and strings."""
    root = here = Node("html", None)
    at, last = 0, page.rfind(">") + 1
    opened: Counter[str] = Counter()

    def leave(to: Node) -> Node:
        node = here
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent
        return to

    while match := TOKEN.search(page, at, last):
        start, end = match.span()
        if start > at:
            here = leave(add_text(here, page[at:start]))
        at = end
        if match[2] is None:
            if match[0].startswith("<!--") and (len(match[0]) < 7 or not match[0].endswith("-->")):
                at = len(page)
            continue
        tag, closing = match[2].lower(), bool(match[1])
        if closing:
            if opened[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                here = leave(node.parent)
            continue
        if tag == "br":
            here.children.append(" ")
            continue
        if tag in VOID:
            continue
        if here.tag == "head" and tag not in IN_HEAD:
            here = leave(here.parent)
        if tag in RAW:
            if match[3].endswith("/>"):
                continue
            close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, end, last)
            at = close.end() if close else len(page)
            here.children.append(Node("hr", here))
            continue
        if tag in BLOCKS or tag in ENDS_OPEN or tag in ENDS_P:
            here = leave(here.block.parent if here.block.tag == "p" else here)
        if tag in ENDS_OPEN:
            here = leave(closed(here, ENDS_OPEN[tag]))
        if tag in ("html", "body"):
            continue
        node = Node(tag, here, junk_of(tag, match[3], any(opened[t] for t in ARTICLE)))
        here.children.append(node)
        if not match[3].endswith("/>"):
            here = node
            opened[tag] += 1
    if at < len(page) and (rest := page[at:last] + page[max(at, last) :].partition("<!--")[0]):
        add_text(here, rest)
    return root


def add_text(here: Node, text: str) -> Node:
    """Append it where it belongs; the node that is open then."""
    if here.tag == "head" and not text.isspace():
        here = here.parent
    here.children.append(unescape(text))
    return here


def closed(here: Node, tags: set[str]) -> Node:
    """Where a start tag goes that ends an open element of `tags`, searched up to the next list or table."""
    node = here.part
    while node is not None and node.tag not in tags:
        if node.tag in LISTS:
            return here
        node = node.parent.part
    return here if node is None else node.parent


def walk(root: Node) -> Iterator[Node]:
    """All nodes, parents before children, in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


def cut(root: Node) -> list[tuple[Node, int, Node]]:
    """Put blanks in the place of junk; what had junk words and more than half of the text, and where it was."""
    nodes = list(walk(root))
    sizes, titled = {}, set()
    for node in reversed(nodes):
        size = 0
        for child in node.children:
            if isinstance(child, str):
                size += len(" ".join(child.split()))
            elif child.junk != DROP:
                size += sizes[id(child)]
                if id(child) in titled or not child.junk and (child.tag == "h1" or child.tag in ARTICLE):
                    titled.add(id(node))
        sizes[id(node)] = size
    large = []
    for node in nodes:
        for k, child in enumerate(node.children):
            if isinstance(child, str) or child.junk not in (DROP, WORDY):
                continue
            most = child.junk == WORDY and 2 * sizes[id(child)] > sizes[id(root)]
            if most and id(child) in titled:
                continue
            if most:
                large.append((node, k, child))
            node.children[k] = Node("hr" if child.tag in BLOCKS or child.tag in DROPPED else "span", node)
    return large


def measure(root: Node) -> list[Node]:
    """Lengths of all text and of link text for each node; the nodes in page order."""
    nodes = list(walk(root))
    for node in reversed(nodes):
        node.size, node.links = 0, 0
        for child in node.children:
            if isinstance(child, Node):
                node.size += child.size
                node.links += child.size if child.tag == "a" else child.links
            else:
                node.size += len(" ".join(child.split()))
    return nodes


def density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def own_text(node: Node) -> tuple[int, int]:
    """Characters and commas of a node that stand in no block below it."""
    size = commas = 0
    stack = list(node.children)
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            size += len(" ".join(child.split()))
            commas += len(COMMAS.findall(child))
        elif child.tag not in BLOCKS:
            stack.extend(child.children)
    return size, commas


def score(nodes: list[Node]) -> Node | None:
    """Pass the paragraphs' points up, and return the best container."""
    for node in nodes:
        if node.tag not in PARAGRAPHS:
            continue
        size, commas = own_text(node)
        if size < LEAST_LENGTH:
            continue
        points = (1 + commas + min(size / 100, 3)) * (1 - min(density(node), 1))
        holder = node if node.tag in ("div", "section", "article") else node.parent
        level = 1.0
        while holder is not None:
            holder.points += points / level
            level = 2 if level == 1 else level + 4 if level == 2 else level + 3
            holder = holder.parent
    best, most = None, 0.0
    for node in nodes:
        if node.tag in BLOCKS and (points := node.points * (1 - min(density(node), 1))) > most:
            best, most = node, points
    return best


def is_link_list(node: Node) -> bool:
    return node.tag in BLOCKS and density(node) > LINK_SHARE and sum(n.tag == "a" for n in walk(node)) > 1


def container(best: Node) -> Node:
    """The article or main element around the winner, without lists of links beside it; else the winner."""
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    top = next((n for tag in ("article", "main") for n in above if n.tag == tag), best)
    for node in above[: above.index(top)]:
        beside = node.parent.children
        for k, child in enumerate(beside):
            if child is not node and isinstance(child, Node) and is_link_list(child):
                beside[k] = Node("hr", node.parent)
    return top


def kept(best: Node) -> list[Node]:
    """The container and those of its siblings that belong to it, in page order."""
    top = container(best)
    if top.parent is None:
        return [top]
    limit = SIBLING_SHARE * best.points
    out, after, next_ = [], True, None
    for node in reversed(top.parent.children):
        if isinstance(node, str) or node is not top and not node.size:
            continue
        after = after and node is not top
        if node is top:
            keep = True
        elif node.tag in HEADINGS:
            keep = not is_link_list(next_) if not after else bool(out) and next_ is out[-1]
        elif node.tag == "p":
            keep = node.size > 80 and density(node) < 0.25 or node.size <= 80 and not node.links
        else:
            keep = node.tag in PIECES and not is_link_list(node)
        if keep or node.tag in BLOCKS and node.points * (1 - min(density(node), 1)) >= limit:
            out.append(node)
        next_ = node
    return out[::-1]


def text_of(nodes: list[Node]) -> str:
    """Their blocks, one a line, white space as one blank."""
    lines, line = [], []

    def end_line():
        if text := " ".join("".join(line).split()):
            lines.append(text)
        line.clear()

    for top in nodes:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end_line()
            elif isinstance(item, str):
                line.append(item)
            else:
                if item.tag in BLOCKS:
                    end_line()
                    stack.append(None)
                stack.extend(reversed(item.children))
        end_line()
    return "\n".join(lines)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    large = cut(root)
    nodes = measure(root)
    best = score(nodes)
    if best is None and large and not any(n.size for n in nodes if n.tag in ARTICLE):
        blanks = [parent.children[k] for parent, k, _ in large]
        for parent, k, node in large:
            parent.children[k] = node
        best = score(measure(root))
        if best is None:
            for (parent, k, _), blank in zip(large, blanks, strict=True):
                parent.children[k] = blank
    if best is None:
        best = next((n for n in nodes if n.tag in ARTICLE), root)
        return text_of([best])
    return text_of(kept(best))


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) of each row of `pages`."""
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = pa.array([main_text(h) for h in part.column("h").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("u"), texts], names=["k", "u", "text"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("k", "u")]
    found = rows.mapInArrow(run, f"k {kinds[0]}, u {kinds[1]}, text string")
    return found.select(F.col("k").alias(key), F.col("u").alias(url), F.col("text").alias("text"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
