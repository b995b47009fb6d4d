"""Main text of web pages by site template removal.

A site's template shows as element subtrees that come back on many of its pages.
The subtrees of each whole page are hashed twice, from the leaves up: by content
(tag, text and children), and by skeleton (place in the page, tags and classes,
no text), so that a block that recurs with other words is found too. Both are
counted per host in Spark, each distinct page once. A subtree on at least a fifth
of a host's pages, and on four of them, is template and deleted. A skeleton counts
only if its element stands outside the article, or, on pages that mark no article,
if its pages give it at most a sixth of their text. Never deleted are the element
that holds the article, the text blocks in it, and what holds most of a page's text.

Elements that by tag or role are no article text go on every page. What recurs too
seldom to be template (a notice on one page, the pages of a small host, comments
below an article) is told by class and id words, but never the article itself, and
only as readers' comments or a sidebar what holds half of it.

A host has at most ten template subtrees for each subtree of a mean page. The
list of templates is written first and joined by host; Spark broadcasts it only
if its stored size is below its own threshold, and else deals both sides out by
host, where adaptive execution splits a large host.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import stored

#: Part of a host's distinct pages, and number of them, on which a template subtree recurs.
SHARE, PAGES = 0.2, 4
#: One in so many characters of its pages is what a skeleton inside the main text may hold.
SLOT = 6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no article text, wherever they stand.
OUT = frozenset(
    "aside audio button canvas datalist dialog embed footer form frame frameset head iframe input map menu nav noembed noframes "
    "noscript object option script select style svg template textarea title video xmp".split()
)
#: Roles of such elements.
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Class or id words of such elements.
OUT_WORDS = frozenset(
    "ad ads adsbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus dropdown footer gdpr hidden infobar login masthead menu menus modal nav navbar navigation "
    "newsletter noprint notification overlay pager pagination paywall popup promo promoted promotion "
    "recommended reply replies respond sharebar sharing sidebar sidebars signup skip sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Class or id words of what readers wrote or what stands beside, however long.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond sidebar sidebars".split())
#: Words that articles also use of their own parts: there such an element goes only if links hold half of its text.
WEAK_WORDS = frozenset("alert disclaimer notice notices privacy related search share social tags teaser".split())
#: First words of classes that describe a layout or file a post.
MODIFIERS = frozenset("category has no tag with without".split())
#: Text blocks, which inside an article stay even if they recur.
KEPT_IN_ARTICLE = frozenset("blockquote caption dd dl dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
#: Class or id words of containers of the main text, for pages without an article or main element.
MAIN_WORDS = frozenset("article content entry main post story".split())

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|([!?/]))")
_ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?)")
_COMMENT_END = re.compile(r"--!?>")
_WORD = re.compile(r"[a-z]+")

#: Open elements that an opening tag ends, and those beyond which it ends none, by kind of tag.
_ENDS = {
    "block": ({"p"}, BLOCK | {"button", "object"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
}
_KIND = {"li": "li", "dt": "dt", "dd": "dt", "option": "option", "tr": "tr", "td": "td", "th": "td"}
#: The kinds for which an open element of a tag matters.
_MARKS = {tag: [k for k, (ends, scope) in _ENDS.items() if tag in ends | scope] for tag in set().union(*(e | s for e, s in _ENDS.values()))}


class Node:
    __slots__ = ("tag", "attributes", "children", "hash", "shape", "size", "links")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        self.hash = self.shape = self.size = self.links = 0

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


class _Open:
    """The open elements. For each tag and kind the open ones are listed, so that no look-up climbs."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.tags: dict[str, list[int]] = {}
        self.kinds: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.tags.setdefault(node.tag, []).append(at)
        for kind in _MARKS.get(node.tag, ()):
            self.kinds.setdefault(kind, []).append(at)

    def cut(self, at: int) -> None:
        """Closes the open elements from the given one on."""
        while len(self.nodes) > at:
            tag = self.nodes.pop().tag
            self.tags[tag].pop()
            for kind in _MARKS.get(tag, ()):
                self.kinds[kind].pop()

    def close(self, tag: str) -> bool:
        if not self.tags.get(tag):
            return False
        self.cut(self.tags[tag][-1])
        return True

    def make_room(self, kind: str) -> None:
        listed = self.kinds.get(kind)
        if listed and self.nodes[listed[-1]].tag in _ENDS[kind][0]:
            self.cut(listed[-1])


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)


def parse(source: str) -> Node:
    """The element tree, in time proportional to the text.

    Tags without an end are closed where HTML closes them, ends without a start
    are ignored. Quotes count only after an equals sign. As in HTML a tag
    or comment that never ends takes the rest; another < with no > behind it is text.
    """
    root = Node("#root")
    opened = _Open(root)
    at, last = 0, source.rfind(">")
    while (match := _OPEN.search(source, at)) and (match.start() < last or source.startswith("<!--", match.start())):
        if match.start() > at:
            opened.nodes[-1].children.append(source[at : match.start()])
        at = match.end()
        if match.group(3):
            at = _skip(source, match.start())
            continue
        tag, start, done = match.group(2).lower(), at, False
        while not done and (found := _ATTRIBUTE.match(source, at)):
            at, done = found.end(), found.group(1) is not None
        if not done:
            return root
        if match.group(1):
            if not opened.close(tag) and tag == "br":
                opened.nodes[-1].children.append(" ")
            continue
        if tag in BLOCK:
            opened.make_room("block")
        if tag in _KIND:
            opened.make_room(_KIND[tag])
        attributes = source[start : at - 1]
        node = Node(tag, attributes)
        opened.nodes[-1].children.append(node)
        if tag in RAW:
            close = _raw_end(tag).search(source, at)
            at = close.end() if close else len(source)
        elif tag not in VOID and not (attributes.endswith("/") and tag not in BLOCK):
            opened.push(node)
    if at < len(source):
        opened.nodes[-1].children.append(source[at:])
    return root


def _skip(source: str, at: int) -> int:
    """Behind the comment or declaration that starts here."""
    if source.startswith("<!--", at):
        if short := re.compile(r"-?>").match(source, at + 4):
            return short.end()
        end = _COMMENT_END.search(source, at + 4)
        return end.end() if end else len(source)
    end = source.find(">", at)
    return end + 1 if end >= 0 else len(source)


@functools.lru_cache(4096)
def _parsed(attributes: str) -> dict[str, str]:
    found = _ATTRIBUTE.findall(attributes)
    return {name.lower(): html.unescape(a or b or c) for _, name, a, b, c in reversed(found) if name}


def _attributes(node: Node) -> dict[str, str]:
    return _parsed(node.attributes) if node.attributes.strip() else {}


def _class_words(node: Node) -> set[str]:
    """The words of class and id, but for names of layouts and categories."""
    given = _attributes(node)
    words: set[str] = set()
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        parts = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
        if not parts or (len(parts) > 1 and parts[0] in MODIFIERS):
            continue
        words.update(parts)
    return words


@functools.lru_cache(4096)
def _label(tag: str, attributes: str) -> str:
    """Tag, names of attributes, and class, id and role without digits: what pages of a site share of an element."""
    given = _parsed(attributes) if attributes.strip() else {}
    named = " ".join(f"{k}={re.sub('[0-9]+', '', given[k])}" for k in ("class", "id", "role") if k in given)
    return f"{tag} {named} {' '.join(sorted(given))}"


def _digest(text: str) -> int:
    raw = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def measure(root: Node, hashed: bool = True) -> None:
    """Sets each node's number of text characters, those in links, and its hashes of content and of shape.

    The content hash covers tag, text and children; the shape that of the labels
    below, of which repeated ones count once.
    """
    for node in reversed(list(root.walk())):
        parts, shapes, size, links = [node.tag], set(), 0, 0
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"<{child.hash}>")
                shapes.add(child.shape)
                size += child.size
                links += child.links
            elif child := " ".join(child.split()):
                parts.append(child)
                size += len(child)
        node.size, node.links = size, size if node.tag == "a" else links
        if hashed:
            node.hash = _digest("\0".join(parts))
            node.shape = _digest("\0".join([_label(node.tag, node.attributes), *map(str, sorted(shapes))]))


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or _attributes(node).get("role") in ("main", "article")


def _hidden(node: Node) -> bool:
    """Whether tag, role or style say that an element is no article text."""
    if node.tag in OUT:
        return True
    given = _attributes(node)
    if not given or node.tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role") in OUT_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")))


def main_node(root: Node) -> tuple[Node, bool]:
    """The element that holds the article, and whether its tag or role says so.

    Articles within comments, sidebars and the like are none, unless there is no other.
    """
    marked, aside, articles = [], [], False
    stack = [(root, False)]
    while stack:
        node, out = stack.pop()
        if _is_main(node):
            (aside if out else marked).append(node)
        else:
            out = out or _hidden(node) or bool(node.attributes and _class_words(node) & (COMMENT_WORDS | {"related"}))
        stack.extend((c, out) for c in reversed(node.children) if isinstance(c, Node))
    for found in (marked, aside):
        articles = [n for n in found if n.tag == "article" or _attributes(n).get("role") == "article"]
        if found:
            return max(articles or found, key=lambda n: n.size), True
    named = []
    for node in root.walk():
        if node.tag in ("div", "section", "td") and node.attributes.strip():
            if _attributes(node).get("itemprop") == "articleBody":
                return node, True
            if _class_words(node) & MAIN_WORDS:
                named.append(node)
    best = max(named, key=lambda n: n.size, default=None)
    if best is not None and 2 * best.size >= root.size:
        return best, False
    return next((n for n in root.walk() if n.tag == "body"), root), False


def _holders(root: Node, top: Node) -> set[int]:
    """The ids of a node and of all that holds it."""
    path: list[Node] = []
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        del path[depth:]
        path.append(node)
        if node is top:
            return {id(n) for n in path}
        stack.extend((c, depth + 1) for c in reversed(node.children) if isinstance(c, Node))
    return set()


def slots(root: Node) -> Iterator[tuple[Node, int, int, bool]]:
    """Subtrees that may be template: node, content hash, skeleton hash (0 for none), and whether it is in the main text.

    They are block elements with text, but for the article, what holds it or most
    of the page's text, and the text blocks in it. A skeleton is place and shape:
    the labels on the way from the root, and what stands below. Text blocks have
    none, nor has an element in a marked article, nor one in unmarked main text
    whose parent has another alike.
    """
    top, marked = main_node(root)
    holders = _holders(root, top)
    elements = [(root, 0, root is top)]
    while elements:
        node, place, inside = elements.pop()
        children = [c for c in node.children if isinstance(c, Node)]
        labels = [_label(c.tag, c.attributes) for c in children]
        alike = Counter(labels)
        for child, label in zip(children, labels):
            here = _digest(f"{place}/{label}")
            elements.append((child, here, inside or child is top))
            text_block = child.tag in KEPT_IN_ARTICLE
            if not child.size or child.tag not in BLOCK or id(child) in holders or 2 * child.size > root.size or (inside and marked and text_block):
                continue
            bare = text_block or (inside and (marked or alike[label] > 1))
            yield child, child.hash, 0 if bare else _digest(f"{here}:{child.shape}"), inside


def prune(root: Node) -> None:
    """Takes out elements that by tag, role, class or id are no part of the article."""
    top, marked = main_node(root)
    holders = _holders(root, top) if marked else set()
    stack = [(root, root is top)]
    while stack:
        node, inside = stack.pop()
        kept: list[Node | str] = []
        for child in node.children:
            if isinstance(child, Node):
                if id(child) not in holders and _is_out(child, inside and marked, top):
                    kept.append(" ")
                    continue
                stack.append((child, inside or child is top))
            kept.append(child)
        node.children = kept


def _is_out(node: Node, inside: bool, top: Node) -> bool:
    if _hidden(node):
        return True
    if node.tag == "header":
        return not (inside and any(n.tag in ("h1", "h2", "h3") for n in node.walk()))
    if node.tag in ("html", "body", "main") or not node.attributes.strip():
        return False
    words = _class_words(node)
    if words & COMMENT_WORDS:
        return True
    if node is top or 2 * node.size >= top.size:
        return False
    return bool(words & OUT_WORDS) or bool(words & WEAK_WORDS and (not inside or 2 * node.links >= node.size))


def page_tree(source: str | None) -> Node:
    root = parse(source or "")
    measure(root)
    return root


def page_subtrees(source: str | None) -> tuple[int, int, dict[int, int]]:
    """The digest of a page, its text's length, and the hashes of subtrees that may be template.

    With each hash goes the length of the text that the page loses by it, where that counts.
    """
    root = page_tree(source)
    found: dict[int, int] = {}
    for node, content, skeleton, inside in slots(root):
        found.setdefault(content, 0)
        if skeleton:
            found[skeleton] = found.get(skeleton, 0) + (node.size if inside else 0)
    return _digest(f"{root.hash} {root.shape}"), root.size, found


def page_text(source: str | None, templates: frozenset[int] = frozenset()) -> str:
    """The main text: blocks in page order, joined by line feeds."""
    root = parse(source or "")
    measure(root, hashed=bool(templates))
    if templates:
        gone = {id(n) for n, content, skeleton, _ in slots(root) if content in templates or skeleton in templates}
        if gone:
            for node in root.walk():
                node.children = [" " if isinstance(c, Node) and id(c) in gone else c for c in node.children]
            measure(root, hashed=False)
    prune(root)
    measure(root, hashed=False)
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    stack: list = [main_node(root)[0]]
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            line.append(html.unescape(item))
        elif item.tag == "br":
            line.append(" ")
        else:
            if item.tag in BLOCK:
                end()
                stack.append(None)
            stack.extend(reversed(item.children))
    end()
    return "\n".join(blocks)


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` for every row of `pages`.

    A null or empty html, or a page without main text, gives an empty text. Pages
    without a url, or with one that names no host, are one host. Null ids are
    kept; repeated rows come back as often as they came in, and count once as
    pages of their host. No rows give no rows. Other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html")
    )
    seen = rows.select("host", "html").mapInArrow(_subtrees, "host string, page long, subtree long, lost long, total long")
    # Distinct pages first, so a host with many copies of one page sends few rows.
    seen = seen.distinct().groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lost").alias("lost"), F.sum("total").alias("total")
    )
    seen = stored(seen, "subtrees")
    sizes = seen.where("subtree is null").select("host", F.col("n").alias("pages"))
    often = seen.where(f"subtree is not null and n >= {PAGES} and {SLOT} * lost <= total").join(sizes, "host").where(F.col("n") >= SHARE * F.col("pages"))
    templates = stored(often.groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("templates")), "templates")
    found = rows.join(templates, "host", "left").select("page_id", "url", "html", "templates")
    schema = f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars long"
    return found.mapInArrow(_texts, schema)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {"host": [], "page": [], "subtree": [], "lost": [], "total": []}
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            page, total, found = page_subtrees(source.as_py())
            n = len(found) + 1
            rows["host"] += [host] * n
            rows["page"] += [page] * n
            rows["subtree"] += [None, *found]
            rows["lost"] += [0, *found.values()]
            rows["total"] += [total] * n
        arrays = [pa.array(v, pa.string() if k == "host" else pa.int64()) for k, v in rows.items()]
        yield pa.RecordBatch.from_arrays(arrays, list(rows))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, listed in zip(batch.column("html"), batch.column("templates")):
            texts.append(page_text(source.as_py(), frozenset(listed.as_py() or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )
