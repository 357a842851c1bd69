"""Main text of pages by the style trees of their sites.

The pages of a host, but for scripts and other unseen parts, are merged into one
tree. A node is a path of elements with their looks (tag and class or id words)
and has, over the distinct pages that show it, two relative entropies: that of
its own text (content) and that of the sequence of elements below it
(presentation). A block's importance is its node's content entropy, halved where
no node from its branch down varies in presentation. What an element is called
(menu, footer, advert), and whether a block lies within or beside the page's
article or main part, are evidence that is added to the importance, the latter
as far as the page's text lies in that part; a page's text is that of its blocks
which are left at ``IMPORTANCE`` or more. Each page is parsed once, in time that
grows with its length whatever its depth: a node is named by a 64-bit hash of its
path, made from its parent's.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .runtime import dealt_join, materialize, pieces
from .textkit import chunks

#: Stored bytes of the parts that a hot host's pages are dealt to.
PART_BYTES = 16 << 20
#: Blocks below this importance go; a node starts with the importance PRIOR, as if WEIGHT pages had told so.
IMPORTANCE, PRIOR, WEIGHT = 0.3, 0.5, 3
#: Evidence: a telling name or tag, a place beside the page's article, both, a place within it.
NAMED, BESIDE, BOTH, WITHIN = -0.6, -0.25, -0.65, 0.15
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes plaintext".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose text is not shown as a page's text.
_UNSEEN = frozenset("head script style noscript iframe template svg math object canvas audio video button select textarea input title xmp noembed noframes".split())
#: Elements that by their tag are other parts than the article.
_ASIDE = frozenset("nav header footer aside form menu dialog".split())
#: Words of a class, id or role that name other parts than the article.
_NAMES = frozenset("ad ads adv advert advertisement advertising adverts banner banners breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer header login masthead menu menus nav navbar navigation newsletter notice notices pagination popup promo promos promoted promotion related recommended reply replies respond rail share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split())
#: Words that say of a part where or how it stands: before them comes what it is.
_PLACES = frozenset("area bar block bottom box button buttons column container content form group heading holder icon icons inner item items left link links list main module outer page panel post posts primary region right row secondary section site slot stories story text title top unit wide wrap wrapper zone".split())
#: Words before ``header`` that make it an article's own.
_OWN = frozenset("article entry post story content".split())
_CLOSES_P = _BLOCK - {"option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "title", "legend", "summary"}
#: Elements that end an open one of the same family, up to the family's container.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_MAIN = frozenset(("article", "main"))
# a quoted value ends where more attributes or the tag's end follow, else the quote was left open
_TOKEN = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]{0,100000}\"(?=[\s/>])|=\s*'[^']{0,100000}'(?=[\s/>])|=)*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


class Place:
    """A node of a page: hash of its path, its parent's, how its branch stands to the
    parent's (``GOES_ON``, ``STARTS`` a branch, lies ``ABOVE`` branches), and the looks
    of the children of each element there."""

    __slots__ = ("path", "parent", "branch", "looks")

    def __init__(self, path: int, parent: int, branch: int):
        self.path, self.parent, self.branch, self.looks = path, parent, branch, []


GOES_ON, STARTS, ABOVE = range(3)


class Node:
    """An open element: its place's path, whether its text is unseen, whether it is named
    as another part than the article or within it, and the looks of its children."""

    __slots__ = ("tag", "path", "unseen", "named", "main", "looks")

    def __init__(self, tag: str, path: int, unseen: bool, named: bool, main: bool, looks: list[str]):
        self.tag, self.path, self.unseen, self.named, self.main, self.looks = tag, path, unseen, named, main, looks

    @property
    def kind(self) -> tuple[bool, bool, bool]:
        return self.unseen, self.named, self.main


def _told(name: str) -> bool:
    """Whether a class, id or role says that its element is another part than the article:
    its last word that isn't about place does (related-posts, site-footer, share-buttons,
    but not social-history or article-header)."""
    parts = [w for w in re.split(r"[^a-z]+", re.sub(r"\d+", "", name)) if w]
    while len(parts) > 1 and parts[-1] in _PLACES:
        parts.pop()
    return bool(parts) and parts[-1] in _NAMES and not (parts[-1] == "header" and len(parts) > 1 and parts[-2] in _OWN)


def _look(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """An element's look, whether its text is unseen, and whether it is named as another
    part than the article."""
    names, hidden = [], False
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or key == "aria-hidden":
                hidden |= key == "hidden" or value == "true"
            else:
                names += value.split()
    words = {w for n in names for w in re.split(r"[^a-z]+", re.sub(r"\d+", "", n)) if w}
    own = tag not in ("html", "body", "article", "main")
    named = tag in _ASIDE or own and any(map(_told, names))
    return tag + "".join(f".{w}" for w in sorted(words)), tag in _UNSEEN or own and hidden, named


def parse(page: str | None) -> tuple[list[tuple[int, str, bool, bool]], dict[int, Place]]:
    """Blocks of text in page order: path, text, whether named as another part than the
    article, whether inside an article or main part; and the seen nodes by path, a
    parent before its children. White space in a block is one space; blocks without
    text and unseen parts are left out."""
    out: list[tuple[int, str, bool, bool]] = []
    places: dict[int, Place] = {}
    stack = [Node("", 0, False, False, False, [])]
    opened: Counter[str] = Counter()
    held: list[str] = []
    at: Node | None = None

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text and not at.unseen:
                out.append((at.path, text, at.named, at.main))
            held.clear()

    def take(text: str) -> None:
        nonlocal at
        # inline elements belong to the block around them unless they are told apart
        node = stack[-1]
        if at is not node and held and node.kind != at.kind:
            flush()
        if not held:
            at = node if node.unseen or node.named else next((n for n in reversed(stack) if n.tag in _BLOCK), stack[0])
        held.append(text)

    def close(n: int) -> None:
        if any(x.tag in _BLOCK or x.unseen or x.named for x in stack[n:]):
            flush()
        opened.subtract(x.tag for x in stack[n:])
        del stack[n:]

    def innermost(tag: str) -> int:
        """Where the last open element of a tag stands; 0 for none."""
        return next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0) if opened[tag] else 0

    page = page or ""
    place, limit = 0, len(page)
    while place < limit:
        m = _TOKEN.search(page, place)
        if m is None:
            take(page[place:])
            break
        if m.start() > place:
            take(page[place : m.start()])
        place = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                take(" ")
            n = innermost(tag)
            if n:
                close(n)
            elif tag == "p":
                flush()
            continue
        if tag == "br" or tag == "wbr":
            take(" " if tag == "br" else "")
            continue
        if tag in _CLOSES_P:
            n = innermost("p")
            if n:
                close(n)
        if tag in _ENDS:
            family, holds = _ENDS[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in family) else ():
                if stack[i].tag in holds:
                    break
                if stack[i].tag in family:
                    close(i)
                    break
        parent = stack[-1]
        look, unseen, named = _look(tag, m[3])
        if tag in _BLOCK or unseen or named:
            flush()
        # a header inside an article belongs to it where it holds the title
        if tag == "header" and parent.main and not parent.named:
            named = any(w in _NAMES for w in look.split(".")[1:])
        if not unseen:
            parent.looks.append(look)
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, place)
            place = end.start() if end else limit
            if tag == "title" or tag == "textarea" or not end:
                continue
            stop = page.find(">", place)
            place = stop + 1 if stop >= 0 else limit
            continue
        main = parent.main or tag in _MAIN or tag == "div" and "main" in look.split(".")[1:]
        path, looks = parent.path, parent.looks
        if tag in _BLOCK or named:
            path, looks = xxhash.xxh3_64_intdigest(f"{parent.path:x}>{look}") >> 1, []
            if not (parent.unseen or unseen):
                # a branch begins below the body, and anew at a name
                if path not in places:
                    places[path] = Place(path, parent.path, ABOVE if tag in ("html", "body") else STARTS if named and not parent.named else GOES_ON)
                places[path].looks.append(looks)
        opened[tag] += 1
        stack.append(Node(tag, path, parent.unseen or unseen, parent.named or named, main, looks))
    flush()
    return out, places


def host_of(url: str | None) -> str:
    """The host of an address in lower case; empty for none."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


_PARSED = "host string, page long, blocks array<struct<path: long, text: string, named: boolean, main: boolean>>, nodes array<struct<path: long, parent: long, branch: int, content: long, presentation: long>>"


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page (url, html and what goes with it) as its host, a hash of it, its blocks and
    its nodes with hashes of their text and of the looks below."""
    kinds = [pa.list_(pa.struct([("path", pa.int64()), ("text", pa.string()), ("named", pa.bool_()), ("main", pa.bool_())])), pa.list_(pa.struct([("path", pa.int64()), ("parent", pa.int64()), ("branch", pa.int32()), ("content", pa.int64()), ("presentation", pa.int64())]))]
    for batch in batches:
        for own in chunks(zip(batch.column("url").to_pylist(), batch.column("html"), range(len(batch)), strict=True), lambda r: 1 + (r[1].as_buffer().size if r[1].is_valid else 0), limit=4 << 20):
            rows = []
            for url, page, _ in own:
                page = page.as_py() or ""
                blocks, places = parse(page)
                texts: dict[int, list[str]] = {}
                for path, text, *_ in blocks:
                    texts.setdefault(path, []).append(text)
                nodes = [(p.path, p.parent, p.branch, _hash("\n".join(texts[p.path])) if p.path in texts else None, _hash("|".join(map(",".join, p.looks)))) for p in places.values()]
                # text outside any element, or in named inline ones, has a path without a place
                nodes += [(path, 0, ABOVE, _hash("\n".join(t)), None) for path, t in texts.items() if path not in places]
                rows.append((host_of(url), _hash(page), blocks, nodes))
            columns = list(zip(*rows, strict=True))
            rest = batch.slice(own[0][2], len(own)).drop_columns(["html"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], kinds[0]), pa.array(columns[3], kinds[1])], [*rest.schema.names, "host", "page", "blocks", "nodes"])


def parsed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, host, page (a hash), blocks and nodes of each row."""
    ship_package(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(_parse_pages, f"page_id {source.schema['page_id'].dataType.simpleString()}, url string, {_PARSED}")


def style_trees(parsed: DataFrame) -> DataFrame:
    """(host, path, pages, content, presentation) of the nodes of every host: on how many
    distinct pages, and the two relative entropies (``importance``).

    Copies of a page count once, so they make no template. Values are counted
    before hosts are put together, so a host with a third of all pages costs a task
    one row per node and distinct value it has seen.
    """
    each = parsed.select("host", "page", F.explode("nodes").alias("node"))
    values = F.array(F.struct(F.lit(True).alias("is_content"), F.col("node.content").alias("value")), F.struct(F.lit(False).alias("is_content"), F.col("node.presentation").alias("value")))
    seen = each.select("host", "page", F.col("node.path").alias("path"), F.explode(F.filter(values, lambda v: v["value"].isNotNull())).alias("v")).select("host", "page", "path", "v.*")
    counts = seen.distinct().groupBy("host", "path", "is_content", "value").agg(F.count("*").alias("n"))
    node = counts.groupBy("host", "path", "is_content").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"))
    entropy = F.when(F.col("pages") < 2, 1.0).otherwise(1 - F.col("s") / F.col("pages") / F.log(F.greatest("pages", F.lit(2))))
    both = node.groupBy("host", "path")
    return both.agg(F.max("pages").alias("pages"), F.max(F.when(F.col("is_content"), entropy)).alias("content"), F.max(F.when(~F.col("is_content"), entropy)).alias("presentation"))


#: Nodes by path: pages, content, presentation.
Tree = Mapping[int, tuple[int, float | None, float | None]]
_UNKNOWN = (0, None, None)


def node_importance(pages: int, content: float | None, varied: float) -> float:
    """The importance of a node's text on its site: of its content entropy, and the largest
    presentation entropy from its branch down."""
    if content is None:
        return PRIOR
    # one page alone tells nothing; the more there are, the less the prior counts
    return (content * (1 + varied) / 2 * (pages - 1) + PRIOR * WEIGHT) / (pages - 1 + WEIGHT)


def page_text(blocks: list[tuple[int, str, bool, bool]], nodes: list[tuple[int, int, int]], tree: Tree) -> str:
    """A page's main text by its blocks, its nodes (path, parent, branch) and its site's tree."""
    varied: dict[int, float] = {}
    for path, parent, branch in nodes:
        own = tree.get(path, _UNKNOWN)[2] or 0.0
        varied[path] = 0.0 if branch == ABOVE else own if branch == STARTS else max(own, varied.get(parent, 0.0))
    within = sum(len(text) for _, text, named, main in blocks if main and not named)
    seen = sum(len(text) for _, text, named, _ in blocks if not named)
    # a mark that holds little of the text tells little of the rest
    mark = min(1.0, 4 * within / seen) if seen else 0.0
    kept = []
    for path, text, named, main in blocks:
        evidence = WITHIN if main and not named else 0.0
        if within and not main:
            evidence = mark * BESIDE if not named else NAMED + mark * (BOTH - NAMED)
        elif named:
            evidence = NAMED
        pages, content, _ = tree.get(path, _UNKNOWN)
        if node_importance(pages, content, varied.get(path, 0.0)) + evidence >= IMPORTANCE:
            kept.append(text)
    return "\n".join(kept)


def main_text(page: str | None) -> str:
    """A single page's main text, its blocks joined by line feeds."""
    blocks, places = parse(page)
    return page_text(blocks, [(p.path, p.parent, p.branch) for p in places.values()], {})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text.

    Null or empty html gives an empty text, a null url counts as a host of its
    own kind, repeated rows keep a row each, other columns are ignored and an
    empty table gives an empty result. Pages of any length and depth are read
    whole.
    """
    parsed = materialize(parsed_pages(pages, id_col, url_col, html_col), "parsed-pages")
    # what a single page shows has the prior's importance, as what no page has shown
    nodes = materialize(style_trees(parsed).filter("pages > 1"), "style-trees")
    # nodes of a host: as many as its templates have, whatever its pages
    by_host = nodes.groupBy("host").agg(F.collect_list(F.struct("path", "pages", "content", "presentation")).alias("_tree"))
    sizes = parsed.groupBy("host").agg(F.count("*").alias("rows"))
    marked = dealt_join(parsed, by_host, "host", ["page_id", "page"], sizes, pieces(parsed, PART_BYTES)).select("page_id", "url", "host", "blocks", F.transform("nodes", lambda n: F.struct(n["path"], n["parent"], n["branch"])).alias("nodes"), "_tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees: dict[str, Tree] = {}
            text = []
            for blocks, own, host, tree in zip(batch.column("blocks"), batch.column("nodes"), batch.column("host").to_pylist(), batch.column("_tree"), strict=True):
                if host not in trees:
                    trees[host] = {n["path"]: (n["pages"], n["content"], n["presentation"]) for n in tree.as_py() or ()}
                text.append(page_text(_tuples(blocks.values), _tuples(own.values), trees[host]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    return marked.mapInArrow(run, f"page_id {parsed.schema['page_id'].dataType.simpleString()}, url string, text string")


def _tuples(rows: pa.StructArray) -> list[tuple]:
    return list(zip(*(c.to_pylist() for c in rows.flatten()), strict=True))


def importance(contents: list[int]) -> float:
    """The relative entropy of a node's values by their counts, as in ``style_trees``."""
    n = sum(contents)
    if n < 2:
        return 1.0
    return -sum(c / n * math.log(c / n) for c in contents) / math.log(n)
