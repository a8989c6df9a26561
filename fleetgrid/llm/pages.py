"""Main text of web pages, with a site style tree.

The pages of a host are merged into one tree, whose nodes are the paths of block
elements (names, classes and ids). For each node two importances follow from how its
pages differ:

- presentation: the entropy of the sequences of its child blocks over the host's pages;
- content: one less the mean share of the host's other pages that have its texts, where the
  text of a node is that of its whole branch. A text that every page has says nothing about
  a page; one that a single page has is all its own.

A branch of low importance is removed from every page of the host; a heading or a
paragraph of an article that recurs stays with its branch. Names of menus, adverts and the
like are known beforehand: plain ones count for themselves, compound ones such as
`ad-slot` where the tree, links or brevity agree; none where it holds most of the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, ship_package

# HTML element names.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var".split()
)
_FURNITURE = frozenset(
    "nav footer aside form noscript template svg button select menu dialog object head".split()
)
_SAME_LEVEL = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
_LEVEL_ENDS = frozenset("ul ol dl table select article section div body".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer comment comments cookie cookies "
    "consent notice notices popup modal share social newsletter subscribe related widget "
    "pagination masthead".split()
)
# Inside an article these classes also name content.
_CONTENT_INSIDE = frozenset("notice notices related menu widget".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _RAW}
_HOST = re.compile(r"\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)
_SPACE = re.compile(r"\s+")


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


# First parts of compound names that deny the last one, and last parts that
# only tell a state.
_DENIALS = frozenset("has with no without is not show hide can".split())
_STATES = frozenset("open closed on off enabled disabled visible hidden active".split())
_PARTS = re.compile(r"[-_]+")

_PLAIN, _LAST, _FIRST, _MAYBE = 4, 3, 2, 1  # how an element is named as furniture


class _Element:
    __slots__ = (
        "article", "block", "block_at", "chars", "children", "hashes", "inner", "links", "name",
        "named", "noise", "parent", "path",
    )

    def __init__(self, name: str, parent: _Element | None):
        self.name, self.parent = name, parent  # the parent is the next block above
        self.path, self.named, self.block = "", 0, True
        self.noise = parent is not None and parent.noise
        self.article = parent is not None and parent.article
        self.block_at = self.chars = self.links = 0
        self.inner = False  # it has blocks inside
        self.children: list[str] = []
        self.hashes: list[int] = []


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _longer(path: str, label: str) -> str:
    """Paths are of bounded length: a long one goes on from its hash."""
    path = f"{path}/{label}"
    return path if len(path) <= 400 else f"#{_hash(path):x}"


def _named(token: str, article: bool) -> int:
    """How a class or id names furniture."""
    names = _NAMES - _CONTENT_INSIDE if article else _NAMES
    if token in names or (token == "header" and not article):
        return _PLAIN
    parts = _PARTS.split(token)
    if len(parts) < 2 or parts[0] in _DENIALS or parts[-1] in _STATES:
        return 0
    if not article and (parts[-1] in _NAMES or parts[-1] == "header"):
        return _LAST
    if article and parts[-1] in names:
        return _LAST
    if parts[0] in names:
        return _FIRST
    return _MAYBE if parts[0] in _NAMES or parts[-1] in _NAMES else 0


def _opened(name: str, attributes: str, top: _Element, above: _Element) -> _Element:
    """A new element in `top`, whose next block is `above`."""
    element = _Element(name, above)
    element.noise, element.article = top.noise or name in _FURNITURE, top.article
    label, named = name, 0
    element.article |= name in ("article", "main")
    if attributes and not attributes.isspace():
        for kind, *values in _ATTRIBUTE.findall(attributes):
            value = next(filter(None, values), "").lower()
            if kind.lower() == "role":
                element.noise |= value in _ROLES
                element.article |= value == "main" and not element.noise
            else:
                label += f".{value}"
                named = max(named, *(_named(x, element.article) for x in value.split()), 0)
    element.noise |= name == "header" and not element.article
    element.block = name not in _INLINE
    if name in ("html", "body", "main", "article"):
        named = 0
    if element.block:
        element.path, element.named = _longer(above.path, label), named
    else:
        element.path = above.path
        element.noise |= named == _PLAIN
    return element


class Page:
    """The blocks of a page outside semantic furniture, in order, and its block elements.

    Time and memory grow with the length of the html, however it is nested: an element knows
    its next block, and open elements are found by name.
    """

    def __init__(self, html: str):
        self.root = _Element("", None)
        self.elements = [self.root]
        self.blocks: list[tuple[_Element, str]] = []
        self.main = False
        self._stack = [self.root]
        self._open: dict[str, list[int]] = {}
        self._suspects: list[_Element] = []
        self._parts: list[str] = []
        self._linked = 0
        self._parse(html)

    def _close(self) -> None:
        """The text so far is a block of the innermost block element."""
        if self._parts:
            text = _SPACE.sub(" ", unescape("".join(self._parts))).strip()
            if text:
                owner = self._stack[self._stack[-1].block_at]
                owner.chars += len(text)
                owner.links += min(self._linked, len(text))
                owner.hashes.append(_hash(text))
                self.blocks.append((owner, text))
            self._parts.clear()
        self._linked = 0

    def _text(self, text: str) -> None:
        if not self._stack[-1].noise:
            self._parts.append(text)
            if self._open.get("a"):
                self._linked += len(text)

    def _pop(self) -> None:
        element = self._stack[-1]
        if element.block:
            self._close()
            above = element.parent
            above.chars += element.chars
            above.links += element.links
            if element.hashes:
                above.inner = True
                above.hashes.append(_hash(" ".join(map(str, element.hashes))))
            if self._suspects and self._suspects[-1] is element:
                self._suspects.pop()
        self._stack.pop()
        self._open[element.name].pop()

    def _pop_to(self, at: int) -> None:
        while len(self._stack) > at:
            self._pop()

    def _last(self, names: Iterable[str]) -> int:
        return max((self._open[x][-1] for x in names if self._open.get(x)), default=0)

    def _parse(self, html: str) -> None:
        stack, at, end = self._stack, 0, len(html)
        while at < end:
            found = _MARKUP.search(html, at)
            stop = found.start() if found else end
            if stop > at:
                self._text(html[at:stop])
            if not found:
                break
            at = found.end()
            closing, name, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
            if not name:
                continue
            name = name.lower()
            if closing:
                if self._open.get(name):
                    self._pop_to(self._open[name][-1])
            elif name in _VOID:
                self._text(" ")
            elif name in _RAW:
                over = _RAW_ENDS[name].search(html, at)
                at = over.start() if over else end
            else:
                self._start(name, attributes or "")
        self._pop_to(1)
        self._close()

    def _start(self, name: str, attributes: str) -> None:
        stack = self._stack
        if name not in _INLINE:
            self._close()
            above = stack[-1].block_at
            if stack[above].name == "p":
                self._pop_to(above)
            same = self._last(_SAME_LEVEL.get(name, ()))
            if same and same > self._last(_LEVEL_ENDS):
                self._pop_to(same)
        above = stack[stack[-1].block_at]
        element = _opened(name, attributes, stack[-1], above)
        if element.article and not element.noise:
            self.main |= name == "main" or not stack[-1].article and name != "article"
            if not stack[-1].article:
                for holder in self._suspects:  # what holds an article is no furniture
                    holder.named = 0
                self._suspects.clear()
        element.block_at = len(stack) if element.block else stack[-1].block_at
        if element.block:
            above.children.append(name)
            self.elements.append(element)
            if element.named:
                self._suspects.append(element)
        self._open.setdefault(name, []).append(len(stack))
        stack.append(element)

    def kept(self, low: dict[str, float]) -> list[str]:
        """The texts of the main part. `low` has the importance of the host's nodes where it
        is low."""
        total = max(1, self.root.chars)
        dropped: dict[int, bool] = {id(self.root): False}
        for element in self.elements[1:]:  # parents come first
            dropped[id(element)] = dropped[id(element.parent)] or _is_furniture(element, total, low)
        blocks = [(e, text) for e, text in self.blocks if not dropped[id(e)]]
        inside = [text for e, text in blocks if e.article]
        if self.main and inside or 2 * sum(map(len, inside)) >= sum(len(x) for _, x in blocks):
            return inside
        return [text for _, text in blocks]


def _is_furniture(element: _Element, total: int, low: dict[str, float]) -> bool:
    importance = low.get(element.path, 1.0)
    if importance < LEAST_IMPORTANCE and (element.inner or not element.article):
        return True
    if not element.named or 2 * element.chars > total and element.named != _PLAIN:
        return False
    if element.named > _FIRST:
        return True
    brief = element.named == _FIRST and element.chars <= 200
    return importance < DOUBTFUL or 2 * element.links >= element.chars or brief


# Below it a branch is removed, and below the other one where a compound name agrees.
LEAST_IMPORTANCE, DOUBTFUL = 0.2, 0.5


def page_blocks(html: str) -> list[tuple[str, str]]:
    """The page's blocks outside semantic furniture, in order, as path and text."""
    return [(element.path, text) for element, text in Page(html).blocks]


def _features(pages: DataFrame) -> DataFrame:
    """`host, path, kind, feature, page`: what each page shows at each node with text, and a
    row of kind `page` for each. A page is known by its main text."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple] = set()
            for url, html in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                host = host_of(url)
                if host is None or not html:
                    continue
                page = Page(html)
                if not page.blocks:
                    continue
                own = _hash("\n\n".join(page.kept({})))
                rows.add((host, "", "page", 0, own))
                layout: dict[str, list[str]] = {}
                for element in page.elements[1:]:
                    if element.hashes:
                        text = _hash(" ".join(map(str, element.hashes)))
                        rows.add((host, element.path, "content", text, own))
                        layout.setdefault(element.path, []).extend(element.children)
                for path, names in layout.items():
                    rows.add((host, path, "style", _hash(" ".join(names)), own))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in columns], names_)

    names_ = ["host", "path", "kind", "feature", "page"]
    schema = "host string, path string, kind string, feature long, page long"
    return pages.select("url", "html").mapInArrow(found, schema)


def style_tree(pages: DataFrame, scratch: Scratch, content_weight: float = 0.9) -> DataFrame:
    """`host, path, pages, importance` of the nodes with text of each host's merged tree.

    Pages of a host with the same main text count once; `pages` are those of the host. With m
    of them, a text on n has the share (n - 1) / (m - 1), whatever m. Layouts on shares p
    of the node's pages have the entropy -sum p log p, relative to that of as many even ones.
    """
    seen = scratch.table("features", _features(pages).distinct())
    hosts = seen.where("kind = 'page'").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    by_feature = seen.where("kind <> 'page'").groupBy("host", "path", "kind", "feature").agg(
        F.count(F.lit(1)).alias("n")
    )

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    n = F.col("n")
    nodes = by_feature.groupBy("host", "path").agg(
        F.avg(of("content", n)).alias("mean_n"),
        F.sum(of("style", n)).alias("at"),
        F.sum(of("style", n * F.log(n))).alias("n_log_n"),
        F.count(of("style", n)).alias("layouts"),
    )
    content = 1 - (F.col("mean_n") - 1) / (F.col("pages") - 1)
    entropy = (F.log("at") - F.col("n_log_n") / F.col("at")) / F.log("layouts")
    style = F.when(F.col("layouts") > 1, entropy).otherwise(0.0)
    importance = content_weight * content + (1 - content_weight) * style
    nodes = nodes.join(hosts.where("pages > 1"), "host")
    return nodes.select("host", "path", "pages", importance.alias("importance"))


def extract_main_text(
    pages: DataFrame,
    scratch: Scratch,
    least_pages: int = 5,
    broadcast_rows: int = 100_000,
    use_tree: bool = True,
) -> DataFrame:
    """`page_id, url, text` of every row of `page_id, url, html`.

    The text is that of `main`, else of the articles if they hold at least half of what is
    left, else of the whole body; without furniture, and without the branches whose
    importance on their host is low, on at least `least_pages` different pages. References
    are decoded, white space in a block is one space, blocks are joined by two line feeds.
    Null or empty pages have an empty text; pages without a host belong to no tree.
    Repeated rows each have their row; other columns are ignored.

    Low importances are broadcast while they are at most `broadcast_rows`; beyond it, pages
    and branches are joined by host. Without `use_tree`, names alone decide.
    """
    ship_package(pages.sparkSession)
    columns = pages.select("page_id", "url", "html")
    node = "array<struct<path:string,importance:double>>"
    source, shared = columns.withColumn("low", F.lit(None).cast(node)), None
    if use_tree:
        tree = style_tree(pages, scratch)
        low = (F.col("importance") < DOUBTFUL) & (F.col("pages") >= least_pages)
        low = scratch.table("low", tree.where(low).select("host", "path", "importance"))
        if low.count() <= broadcast_rows:
            known: dict[str, dict[str, float]] = {}
            for row in low.collect():
                known.setdefault(row["host"], {})[row["path"]] = row["importance"]
            shared = pages.sparkSession.sparkContext.broadcast(known)
        else:
            nodes = F.collect_list(F.struct("path", "importance")).alias("low")
            host = F.lower(F.regexp_extract("url", f"(?i)^{_HOST.pattern}", 1))
            hosts = low.groupBy("host").agg(nodes)
            source = columns.withColumn("host", host).join(hosts, "host", "left").drop("host")

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            rows = (batch.column(c).to_pylist() for c in ("url", "html", "low"))
            for url, html, nodes in zip(*rows, strict=True):
                low = {x["path"]: x["importance"] for x in nodes or ()}
                if shared is not None:
                    low = shared.value.get(host_of(url), {})
                texts.append("\n\n".join(Page(html or "").kept(low)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    source = source.select("page_id", "url", "html", "low")
    return source.mapInArrow(extracted, "page_id long, url string, text string")
