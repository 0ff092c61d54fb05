"""HTML extraction by consensus host paths.

A path is the chain of tags and generalised classes from the body to a container, known by a digest that is made from
its parent's. Every page scores its containers by the text of their blocks, less what is link text, and votes for the
path of its best one: its articles, else its main part, else the lowest path that holds nearly all scored text. The votes
are added up over the pages of a host, one winning path per host, and the pages are extracted again below the nodes on
that path. So one odd page doesn't decide, and a page whose own best container is a long comment thread follows its host
where that has articles. Pages that lack the host's path, or hold little on it, use their own best one.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, join_table, read

# HTML's elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video select option datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body blockquote center div main section table tbody td tr".split())
PROSE = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
DROPPED = frozenset("nav aside footer form button menu dialog head".split()) | RAW
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
CLOSES_P = BLOCK - frozenset("body html".split())
NOT_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|"
    r"site-?header|page-?header|header|comments?|replies|reply|disqus|respond|cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|signup|"
    r"share|sharing|social|related|recommended|popup|modal|widget|pagination|pager|toolbar|skip-link|hidden|legal|copyright)(?:$|[\s_-])",
    re.I,
)
# Names of what is no article inside an article or main part, and words that go with them in one class name.
FOREIGN = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|comments?|replies|reply|disqus|respond|"
    r"cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|signup|share|sharing|social|popup|modal|widget|pagination|pager|toolbar|hidden",
    re.I,
)
BESIDE = re.compile(
    r"article|post|entry|page|site|user|reader|main|content|section|area|box|block|body|bar|banner|buttons?|container|form|group|icons?|inline|"
    r"inner|outer|items?|legal|links?|list|mobile|row|slot|sticky|text|thread|top|bottom|left|right|unit|wrap|wrapper|[0-9a-f]*[0-9][0-9a-f]*|",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^<>]*+>|<(/?)([A-Za-z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
LISTS = ("ul", "ol", "dl", "table", "menu")
FELLOWS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
SEMANTIC = ("article", "main")
LEAST_SEMANTIC = 0.25
NEARLY_ALL = 0.9
LITTLE = 0.2


class Paths:
    """The paths of a page by number; a parent's number is less than its children's."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.parents: list[int] = []
        self.depths: list[int] = []
        self.digests: list[bytes] = []

    def number(self, parent: int, name: str) -> int:
        found = self.numbers.get((parent, name))
        if found is None:
            found = self.numbers[parent, name] = len(self.parents)
            self.parents.append(parent)
            above = self.digests[parent] if parent >= 0 else b""
            self.depths.append(self.depths[parent] + 1 if parent >= 0 else 0)
            self.digests.append(blake2b(above + name.encode("utf-8", "replace"), digest_size=16).digest())
        return found

    def below(self, digest: bytes) -> list[bool]:
        """For each path whether it is the one with this digest or lies below it."""
        out: list[bool] = []
        for own, parent in zip(self.digests, self.parents, strict=True):
            out.append(own == digest or parent >= 0 and out[parent])
        return out


class Node:
    """An open element. ``article``, ``main`` and ``nearest`` are the paths of containers around it, -1 for none."""

    __slots__ = ("article", "dropped", "main", "nearest", "path", "tag")

    def __init__(self, tag: str, dropped: bool, path: int, parent: Node | None) -> None:
        self.tag, self.dropped, self.path = tag, dropped, path
        self.article = parent.article if parent else -1
        self.main = parent.main if parent else -1
        self.nearest = path if parent is None or tag in CONTAINERS else parent.nearest
        if tag == "article" and self.article < 0:
            self.article = path
        if tag == "main" and self.main < 0:
            self.main = path

    @property
    def container(self) -> int:
        """What its text counts for: the outermost article, else the outermost main, else the nearest container."""
        return self.article if self.article >= 0 else self.main if self.main >= 0 else self.nearest


class Open:
    """The open elements, with the places of each tag and of blocks, so that no look walks through ancestors."""

    def __init__(self, top: Node) -> None:
        self.nodes = [top]
        self.places: dict[str, list[int]] = {top.tag: [0]}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()
            if self.blocks[-1] == len(self.nodes):
                self.blocks.pop()

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)


def generalised(value: str) -> str:
    """Classes in alphabetical order, without numbers and hashes: ``post-8731 wide`` and ``wide post-9`` are one."""
    names = {re.sub(r"[-_]?[0-9][0-9a-f]*", "", c.lower()) for c in value.split()}
    return "".join(f".{c}" for c in sorted(names - {""}))


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def foreign(name: str) -> bool:
    """Whether a class or id inside an article names something else: each of its parts is such a name or goes with one."""
    parts = re.split("[-_]+", name)
    return any(FOREIGN.fullmatch(p) for p in parts) and all(FOREIGN.fullmatch(p) or BESIDE.fullmatch(p) for p in parts)


def furniture(tag: str, given: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is no part of the article.

    Inside an article or main part a header may hold its headline, and only names that say nothing but comments, adverts,
    notices, sharing and the like count: ``share-buttons`` does, ``share-price`` doesn't.
    """
    if tag in DROPPED or tag == "header" and not inside_article:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in ROLES:
        return True
    named = f"{given.get('class', '')} {given.get('id', '')}".strip()
    if inside_article:
        return any(foreign(n) for n in named.split())
    return bool(named) and bool(NOT_CONTENT.search(named))


@lru_cache(maxsize=4096)
def judged(tag: str, given: str, inside_article: bool) -> tuple[str, bool]:
    """Name of an element in its path, and whether it is no part of the article."""
    values = attributes(given) if given.strip(" /\n\t\r") else {}
    if tag not in BLOCK:
        return tag, furniture(tag, values, inside_article) if values else tag in DROPPED
    return tag + generalised(values.get("class", "")), furniture(tag, values, inside_article)


def blocks(html: str, paths: Paths) -> Iterator[tuple[Node, str, int]]:
    """Blocks of a page in its order: the node they stand in, their text and how many characters of it are links.

    Unclosed and wrongly nested tags are put up with: a block closes an open paragraph, an end tag closes what is
    open inside, and one without a start is left out. What is dropped gives no blocks. The time grows with the
    page, however deep its elements are nested.
    """
    top = Node("body", False, paths.number(-1, "body"), None)
    open_ = Open(top)
    at, size = 0, len(html)
    parts: list[str] = []
    linked, in_link, owner = 0, 0, top

    def flush() -> Iterator[tuple[Node, str, int]]:
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                yield owner, text, linked
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked, owner
        if text and not open_.nodes[-1].dropped:
            if not parts:
                owner = open_.nodes[open_.blocks[-1]]
            parts.append(text)
            if in_link:
                linked += len(text)

    while at < size:
        found = TOKEN.search(html, at)
        if found is None:
            add(cut_tail(html[at:]))
            break
        add(html[at : found.start()])
        at = found.end()
        if found[1] is not None:
            add(found[1].replace("&", "&amp;"))
        if found[3] is None:
            continue
        tag = found[3].lower()
        if found[2]:
            if tag == "a":
                in_link = 0
            place = open_.last(tag)
            if tag == "br" or tag == "p" and place < 0:
                add(" ")
            if place <= 0:
                continue
            if open_.blocks[-1] >= place:
                if tag not in BLOCK:
                    continue
                yield from flush()
            open_.cut(place)
            continue
        if tag in ("html", "body"):
            if tag == "body" and len(open_.nodes) == 1:
                top = Node("body", False, paths.number(-1, "body" + generalised(attributes(found[4]).get("class", ""))), None)
                open_.nodes[0] = top
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in RAW:
            if not found[4].rstrip().endswith("/"):
                end = RAW_END[tag].search(html, at)
                at = end.end() if end else size
            add(" ")
            continue
        if tag in BLOCK:
            if parts:
                yield from flush()
            make_room(open_, tag)
        if tag in VOID:
            continue
        if tag == "a":
            in_link = 1
        node = open_.nodes[-1]
        judge = judged if len(found[4]) <= 200 else judged.__wrapped__
        name, dropped = judge(tag, found[4], node.article >= 0 or node.main >= 0)
        if dropped and not node.dropped:
            yield from flush()
        open_.push(Node(tag, dropped or node.dropped, paths.number(node.path, name), node))
    yield from flush()


def cut_tail(text: str) -> str:
    """Text without a tag that the end of the page has cut off."""
    at = text.rfind("<")
    return text[:at] if at >= 0 and re.match(r"<[/!A-Za-z]", text[at:]) else text


def make_room(open_: Open, tag: str) -> None:
    """Close what ``tag`` ends: a block ends a paragraph, an item or a cell ends its fellow in the same list or table."""
    if tag in CLOSES_P and (p := open_.last("p")) > 0:
        open_.cut(p)
    fellow = open_.last(*FELLOWS.get(tag, ()))
    if fellow > open_.last(*LISTS):
        open_.cut(fellow)


class Page:
    """A parsed page: its paths, its blocks and the score of each container path.

    A block scores its characters that are no links, in full where it is prose and half elsewhere.
    """

    def __init__(self, html: str) -> None:
        self.paths = Paths()
        self.blocks: list[tuple[int, str]] = []
        self.own: dict[int, float] = {}
        self.semantic: set[int] = set()
        for node, text, linked in blocks(html, self.paths):
            self.blocks.append((node.path, text))
            at = node.container
            if node.article >= 0 or node.main >= 0:
                self.semantic.add(at)
            gain = max(len(text) - 2 * linked, 0) * (1.0 if node.tag in PROSE else 0.5)
            self.own[at] = self.own.get(at, 0.0) + gain
        self.whole = sum(self.own.values())

    def best(self) -> bytes | None:
        """The path of the page's best container, None for a page without scored text.

        Articles or main parts with a quarter of the score come first, else the lowest path that holds nine tenths of it.
        """
        if self.whole <= 0:
            return None
        chosen = max(sorted(self.semantic), key=lambda p: self.own[p], default=None)
        if chosen is not None and self.own[chosen] >= LEAST_SEMANTIC * self.whole:
            return self.paths.digests[chosen]
        held = [0.0] * len(self.paths.parents)
        for path, value in self.own.items():
            held[path] = value
        lowest, parents, depths = 0, self.paths.parents, self.paths.depths
        for path in range(len(held) - 1, -1, -1):
            if parents[path] >= 0:
                held[parents[path]] += held[path]
        for path, value in enumerate(held):
            if value >= NEARLY_ALL * self.whole and depths[path] >= depths[lowest]:
                lowest = path
        # Body tags with and without classes are roots of their own: a page that holds text in both is one.
        return self.paths.digests[lowest] if held[lowest] >= NEARLY_ALL * self.whole else b""

    def text(self, digest: bytes | None) -> str:
        """The blocks below a path; the empty digest stands for the whole page."""
        if digest == b"":
            return "\n\n".join(text for _, text in self.blocks)
        below = self.paths.below(digest)
        return "\n\n".join(text for path, text in self.blocks if below[path])

    def follows(self, digest: bytes) -> bool:
        """Whether the page has an article or main part on a path, or else holds more than a little there."""
        below = self.paths.below(digest)
        if any(below[p] for p in self.semantic):
            return True
        held = sum(value for p, value in self.own.items() if below[p])
        return held > LITTLE * self.whole if self.whole > 0 else any(below[p] for p, _ in self.blocks)


def extracted(html: str, digest: bytes | None) -> str:
    """Main text of a page below the nodes on its host's path, or below its own best container."""
    page = Page(html)
    if digest is not None and page.follows(digest):
        return page.text(digest)
    own = page.best()
    return page.text(b"" if own is None else own)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals: dict[tuple[str | None, bytes], int] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            best = Page(html).best()
            if best:
                totals[host, best] = totals.get((host, best), 0) + 1
        keys = list(totals)
        columns = [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.binary()), pa.array(list(totals.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "votes"])


def _extracted(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extracted(h, p) for h, p in zip(batch.column("__html").to_pylist(), batch.column("__path").to_pylist(), strict=True)]
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *added], names=[*keep, "text", "n_chars"])

    return run


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1))


def consensus(pages: DataFrame) -> DataFrame:
    """``host, path``: the path with the most votes of each host, by its digest; of equals the one with the least digest."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    votes = rows.mapInArrow(_voted, "host string, path binary, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), "path"))
    return checkpointed(votes.groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("__path")))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``, its code points.

    White space inside a block is one space, blocks are joined in page order by two line feeds. A null or empty
    page, and one without content, gives an empty text. Long pages and any depth of nesting take time in proportion to
    their length. A null url belongs to a host of its own. Columns called
    like the added ones are replaced; repeated rows are extracted alike; an empty table gives an empty result.
    """
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    rows = pages.select(*keep, F.coalesce(F.col("html"), F.lit("")).alias("__html"), host_of(F.col("url")).alias("__host"))
    found = consensus(pages).withColumnRenamed("host", "__host")
    joined = join_table(rows, found, ["__host"]).drop("__host")
    schema = joined.drop("__html", "__path").select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return joined.mapInArrow(_extracted(keep), schema)


def op2_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
