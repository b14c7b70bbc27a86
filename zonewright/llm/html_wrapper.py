"""Main text of web pages by wrappers induced from the pages of each host.

A page becomes a tree of its block elements. The trees of one host are folded into one wrapper:
two trees are aligned by simple tree matching (the largest ordered matching of children, level
by level), aligned nodes become one, others stay as optional nodes, and repeated paragraphs, list
items and rows are one repeated node. Each node of a wrapper knows in how many pages it stands and
whether its own text is the same in all of them. Text that is the same in ``least_pages`` pages
or more, while others of the host's nodes vary, is template; varying nodes are slots.

A page is then aligned with its host's wrapper. Of its slots, those of a known role that is not
content (menus, footers, adverts, forms, comments and so on, by element, class, id or role) are
left out. Where the page names its main part (``article``, ``main``), the text inside is content,
also what other pages share; elsewhere a slot is content unless it consists mostly of links.

Every page of a host takes part in its wrapper: tasks fold their own pages, then partial wrappers
are merged in two rounds, salted first, so that a host with most of the pages is no task's burden.

Defined results: a null or empty html gives an empty text; pages without a host (null url or no
``://``) share the empty host; repeated rows give repeated rows; unclosed, crossed and cut-off
elements are closed as HTML does it; elements nested deeper than ``DEEPEST`` count as part of the
element there; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, slices
from zonewright.llm.url_rules import host_and_path

DEEPEST = 60
#: Children of one node that are aligned one by one; beyond, equal neighbours are one node.
MOST_CHILDREN = 32
#: Wrappers that a task holds before it writes them out, and salts of the first merge.
HELD_HOSTS, SALTS = 1000, 16
#: Bytes up to which all wrappers are broadcast, measured beforehand.
BROADCAST_BYTES = 32 << 20
#: Weight of a matched node next to that of an equal text.
NODE = 1 << 20

# Fixed values of HTML: elements without content, and elements that flow within a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark nobr q rp"
    " rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Repeatable parts of running text.
FLOW = set(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th ul ol dl table tbody thead blockquote pre figure"
    " figcaption hr".split()
)
#: Elements that are never part of an article's text.
NOISE_TAGS = set(
    "head script style noscript template svg math iframe object canvas audio video nav footer aside"
    " form button select textarea input dialog menu".split()
)
#: Those of them, and others, that may stand within a line and do not end it.
IN_LINE = set(
    "script style noscript template svg math iframe object canvas audio video button select textarea"
    " input option img meta link wbr".split()
)
NOISE_ROLES = set(
    "navigation contentinfo complementary search form alert dialog menu menubar banner".split()
)
#: Words in class or id that tell such a part.
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar"
    " navigation breadcrumb breadcrumbs sidebar sidenav aside widget footer comment comments respond"
    " disqus notice notices cookie cookies consent gdpr popup modal newsletter subscribe signup login"
    " search share sharing social related recommended pagination pager toolbar copyright".split()
)
#: The same, but only outside the main part, where a heading may stand in such an element.
HEADER_WORDS = set("header masthead topbar banner".split())
MAIN_TAGS = {"article", "main"}
#: An opening tag closes the nearest open one of these, up to a border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_BORDERS = {"td", "th", "table", "caption", "button", "object", "template"}
_WORDS = re.compile(r"[a-z]+")


class Node:
    """A block element: its signature, texts and child elements in order."""

    __slots__ = ("tag", "sign", "items", "noise", "main", "chars", "linked")

    def __init__(self, tag: str, sign: str, noise: bool, main: bool):
        self.tag, self.sign, self.noise, self.main = tag, sign, noise, main
        self.items: list[str | Node] = []
        self.chars = self.linked = 0


class PageTree(HTMLParser):
    """Builds the tree of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", False, False)
        self.open: list[tuple[str, Node]] = [("", self.root)]
        self.links = 0

    def _pop(self, tags: set[str], borders: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k][0]
            if tag in tags:
                self.links -= sum(t == "a" for t, _ in self.open[k:])
                del self.open[k:]
                return
            if tag in borders:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = self.open[-1][1]
        if tag in INLINE:
            self.links += tag == "a"
            self.open.append((tag, node))
            return
        if tag == "br":
            node.items.append(" ")
            return
        if tag in CLOSES:
            self._pop(*CLOSES[tag])
        if tag not in IN_LINE:
            self._pop({"p"}, P_BORDERS)
        node = self.open[-1][1]
        named = {k: v or "" for k, v in attrs}
        words = set(_WORDS.findall(f"{named.get('class', '')} {named.get('id', '')}".lower()))
        role = named.get("role", "").lower()
        main = node.main or tag in MAIN_TAGS or role in ("main", "article")
        noise = (
            node.noise
            or tag in NOISE_TAGS
            or role in NOISE_ROLES
            or "hidden" in named
            or not words.isdisjoint(NOISE_WORDS)
            or (not main and (tag == "header" or not words.isdisjoint(HEADER_WORDS)))
        )
        if tag in VOID:
            if tag not in IN_LINE:
                node.items.append(Node("", "", noise, main))
            return
        if node.noise or (len(self.open) > DEEPEST and not noise):
            node.items.append(Node("", "", node.noise, main))
            self.open.append((tag, node))
            return
        sign = " ".join([tag, *sorted(words)])
        child = Node(tag, sign, noise, main)
        node.items.append(child)
        self.open.append((tag, child))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # a slash closes nothing in HTML
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == tag:
                    self.links -= tag == "a"
                    del self.open[k]
                    return
                if self.open[k][0] not in INLINE:
                    return
        elif tag not in ("body", "html"):
            before = self.open[-1][1]
            self._pop({tag}, set())
            if self.open[-1][1] is before:
                before.items.append(Node("", "", before.noise, before.main))

    def handle_data(self, data: str) -> None:
        node = self.open[-1][1]
        if node.noise:
            return
        node.items.append(data)
        size = sum(map(len, data.split()))
        node.chars += size
        node.linked += size if self.links else 0


def parse(html: str | None) -> Node:
    page = PageTree()
    page.feed(html or "")
    page.close()
    return page.root


class Slot:
    """A node of a wrapper. ``text`` is a digest of the own text, None once it varies."""

    __slots__ = ("sign", "pages", "text", "chars", "linked", "kids", "nodes", "of")

    def __init__(self, sign: str, pages: int, text: str | None, chars: int, linked: int):
        self.sign, self.pages, self.text, self.chars, self.linked = sign, pages, text, chars, linked
        self.kids: list[Slot] = []
        #: elements of a page, and the wrapper's slot they are aligned with
        self.nodes: list[Node] = []
        self.of: Slot | None = None

    def dump(self) -> list:
        return [self.sign, self.pages, self.text, self.chars, self.linked, [k.dump() for k in self.kids]]

    @staticmethod
    def load(data: list) -> Slot:
        slot = Slot(*data[:5])
        slot.kids = [Slot.load(k) for k in data[5]]
        return slot


def tree_of(nodes: list[Node]) -> Slot:
    """A page's slots: repeated parts of running text, or marked neighbours, are one."""
    own = " ".join(" ".join("".join(i for i in n.items if isinstance(i, str)).split()) for n in nodes)
    digest = hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest() if own.strip() else ""
    slot = Slot(nodes[0].sign, 1, digest, sum(n.chars for n in nodes), sum(n.linked for n in nodes))
    slot.nodes = nodes
    children = [i for n in nodes for i in n.items if isinstance(i, Node) and i.tag]
    groups: list[list[Node]] = []
    flows: dict[str, list[Node]] = {}
    containers = sum(c.tag not in FLOW for c in children)
    for child in children:
        if child.tag in FLOW:
            if child.sign not in flows:
                groups.append(flows.setdefault(child.sign, []))
            flows[child.sign].append(child)
        elif (
            groups
            and groups[-1][0].sign == child.sign
            and (" " in child.sign or containers > MOST_CHILDREN)
        ):
            groups[-1].append(child)
        else:
            groups.append([child])
    slot.kids = [tree_of(g) for g in groups]
    return slot


def matching(a: list[Slot], b: list[Slot]) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two ordered lists: its size and the pairs at this level.

    Matched nodes count ``NODE`` each; of matchings with equally many, that with more equal texts wins.
    """
    if not a or not b:
        return 0, []
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    gain = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            score = max(best[i][j + 1], best[i + 1][j])
            if x.sign == y.sign:
                gain[i, j] = NODE + matching(x.kids, y.kids)[0] + bool(x.text and x.text == y.text)
                score = max(score, best[i][j] + gain[i, j])
            best[i + 1][j + 1] = score
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs[::-1]


def fold(into: Slot, other: Slot) -> Slot:
    """Merges two aligned trees into the first."""
    into.pages += other.pages
    into.chars += other.chars
    into.linked += other.linked
    if into.text != other.text:
        into.text = None
    merged, left, right = [], 0, 0
    pairs = matching(into.kids, other.kids)[1]
    for i, j in [*pairs, (len(into.kids), len(other.kids))]:
        merged += into.kids[left:i] + other.kids[right:j]
        if i < len(into.kids):
            merged.append(fold(into.kids[i], other.kids[j]))
        left, right = i + 1, j + 1
    into.kids = merged
    return into


def align(page: Slot, wrapper: Slot) -> None:
    """Notes for each slot of a page the wrapper's slot it is aligned with."""
    page.of = wrapper
    for i, j in matching(page.kids, wrapper.kids)[1]:
        align(page.kids[i], wrapper.kids[j])


def varies(wrapper: Slot) -> bool:
    return wrapper.text is None or any(map(varies, wrapper.kids))


def main_text(root: Node, wrapper: Slot, least_pages: int) -> str:
    """Text blocks of the content slots of a page, in page order."""
    tree = tree_of([root])
    align(tree, wrapper)
    learned = wrapper.pages >= least_pages and varies(wrapper)
    kept: set[int] = set()
    named = False
    waiting = [tree]
    while waiting:
        slot = waiting.pop()
        waiting += slot.kids
        for node in slot.nodes:
            named = named or (node.main and not node.noise)
            if node.noise:
                continue
            of = slot.of
            template = learned and of is not None and of.text is not None and of.pages >= least_pages
            links = of is not None and 2 * of.linked > of.chars
            if node.main or not (template or links):
                kept.add(id(node))
    blocks: list[str] = []
    line: list[str] = []

    def end_line() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    def walk(node: Node) -> None:
        own = id(node) in kept and (node.main or not named)
        for item in node.items:
            if isinstance(item, str):
                if own:
                    line.append(item)
                continue
            if item.tag in IN_LINE:
                continue
            end_line()
            if not item.noise and item.tag:
                walk(item)
                end_line()

    walk(root)
    end_line()
    return "\n".join(blocks)


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Slot] = {}
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            tree = tree_of([parse(html)])
            if host in held:
                fold(held[host], tree)
                continue
            if len(held) >= HELD_HOSTS:
                yield _wrappers(held)
                held = {}
            held[host] = Slot.load(tree.dump())
    if held:
        yield _wrappers(held)


def _wrappers(held: dict[str, Slot]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(held), pa.string()),
            pa.array([json.dumps(w.dump(), separators=(",", ":")) for w in held.values()], pa.string()),
        ],
        names=["host", "wrapper"],
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges neighbouring rows of one host."""
    host, held = None, None
    for batch in batches:
        for row in batch.to_pylist():
            fresh = Slot.load(json.loads(row["wrapper"]))
            if held is not None and row["host"] == host:
                fold(held, fresh)
                continue
            if held is not None:
                yield _wrappers({host: held})
            host, held = row["host"], fresh
    if held is not None:
        yield _wrappers({host: held})


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """One row per host: host and its wrapper; from ``host`` and ``html``."""
    schema = "host string, wrapper string"
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))
    return (
        pages.select("host", "html")
        .mapInArrow(_fold_pages, schema)
        .withColumn("_salt", salt)
        .repartition(parts, "host", "_salt")
        .sortWithinPartitions("host", "_salt", "wrapper")
        .drop("_salt")
        .mapInArrow(_merge, schema)
        .repartition(parts, "host")
        .sortWithinPartitions("host", "wrapper")
        .mapInArrow(_merge, schema)
    )


def _extract(least_pages: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for html, wrapper in zip(
                    part.column("html").to_pylist(), part.column("wrapper").to_pylist()
                ):
                    if wrapper not in known:
                        if len(known) >= 256:
                            known.clear()
                        known[wrapper] = Slot.load(json.loads(wrapper))
                    texts.append(main_text(parse(html), known[wrapper], least_pages))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = 4,
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    placed = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        host_and_path(F.col(url_col).cast("string"))["host"].alias("host"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    wrappers = materialize(induce_wrappers(placed), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64)).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        joined = placed.join(F.broadcast(wrappers), "host")
    else:
        # pages of one host go to many tasks
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        own = F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")
        joined = placed.withColumn("_salt", own).join(
            wrappers.withColumn("_salt", F.explode(salts)).hint("shuffle_merge"), ["host", "_salt"]
        )
    schema = f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars bigint"
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(_extract(least_pages), schema)
