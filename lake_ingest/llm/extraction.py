"""Main text of web pages by site style trees.

The pages of a host are merged into one tree. A node of it stands for the elements of all these pages that
lie at the same place, by the tags and classes from the root down. It has two entropies: of its presentation,
the sequences of tags that its elements hold, and of its content, the clauses of the texts below it. What
repeats from page to page has a low entropy, so both measure how much a place has to say that other pages of
the host do not say there. The importance of a branch is ``(1 - G^l)`` of its presentation's and ``G^l`` of the
mean importance of all clauses in it, for ``l`` kinds of elements right below. Hosts with few pages prove
little: their importances are blended with those of the same place over all hosts, and these with 1.

From each page the branches of low importance are removed, as measured by that of the article they lie in, so
that a host of copies loses nothing. Entropy cannot tell reader comments from articles, both of which differ on
every page, nor an advert of one page. Elements that say by tag, role or class that they are menus, headers,
footers, sidebars, notices, adverts, forms or comments have no importance, and where a page marks its article
or main part, neither has what lies beside that.

Pages are parsed once, into blocks of their texts on shared storage. Counts are summed in each block before
they are shuffled; what a block is told is one row per place that it has. No page is shuffled, and a host that
holds most pages is one row per place and block, or clause and block.

Defined results: null or empty html, and a page without text, give an empty text; a null or unreadable address
is a host of its own, shared by all such pages; white space is what Python's ``split`` takes for it; elements
nested deeper than ``DEPTH`` share their ancestor's place and keep their texts; open tags, comments and quotes
end with the page; texts equal on all pages of a small host stay; repeated rows are extracted alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.llm.blocks import batch, bucketed, mixed, pack, slices_of, unpack
from lake_ingest.llm.shared import frugal, saved

# Weight of a branch's content against its presentation, per kind of element below it.
ATTENUATION = 0.9
# A branch below this share of its article's importance is removed.
THRESHOLD = 0.3
# So many pages count as much as what other hosts tell.
PRIOR_PAGES = 5
DEPTH = 32
SLICE_BYTES = 8 << 20

# Tags, roles and parts of classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp
    small span strike strong sub sup time tt u var wbr img""".split()
)
NO_TEXT = frozenset(
    """script style textarea title xmp iframe noembed noframes head noscript template svg math canvas object
    audio video map select datalist button form""".split()
)
NOISE_TAGS = frozenset("nav footer aside menu dialog fieldset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
NOISE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner
    sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie
    cookies consent gdpr notice newsletter subscribe subscription popup modal overlay share sharing social
    related recommended recommendations login signin signup search pagination pager toolbar""".split()
)
# A class that says one of these too is no frame around an article.
ARTICLE_WORDS = frozenset("article content main entry post story body title text headline".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>
    |<[!?/][^>]*+>?
    |<[a-zA-Z][^>]*+\Z""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
CLAUSE = re.compile(r"[.,;:!?|·•–—]+\s+")
WORD_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _print(*parts) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts))) >> 1


@lru_cache(4096)
def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag, the first of a name counting."""
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'") if value else ""))
    return out


@lru_cache(4096)
def role(tag: str, attrs: str) -> str:
    """What an element says to be: ``hard`` noise, ``soft`` noise (by class only), ``main`` or nothing."""
    held = attributes(attrs)
    style = held.get("style", "").replace(" ", "").lower()
    if "hidden" in held or held.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return "hard"
    said = held.get("role", "").lower()
    parts = {p.lower() for p in WORD_PART.findall(held.get("class", "") + " " + held.get("id", ""))}
    if tag in ("html", "body"):
        return ""
    if tag in NOISE_TAGS or said in NOISE_ROLES or parts & COMMENT_WORDS:
        return "hard"
    if tag in ("article", "main") or said == "main" or held.get("itemprop") == "articleBody":
        return "main"
    if tag == "header":
        return "header"
    return "soft" if parts & NOISE_WORDS and not parts & ARTICLE_WORDS else ""


@lru_cache(4096)
def _label(tag: str, attrs: str) -> str:
    """Tag and classes without their numbers, which tell an element's place."""
    classes = re.sub(r"\d+", "", attributes(attrs).get("class", "")).split()
    return ".".join([tag, *sorted(classes)])


class Page:
    """The texts of a page with their places, and its elements' presentations.

    ``runs`` are ``(place, noise, text)`` in page order, ``elements`` are ``(place, presentation)``; ``chains`` gets
    the places from the root down to each place, and which of them is the article.
    """

    def __init__(self, text: str, chains: dict[int, tuple[tuple[int, ...], int]]):
        self.runs: list[tuple[int, bool, str]] = []
        self.elements: list[tuple[int, int]] = []
        self.chains = chains
        root = _print("")
        chains.setdefault(root, ((root,), root))
        # An open element: tag, place, kind of noise, whether in an article, tags of its elements.
        self.open: list[tuple[str, int, str, bool, list[str]]] = [("", root, "", False, [])]
        self.count: dict[str, int] = {}
        self.kept: list[str] = []
        self.noise: list[str] = []
        self.marked: list[bool] = []
        self._read(text)
        while self.open:
            self._close()
        if any(main and not noise for (_, noise, _), main in zip(self.runs, self.marked)):
            self.runs = [(at, noise or not main, t) for (at, noise, t), main in zip(self.runs, self.marked)]

    def _read(self, text: str) -> None:
        at, end = 0, len(text)
        while at < end:
            token = TOKEN.search(text, at)
            if token is None:
                self._text(text[at:])
                return
            if token.start() > at:
                self._text(text[at : token.start()])
            at = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if token["end"]:
                self._end(tag)
                continue
            self._start(tag, token["attrs"].rstrip("/"))
            if tag in RAW and not token["attrs"].endswith("/"):
                close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(text, at)
                at = close.end() if close else end
                self._end(tag)

    def _text(self, text: str) -> None:
        if self.open[-1][2] != "none":
            if "&" in text:
                text = html.unescape(text)
            (self.noise if self.open[-1][2] else self.kept).append(text)

    def _flush(self) -> None:
        """End the block of text."""
        for held, noise in ((self.kept, False), (self.noise, True)):
            if held:
                text = " ".join("".join(held).split())
                held.clear()
                if text:
                    # Inline elements have the place of the block around them.
                    self.runs.append((self.open[-1][1], noise, text))
                    self.marked.append(self.open[-1][3])

    def _start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body", "head") and self.count.get(tag):
            return
        inline = tag in INLINE
        if not inline:
            self._flush()
            if tag in CLOSED_BY:
                self._close_open(CLOSED_BY[tag], LISTS.get(tag, {"table", "select"}))
            elif tag not in ("br", "hr"):
                self._close_open({"p"}, {"td", "th", "li", "div", "article", "section", "button"})
            if tag == "body":
                self._close_open({"head"}, set())
        if tag in VOID:
            return
        _, above, noise, main, tags = self.open[-1]
        said = role(tag, attrs)
        if tag in NO_TEXT or noise == "none":
            noise = "none"
        elif said == "hard" or (said == "header" and not main):
            noise = "hard"
        elif said == "main" and noise == "soft":
            noise = ""
        elif said == "soft" and not noise:
            noise = "soft"
        main = main or (said == "main" and not noise)
        place = above
        if not inline:
            tags.append(tag)
            place = self._place(above, _label(tag, attrs), said == "main" and not noise)
        self.open.append((tag, place, noise, main, [] if not inline else tags))
        self.count[tag] = self.count.get(tag, 0) + 1

    def _place(self, above: int, label: str, main: bool) -> int:
        chain, article = self.chains[above]
        if len(chain) >= DEPTH:
            return above
        place = _print(above, label)
        if place not in self.chains:
            self.chains[place] = ((*chain, place), place if main else article)
        return place

    def _close(self) -> None:
        tag, place, noise, _, tags = self.open[-1]
        if tag not in INLINE:
            self._flush()
            if noise != "none":
                self.elements.append((place, _print(*tags)))
        self.open.pop()
        if tag:
            self.count[tag] -= 1

    def _close_open(self, tags: set[str], scope: set[str]) -> None:
        """Close the nearest open element of these tags, unless one of the scope lies in between."""
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place][0]
            if tag in tags:
                while len(self.open) > place:
                    self._close()
                return
            if tag in scope or tag in ("", "html", "body"):
                return

    def _end(self, tag: str) -> None:
        if tag in ("html", "body", "br"):
            if tag == "br":
                self._flush()
            return
        inline = tag in INLINE
        for place in range(len(self.open) - 1, 0, -1) if self.count.get(tag) else ():
            held = self.open[place][0]
            if held == tag:
                while len(self.open) > place:
                    self._close()
                return
            if inline and held not in INLINE:
                return
        if not inline:
            self._flush()


def clauses(text: str) -> list[int]:
    """Fingerprints of the clauses of a text."""
    return [xxhash.xxh64_intdigest(c) >> 1 for c in CLAUSE.split(text) if c]


def host_of(url: str) -> Column:
    """Lower-case host of an address; empty if it has none."""
    address = F.lower(F.coalesce(F.col(url).cast("string"), F.lit("")))
    return F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://([^/?#]*@)?([^/?#:]*)", 2)


PAGES = "block long, payload binary, places binary"


def _parsed(rows: pa.RecordBatch) -> tuple[pa.Table, pa.Table]:
    """The rows with their runs and elements in place of the html, and the places with their chains."""
    chains: dict[int, tuple[tuple[int, ...], int]] = {}
    runs, elements = [], []
    for text in rows["text"].to_pylist():
        page = Page(text or "", chains)
        runs.append(page.runs)
        elements.append(page.elements)
    columns = {n: rows[n] for n in rows.schema.names if n != "text"}

    def lists(parts, field, kind):
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array([r[field] for p in parts for r in p], kind))

    columns["place"], columns["noise"], columns["runs"] = (
        lists(runs, i, kind) for i, kind in enumerate((pa.int64(), pa.bool_(), pa.large_string()))
    )
    columns["element"], columns["look"] = (lists(elements, i, pa.int64()) for i in (0, 1))
    places = {
        "place": pa.array(list(chains), pa.int64()),
        "chain": pa.array([list(c) for c, _ in chains.values()], pa.list_(pa.int64())),
        "article": pa.array([a for _, a in chains.values()], pa.int64()),
    }
    return pa.table(columns), pa.table(places)


def _flat(rows: pa.Table, name: str) -> tuple[np.ndarray | pa.Array, np.ndarray]:
    """Values of a list column on end, and the row of each."""
    column = rows[name].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten(), np.repeat(np.arange(len(rows)), np.diff(np.asarray(column.offsets)))


def _hosted(places: np.ndarray, hosts: np.ndarray) -> np.ndarray:
    """Number of a host's node at a place."""
    node = mixed(places.astype(np.uint64) ^ mixed(hosts.astype(np.uint64) + np.uint64(1)))
    return (node >> np.uint64(1)).astype(np.int64)


def _grouped(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns, and how often each is there."""
    if not len(columns[0]):
        return list(columns), np.zeros(0, np.int64)
    order = np.lexsort(columns[::-1])
    held = [c[order] for c in columns]
    new = np.append(True, np.any([c[1:] != c[:-1] for c in held], axis=0))
    first = np.flatnonzero(new)
    return [c[first] for c in held], np.diff(np.append(first, len(order)))


STATS = "kind int, node long, place long, item long, n long, entropy double, block long, chain array<long>"
NODE, LOOK, CLAUSES = 0, 1, 2


def _stats(block: int, rows: pa.Table, places: pa.Table) -> pa.RecordBatch:
    """Counts of a block: pages of each node, its presentations, its clauses with the sum of ``n ln n`` by page."""
    hosts = np.asarray(rows["host"])
    element, page = _flat(rows, "element")
    look, _ = _flat(rows, "look")
    element, look = np.asarray(element), np.asarray(look)
    node = _hosted(element, hosts[page])
    (nodes, at, _), _ = _grouped(node, element, page)
    (nodes, at), n_pages = _grouped(nodes, at)
    (look_node, look_at, looks), n_looks = _grouped(node, element, look)
    run_place, run_page = _flat(rows, "place")
    texts, _ = _flat(rows, "runs")
    found = [clauses(t) for t in texts.to_pylist()]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    clause = np.fromiter((c for f in found for c in f), np.int64, int(sizes.sum()))
    clause_at, clause_page = np.repeat(np.asarray(run_place), sizes), np.repeat(run_page, sizes)
    clause_node = _hosted(clause_at, hosts[clause_page])
    (by_node, by_at, by_clause, _), n = _grouped(clause_node, clause_at, clause, clause_page)
    (by_node, by_at, by_clause), pages = _grouped(by_node, by_at, by_clause)
    first = np.concatenate([[0], np.cumsum(pages)])[:-1].astype(np.int64)
    total = np.add.reduceat(n, first) if len(first) else n
    entropy = np.add.reduceat(n * np.log(np.maximum(n, 1)), first) if len(first) else n.astype(float)
    chains = dict(zip(places["place"].to_pylist(), places["chain"].to_pylist()))
    # A node's chain is that of its place on its host.
    host_at = dict(zip(node.tolist(), hosts[page].tolist()))
    chain = [
        _hosted(np.array(chains[p], np.int64), np.full(len(chains[p]), host_at[v])).tolist()
        for v, p in zip(nodes.tolist(), at.tolist())
    ]
    rest = len(looks) + len(by_clause)
    return batch(
        kind=pa.array(np.repeat([NODE, LOOK, CLAUSES], [len(nodes), len(looks), len(by_clause)]), pa.int32()),
        node=pa.array(np.concatenate([nodes, look_node, by_node])),
        place=pa.array(np.concatenate([at, look_at, by_at])),
        item=pa.array(np.concatenate([np.zeros(len(nodes), np.int64), looks, by_clause])),
        n=pa.array(np.concatenate([n_pages, n_looks, total]).astype(np.int64)),
        entropy=pa.array(np.concatenate([np.zeros(len(nodes) + len(looks)), entropy])),
        block=pa.array(np.full(len(nodes) + rest, block)),
        chain=pa.array(chain + [None] * rest, pa.list_(pa.int64())),
    )


def _tree(stats: DataFrame, key: str, chains: DataFrame) -> DataFrame:
    """``(key, pages, importance)`` of every node, for nodes told apart by ``key``.

    ``chains`` are ``(key, chain)``, a node's ancestors from the root down and itself.
    """
    nodes = stats.where(F.col("kind") == NODE).groupBy(key).agg(F.sum("n").alias("pages"))
    looks = (
        stats.where(F.col("kind") == LOOK)
        .groupBy(key, "item")
        .agg(F.sum("n").cast("double").alias("n"))
        .groupBy(key)
        .agg(F.sum("n").alias("_all"), F.sum(F.col("n") * F.log("n")).alias("_sum"))
        .select(
            key,
            F.when(F.col("_all") > 1, (F.log("_all") - F.col("_sum") / F.col("_all")) / F.log("_all"))
            .otherwise(1.0)
            .alias("look"),
        )
    )
    # A clause's entropy over the pages, but for the division by the logarithm of their number.
    content = (
        stats.where(F.col("kind") == CLAUSES)
        .groupBy(key, "item")
        .agg(F.sum("n").cast("double").alias("n"), F.sum("entropy").alias("entropy"))
        .groupBy(key)
        .agg(
            F.count("*").alias("clauses"),
            F.sum(F.greatest(F.lit(0.0), F.log("n") - F.col("entropy") / F.col("n"))).alias("spread"),
        )
    )
    own = nodes.join(looks, key, "left").join(content, key, "left").join(chains, key)
    own = saved(
        own.select(
            key,
            "pages",
            F.coalesce("look", F.lit(1.0)).alias("look"),
            F.coalesce("clauses", F.lit(0)).alias("clauses"),
            F.when(F.col("pages") > 1, F.col("clauses") - F.least(F.col("clauses").cast("double"), F.col("spread") / F.log("pages")))
            .otherwise(F.col("clauses"))
            .alias("gain"),
            "chain",
        ),
        f"tree-{key}",
    )
    branches = (
        own.select(F.explode("chain").alias(key), "clauses", F.coalesce("gain", F.lit(0.0)).alias("gain"))
        .groupBy(key)
        .agg(F.sum("clauses").alias("clauses"), F.sum("gain").alias("gain"))
    )
    kinds = (
        own.where("size(chain) > 1")
        .groupBy(F.expr("chain[size(chain) - 2]").alias(key))
        .agg(F.count("*").alias("kinds"))
    )
    below = F.pow(F.lit(ATTENUATION), F.coalesce("kinds", F.lit(0)))
    content = F.when(F.col("clauses") > 0, F.col("gain") / F.col("clauses")).otherwise(0.0)
    return (
        own.select(key, "pages", "look")
        .join(branches, key)
        .join(kinds, key, "left")
        .select(key, "pages", ((1 - below) * F.col("look") + below * content).alias("importance"))
    )


def importances(stats: DataFrame) -> DataFrame:
    """``(node, importance)`` of every host's nodes, those of few pages blended with what other hosts tell."""
    nodes = stats.where(F.col("kind") == NODE)
    of_host = _tree(stats, "node", nodes.groupBy("node").agg(F.first("chain").alias("chain")))
    # Over all hosts a place's chain is one of places; any host's nodes name it.
    named = nodes.groupBy("node").agg(F.first("place").alias("place"), F.first("chain").alias("chain"))
    steps = named.select("place", F.size("chain").alias("_depth"), F.posexplode("chain").alias("_at", "_up"))
    ups = named.select(F.col("node").alias("_up"), F.col("place").alias("_place"))
    chains = (
        steps.join(ups, "_up")
        .groupBy("place", "_at")
        .agg(F.first("_place").alias("_place"))
        .groupBy("place")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_place")))["_place"].alias("chain"))
    )
    of_all = _tree(stats, "place", chains).select("place", F.col("pages").alias("_pages"), F.col("importance").alias("_all"))

    def weight(pages: str) -> Column:
        return F.col(pages) / (F.col(pages) + PRIOR_PAGES)

    others = weight("_pages") * F.col("_all") + (1 - weight("_pages"))
    blended = weight("pages") * F.col("importance") + (1 - weight("pages")) * others
    return (
        of_host.join(named.select("node", "place"), "node")
        .join(of_all, "place")
        .select("node", blended.alias("importance"))
    )


def _removed(rows: pa.Table, places: pa.Table, told: dict[int, float]) -> np.ndarray:
    """Of every run, whether it is noise or lies in a branch of low importance."""
    place, page = _flat(rows, "place")
    noise, _ = _flat(rows, "noise")
    place, noise, hosts = np.asarray(place), np.asarray(noise.to_numpy(zero_copy_only=False), bool), np.asarray(rows["host"])
    held = {p: (c, a) for p, c, a in zip(*(places[n].to_pylist() for n in ("place", "chain", "article")))}
    low: dict[tuple[int, int], bool] = {}
    out = noise.copy()
    for i, (at, host) in enumerate(zip(place.tolist(), hosts[page].tolist())):
        known = low.get((at, host))
        if known is None:
            chain, article = held[at]
            values = [told.get(n, 1.0) for n in _hosted(np.array(chain, np.int64), np.full(len(chain), host)).tolist()]
            start = chain.index(article)
            known = low[at, host] = min(values[start + 1 :], default=values[start]) < THRESHOLD * values[start]
        out[i] |= known
    return out


def main_texts(pages: DataFrame, keys: list[str], text: str = "html", url: str = "url") -> DataFrame:
    """The columns ``keys`` of every page with ``text``, its main text, and ``blocks``, that text's blocks."""
    carried = [F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]
    names = [f"key{i}" for i in range(len(keys))]
    chosen = pages.select(*carried, F.xxhash64(host_of(url)).alias("host"), F.col(text).cast("string").alias("text"))

    def parse(batches):
        partition, block = TaskContext.get().partitionId(), 0
        for rows in batches:
            for part in slices_of(rows, "text", SLICE_BYTES):
                table, places = _parsed(part)
                yield batch(
                    block=pa.array([(partition << 32) + block], pa.int64()),
                    payload=pa.array([pack(table)], pa.binary()),
                    places=pa.array([pack(places)], pa.binary()),
                )
                block += 1

    with frugal(pages.sparkSession):
        blocks = bucketed(chosen.mapInArrow(parse, PAGES), "block", "pages")

    def count(batches):
        for rows in batches:
            for block, payload, places in zip(rows["block"].to_pylist(), rows["payload"], rows["places"]):
                yield _stats(block, unpack(payload.as_buffer()), unpack(places.as_buffer()))

    def extract(block: pa.Table, told: pa.Table) -> pa.Table:
        rows = unpack(block["payload"][0].as_buffer())
        places = unpack(block["places"][0].as_buffer())
        known = dict(zip(told["node"].to_pylist(), told["importance"].to_pylist()))
        removed = _removed(rows, places, known)
        texts, page = _flat(rows, "runs")
        kept = texts.filter(pa.array(~removed)).cast(pa.string())
        ends = np.searchsorted(page[~removed], np.arange(len(rows) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), kept)
        joined = pa.compute.binary_join(lists, " ")
        return pa.table({**{n: rows[n] for n in names}, "text": joined, "blocks": lists})

    stats = saved(blocks.mapInArrow(count, STATS), "style-tree")
    told = (
        stats.where(F.col("kind") == NODE).select("block", "node").join(importances(stats), "node").select("block", "node", "importance")
    )
    types = {f.name: f.dataType for f in pages.select(*carried).schema.fields}
    schema = T.StructType([T.StructField(n, types[n]) for n in names])
    schema = schema.add("text", T.StringType()).add("blocks", T.ArrayType(T.StringType()))
    joined = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(extract, schema)
    return joined.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), "text", "blocks")
