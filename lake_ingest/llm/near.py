"""Near-duplicates by Order MinHash over five-word windows, verified by banded alignment.

Windows are labelled with their occurrence, so that each is one of a kind in its text. A sketch keeps
the two windows with the least hashes, in text order; texts that agree in one of the sketches are
candidates. A pair is a link if the longest chain of common windows in the order of both texts, within
the band that the threshold leaves, is at least ``SIMILARITY`` of all windows of the two.

Equal texts form a class, and all work is done on classes. In each bucket of a sketch the class that
shares the most buckets leads, and all others are compared with it. Texts connected by buckets form a
cluster; where links have not joined a cluster into one component, all its pairs from different
components that share a bucket are compared, tile by tile. Clusters of many tiles, as passages that
many texts quote make them, are sieved first: a text has no link to another component if too few of
its windows are in the texts of other components. Pairs that share too few windows to be a link are ruled
out by a matrix product of window counts, the others are aligned. Only links leave a task, and only those
that join components, so that a large group costs rows in proportion to its size.

Defined results: a null text is alone in its group; texts without words are grouped only with equal
texts; a text of fewer than five words has one window; a null document orders last; repeated rows are
copies; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lake_ingest.llm.blocks import Rolling, batch, bucketed, mixed, slices_of, text_bytes
from lake_ingest.llm.components import components
from lake_ingest.llm.shared import saved

WINDOW = 5
SIMILARITY = 0.8
SKETCHES = 12
TILE = 512
# Hash slots whose counts are multiplied at a time.
SLOTS = 4096
# So few pairs are aligned without more ado.
FEW = 16
# Tiles of a cluster's text on average beyond which large clusters are sieved.
REPEATS = 4
# Bytes of a cluster's windows that a task sieves at once.
SIEVE_BYTES = 8 << 20

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
# One odd word per sketch.
_SEEDS = [np.uint64((int(_ODD[2]) * (2 * r + 1)) % 2**64) for r in range(SKETCHES)]
_MOST = np.uint64(2**64 - 1)


def labelled_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' occurrence-labelled windows, in text order, and where each text's start."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = space[:-1] != space[1:]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~space[starts]
    starts, ends = starts[solid], ends[solid]
    words = Rolling(8).of(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at, end = np.arange(len(words)), first[1:][text]
    windows = np.zeros(len(words), np.uint64)
    padded = np.append(words, np.zeros(WINDOW, np.uint64))
    for i in range(WINDOW):
        windows += np.where(at + i < end, padded[i : i + len(words)] * _ODD[i], np.uint64(0))
    kept = at < np.maximum(first[:-1][text] + 1, end - WINDOW + 1)
    windows, text = mixed(windows[kept]), text[kept]
    grouped = mixed(windows + text.astype(np.uint64) * _ODD[0])
    order = np.argsort(grouped, kind="stable")
    run = np.ones(len(order), bool)
    run[1:] = grouped[order][1:] != grouped[order][:-1]
    ranks = np.arange(len(order)) - np.maximum.accumulate(np.where(run, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = ranks.astype(np.uint64)
    return mixed(windows + occurrence * _ODD[1]), np.searchsorted(text, np.arange(len(offsets)))


def sketches(windows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text with windows its ``SKETCHES`` ordered pairs of least windows, hashed."""
    counts = np.diff(first)
    used = counts > 0
    starts, counts = first[:-1][used], counts[used]
    out = np.zeros((len(counts), SKETCHES), np.uint64)
    if not len(counts):
        return out

    def least(hashes: np.ndarray) -> np.ndarray:
        places = np.flatnonzero(hashes == np.repeat(np.minimum.reduceat(hashes, starts), counts))
        return places[np.searchsorted(places, starts)]

    for r in range(SKETCHES):
        hashes = mixed(windows ^ _SEEDS[r])
        one = least(hashes)
        hashes[one] = _MOST
        two = least(hashes)
        early, late = windows[np.minimum(one, two)], windows[np.maximum(one, two)]
        out[:, r] = mixed(early * _ODD[3] + late * _ODD[4] + np.uint64(r))
    return out


def _sketch_rows(batches):
    for rows in batches:
        for some in slices_of(rows, "text"):
            windows, first = labelled_windows(*text_bytes(some["text"]))
            used = np.diff(first) > 0
            values = sketches(windows, first).astype(np.int64).ravel()
            lengths = np.where(used, SKETCHES, 0)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield batch(
                key=some["key"],
                sketches=pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
            )


def _window_rows(batches):
    for rows in batches:
        for some in slices_of(rows, "text"):
            windows, first = labelled_windows(*text_bytes(some["text"]))
            short = (windows >> np.uint64(32)).astype(np.uint32).tobytes()
            cut = [short[4 * a : 4 * b] for a, b in zip(first[:-1], first[1:])]
            yield batch(key=some["key"], windows=pa.array(cut, pa.binary()))


def least_chain(total, similarity: float = SIMILARITY):
    """Least length of a chain that makes two texts of so many windows together similar.

    In whole numbers: at 0.8 a total of 63 needs 28, where floats give a little more.
    """
    part = _part(similarity)
    return -(-part.numerator * total // (part.numerator + part.denominator))


def _part(similarity: float) -> Fraction:
    return Fraction(similarity).limit_denominator(10**6)


def chain(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two texts' windows are similar: their longest common chain within the band.

    A chain of ``n`` makes the similarity ``n / (len(a) + len(b) - n)``, so that the windows left out
    on either side bound how far apart two places of the chain can be.
    """
    total = len(a) + len(b)
    needed = least_chain(total, similarity)
    if min(len(a), len(b)) < needed:
        return False
    _, left, right = np.intersect1d(a, b, return_indices=True)
    near = np.abs(left - right) <= total - 2 * needed
    left, right = left[near], right[near]
    if len(left) < needed:
        return False
    places = right[np.argsort(left, kind="stable")]
    if (np.diff(places) > 0).all():
        return True
    tails: list[int] = []
    for place in places.tolist():
        at = bisect.bisect_left(tails, place)
        tails[at : at + 1] = [place]
    return len(tails) >= needed


def _verified(similarity: float):
    def check(batches):
        for rows in batches:
            same = [
                chain(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), similarity)
                for a, b in zip(rows["wu"].to_pylist(), rows["wv"].to_pylist())
            ]
            yield batch(u=rows["u"], v=rows["v"]).filter(pa.array(same, pa.bool_()))

    return check


def verify(pairs: DataFrame, windows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs ``(u, v)`` that are links."""
    one = windows.select(F.col("key").alias("u"), F.col("windows").alias("wu"))
    two = windows.select(F.col("key").alias("v"), F.col("windows").alias("wv"))
    joined = pairs.join(one, "u").join(two, "v").select("u", "v", "wu", "wv")
    return joined.mapInArrow(_verified(similarity), "u binary, v binary")


def text_key(text: str) -> Column:
    return F.unhex(F.md5(text))


def _ordered(u: str, v: str) -> list[Column]:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def _common_at_most(windows: list[np.ndarray], ones: np.ndarray, twos: np.ndarray) -> np.ndarray:
    """Upper bounds of the numbers of common windows of all pairs of two sets of texts.

    Windows are counted in hash slots; the product of two texts' counts is no less than what they share.
    """
    used = np.union1d(ones, twos)
    slots = 1 << int(8 * max(len(windows[x]) for x in used) - 1).bit_length()
    rows = np.repeat(np.arange(len(used)), [len(windows[x]) for x in used])
    slot = np.concatenate([windows[x] for x in used]).astype(np.int64) % slots
    bound = np.zeros((len(ones), len(twos)), np.float32)
    for low in range(0, slots, SLOTS):
        here = (slot >= low) & (slot < low + SLOTS)
        counts = np.bincount(rows[here] * SLOTS + slot[here] - low, minlength=len(used) * SLOTS)
        counts = counts.reshape(len(used), SLOTS).astype(np.float32)
        bound += counts[np.searchsorted(used, ones)] @ counts[np.searchsorted(used, twos)].T
    return bound


def _prune(agree: np.ndarray, needed: np.ndarray, windows: list[np.ndarray], ones: np.ndarray, twos: np.ndarray) -> None:
    """Drop pairs that share too few windows, texts of about the same length at a time."""
    octave = np.array([len(windows[x]).bit_length() for x in ones])
    for size in np.unique(octave[agree.any(axis=1)]):
        rows = np.flatnonzero((octave == size) & agree.any(axis=1))
        columns = np.flatnonzero(agree[rows].any(axis=0))
        if len(rows) * len(columns) > FEW:
            part = np.ix_(rows, columns)
            agree[part] &= _common_at_most(windows, ones[rows], twos[columns]) >= needed[part] - 0.5


def _tile_links(similarity: float):
    """Links of a pair of tiles that join different components, one at most for each two of them."""

    def links(rows: pa.Table) -> pa.Table:
        keys = rows["key"].to_pylist()
        windows = [np.frombuffer(w, np.uint32) for w in rows["windows"].to_pylist()]
        tile, i, j = np.asarray(rows["tile"]), rows["i"][0].as_py(), rows["j"][0].as_py()
        root = np.asarray(rows["root"].combine_chunks().dictionary_encode().indices)
        values = np.asarray(rows["sketches"].combine_chunks().flatten()).reshape(len(rows), SKETCHES)
        sizes = np.array([len(w) for w in windows])
        ones, twos = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        agree = np.zeros((len(ones), len(twos)), bool)
        for r in range(SKETCHES):
            agree |= values[ones, r][:, None] == values[twos, r][None, :]
        agree &= root[ones][:, None] != root[twos][None, :]
        if i == j:
            agree &= ones[:, None] < twos[None, :]
        needed = least_chain(sizes[ones][:, None] + sizes[twos][None, :], similarity)
        agree &= np.minimum(sizes[ones][:, None], sizes[twos][None, :]) >= needed
        _prune(agree, needed, windows, ones, twos)
        joined = list(range(len(rows) + 1))

        def find(x: int) -> int:
            while joined[x] != x:
                joined[x] = x = joined[joined[x]]
            return x

        found = []
        for a, b in zip(*(side[at].tolist() for side, at in zip((ones, twos), np.nonzero(agree)))):
            ra, rb = find(root[a]), find(root[b])
            if ra != rb and chain(windows[a], windows[b], similarity):
                joined[rb] = ra
                found.append((keys[a], keys[b]))
        u, v = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(u, pa.binary()), "b": pa.array(v, pa.binary())})

    return links


SHARES = "cluster binary, share int, key binary, root binary, n long, windows binary"
FOUND = "cluster binary, key binary, root binary, n long, found long"


def _window_shares(batches):
    """The texts' windows dealt by their hashes into as many shares as the cluster has."""
    for rows in batches:
        out = []
        for cluster, key, root, shares, windows in zip(
            *(rows[name].to_pylist() for name in ("cluster", "key", "root", "shares", "windows"))
        ):
            values = np.frombuffer(windows, np.uint32)
            share = values % np.uint32(shares)
            order = np.argsort(share, kind="stable")
            held, first = np.unique(share[order], return_index=True)
            for at, part in zip(held.tolist(), np.split(values[order], first[1:])):
                out.append((cluster, at, key, root, len(values), part.tobytes()))
        types = (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
        names = ("cluster", "share", "key", "root", "n", "windows")
        columns = list(zip(*out)) or [()] * len(names)
        yield batch(**{name: pa.array(c, t) for name, c, t in zip(names, columns, types)})


def _foreign(rows: pa.Table) -> pa.Table:
    """Of a share of a cluster's windows, how many of each text's are in a text of another component too."""
    column = pa.concat_arrays([c.cast(pa.large_binary()) for c in rows["windows"].chunks])
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8)[places[0] : places[-1]].view(np.uint32)
    text = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(places) // 4)
    root = np.asarray(rows["root"].combine_chunks().dictionary_encode().indices)
    order = np.argsort(values, kind="stable")
    values, text = values[order], text[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    roots = root[text]
    both = np.minimum.reduceat(roots, first) != np.maximum.reduceat(roots, first)
    found = np.bincount(text[np.repeat(both, np.diff(first, append=len(values)))], minlength=len(rows))
    return rows.select(["cluster", "key", "root", "n"]).append_column("found", pa.array(found, pa.int64()))


def _sieved(rooted: DataFrame, windows: DataFrame, similarity: float) -> DataFrame:
    """``(cluster, key, root)`` of the texts that may have a link to another component of their cluster.

    A chain of ``c`` windows is at least ``similarity`` of all windows of two texts only if it is so of those of either
    one, and each of its windows is in a text of another component.
    """
    size = F.sum(F.octet_length("windows"))
    shares = rooted.join(windows, "key").groupBy("cluster").agg(F.ceil(size / F.lit(SIEVE_BYTES)).cast("int").alias("shares"))
    # The windows come last, so that they are not dealt by the cluster.
    dealt = rooted.join(shares, "cluster").join(windows, "key").select("cluster", "key", "root", "shares", "windows")
    found = dealt.mapInArrow(_window_shares, SHARES).groupBy("cluster", "share").applyInArrow(_foreign, FOUND)
    part = _part(similarity)
    return (
        found.groupBy("cluster", "key", "root", "n")
        .agg(F.sum("found").alias("found"))
        .where(F.col("found") * part.denominator >= F.col("n") * part.numerator)
        .select("cluster", "key", "root")
    )


def _of_several(rooted: DataFrame) -> DataFrame:
    """The texts of clusters of several components, with the number of the cluster's tiles."""
    sizes = (
        rooted.groupBy("cluster")
        .agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
        .where("r0 <> r1")
        .select("cluster", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    )
    return rooted.join(sizes, "cluster").select("cluster", "key", "root", "tiles")


def _repeated(rooted: DataFrame) -> tuple[int, int]:
    """Number of texts, and of their rows once each is repeated for every tile of its cluster."""
    return tuple(rooted.agg(F.count("*"), F.coalesce(F.sum("tiles"), F.lit(0))).first())


def _rest_links(
    members: DataFrame, stars: DataFrame, roots: DataFrame, windows: DataFrame, similarity: float
) -> DataFrame:
    """Links between different components among texts that buckets connect.

    Each text is in one cluster of texts connected by buckets. A cluster of several components is cut
    into tiles, and each pair of tiles is one task's work. As this repeats a text for every tile of its cluster, large
    clusters are sieved before, until that is a few times the texts or a sieve leaves more than half of it.
    """
    clusters = components(stars).select(F.col("u").alias("key"), F.col("root").alias("cluster"))
    rooted = clusters.join(roots.withColumnRenamed("u", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    rooted, ready, before = saved(_of_several(rooted), "rooted"), [], None
    texts, repeated = _repeated(rooted)
    while repeated > REPEATS * texts and (before is None or 2 * repeated <= before):
        ready.append(rooted.where("tiles = 1"))
        left = saved(_sieved(rooted.where("tiles > 1"), windows, similarity), "sieved")
        rooted, before = saved(_of_several(left), "rooted"), repeated
        repeated = _repeated(rooted)[1]
    tiled = (
        reduce(DataFrame.unionByName, ready, rooted)
        .join(members.select("key", "sketches").dropDuplicates(["key"]), "key")
        .join(windows, "key")
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
        .select("cluster", "i", "j", "tile", "key", "root", "sketches", "windows")
    )
    found = tiled.groupBy("cluster", "i", "j").applyInArrow(_tile_links(similarity), "a binary, b binary")
    return found.select(*_ordered("a", "b"))


def groups(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The classes of equal texts ``(key, sketches)``, and links ``(u, v)`` that connect all similar ones."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), text_key(text).alias("key"))
    sketched = rows.mapInArrow(_sketch_rows, "key binary, sketches array<long>")
    classes = saved(sketched.groupBy("key").agg(F.any_value("sketches").alias("sketches")), "classes")
    each = classes.select("key", F.explode("sketches").alias("sketch"))
    counts = each.groupBy("sketch").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(
        each.join(counts, "sketch").join(classes, "key").select("sketch", "key", "n", "sketches"), "members"
    )
    shared = members.groupBy("key").agg(F.sum("n").alias("shared"))
    leads = (
        members.select("sketch", "key")
        .join(shared, "key")
        .groupBy("sketch")
        .agg(F.max(F.struct("shared", "key"))["key"].alias("lead"))
    )
    stars = (
        members.select("sketch", "key")
        .join(leads, "sketch")
        .where("key <> lead")
        .select(*_ordered("key", "lead"))
        .distinct()
    )
    stars = saved(stars, "stars")
    windows = _windows_of(rows, members.select("key").distinct())
    first = saved(verify(stars, windows, similarity), "links")
    rest = saved(_rest_links(members, stars, components(first), windows, similarity), "links")
    return classes, first.unionByName(rest)


def _windows_of(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``(key, windows)`` of the given classes, in a table bucketed by key."""
    wanted = rows.select("key", "text").join(keys, "key", "left_semi").dropDuplicates(["key"])
    return bucketed(wanted.mapInArrow(_window_rows, "key binary, windows binary"), "key", "windows")


def _representatives(rooted: DataFrame) -> DataFrame:
    """Per component the least document's row, ``(root, group_id, rep)``; a null document orders last."""
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    return rooted.groupBy("root").agg(F.min(place).alias("rep")).select(
        "root", F.col("rep.doc_id").alias("group_id"), F.col("rep.key").alias("rep_key")
    )


def _rooted(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """``(doc_id, key, root)`` per row with a text."""
    classes, links = groups(docs, text, similarity)
    found = saved(
        classes.select("key")
        .join(components(links).withColumnRenamed("u", "key"), "key", "left")
        .select("key", F.coalesce("root", "key").alias("root")),
        "groups",
    )
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), text_key(text).alias("key"))
    return rows.join(found, "key")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``(doc_id, group_id, kept)`` per row: the least document of its group, and true for one row of each."""
    rooted = saved(_rooted(docs, doc_id, text, similarity), "rooted")
    marked = rooted.join(_representatives(rooted), "root").withColumn(
        "_first", F.col("doc_id").eqNullSafe(F.col("group_id")) & (F.col("key") == F.col("rep_key"))
    )
    firsts = marked.where("_first").withColumn(
        "kept", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0))) == 1
    )
    alone = docs.where(F.col(text).isNull()).select(
        F.col(doc_id).alias("doc_id"),
        F.col(doc_id).alias("group_id"),
        F.lit(True).alias("kept"),
    )
    columns = ["doc_id", "group_id", "kept"]
    others = marked.where("NOT _first").withColumn("kept", F.lit(False))
    return firsts.select(columns).unionByName(others.select(columns)).unionByName(alone)


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group."""
    rooted = _rooted(docs, doc_id, text, similarity)
    kept = _representatives(rooted).select(
        F.col("group_id").alias("_group_id"), F.col("rep_key").alias("_rep_key")
    )
    stays = docs.withColumn("_near_key", text_key(text)).join(
        kept,
        (F.col("_near_key") == F.col("_rep_key")) & F.col(doc_id).eqNullSafe(F.col("_group_id")),
        "left_semi",
    )
    return stays.dropDuplicates(["_near_key"]).drop("_near_key").unionByName(docs.where(F.col(text).isNull()))
