import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lake_ingest.llm import near
from lake_ingest.llm.blocks import text_bytes
from lake_ingest.llm.components import components
from tests.llm.helpers import Groups, documents, found


def _similarity(a, b):
    """By a full table of common chains of labelled five-word windows."""

    def labelled(text):
        words, seen, out = text.split(), Counter(), []
        for i in range(max(1, len(words) - 4)):
            window = tuple(words[i : i + 5])
            out.append((window, seen[window]))
            seen[window] += 1
        return out

    a, b = labelled(a), labelled(b)
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1] / (len(a) + len(b) - row[-1])


def _corpus():
    random.seed(6)
    words = [f"w{i}" for i in range(300)]
    texts, passage = [], random.choices(words, k=60)
    for _ in range(14):
        base = random.choices(words, k=random.randint(30, 150))
        texts.append(base)
        for _ in range(random.randint(0, 9)):
            copy = list(base)
            for _ in range(random.randint(1, 4)):
                at = random.randrange(len(copy))
                copy[at : at + random.randint(0, 2)] = random.choices(words, k=random.randint(0, 2))
            texts.append(copy)
    texts += [random.choices(words, k=40) + passage + random.choices(words, k=random.randint(20, 60)) for _ in range(25)]
    texts += [["a", "b", "c"], ["a", "b", "c", "d"], ["same"] * 200, ["same"] * 190, ["same"] * 100]
    return [" ".join(t) for t in texts] + ["a  b c", "", " ", None, None, ""]


def _expected(rows):
    groups = Groups(len(rows))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a is not None and b is not None and (a == b or (a.split() and b.split() and _similarity(a, b) >= 0.8)):
                groups.join(i, j)
    return groups.members()


def test_groups_by_brute_force(spark):
    rows = [(1000 - i, t) for i, t in enumerate(_corpus())]
    rows += [rows[0], (5000, rows[3][1])]
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    got = near.near_duplicates(docs).collect()
    want = []
    for members in _expected(rows):
        want += [(rows[m][0], min(rows[x][0] for x in members)) for m in members]
    assert sorted((r.doc_id, r.group_id) for r in got) == sorted(want)
    assert Counter(r.kept for r in got)[True] == len(_expected(rows))
    assert all(r.doc_id == r.group_id for r in got if r.kept)
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns
    assert found(kept, "doc_id") == sorted(((r.doc_id,) for r in got if r.kept), key=repr)


def test_large_clusters_go_by_tiles(spark, monkeypatch):
    monkeypatch.setattr(near, "TILE", 8)
    rows = [(i, t) for i, t in enumerate(_corpus()) if t]
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    want = [(rows[m][0], min(rows[x][0] for x in g)) for g in _expected(rows) for m in g]
    assert sorted((r.doc_id, r.group_id) for r in near.near_duplicates(docs).collect()) == sorted(want)


def test_texts_that_share_a_passage_are_not_repeated_for_every_tile(spark, monkeypatch, tmp_path):
    random.seed(3)
    passage = [f"p{i}" for i in range(60)]
    texts = [[f"{n}.{i}" for i in range(10)] + passage + [f"{n}.{i}" for i in range(10, 25)] for n in range(40)]
    # Most of the windows of these are in each other, with and without links.
    texts += [passage + [f"end{n}.{i}" for i in range(4 + 2 * n)] for n in range(4)]
    texts += [passage[:20] + [f"mid{n}"] + passage[20:40] + [f"mid{n}"] * (n % 2) + passage[40:] for n in range(4)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    links = near._tile_links

    def counted(similarity):
        found = links(similarity)

        def of(part):
            (tmp_path / f"{random.getrandbits(64)}-{part['key'][0].as_py().hex()}").write_text(str(part.num_rows))
            return found(part)

        return of

    monkeypatch.setattr(near, "TILE", 8)
    monkeypatch.setattr(near, "_tile_links", counted)
    got = near.near_duplicates(documents(spark, [(i, t, None, None) for i, t in rows])).collect()
    want = [(rows[m][0], min(rows[x][0] for x in g)) for g in _expected(rows) for m in g]
    assert sorted((r.doc_id, r.group_id) for r in got) == sorted(want)
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) <= 2 * len(rows)


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_sieve_keeps_what_may_have_a_link(spark, monkeypatch, size):
    monkeypatch.setattr(near, "SIEVE_BYTES", size)
    # Of 63 windows in all at 0.8 a chain has 28: 28 and 35 windows, all of the one and 28 of the other.
    texts = {
        "a": (range(35), "r"),
        "b": (range(28), "s"),
        "c": (range(100, 140), "t"),
        "d": ([*range(100, 131), *range(200, 209)], "u"),
        "e": (range(300, 340), "v"),
        "f": (range(300, 340), "v"),
        "g": ([], "w"),
    }
    rooted = [("x", k, r) for k, (_, r) in texts.items()] + [("y", "h", "z"), ("y", "i", "q")]
    texts |= {"h": (range(35), ""), "i": ([*range(27), *range(500, 508)], "")}
    windows = [(k, bytearray(np.array(w, np.uint32).tobytes())) for k, (w, _) in texts.items()]
    schema = "cluster binary, key binary, root binary"
    rooted = spark.createDataFrame([tuple(bytearray(v.encode()) for v in r) for r in rooted], schema)
    windows = [(bytearray(k.encode()), w) for k, w in windows]
    windows = spark.createDataFrame(windows, "key binary, windows binary")
    left = near._sieved(rooted, windows, 0.8).collect()
    assert sorted((bytes(r.cluster), bytes(r.key), bytes(r.root)) for r in left) == [(b"x", b"a", b"r"), (b"x", b"b", b"s")]


@pytest.mark.parametrize("seed", range(3))
def test_chain_is_the_longest_common_one(seed):
    random.seed(seed)
    for _ in range(60):
        a = random.sample(range(60), 40)
        b = list(a)
        for _ in range(random.randint(0, 6)):
            b.insert(random.randrange(len(b)), b.pop(random.randrange(len(b))))
        row = [0] * (len(b) + 1)
        for x in a:
            before, row = row, [0]
            for j, y in enumerate(b):
                row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        similar = row[-1] / (80 - row[-1]) >= 0.8
        assert near.chain(np.array(a, np.uint32), np.array(b, np.uint32)) == similar


@pytest.mark.parametrize("total", [63, 126, 189, 207, 252, 81])
def test_links_at_exactly_the_threshold(total):
    n = 4 * total // 9
    long, short = np.arange(total - n, dtype=np.uint32), np.arange(n, dtype=np.uint32)
    assert near.chain(long, short) and near.chain(short, long)
    spoilt = short.copy()
    spoilt[0] = 10**6
    assert not near.chain(long, spoilt)
    rows = pa.table(
        {
            "key": pa.array([b"a", b"b"], pa.binary()),
            "windows": pa.array([long.tobytes(), short.tobytes()], pa.binary()),
            "tile": pa.array([0, 0], pa.int32()),
            "i": pa.array([0, 0], pa.int32()),
            "j": pa.array([0, 0], pa.int32()),
            "root": pa.array([b"a", b"b"], pa.binary()),
            "sketches": pa.array([[1] * near.SKETCHES] * 2, pa.list_(pa.int64())),
        }
    )
    assert near._tile_links(near.SIMILARITY)(rows).num_rows == 1


def test_least_chain_is_exact():
    total = np.arange(200_000)
    assert (near.least_chain(total) == -(-4 * total // 9)).all()


@pytest.mark.parametrize("total", [63, 126])
def test_groups_at_exactly_the_threshold(spark, total):
    words = [f"w{i}" for i in range(total)]
    n = 4 * total // 9
    rows = [(1, " ".join(words[: total - n + 4]), None, None), (2, " ".join(words[: n + 4]), None, None)]
    rows.append((3, " ".join(words[: n - 1 + 4]) + " other", None, None))
    assert _similarity(rows[0][1], rows[1][1]) == 0.8
    got = {r.doc_id: r.group_id for r in near.near_duplicates(documents(spark, rows)).collect()}
    assert got[1] == got[2] == 1


def test_bound_of_common_windows():
    rng = np.random.default_rng(0)
    windows = [rng.choice(900, size=rng.integers(1, 400), replace=False).astype(np.uint32) for _ in range(20)]
    places = np.arange(20)
    bound = near._common_at_most(windows, places[:12], places[5:])
    for i in range(12):
        for j in range(15):
            assert bound[i, j] >= len(np.intersect1d(windows[i], windows[5 + j]))


def test_windows_do_not_depend_on_the_batch():
    texts = ["a b c d e f g", "", None, "x y", "a b c d e a b c d e a b c d e"]
    together, first = near.labelled_windows(*text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        alone, _ = near.labelled_windows(*text_bytes(pa.array([text], pa.string())))
        assert alone.tolist() == together[first[i] : first[i + 1]].tolist()
        assert len(set(alone.tolist())) == len(alone)
    assert np.diff(first).tolist() == [3, 0, 0, 1, 11]


def test_components(spark):
    random.seed(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)]
    edges += [(random.randrange(200, 300), random.randrange(200, 300)) for _ in range(70)] + [(7, 7)]
    groups = Groups(300)
    for a, b in edges:
        groups.join(a, b)
    want = {(x, min(m)) for m in groups.members() if len(m) > 1 for x in m}
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty(spark):
    docs = documents(spark, [])
    assert near.near_duplicates(docs).count() == 0 and near.deduplicated(docs).count() == 0
