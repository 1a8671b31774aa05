import numpy as np
import pytest

from lake_ingest.llm import embeddings
from tests.llm.helpers import Groups

SCHEMA = "vec_id long, embedding array<double>, label int, key string, n int"


def _rows():
    rng, rows = np.random.default_rng(5), []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.normal(size=5)
            rows += [(len(rows) + k, (centre + rng.normal(size=5) * 0.25).tolist(), label) for k in range(20)]
    rows += [(len(rows) + k, [1.0, 2.0, 3.0, 4.0, 5.0], 0) for k in range(100)]
    n = len(rows)
    odd = [[float("nan")] * 5, None, [0.0] * 5, [], [1.0, None, 2.0, 3.0, 4.0], [float("inf")] + [1.0] * 4]
    rows += [(n + k, vector, 0) for k, vector in enumerate(odd)]
    rows += [(n + 10, [1e300, 2e300, 3e300, 4e300, 5e300], 0), (n + 11, [1.0, 2.0], 0), (n + 12, [1.0, 2.0], 0)]
    return [*rows, (None, [1.0, 2.0, 3.0, 4.0, 5.0], 0), (3, [1.0, 2.0], 0)]


def _expected(rows):
    def usable(vector, label):
        return bool(
            label is not None
            and vector
            and all(x is not None and np.isfinite(x) for x in vector)
            and any(vector)
        )

    ok = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    units = {i: embeddings.unit(np.array([rows[i][1]]))[0] for i in ok}
    groups, degree = Groups(len(rows)), [0] * len(rows)
    for a in ok:
        for b in ok:
            same = a < b and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
            if same and units[a] @ units[b] >= 0.93:
                groups.join(a, b)
                degree[a] += 1
                degree[b] += 1
    out = []
    for members in groups.members():
        least = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out += [(rows[i][0], degree[i], least, rows[i][0] == least) for i in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [2048, 16])
def test_links_and_components(spark, tile):
    rows = _rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, embeddings.near_vectors(df, tile=tile).collect()), key=repr) == _expected(rows)


def test_any_rotation_gives_the_same_links():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(200, 40)), rng.normal(size=(150, 40))
    b[:80] = a[:80] + rng.normal(size=(80, 40)) * np.linspace(0.1, 0.6, 80)[:, None]
    cosine = embeddings.unit(a) @ embeddings.unit(b).T
    want = set(zip(*(x.tolist() for x in np.nonzero(cosine >= 0.93))))
    assert len(want) > 10
    for seed in range(3):
        rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(40, 40)))[0]
        assert set(zip(*(x.tolist() for x in embeddings.linked(a, b, rotation, 0.93)))) == want


def test_empty(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
