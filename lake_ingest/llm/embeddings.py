"""Near-duplicate embeddings: PCA-ordered tiled comparison.

Vectors of a label are rotated to the principal axes of all vectors and dealt into tiles of neighbours
along the leading axis. Two tiles are compared unless their extents along the leading axes, and the
norms of what is left, already put every pair too far apart. Within a pair of tiles the leading axes
are accumulated first; a pair of vectors goes on only while its product so far, and the product of the
norms of the remaining axes, can still reach the threshold. What remains is decided by the cosine of
the vectors as given, in double precision. The rotation only orders the work: any rotation gives the
same links.

Equal vectors of a label are one class with a count. A pair of tiles returns counts per class and a
spanning forest of its links, never the links themselves, so that a large group costs rows in
proportion to its size.

Defined results: a null label, and a vector that is null, empty, zero or holds a null or non-finite
component, has no links; vectors of different length have none with each other; a null id is no
candidate for the smallest id; repeated rows are copies that link with each other; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lake_ingest.llm.blocks import batch, pack, unpack
from lake_ingest.llm.components import components
from lake_ingest.llm.shared import saved

THRESHOLD = 0.93
TILE = 2048
# Slices of the second axis along which tiles are filled.
BINS = 4096
# Axes accumulated in each step before the exact cosine.
STEPS = (8, 24)
# Leading axes whose extents are compared between tiles.
EXTENT = 6
# Far above rounding in any bound, far below any difference that matters to the amount of work.
MARGIN = 1e-9


def _vectors(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def classes_of(embeddings: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``(vec_id, key, salt)``, the key null where nothing can link, and the classes of equal vectors."""
    plain = embeddings.select(
        F.col(vec_id).alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    usable = F.expr(
        """coalesce(label IS NOT NULL AND size(vector) > 0
            AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))
            AND exists(vector, x -> x <> 0), false)"""
    )
    rows = plain.withColumns(
        {
            "key": F.when(usable, F.xxhash64("label", "vector")),
            "salt": F.when(usable, F.xxhash64(F.lit("salt"), "vector", "label")),
        }
    )
    grouped = (
        rows.where("key IS NOT NULL")
        .groupBy("key", "salt")
        .agg(
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least"),
            F.any_value("label").alias("label"),
            F.any_value("vector").alias("vector"),
        )
        .withColumns({"id": F.monotonically_increasing_id(), "dim": F.size("vector")})
    )
    return rows.select("vec_id", "key", "salt"), saved(grouped, "vectors")


def axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the principal axes of all vectors, the leading ones first; one matrix each."""

    def products(batches):
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            dims = np.asarray(rows["dim"])
            for dim in np.unique(dims).tolist():
                x = unit(_vectors(rows["vector"].filter(pa.array(dims == dim)), dim))
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, sum_ in sums.items():
            yield batch(dim=pa.array([dim], pa.int32()), products=pa.array([sum_.ravel()], pa.list_(pa.float64())))

    summed = (
        classes.select("dim", "vector")
        .mapInArrow(products, "dim int, products array<double>")
        .select("dim", F.posexplode("products").alias("at", "x"))
        .groupBy("dim", "at")
        .agg(F.sum("x").alias("x"))
    )
    matrices: dict[int, np.ndarray] = {}
    for r in summed.collect():
        matrices.setdefault(r.dim, np.zeros(r.dim * r.dim))[r.at] = r.x
    return {dim: np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1].copy() for dim, m in matrices.items()}


def tiles_of(classes: DataFrame, rotations: dict[int, np.ndarray], threshold: float, tile: int) -> DataFrame:
    """``(tile, label, dim, cell, low, high, payload)``: packed neighbours with their extents.

    Cells are slices of the leading axis so wide that only neighbouring ones can hold a link. Within a cell
    tiles follow the second axis, so that those far apart on it are ruled out by their extents.
    """
    width = float(np.sqrt(2 - 2 * threshold)) + MARGIN

    def places(batches):
        for rows in batches:
            dims, cells = np.asarray(rows["dim"]), np.zeros(len(rows), np.int32)
            bins = np.zeros(len(rows), np.int32)
            for dim in np.unique(dims).tolist():
                here = dims == dim
                x = unit(_vectors(rows["vector"].filter(pa.array(here)), dim))
                cells[here] = np.floor(x @ rotations[dim][:, 0] / width)
                if dim > 1:
                    bins[here] = np.floor((x @ rotations[dim][:, 1] + 1) / 2 * BINS)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(cells), pa.array(bins)], names=[*rows.schema.names, "cell", "bin"]
            )

    def packed(rows: pa.Table) -> pa.Table:
        dim = rows["dim"][0].as_py()
        y = unit(_vectors(rows["vector"], dim)) @ rotations[dim]
        lead = y[:, :EXTENT]
        rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(axis=1, keepdims=True)))
        extents = np.hstack([lead, rest])
        return pa.table(
            {
                "label": rows["label"][:1],
                "dim": rows["dim"][:1],
                "cell": rows["cell"][:1],
                "part": rows["part"][:1],
                "low": pa.array([extents.min(axis=0)], pa.list_(pa.float64())),
                "high": pa.array([extents.max(axis=0)], pa.list_(pa.float64())),
                "payload": pa.array([pack(rows.select(["id", "copies", "vector"]).combine_chunks())], pa.binary()),
            }
        )

    placed = saved(
        classes.select("id", "copies", "label", "dim", "vector").mapInArrow(
            places, "id long, copies long, label string, dim int, vector array<double>, cell int, bin int"
        ),
        "placed",
    )
    # Bins along the second axis in order fill the cell's tiles; one that fills several is dealt among them.
    cell = ["label", "dim", "cell"]
    upto = F.sum("n").over(Window.partitionBy(*cell).orderBy("bin"))
    parts = (
        placed.groupBy(*cell, "bin")
        .agg(F.count("*").alias("n"))
        .withColumn("_upto", upto)
        .select(
            *cell,
            "bin",
            F.floor((F.col("_upto") - F.col("n")) / tile).alias("_first"),
            F.floor((F.col("_upto") - 1) / tile).alias("_last"),
        )
    )
    among = F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_last") - F.col("_first") + 1)
    dealt = placed.join(parts, [*cell, "bin"]).withColumn("part", among).drop("_first", "_last", "bin")
    grouped = dealt.groupBy("label", "dim", "cell", "part").applyInArrow(
        packed,
        "label string, dim int, cell int, part long, low array<double>, high array<double>, payload binary",
    )
    return saved(grouped.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of tiles whose extents leave room for a link."""
    light = tiles.drop("payload")
    ours = light.select(*(F.col(c).alias(f"a_{c}") for c in light.columns)).withColumn(
        "b_cell", F.explode(F.expr("array(a_cell - 1, a_cell, a_cell + 1)"))
    )
    theirs = light.select(*(F.col(c).alias(f"b_{c}") for c in light.columns))
    gap = """aggregate(zip_with(zip_with(a_low, b_high, (l, h) -> greatest(l - h, 0D)),
        zip_with(b_low, a_high, (l, h) -> greatest(l - h, 0D)), (x, y) -> greatest(x, y)),
        0D, (s, x) -> s + x * x)"""
    return (
        ours.join(theirs.withColumnRenamed("b_cell", "cell"), (F.col("a_label") == F.col("b_label")) & (F.col("a_dim") == F.col("b_dim")) & (F.col("b_cell") == F.col("cell")))
        .where("a_tile <= b_tile")
        .where(f"{gap} <= {2 - 2 * threshold + MARGIN}")
        .select(F.col("a_tile").alias("a"), F.col("b_tile").alias("b"))
    )


def linked(a: np.ndarray, b: np.ndarray, rotation: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of two sets of vectors."""
    ua, ub = unit(a), unit(b)
    ya, yb = ua @ rotation, ub @ rotation
    squares_a, squares_b = ya * ya, yb * yb
    done, first = 0, True
    i = j = so_far = None
    for step in STEPS:
        step = min(step, ya.shape[1])
        rest_a = np.sqrt(squares_a[:, step:].sum(axis=1))
        rest_b = np.sqrt(squares_b[:, step:].sum(axis=1))
        if first:
            product = ya[:, :step] @ yb[:, :step].T
            i, j = np.nonzero(product + np.outer(rest_a, rest_b) >= threshold - MARGIN)
            so_far, first = product[i, j], False
        else:
            so_far = so_far + np.einsum("ij,ij->i", ya[i, done:step], yb[j, done:step])
            alive = so_far + rest_a[i] * rest_b[j] >= threshold - MARGIN
            i, j, so_far = i[alive], j[alive], so_far[alive]
        done = step
    cosine = np.einsum("ij,ij->i", ua[i], ub[j])
    near = cosine >= threshold
    return i[near], j[near]


def _forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Per node the least node it is linked with through any of the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            return root


def _compared(rotations: dict[int, np.ndarray], threshold: float, chunk: int = 512):
    def compare(batches):
        for rows in batches:
            for dim, a, b, pa_, pb in zip(*(rows[c].to_pylist() for c in ("dim", "a", "b", "pa", "pb"))):
                ones, twos = unpack(pa_), unpack(pb)
                xa, xb = _vectors(ones["vector"], dim), _vectors(twos["vector"], dim)
                ids = np.concatenate([ones["id"].to_numpy(), twos["id"].to_numpy()])
                ca, cb = ones["copies"].to_numpy(), twos["copies"].to_numpy()
                counts = np.zeros(len(ids), np.int64)
                root = np.arange(len(ids))
                for at in range(0, len(xa), chunk):
                    i, j = linked(xa[at : at + chunk], xb, rotations[dim], threshold)
                    i = i + at
                    if a == b:
                        i, j = i[i < j], j[i < j]
                    counts[: len(xa)] += np.bincount(i, cb[j], len(xa)).astype(np.int64)
                    counts[len(xa) :] += np.bincount(j, ca[i], len(xb)).astype(np.int64)
                    # In a tile paired with itself both halves stand for the same vectors.
                    v = j if a == b else j + len(xa)
                    held = np.flatnonzero(root != np.arange(len(ids)))
                    root = _forest(np.concatenate([i, held]), np.concatenate([v, root[held]]), len(ids))
                some, forest = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(ids)))
                yield batch(
                    u=pa.array(np.concatenate([ids[some], ids[forest]])),
                    v=pa.array(np.concatenate([ids[some], ids[root[forest]]])),
                    n=pa.array(np.concatenate([counts[some], np.zeros(len(forest), np.int64)])),
                )

    return compare


def near_vectors(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    *,
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    rows, classes = classes_of(embeddings, vec_id, embedding, label)
    rotations = axes(classes)
    tiles = tiles_of(classes, rotations, threshold, tile)
    pairs = tile_pairs(tiles, threshold)
    one = tiles.select(F.col("tile").alias("a"), "dim", F.col("payload").alias("pa"))
    two = tiles.select(F.col("tile").alias("b"), F.col("payload").alias("pb"))
    found = saved(
        pairs.join(one, "a").join(two, "b").select("dim", "a", "b", "pa", "pb").mapInArrow(
            _compared(rotations, threshold), "u long, v long, n long"
        ),
        "links",
    )
    counts = found.where("n > 0").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("n = 0").select("u", "v"))
    joined = (
        classes.select("id", "key", "salt", "copies", "least")
        .join(counts, "id", "left")
        .join(roots.withColumnRenamed("u", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    known = joined.join(least, "root").select(
        "key", "salt", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(known, ["key", "salt"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
