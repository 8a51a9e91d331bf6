"""Near duplicates among embeddings by PCA-ordered tiled comparison.

Equal vectors of a label are one vector with a count.  Vectors are turned into
the principal axes of a bounded sample, which changes no inner product, and
sorted along the first axis into tiles.  Up to MOST_SIDE tiles in a row are a square's
side: a task gets two sides and compares all their tiles, so a vector is sent to as many
tasks as there are sides, not tiles.  Two sides meet unless their ranges on the axis lie
too far apart, and two tiles of them unless their centres do, given how far their vectors
lie from these.  Within a pair of tiles the leading dimensions are multiplied first; the
rest of a product is at most the product of the suffix norms, so most pairs are settled
early.  Those left are decided by the cosine of the vectors as they came, in double
precision.

A pair of sides reports numbers of links per vector and a spanning forest of
them, never its list of pairs, so clusters of any size stay linear.

Defined results: a vector that is null, zero, or holds a null or a value that is
not finite, and one without label or id, links with nothing and is its own
component; vectors of unequal length do not link; repeated rows are vectors of
their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import components, release, staged

THRESHOLD = 0.93
TILE = 2048
MOST_SIDE = 16  # tiles that a task gets of each of two sides
SAMPLE = 4096  # vectors that the axes are fitted on; any axes give the same links
STRIDES = (8, 16, 32)
SLACK = 1e-9

TILE_SCHEMA = "label long, dim int, rep long, copies long, vector array<double>, first double"
FOUND_SCHEMA = "label long, dim int, rep long, other long, print long, links long"


def usable(vector: str = "vector") -> str:
    return (
        f"{vector} IS NOT NULL AND exists({vector}, x -> x <> 0)"
        f" AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x)"
        " AND abs(x) < double('infinity'))"
    )


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """One row per label and vector: its least id and how many rows have it."""
    return rows.groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )


def units(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest entry first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes by falling variance for each vector length in a bounded sample;
    the driver sees at most SAMPLE vectors."""
    sample = (
        vectors.select("vector", F.xxhash64("vector").alias("h"), "rep")
        .orderBy("h", "rep")
        .limit(SAMPLE)
        .select("vector")
        .toPandas()["vector"]
    )
    by_length: dict[int, list] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(np.asarray(vector, dtype=np.float64))
    axes = {}
    for length, some in by_length.items():
        unit = units(np.stack(some))
        values, found = np.linalg.eigh(unit.T @ unit)
        axes[length] = np.ascontiguousarray(found[:, np.argsort(-values, kind="stable")])
    return axes


def turned(vectors: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    unit, own = units(vectors), axes.get(vectors.shape[1])
    return unit if own is None else unit @ own


def _matrix(column) -> np.ndarray:
    rows = column.to_numpy(zero_copy_only=False)
    return np.stack([np.asarray(v, dtype=np.float64) for v in rows])


def with_first_axis(vectors: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("vector").to_numpy(zero_copy_only=False)
            lengths = np.array([len(v) for v in rows])
            first = np.zeros(len(rows))
            for length in np.unique(lengths):
                which = np.flatnonzero(lengths == length)
                first[which] = turned(np.stack([rows[w] for w in which]), axes)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array(lengths, pa.int32()),
                    batch.column("rep"),
                    batch.column("copies"),
                    batch.column("vector"),
                    pa.array(first),
                ],
                names=["label", "dim", "rep", "copies", "vector", "first"],
            )

    return vectors.select("label", "rep", "copies", "vector").mapInArrow(run, TILE_SCHEMA)


def tiled(vectors: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """Adds the tile, the range along label, length and first axis, and the side it
    belongs to; and the tiles of a side, few where there are few tiles, so that all
    tasks have work.

    Staged, since a tile's number must be the same wherever it is read.
    """
    rows = staged(vectors, purpose)
    count = max(1, -(-rows.count() // TILE))
    width = max(1, min(MOST_SIDE, math.isqrt(count) // 2))
    ranged = rows.repartitionByRange(count, "label", "dim", "first", "rep")
    tile = F.spark_partition_id()
    out = staged(
        ranged.withColumn("tile", tile).withColumn("side", F.expr(f"tile div {width}")), purpose
    )
    release(rows)
    return out, width


def side_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sides of one label and length that can hold a link.

    Unit vectors with cosine t differ by at most sqrt(2 - 2 t) on any axis.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK)
    ranges = rows.groupBy("label", "dim", "side").agg(
        F.min("first").alias("low"), F.max("first").alias("high")
    )
    later = ranges.select(
        "label", "dim", F.col("side").alias("other"), F.col("low").alias("low2"),
        F.col("high").alias("high2"),
    )
    return (
        ranges.join(later, ["label", "dim"])
        .where(F.col("side") <= F.col("other"))
        .where((F.col("low2") <= F.col("high") + reach) & (F.col("low") <= F.col("high2") + reach))
        .select("label", "dim", "side", "other")
    )


def centre(spun: np.ndarray) -> tuple[np.ndarray, float]:
    """Mean direction of unit vectors, and the largest angle to it; any direction
    would be right, a near one prunes more."""
    mean = spun.sum(axis=0)
    size = np.sqrt(mean @ mean)
    mean = mean / size if size > 0 else spun[0]
    return mean, float(np.arccos(np.clip(spun @ mean, -1, 1)).max())


def apart(one: tuple, other: tuple, threshold: float) -> bool:
    """Whether no vectors of two tiles can be as near as the threshold: angles obey the
    triangle inequality."""
    between = float(np.arccos(np.clip(one[0] @ other[0], -1, 1)))
    return between - one[1] - other[1] > np.arccos(max(-1.0, threshold)) + 1e-6


def close_pairs(
    a: np.ndarray, b: np.ndarray, threshold: float, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) whose cosine can reach the threshold; i < j if same.

    The first stride is a product of whole tiles; what its bound leaves is a
    list of pairs, to which the later strides are added one at a time.
    """
    stops = [s for s in STRIDES if s < a.shape[1]] + [a.shape[1]]

    def suffix(x: np.ndarray, stop: int) -> np.ndarray:
        return np.sqrt((x[:, stop:] ** 2).sum(axis=1))

    stop = stops[0]
    part = a[:, :stop] @ b[:, :stop].T
    can = part + np.outer(suffix(a, stop), suffix(b, stop)) >= threshold - SLACK
    i, j = np.nonzero(np.triu(can, 1) if same else can)
    part = part[i, j]
    for begin, stop in zip(stops, stops[1:]):
        part = part + np.einsum("nd,nd->n", a[i, begin:stop], b[j, begin:stop])
        can = part + suffix(a, stop)[i] * suffix(b, stop)[j] >= threshold - SLACK
        i, j, part = i[can], j[can], part[can]
    return i, j


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, of the vectors as they came, in double precision."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    norms = np.sqrt(np.einsum("nd,nd->n", a, a)) * np.sqrt(np.einsum("nd,nd->n", b, b))
    return np.einsum("nd,nd->n", a, b) / norms


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place of each place's component under the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _prints(vectors: list) -> np.ndarray:
    """Tells apart vectors that carry the same id."""
    import xxhash

    prints = [xxhash.xxh64_intdigest(v.tobytes()) for v in vectors]
    return np.array(prints, dtype=np.uint64).view(np.int64)


def compare_sides(group: pa.Table, axes: dict[int, np.ndarray], threshold: float) -> pa.Table:
    """All links between the tiles of two sides, or in one, as counts and a forest."""
    order = np.lexsort(
        (group["rep"].to_numpy(), group["first"].to_numpy(), group["tile"].to_numpy())
    )
    group = group.take(pa.array(order))
    vectors = _matrix(group["vector"].combine_chunks())
    spun, tile, side = turned(vectors, axes), group["tile"].to_numpy(), group["side"].to_numpy()
    left, right = group["left"][0].as_py(), group["right"][0].as_py()
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    tiles = [(int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(tile)])]
    centres = [centre(spun[a:b]) for a, b in tiles]
    links = np.zeros(len(tile), dtype=np.int64)
    copies, trees = group["copies"].to_numpy(), []
    for p, (a, b) in enumerate(tiles):
        for q, (c, d) in enumerate(tiles):
            if q < p or side[a] != left or side[c] != right or apart(centres[p], centres[q], threshold):
                continue
            i, j = close_pairs(spun[a:b], spun[c:d], threshold, p == q)
            tree: list[np.ndarray] = []
            for part in np.array_split(np.arange(len(i)), 1 + len(i) // 500_000):
                x, y = i[part] + a, j[part] + c
                linked = exact_cosine(vectors[x], vectors[y]) >= threshold
                x, y = x[linked], y[linked]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                tree = [spanning(np.concatenate([*tree, np.stack([x, y], axis=1)]))]
            trees += tree
    edges = np.concatenate(trees) if trees else np.zeros((0, 2), dtype=np.int64)
    root = forest(len(tile), edges[:, 0], edges[:, 1])
    told = np.flatnonzero(links)
    rep, prints = group["rep"].to_numpy(), _prints([vectors[k] for k in told])
    return pa.table(
        {
            "label": group["label"].take(pa.array(told)),
            "dim": group["dim"].take(pa.array(told)),
            "rep": pa.array(rep[told], pa.int64()),
            "other": pa.array(rep[root[told]] if len(told) else [], pa.int64()),
            "print": pa.array(prints, pa.int64()),
            "links": pa.array(links[told], pa.int64()),
        }
    )


def spanning(edges: np.ndarray) -> np.ndarray:
    """As few edges as connect what these connect: each node and its root."""
    nodes, where = np.unique(edges, return_inverse=True)
    where = where.reshape(edges.shape)
    root = forest(len(nodes), where[:, 0], where[:, 1])
    some = root != np.arange(len(nodes))
    return np.stack([nodes[some], nodes[root[some]]], axis=1)


def link_counts(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of embeddings."""
    rows = staged(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
        ).withColumn(
            "usable",
            F.expr(f"coalesce({usable()} AND label IS NOT NULL AND vec_id IS NOT NULL, false)"),
        ),
        "vectors",
    )
    distinct = staged(distinct_vectors(rows.where("usable")), "vectors-distinct")
    axes = principal_axes(distinct)
    tiles = tiled(with_first_axis(distinct, axes), "vectors-tiled")[0]
    pairs = side_pairs(tiles, threshold).select(
        "label", "dim", F.col("side").alias("left"), F.col("other").alias("right"),
        F.explode(F.array_distinct(F.array("side", "other"))).alias("side"),
    )
    found = staged(
        tiles.join(pairs, ["label", "dim", "side"])
        .groupBy("label", "dim", "left", "right")
        .applyInArrow(lambda group: compare_sides(group, axes, threshold), FOUND_SCHEMA),
        "vectors-linked",
    )
    release(tiles)
    # A vector with twins is linked to all of them; its other links were counted.
    counted = found.groupBy("label", "dim", "rep", "print").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = _with_print(distinct).join(counted, ["label", "dim", "rep", "print"], "left")
    resolved = named.join(roots, named["rep"] == roots["id"], "left").select(
        "label",
        "vector",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"),
    )
    linked = rows.where("usable").join(resolved, ["label", "vector"]).select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def _with_print(vectors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("vector").to_numpy(zero_copy_only=False)
            some = [np.asarray(v, dtype=np.float64) for v in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(v) for v in some], pa.int32()),
                 pa.array(_prints(some), pa.int64())],
                names=[*batch.schema.names, "dim", "print"],
            )

    schema = "label long, vector array<double>, rep long, copies long, dim int, print long"
    return vectors.select("label", "vector", "rep", "copies").mapInArrow(run, schema)
