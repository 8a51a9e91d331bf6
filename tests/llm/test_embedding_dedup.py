"""Embedding near-dedup against the full matrix of cosines."""

import numpy as np
import pytest

from tallymill.llm import embedding_dedup as ed
from tests.llm import messy

NAN, INF = float("nan"), float("inf")


def plain(rows):
    """(vec_id, label, vector) -> {row number: (links, component)}."""
    def usable(v):
        return v is not None and None not in v and np.isfinite(v).all() and np.any(v)

    ok = [n for n, (i, label, v) in enumerate(rows)
          if i is not None and label is not None and usable(v)]
    links, root = dict.fromkeys(range(len(rows)), 0), {n: rows[n][0] for n in range(len(rows))}
    pairs = []
    for x, n in enumerate(ok):
        a = np.array(rows[n][2], dtype=np.float64)
        a = a / np.abs(a).max()
        for m in ok[x + 1 :]:
            if rows[n][1] != rows[m][1] or len(rows[n][2]) != len(rows[m][2]):
                continue
            b = np.array(rows[m][2], dtype=np.float64)
            b = b / np.abs(b).max()
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= ed.THRESHOLD:
                links[n] += 1
                links[m] += 1
                pairs.append((n, m))
    while True:
        before = dict(root)
        for n, m in pairs:
            root[n] = root[m] = min(root[n], root[m])
        if before == root:
            return {n: (links[n], root[n]) for n in links}


def check(spark, rows):
    frame = spark.createDataFrame(
        [(i, v, label, "x", 1.0) for i, label, v in rows],
        "vec_id long, embedding array<float>, label int, tile string, first double",
    )
    # What the table holds are floats.
    rows = [(i, label, v if v is None else [None if x is None else float(np.float32(x)) for x in v])
            for i, label, v in rows]
    got = sorted(map(tuple, ed.link_counts(frame.repartition(3)).collect()), key=str)
    want = [(rows[n][0], *found) for n, found in plain(rows).items()]
    assert [g[:3] for g in got] == sorted(want, key=str)
    assert all(g[3] == (g[0] is None or g[0] == g[2]) for g in got)


def clustered(seed, n, dim=12, clusters=9, noise=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    points = centres[rng.integers(0, clusters, n)] + noise * rng.standard_normal((n, dim))
    return [p.tolist() for p in points]


def test_clusters_over_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(ed, "TILE", 40)
    rows = [(n, n % 2 if n % 3 else 0, v) for n, v in enumerate(clustered(1, 400))]
    check(spark, rows)


@pytest.mark.parametrize("most", [1, 2, 16])
def test_sides_of_several_tiles(spark, monkeypatch, most):
    monkeypatch.setattr(ed, "TILE", 8)
    monkeypatch.setattr(ed, "MOST_SIDE", most)
    rows = [(n, n % 2 if n % 3 else 0, v) for n, v in enumerate(clustered(7, 400))]
    check(spark, rows)


def test_vectors_are_sent_once_a_side(spark, sf_dir, monkeypatch):
    """Not once a tile: the rows that meet fall with the width of a side."""
    monkeypatch.setattr(ed, "TILE", 16)
    rows = ed.distinct_vectors(
        messy.table(spark, sf_dir, "embeddings").selectExpr(
            "cast(vec_id AS long) vec_id", "1L AS label", "cast(embedding AS array<double>) vector"
        )
    )
    firsts = ed.with_first_axis(rows, ed.principal_axes(rows))
    sent = {}
    for most in (1, 8):
        monkeypatch.setattr(ed, "MOST_SIDE", most)
        tiles, width = ed.tiled(firsts, "test-tiles")
        pairs = ed.side_pairs(tiles, ed.THRESHOLD).collect()
        sides = dict(tiles.groupBy("side").count().collect())
        sent[width] = sum(sides[s] for p in pairs for s in {p.side, p.other})
    (one, many), (width, wide) = sorted(sent.items())
    assert one == 1 and width > 1 and wide < 1.2 * many / width


def test_tiles_apart_hold_no_link():
    pruned = 0
    for seed in range(5):
        unit = ed.units(np.array(clustered(seed, 600, 6, noise=0.05)))
        tiles = np.array_split(unit[np.argsort(unit[:, 0])], 40)
        centres = [ed.centre(t) for t in tiles]
        for a, x in zip(tiles, centres):
            for b, y in zip(tiles, centres):
                if ed.apart(x, y, ed.THRESHOLD):
                    pruned += 1
                    assert (a @ b.T).max() < ed.THRESHOLD
    assert pruned > 100


def test_spanning_forest():
    rng = np.random.default_rng(4)
    edges = rng.integers(0, 60, (50, 2))
    kept = ed.spanning(edges)
    want = ed.forest(60, edges[:, 0], edges[:, 1])
    assert ed.forest(60, kept[:, 0], kept[:, 1]).tolist() == want.tolist() and len(kept) <= 50


def test_awkward_vectors(spark):
    rows = [
        (1, 0, None), (2, 0, []), (3, 0, [0.0, 0.0]), (4, 0, [1.0, None]), (5, 0, [1.0, NAN]),
        (6, 0, [INF, 1.0]), (7, None, [1.0, 1.0]), (8, 0, [1.0, 1.0]), (9, 0, [2.0, 2.0]),
        (10, 0, [1.0, 1.0]), (11, 1, [1.0, 1.0]), (12, 0, [1.0, 1.0, 0.0]), (None, 0, [1.0, 1.0]),
        (13, 0, [1e38, 1e38]), (14, 0, [1e-38, 1e-38]), (15, 0, [-1.0, -1.0]), (15, 0, [3.0, -1.0]),
        (8, 0, [1.0, 1.0]), (16, 0, [-0.0, 1.0]), (17, 0, [0.0, 1.0]),
    ]
    check(spark, rows)


def test_one_vector_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ed, "TILE", 30)
    rows = [(n, 0, [1.0, 2.0, 3.0, 0.5]) for n in range(100)]
    rows += [(100 + n, 0, v) for n, v in enumerate(clustered(2, 200, 4))]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, 0, [1.0, 2.0])], [(1, 0, None)]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_query_on_whole_table(spark, sf_dir):
    frame = messy.table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.label, [float(x) for x in r.embedding]) for r in frame.collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.link_counts(frame).collect()}
    assert got == {rows[n][0]: found for n, found in plain(rows).items()}


def test_bounds_lose_no_pair():
    unit = ed.units(np.array(clustered(3, 300, 40, noise=0.3)))
    i, j = ed.close_pairs(unit, unit, ed.THRESHOLD, True)
    real = np.argwhere(np.triu(unit @ unit.T >= ed.THRESHOLD, 1))
    assert {tuple(p) for p in real} <= set(zip(i, j)) and len(real)
    assert len(i) < 300 * 299 / 2


def test_forest():
    i, j = np.array([0, 5, 3, 9]), np.array([5, 7, 4, 3])
    assert ed.forest(10, i, j).tolist() == [0, 1, 2, 3, 3, 0, 6, 0, 8, 3]
