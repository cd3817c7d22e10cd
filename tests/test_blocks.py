"""The block tree: exact against brute force, and pruning that pays."""

import time

import numpy as np
import pytest

from ledgerloom.operators import neighbors
from ledgerloom.operators.blocks import BlockTree


def clustered(n, width=6, clusters=40, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 30, (clusters, width))[rng.integers(0, clusters, n)] + rng.normal(0, 1, (n, width))


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")


@pytest.mark.parametrize("leaf, seed", [(1, 0), (5, 1), (30, 2)])
def test_routes_miss_nothing(leaf, seed):
    rng = np.random.default_rng(seed)
    points = np.concatenate([clustered(300, seed=seed), np.zeros((3, 6)), rng.normal(0, 1, (100, 6)).round()])
    tree = BlockTree(points[::3], leaf)
    block = tree.assign(points)
    centres = tree.centres()
    away = np.array([np.linalg.norm(p - centres[b]) for p, b in zip(points, block)])
    tree.measure({int(b): away[block == b].max() for b in set(block)})
    reach = rng.uniform(0, 10, len(points))
    met = {(b, i) for b, at in tree.routes(points, reach + 1e-9) for i in at}
    distance = np.linalg.norm(points[:, None] - points[None], axis=2)
    for i, j in zip(*np.nonzero(distance <= reach[:, None])):
        assert (block[j], i) in met


def test_nearest_is_exact_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "SAMPLE_ROWS", 60)  # so that blocks have to grow
    points = np.concatenate([clustered(700), clustered(60).round()])
    found = {}
    for r in neighbors.nearest(frame(spark, points), 3, block_rows=20).collect():
        found.setdefault(r["id"], {})[r["rank"]] = r["neighbor_id"]
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(distance, np.inf)
    for i in range(len(points)):
        want = sorted(range(len(points)), key=lambda j: (distance[i, j], j))[:3]
        assert [found[i][r] for r in (1, 2, 3)] == want


def test_visits_grow_less_than_quadratically(spark):
    few, many = (neighbors.visited_rows(frame(spark, clustered(n)), 1, block_rows=64) for n in (2_000, 16_000))
    assert many < few * 8**1.5  # quadratic growth would be 8 ** 2
    assert many < 16_000**2 / 20


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_the_matrix_product_sorts_out_only_what_is_farther(shift):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(3000, 24)).round(1) + shift
    points[:40] = points[40:80]  # ties, and distances of 0
    queries, ids = points[:400], np.arange(3000)
    for k in (1, 5):
        got = neighbors._closest(ids[:400], queries, ids, points, k)
        direct = np.sqrt(((queries[:, None, :] - points[None]) ** 2).sum(axis=2))
        direct[np.arange(400), np.arange(400)] = np.inf
        expected = np.sort(direct, axis=1)[:, :k]
        assert got.groupby("id").size().eq(k).all()
        assert np.allclose(got.distance.to_numpy().reshape(400, k), expected, rtol=1e-12, atol=0)
        assert got[got.id < 40].groupby("id").first().neighbor_id.tolist() == list(range(40, 80))


def test_a_block_is_searched_by_matrix_products():
    rng = np.random.default_rng(9)
    points, ids = rng.normal(size=(4000, 64)), np.arange(4000)
    begin = time.perf_counter()
    for part in range(0, 1000, 50):  # differences of every pair, as the search worked before
        difference = points[part : part + 50, None, :] - points[None]
        np.partition(np.sqrt(np.einsum("ijk,ijk->ij", difference, difference)), 1, axis=1)
    middle = time.perf_counter()
    neighbors._closest(ids[:1000], points[:1000], ids, points, 1)
    assert time.perf_counter() - middle < (middle - begin) / 2


def test_many_visits_go_in_waves_of_tiles(spark, monkeypatch):
    """A search whose points visit most blocks: fewer rows sent, in several waves, and no neighbour missed."""
    rng = np.random.default_rng(11)
    v = rng.normal(size=(700, 12))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    monkeypatch.setattr(neighbors, "WAVE_ROWS", 1500)
    monkeypatch.setattr(neighbors, "TILE_BLOCKS", 4)
    sent, staged = [], neighbors.staged
    monkeypatch.setattr(neighbors, "staged", lambda frame, name: sent.append(name) or staged(frame, name))
    located = neighbors._located(df, 3, 32, neighbors.MAX_BLOCKS)
    blocks, tiles = neighbors._visits(located), neighbors._visits(located, 4)
    assert sum(tiles.values()) < sum(blocks.values()) / 2
    got = {(r["id"], r["rank"]): (r["neighbor_id"], r["distance"]) for r in neighbors.nearest(df, 3, block_rows=32).collect()}
    assert len(sent) == len(neighbors._waves(tiles, 1500)) > 2
    distance = np.sqrt(((v[:, None] - v) ** 2).sum(axis=2))
    np.fill_diagonal(distance, np.inf)
    near = distance.argsort(axis=1)[:, :3]
    assert len(got) == 2100 and all(got[i, j + 1][0] == near[i, j] for i in range(700) for j in range(3))
    assert neighbors._waves({1: 5, 2: 4, 3: 9, 4: 1}, 9) == [[1, 2], [3], [4]]
