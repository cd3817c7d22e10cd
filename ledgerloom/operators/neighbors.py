"""Exact nearest neighbours, and the class balancing built on them (SMOTE, Tomek links).

Space is split again and again until each block holds a bounded number of points (``blocks``). A
first pass inside each block gives every point an upper bound for the distance of its k-th
neighbour. A point then only visits the blocks that can hold something closer, by their centre and
radius and by the splits between, and each visit returns at most k rows. No pair table is ever built
and no neighbour is missed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import hash_number, one_row
from ledgerloom.operators.blocks import BlockTree
from ledgerloom.operators.sampling import take_by_hash
from ledgerloom.session import cut_lineage, freed_shuffles, staged

BLOCK_ROWS = 4096
#: Blocks at most, about: what every task gets of the tree. More rows make larger blocks.
MAX_BLOCKS = 4096
#: Points of a sample that splits are learned from, and passes over the points for that.
SAMPLE_ROWS, MAX_SPLITS = 20_000, 8
#: Rows that one wave of the search sends to blocks, about. A search that sends more puts TILE_BLOCKS blocks together, so that
#: a point is sent once for all of them, and goes wave by wave; the files of a wave's shuffle are deleted before the next.
WAVE_ROWS, TILE_BLOCKS = 1 << 20, 8
# Slack for rounding when distances are compared with bounds.
SLACK = 1e-9


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _pair_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances row by row, by direct differences: equal points come out at exactly 0."""
    difference = left - right
    return np.sqrt(np.einsum("ij,ij->i", difference, difference))


def _rough_squares(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and per row of ``left`` how far they may be off."""
    centre = right.mean(axis=0)
    a, b = left - centre, right - centre
    sizes = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    off = 8 * (left.shape[1] + 4) * np.finfo(np.float64).eps * (np.sqrt(sizes[0]) + np.sqrt(sizes[1].max(initial=0.0))) ** 2
    off += 64 * np.finfo(np.float64).eps * (np.abs(left).max(initial=0.0) + np.abs(right).max(initial=0.0)) ** 2
    squares = a @ b.T
    squares *= -2
    squares += sizes[0][:, None]
    squares += sizes[1]
    return squares, off


def _chunks(rows: int, other: int) -> Iterator[slice]:
    step = max(1, 2_000_000 // max(1, other))
    for start in range(0, rows, step):
        yield slice(start, start + step)


def _closest(query_ids, queries, ids, points, k: int) -> pd.DataFrame:
    """The k closest points of each query, itself left out, ordered by distance and then id.

    A matrix product sorts out what is surely farther than k others; the distances of the rest are worked out directly.
    """
    parts = []
    for part in _chunks(len(queries), len(points)):
        square, off = _rough_squares(queries[part], points)
        square[query_ids[part][:, None] == ids[None, :]] = np.inf
        keep = min(k, len(ids))
        edge = square.min(axis=1) if keep == 1 else np.partition(square, keep - 1, axis=1)[:, keep - 1]
        row, col = np.nonzero((square <= (edge + 2 * off)[:, None]) & np.isfinite(square))
        distance = _pair_distances(queries[part][row], points[col])
        found = pd.DataFrame({"id": query_ids[part][row], "neighbor_id": ids[col], "distance": distance})
        # Ties at the edge may give more than k rows; the lowest ids win.
        found = found.sort_values(["id", "distance", "neighbor_id"])
        parts.append(found[found.groupby("id").cumcount() < k])
    return pd.concat(parts) if parts else pd.DataFrame({"id": [], "neighbor_id": [], "distance": []})


def nearest(
    points: DataFrame, k: int, key: str = "id", vector: str = "v", block_rows: int = BLOCK_ROWS,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """(id, neighbor_id, rank, distance) of the k nearest other points, Euclidean, exact; ties by id.

    ``key`` is unique. Equal points are searched once, so a group of copies of any size costs one search:
    no point needs more than the k + 1 smallest ids of a group.
    """
    base = points.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    # Ordered by the vectors' hashes first: whole vectors are only compared where the hashes are equal.
    hashed = base.withColumn("_h", F.xxhash64("v"))
    place = F.row_number().over(Window.partitionBy("_h", "v").orderBy("id"))
    groups = cut_lineage(
        hashed.withColumn("_place", place)
        .filter(F.col("_place") <= k + 1)
        .groupBy("_h", "v")
        .agg(F.array_sort(F.collect_list("id")).alias("copies"))
        .select(F.col("copies")[0].alias("id"), "_h", "v", "copies")
    )
    found = _nearest_distinct(groups.select("id", "v"), k, block_rows, max_blocks)
    others = found.select("id", "neighbor_id", "distance").join(
        groups.select(F.col("id").alias("neighbor_id"), "copies"), "neighbor_id"
    )
    entries = others.select("id", "distance", F.explode("copies").alias("neighbor_id")).unionByName(
        groups.select("id", F.lit(0.0).alias("distance"), F.explode("copies").alias("neighbor_id"))
    )
    # At most (k + 1) ** 2 entries a group.
    closest = F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))), 1, k + 1)
    lists = entries.groupBy("id").agg(closest.alias("near"))
    full = F.size("copies") > k
    # A group of at most k copies is listed whole. The rows of larger ones are found by their vectors; a very large group makes
    # that join skewed, and adaptive execution splits the side of the points.
    own = groups.select("id", *[F.when(~full if c == "copies" else full, F.col(c)).alias(c) for c in ("copies", "_h", "v")])
    listed = cut_lineage(lists.join(own, "id"))
    rows = listed.select(F.explode("copies").alias("id"), "near")
    large = listed.filter("copies is null").select("_h", "v", "near")
    if not large.isEmpty():
        rows = rows.unionByName(hashed.join(large, ["_h", "v"]).select("id", "near"))
    return (
        rows
        .select("id", F.expr(f"slice(filter(near, e -> e.neighbor_id != id), 1, {int(k)})").alias("near"))
        .select("id", F.posexplode("near").alias("_p", "_e"))
        .select("id", "_e.neighbor_id", (F.col("_p") + 1).alias("rank"), "_e.distance")
    )


@dataclass
class Located:
    """Distinct points in blocks, ``(id, v, block, bound)``, with the tree and the number of points per block."""

    points: DataFrame
    tree: BlockTree
    sizes: dict[int, int]


def _sampled(points: DataFrame, limit: int) -> np.ndarray:
    rows = points.orderBy(hash_number("id"), "id").limit(limit).collect()
    return np.array([r["v"] for r in rows], dtype=np.float64)


def _located(base: DataFrame, k: int, block_rows: int, max_blocks: int) -> Located | None:
    """Points in blocks of at most about ``block_rows`` rows, each with a bound for the distance of its k-th neighbour.

    The driver sees samples of SAMPLE_ROWS points and one line per block; there are at most about ``max_blocks``, larger
    ones if there are more rows. The located points are checkpointed, because both sides of the search read them.
    """
    id_type = base.schema["id"].dataType.simpleString()
    n = base.count()
    if not n:
        return None
    block_rows = max(block_rows, -(-n // max_blocks))

    def share(rows: int, sample: int) -> int:
        return max(2, block_rows * sample // (2 * rows))

    sample = _sampled(base, SAMPLE_ROWS)
    tree = BlockTree(sample, block_rows if n <= len(sample) else share(n, len(sample)))

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = tree.centres()
        for batch in batches:
            if len(batch):
                matrix = _matrix(batch["v"])
                block = tree.assign(matrix)
                centre = np.array([centres[b] for b in block])
                yield batch.assign(block=block, away=np.sqrt(((matrix - centre) ** 2).sum(axis=1)))

    whole = set()
    for turn in range(MAX_SPLITS):
        blocked = base.mapInPandas(to_blocks, f"id {id_type}, v array<double>, block int, away double")
        lines = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
        large = [r for r in lines if r["n"] > 2 * block_rows and r["block"] not in whole]
        if not large or turn == MAX_SPLITS - 1:
            break
        limit = max(64, SAMPLE_ROWS // len(large))
        order = F.row_number().over(Window.partitionBy("block").orderBy(hash_number("id"), "id"))
        wanted = blocked.filter(F.col("block").isin([r["block"] for r in large])).withColumn("_n", order)
        parts: dict[int, list] = {}
        for r in wanted.filter(F.col("_n") <= limit).select("block", "v").collect():
            parts.setdefault(r["block"], []).append(r["v"])
        for r in large:
            own = np.array(parts[r["block"]], dtype=np.float64)
            if not tree.grow(r["block"], own, share(r["n"], len(own))):
                whole.add(r["block"])
    sizes = {r["block"]: r["n"] for r in lines}
    tree.measure({r["block"]: r["radius"] * (1 + SLACK) for r in lines})

    def bound_in_block(group: pd.DataFrame) -> pd.DataFrame:
        matrix = _matrix(group["v"])
        bound = np.full(len(group), np.inf)
        if len(group) > k:
            for part in _chunks(len(matrix), len(matrix)):
                square, off = _rough_squares(matrix[part], matrix)
                # The point itself is at distance 0, so its k-th neighbour is at place k.
                bound[part] = np.sqrt(np.maximum(np.partition(square, k, axis=1)[:, k] + off, 0))
        return group.assign(bound=bound)

    points = blocked.drop("away").groupBy("block").applyInPandas(
        bound_in_block, f"id {id_type}, v array<double>, block int, bound double"
    )
    return Located(cut_lineage(points), tree, sizes)


def _routes(tree: BlockTree, tile_of: dict[int, int], batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each tile of blocks, which points visit one of them."""
    found: dict[int, list[np.ndarray]] = {}
    for block, at in tree.routes(_matrix(batch["v"]), batch["bound"].to_numpy() * (1 + SLACK) + SLACK):
        found.setdefault(tile_of[block], []).append(at)
    for tile, parts in found.items():
        yield tile, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def _tiles(tree: BlockTree, blocks: int) -> dict[int, int]:
    """The tile of each block: ``blocks`` neighbours in the order of the tree, named by the first of them."""
    order = [leaf.block for leaf in tree.leaves()]
    return {block: order[i - i % blocks] for i, block in enumerate(order)}


def _visits(located: Located, blocks: int = 1) -> dict[int, int]:
    """How many points visit each tile: one line per tile for the driver."""
    tree, tile_of = located.tree, _tiles(located.tree, blocks)

    def count_routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame([{"block": b, "n": len(at)} for b, at in _routes(tree, tile_of, batch)], columns=["block", "n"])

    counted = located.points.mapInPandas(count_routes, "block int, n long").groupBy("block").agg(F.sum("n").alias("n"))
    return {r["block"]: r["n"] for r in counted.collect()}


def _waves(visits: dict[int, int], rows: int) -> list[list[int]]:
    """The tiles in waves of at most ``rows`` visits, or of one tile."""
    waves, sent = [], rows + 1
    for tile, n in sorted(visits.items()):
        if sent + n > rows:
            waves.append([])
            sent = 0
        waves[-1].append(tile)
        sent += n
    return waves


def visited_rows(points: DataFrame, k: int, key: str = "id", vector: str = "v", block_rows: int = BLOCK_ROWS) -> int:
    """Pairs of points whose distance the search looks at, for distinct points."""
    located = _located(points.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")), k, block_rows, MAX_BLOCKS)
    return sum(n * located.sizes[b] for b, n in _visits(located).items()) if located else 0


def _nearest_distinct(base: DataFrame, k: int, block_rows: int, max_blocks: int) -> DataFrame:
    """The search among distinct points (id, v)."""
    id_type = base.schema["id"].dataType.simpleString()
    located = _located(base, k, block_rows, max_blocks)
    if located is None:
        return base.sparkSession.createDataFrame([], f"id {id_type}, neighbor_id {id_type}, rank int, distance double")
    tree, visits, tile_blocks = located.tree, _visits(located), 1
    if sum(visits.values()) > WAVE_ROWS:
        tile_blocks = TILE_BLOCKS
        visits = _visits(located, tile_blocks)
    tile_of = _tiles(tree, tile_blocks)
    n_chunks = {b: max(1, -(-n // (block_rows * tile_blocks))) for b, n in visits.items()}
    spread = F.pmod(F.xxhash64(F.concat(F.lit("q"), F.col("id").cast("string"))), F.lit(1 << 31)).cast("bigint")
    spread_points = located.points.withColumn("spread", spread)
    data_points = located.points
    if tile_blocks > 1:  # one entry per block at most
        names = F.create_map(*[F.lit(x) for pair in tile_of.items() for x in pair])
        data_points = data_points.withColumn("block", F.element_at(names, F.col("block")))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "neighbor_id": [], "distance": []})
        return _closest(
            left["id"].to_numpy(), _matrix(left["v"]), right["id"].to_numpy(), _matrix(right["v"]), k
        )

    def found_in(wave: set[int]) -> DataFrame:
        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                for block, at in _routes(tree, tile_of, batch):
                    if block in wave:
                        rows = batch.iloc[at]
                        chunk = (rows["spread"] % n_chunks[block]).astype("int32")
                        yield rows[["id", "v"]].assign(block=block, chunk=chunk)

        queries = spread_points.mapInPandas(send, f"id {id_type}, v array<double>, block int, chunk int")
        split = {b: n_chunks[b] for b in wave if n_chunks[b] > 1}
        chunk_count = F.lit(1)
        if split:  # one entry per block at most
            counts = F.create_map(*[F.lit(x) for pair in split.items() for x in pair])
            chunk_count = F.coalesce(F.try_element_at(counts, F.col("block")), F.lit(1))
        own = data_points.filter(F.col("block").isin(list(wave))) if len(waves) > 1 else data_points
        data = own.select("id", "v", "block", F.explode(F.sequence(F.lit(0), chunk_count - 1)).alias("chunk"))
        return (
            queries.groupBy("block", "chunk")
            .cogroup(data.groupBy("block", "chunk"))
            .applyInPandas(search, f"id {id_type}, neighbor_id {id_type}, distance double")
        )

    waves = _waves(visits, WAVE_ROWS) if tile_blocks > 1 else [list(visits)]
    found = found_in(set(waves[0]))
    if len(waves) > 1:
        parts = []
        for wave in waves:
            with freed_shuffles(base.sparkSession):
                parts.append(staged(found_in(set(wave)), "neighbors"))
        found = functools.reduce(DataFrame.unionAll, parts)
    order = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", order).filter(F.col("rank") <= k).select("id", "neighbor_id", "rank", "distance")


def smote_neighbors(points: DataFrame, label: str = "y", minority: int = 1, k: int = 5) -> DataFrame:
    """The k nearest minority points of each minority point."""
    return nearest(points.filter(F.col(label) == minority), k)


def smote_rows(points: DataFrame, label: str = "y", minority: int = 1, k: int = 5) -> DataFrame:
    """New minority points that bring the classes to 1:1, each between a point and one of its neighbours.

    Every minority point gets the same number of copies and the first few in hash order one more. The
    neighbour and the place on the line come from hashes of the point and the copy number, so the
    result is the same on every run. ``id`` is unique; the new rows carry ``base_id`` and ``copy_no``.
    """
    few = points.filter(F.col(label) == minority)
    sizes = one_row(
        points, F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many")
    )
    wanted = F.greatest(F.lit(0), sizes.getField("many") - sizes.getField("few"))
    neighbors = smote_neighbors(points, label, minority, k)
    available = F.least(F.lit(k), sizes.getField("few") - 1)
    flagged = take_by_hash(few, label, "id", F.try_mod(wanted, sizes.getField("few")), "_extra")
    copies = F.floor(wanted / sizes.getField("few")) + F.col("_extra").cast("int")
    planned = flagged.select("id", "v", copies.cast("int").alias("_copies")).filter(F.col("_copies") > 0)
    drawn = planned.select("id", "v", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy_no")).select(
        "id",
        "v",
        "copy_no",
        (hash_number("id", "copy_no") % available + 1).cast("int").alias("rank"),
        ((hash_number("copy_no", "id") % 1_000_000) / 1_000_000.0).alias("step"),
    )
    ends = few.select(F.col("id").alias("neighbor_id"), F.col("v").alias("_end"))
    mixed = F.expr("zip_with(v, _end, (a, b) -> a + step * (b - a))")
    return (
        drawn.join(neighbors.select("id", "rank", "neighbor_id"), ["id", "rank"])
        .join(ends, "neighbor_id")
        .select(F.col("id").alias("base_id"), "copy_no", "neighbor_id", "step", mixed.alias("v"))
    )


def oversample(points: DataFrame, label: str = "y", minority: int = 1, k: int = 5) -> DataFrame:
    """(id, v, label) with the new minority points added; ids become text so that new ones fit in."""
    new = smote_rows(points, label, minority, k).select(
        F.concat_ws("+", F.col("base_id").cast("string"), F.col("copy_no").cast("string")).alias("id"),
        "v",
        F.lit(minority).cast(points.schema[label].dataType).alias(label),
    )
    return points.select(F.col("id").cast("string").alias("id"), "v", label).unionByName(new)


def tomek_links(points: DataFrame, label: str = "y") -> DataFrame:
    """Pairs of mutual nearest neighbours with different labels, smaller id first. The search runs once; a pair is mutual if
    both of its ends name it."""
    labels = points.select("id", F.col(label).alias("label"))
    closest = nearest(points, 1).select("id", "neighbor_id", "distance").join(labels, "id")
    first = F.col("id") < F.col("neighbor_id")
    pairs = closest.groupBy(F.least("id", "neighbor_id").alias("_a"), F.greatest("id", "neighbor_id").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(first, F.col("label"))).alias("label"),
        F.max(F.when(~first, F.col("label"))).alias("neighbor_label"),
        F.max(F.when(first, F.col("distance"))).alias("distance"),
    )
    return pairs.filter((F.col("_n") == 2) & (F.col("label") != F.col("neighbor_label"))).select(
        F.col("_a").alias("id"), F.col("_b").alias("neighbor_id"), "label", "neighbor_label", "distance"
    )


def drop_tomek(points: DataFrame, label: str = "y") -> DataFrame:
    """Both ends of every Tomek link removed."""
    ends = tomek_links(points, label).select(F.explode(F.array("id", "neighbor_id")).alias("id"))
    return points.join(ends, "id", "left_anti")


def resample(points: DataFrame, label: str = "y", minority: int = 1, k: int = 5) -> DataFrame:
    """Over-sample the minority to 1:1, then remove Tomek links. The search reads the over-sampled rows
    several times, so they are checkpointed in between."""
    return drop_tomek(cut_lineage(oversample(points, label, minority, k)), label)
