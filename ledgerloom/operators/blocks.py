"""A tree of bounded blocks over points: recursive splits, a centre and radius per block, and which blocks a search visits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    """A block (``block`` is set) or a split: points with ``point . direction <= threshold`` go to ``low``, others to ``high``."""

    centre: np.ndarray
    radius: float = 0.0
    block: int = -1
    direction: np.ndarray | None = None
    threshold: float = 0.0
    low: Node | None = None
    high: Node | None = None


class BlockTree:
    """Splits are learned from samples and run across the line between two far points of a node, at the sample's median.

    ``grow`` splits further the blocks that turn out too large; ``measure`` sets the radii from all points. Sample sizes
    only change how even the blocks are, never which neighbours are found.
    """

    def __init__(self, sample: np.ndarray, leaf_size: int) -> None:
        self.n_blocks = 0
        self.root = self._build(sample, leaf_size)

    def _leaf(self, sample: np.ndarray) -> Node:
        self.n_blocks += 1
        return Node(sample.mean(axis=0), block=self.n_blocks - 1)

    def _build(self, sample: np.ndarray, leaf_size: int) -> Node:
        if len(sample) <= max(leaf_size, 1):
            return self._leaf(sample)
        centre = sample.mean(axis=0)
        far = sample[((sample - centre) ** 2).sum(axis=1).argmax()]
        other = sample[((sample - far) ** 2).sum(axis=1).argmax()]
        length = np.sqrt(((other - far) ** 2).sum())
        if not length > 0:
            return self._leaf(sample)
        direction = (other - far) / length
        along = sample @ direction
        threshold = float(np.median(along))
        if threshold >= along.max():  # half of the sample or more lies at the end
            threshold = float((along[along < along.max()].max() + along.max()) / 2)
        low = along <= threshold
        if low.all() or not low.any():
            return self._leaf(sample)
        return Node(
            centre, direction=direction, threshold=threshold,
            low=self._build(sample[low], leaf_size), high=self._build(sample[~low], leaf_size),
        )

    def leaves(self, node: Node | None = None) -> Iterator[Node]:
        stack = [node or self.root]
        while stack:
            top = stack.pop()
            if top.low is None:
                yield top
            else:
                stack += [top.high, top.low]

    def grow(self, block: int, sample: np.ndarray, leaf_size: int) -> bool:
        """Splits a block by a sample of its points; whether that gave more than one."""
        leaf = next(x for x in self.leaves() if x.block == block)
        before = self.n_blocks
        new = self._build(sample, leaf_size)
        if new.low is None:
            self.n_blocks = before
            return False
        leaf.__dict__.update(new.__dict__)
        return True

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The block of each point."""
        out = np.empty(len(points), np.int32)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node.low is None:
                out[at] = node.block
                continue
            # A sum per row, which does not depend on the other rows: the same point always comes to the same side.
            low = (points[at] * node.direction).sum(axis=1) <= node.threshold
            stack += [(node.low, at[low]), (node.high, at[~low])]
        return out

    def centres(self) -> dict[int, np.ndarray]:
        return {leaf.block: leaf.centre for leaf in self.leaves()}

    def measure(self, radius: dict[int, float]) -> None:
        """Radii of the blocks, from them those of the nodes above; an empty block is never visited."""

        def set_radius(node: Node) -> float:
            if node.low is None:
                node.radius = radius.get(node.block, -np.inf)
                return node.radius
            reach = [
                np.sqrt(((node.centre - child.centre) ** 2).sum()) + set_radius(child) for child in (node.low, node.high)
            ]
            node.radius = max(reach)
            return node.radius

        set_radius(self.root)

    def routes(self, points: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each block, which points may have something within their ``reach`` in it.

        A node is left out if its ball lies farther away, or if the way across one of the splits above it is longer.
        """
        stack = [(self.root, np.arange(len(points)), np.zeros(len(points)))]
        while stack:
            node, at, across = stack.pop()
            distance = np.sqrt(((points[at] - node.centre) ** 2).sum(axis=1)) - node.radius
            near = np.maximum(distance, across) <= reach[at]
            at, across = at[near], across[near]
            if not len(at):
                continue
            if node.low is None:
                yield node.block, at
                continue
            beyond = points[at] @ node.direction - node.threshold
            stack += [(node.low, at, np.maximum(across, beyond)), (node.high, at, np.maximum(across, -beyond))]
