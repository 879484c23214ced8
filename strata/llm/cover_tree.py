"""Cover trees over the rows of a matrix, for dual-tree joins and searches.

Levels are nested with halving radii: a node's centre is a centre on every level
below it, and its children's centres lie more than the level's radius apart. Each
node knows the largest distance from its centre to any row below it.
"""

from __future__ import annotations

import numpy as np

LEAF = 32


class Node:
    __slots__ = ("centre", "radius", "members", "children")

    def __init__(self, centre: int, radius: float, members: np.ndarray, children: list):
        self.centre, self.radius, self.members, self.children = centre, radius, members, children


def distances(points: np.ndarray, rows: np.ndarray, to: int) -> np.ndarray:
    return np.sqrt(np.maximum(((points[rows] - points[to]) ** 2).sum(1), 0))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node | None:
    """The tree over all rows of ``points``; None without rows."""
    if not len(points):
        return None

    squares = (points * points).sum(1)
    longest = float(np.sqrt(squares.max()))

    def split(centre: int, members: np.ndarray, far: np.ndarray, reach: float, close: bool):
        """Centres more than ``reach`` apart with the rows that each covers."""
        rows, at, square = members, points[members], squares[members]
        free, left, own = np.ones(len(rows), bool), len(rows), far
        first = int(np.flatnonzero(rows == centre)[0])
        while True:
            near = free & (own <= reach)
            near[first] = True
            yield int(rows[first]), rows[near]
            free &= ~near
            left -= int(near.sum())
            if not left:
                return
            if 2 * left < len(rows):
                rows, at, square = rows[free], at[free], square[free]
                free = np.ones(left, bool)
            first = int(free.argmax())
            own = (distances(points, rows, int(rows[first])) if close else
                   np.sqrt(np.maximum(square + square[first] - 2 * (at @ at[first]), 0)))

    def node(centre: int, members: np.ndarray, far: np.ndarray) -> Node:
        radius = float(far.max())
        if len(members) <= leaf or radius == 0:
            return Node(centre, radius, members, [])
        # A little less than the level's radius, so that a child always shrinks whatever
        # the products round to; rows too close together for products are subtracted.
        reach = 2.0 ** (np.ceil(np.log2(radius)) - 1) * (1 - 1e-6)
        children = [node(c, rows, distances(points, rows, c))
                    for c, rows in split(centre, members, far, reach, radius < 1e-3 * longest)]
        # Lone rows side by side are one leaf, so that they are compared in one product.
        single = [c for c in children if len(c.members) == 1]
        if len(single) > 1:
            children = [c for c in children if len(c.members) > 1]
            for i in range(0, len(single), leaf):
                rows = np.concatenate([c.members for c in single[i:i + leaf]])
                children.append(Node(int(rows[0]), float(distances(points, rows, int(rows[0])).max()), rows, []))
        return Node(centre, radius, members, children)

    rows = np.arange(len(points))
    return node(0, rows, distances(points, rows, 0))


__all__ = ["Node", "cover_tree", "distances"]
