"""A geometric near-neighbour access tree over the entries of a codebook, searched for many queries at once.

Every node picks split points among its entries, far from each other, and gives each other entry to
its nearest split point. For every split point and every child it keeps the smallest and the largest
distance from the one to the entries of the other. A query that is at distance d of a split point and
at most r from the best entry so far skips a child whose range is entirely outside [d - r, d + r]. The
comparison is strict and rounded against skipping, so an entry that ties with the best is always
looked at, and ties are settled on the integer distances.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPLITS = 8
#: Entries up to which a node compares all of them.
LEAF = 12
#: Relative slack of the floating distances, many times their rounding error.
SLACK = 2.0**-44


@dataclass
class Node:
    points: np.ndarray  # entry numbers compared at this node
    children: list[Node | None]  # by split point
    low: np.ndarray  # [split point, child]: at most the smallest distance
    high: np.ndarray  # [split point, child]: at least the largest distance


def distances(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all queries to all entries, in integers."""
    return np.stack([((queries - e) ** 2).sum(axis=1) for e in entries], axis=1)


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """The tree over the given entries (all by default)."""
    members = np.arange(len(entries)) if members is None else members
    own = entries[members]
    picked, nearest = [0], ((own - own[0]) ** 2).sum(axis=1)
    while len(members) > LEAF and len(picked) < SPLITS and nearest.max() > 0:
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((own - own[picked[-1]]) ** 2).sum(axis=1))
    if len(picked) == 1:
        none = np.zeros((0, 0))
        return Node(members, [], none, none)
    table = distances(own, own[picked])
    home = table.argmin(axis=1)
    home[picked] = -1
    far = np.sqrt(table)
    children: list[Node | None] = []
    low = np.zeros((len(picked), len(picked)))
    high = np.zeros_like(low)
    for j in range(len(picked)):
        inside = home == j
        children.append(build(entries, members[inside]) if inside.any() else None)
        if inside.any():
            low[:, j] = far[inside].min(axis=0) * (1 - SLACK)
            high[:, j] = far[inside].max(axis=0) * (1 + SLACK)
    return Node(members[picked], children, low, high)


def nearest(root: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every query the number of its nearest entry, the lowest of ties, and its squared distance."""
    best = np.full(len(queries), -1, dtype=np.int64)
    square = np.full(len(queries), np.iinfo(np.int64).max, dtype=np.int64)

    def look(node: Node, rows: np.ndarray) -> None:
        table = distances(queries[rows], entries[node.points])
        for k, entry in enumerate(node.points):
            d, old, number = table[:, k], square[rows], best[rows]
            better = (d < old) | ((d == old) & (entry < number))
            best[rows[better]] = entry
            square[rows[better]] = d[better]
        if not node.children:
            return
        away, home = np.sqrt(table), table.argmin(axis=1)
        for first in (True, False):  # the nearest split point's child first: it brings the best entry near
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                here = home == j if first else home != j
                if not first:
                    reach = np.sqrt(square[rows[here]])[:, None]
                    d = away[here]
                    out = (d * (1 - SLACK) > (node.high[:, j] + reach) * (1 + SLACK)) | (node.low[:, j] * (1 - SLACK) > (d + reach) * (1 + SLACK))
                    here[here] = ~out.any(axis=1)
                if here.any():
                    look(child, rows[here])

    if len(queries):
        look(root, np.arange(len(queries)))
    return best, square
