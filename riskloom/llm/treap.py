"""A K2-treap over a grid of terms (rows) and documents (columns): a quadtree whose cells know the largest impact inside.

Rows and columns are halved together, so a node has up to four children. Children are stored level by level behind
each other; a node's children are found by counting the marks before it. A node that holds one entry is not divided further (the tree
is compressed) and stores that entry's row and column.

Columns are few compared with rows, as a rule; the first levels then divide the rows only.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Document ranges opened at a time.
CHUNK = 512
_COUNT = np.array([bin(i).count("1") for i in range(16)], np.int64)


@dataclass
class Treap:
    """``marks``: per node the children that exist, one bit each, 0 for a single entry; ``peaks``: the largest impact
    inside; ``rows`` and ``columns``: of single entries, in node order. ``depth`` halvings reach one row and column."""

    depth: int
    marks: np.ndarray
    peaks: np.ndarray
    rows: np.ndarray
    columns: np.ndarray

    def __post_init__(self) -> None:
        single = self.marks == 0
        # Of a divided node the place of its first child, of a single entry its place among these.
        children = _COUNT[self.marks]
        first = 1 + np.cumsum(children) - children
        self.links = np.where(single, np.cumsum(single) - 1, first)


def spread(x: np.ndarray, bits: int) -> np.ndarray:
    """Every bit of x at twice its place."""
    out = np.zeros_like(x)
    for b in range(bits):
        out |= ((x >> b) & 1) << (2 * b)
    return out


def build(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
    """The treap of distinct (row, column) entries with impacts over zero."""
    if not len(rows):
        return Treap(0, np.zeros(0, np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))
    depth = max(int(rows.max()).bit_length(), int(columns.max()).bit_length())
    codes = spread(rows.astype(np.int64), depth) << 1 | spread(columns.astype(np.int64), depth)
    order = np.argsort(codes)
    codes, where, impacts = codes[order], order, impacts[order]
    marks, peaks, singles = [], [], []
    parents = None
    for level in range(depth + 1):
        prefix = codes >> (2 * (depth - level))
        starts = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        counts = np.diff(np.append(starts, len(codes)))
        heads = prefix[starts]
        if parents is not None:
            # Every divided node of the level above has children here, in the same order.
            groups = np.flatnonzero(np.concatenate(([True], heads[1:] >> 2 != heads[:-1] >> 2)))
            marks[-1][parents] = np.bitwise_or.reduceat(1 << (heads & 3), groups)
        marks.append(np.zeros(len(starts), np.uint8))
        peaks.append(np.maximum.reduceat(impacts, starts))
        alone = counts == 1
        singles.append(where[starts[alone]])
        parents = np.flatnonzero(~alone)
        if not len(parents):
            break
        inside = np.repeat(~alone, counts)
        codes, where, impacts = codes[inside], where[inside], impacts[inside]
    entries = np.concatenate(singles)
    return Treap(depth, np.concatenate(marks), np.concatenate(peaks), rows[entries], columns[entries])


def best_columns(tree: Treap, rows: np.ndarray, weights: np.ndarray, count: int, least: int = 1) -> list[tuple[int, int]]:
    """(score, column) of the ``count`` columns with the largest sums of weight times impact over ``rows``, of those with
    at least ``least``; equal sums by column.

    The paths of all rows go down together over ranges of columns. A range's sum of peaks bounds its columns' scores; ranges wait by
    that bound and are opened some at a time, of one level each, until no bound reaches the worst score kept.
    """
    found: list[tuple[int, int]] = []
    if not len(rows) or not len(tree.marks):
        return found
    least = max(least, 1)
    start = np.zeros(len(rows), np.int64)
    lines = np.arange(len(rows))
    if tree.marks[0] == 0:
        keep = tree.rows[0] == rows
        start, lines = start[keep], lines[keep]
        if not len(lines):
            return found
    bound = int((tree.peaks[start].astype(np.int64) * weights[lines]).sum())
    # (bound, a tie-breaking number, level, columns, owners, lines, nodes): owners number the range of each path.
    waiting = [(-bound, 0, 0, np.zeros(1, np.int64), np.array([bound]), np.zeros(len(lines), np.int64), lines, start)]
    number = 0
    while waiting:
        top, _, level, columns, bounds, owners, lines, nodes = heapq.heappop(waiting)
        if -top < least:
            break
        if level == tree.depth:
            found += zip(bounds.tolist(), columns.tolist())
            found.sort(key=lambda x: (-x[0], x[1]))
            del found[count:]
            if len(found) == count:
                least = max(least, found[-1][0])
            continue
        open_ = bounds >= least
        if not open_.all():
            place = np.cumsum(open_) - 1
            keep = open_[owners]
            owners, lines, nodes = place[owners[keep]], lines[keep], nodes[keep]
            columns = columns[open_]
        shift = tree.depth - 1 - level
        marks, links = tree.marks[nodes].astype(np.int64), tree.links[nodes]
        bits = (rows[lines] >> shift & 1) * 2
        divided = marks > 0
        own_side = np.where(divided, -1, tree.columns[np.where(divided, 0, links)].astype(np.int64) >> shift & 1)
        parts = []
        for side in (0, 1):
            slot = bits + side
            keep = np.where(divided, marks >> slot & 1 == 1, own_side == side)
            to = links + _COUNT[marks & ((1 << slot) - 1)]
            new = np.where(divided, to, nodes)[keep]
            line, owner = lines[keep], owners[keep]
            # An entry met for the first time must be of this path's row.
            fresh = divided[keep] & (tree.marks[new] == 0)
            wrong = np.zeros(len(new), bool)
            wrong[fresh] = tree.rows[tree.links[new[fresh]]] != rows[line[fresh]]
            parts.append((owner[~wrong] * 2 + side, line[~wrong], new[~wrong]))
        owners, lines, nodes = (np.concatenate(x) for x in zip(*parts))
        if not len(owners):
            continue
        order = np.argsort(owners, kind="stable")
        owners, lines, nodes = owners[order], lines[order], nodes[order]
        starts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
        bounds = np.add.reduceat(tree.peaks[nodes].astype(np.int64) * weights[lines], starts)
        ranges = owners[starts]
        columns = columns[ranges >> 1] + ((ranges & 1) << shift)
        sizes = np.diff(np.append(starts, len(owners)))
        keep = bounds >= least
        if not keep.any():
            continue
        # The best ranges share a chunk.
        order = np.flatnonzero(keep)
        if len(order) > CHUNK:
            order = order[np.lexsort((columns[order], -bounds[order]))]
        for first in range(0, len(order), CHUNK):
            part = order[first : first + CHUNK]
            length = sizes[part]
            ends = np.cumsum(length)
            paths = np.arange(ends[-1]) + np.repeat(starts[part] - (ends - length), length)
            number += 1
            heapq.heappush(waiting, (-int(bounds[part].max()), number, level + 1, columns[part], bounds[part], np.repeat(np.arange(len(part)), length), lines[paths], nodes[paths]))
    return found
