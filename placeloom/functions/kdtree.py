"""k-d trees over unit vectors: a split tree that partitions the globe, and a local tree that answers radius queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

EARTH_M = 6_371_008.8


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Points on the unit sphere, one row each."""
    a, b = np.radians(lat), np.radians(lon)
    return np.column_stack((np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)))


def chord(radius_m: float) -> float:
    """Straight-line length, on the unit sphere, of an arc of ``radius_m``."""
    return 2 * np.sin(min(radius_m / EARTH_M, np.pi) / 2)


def arc_m(chord2: np.ndarray) -> np.ndarray:
    """Metres along the sphere for squared chords."""
    return 2 * EARTH_M * np.arcsin(np.minimum(1, np.sqrt(chord2) / 2))


class SplitTree:
    """k-d splits learnt on a sample of points; every point has one cell, and halo copies in the cells within ``reach``.

    A cell that would still hold more than ``leaf_rows`` rows but is too narrow to be split (a hot spot) is divided
    into chunks by a hash of the row, and each pair of chunks becomes one block. So no block holds more than about
    two chunks, and every pair of rows still meets in exactly one block.
    """

    def __init__(self, sample: np.ndarray, rows: int, reach: float, leaf_rows: int):
        self.reach, self.axis, self.at, self.child, self.chunks = reach, [], [], [], []
        scale = rows / max(1, len(sample))

        def grow(part: np.ndarray) -> int:
            me = len(self.axis)
            self.axis.append(-1), self.at.append(0.0), self.child.append((-1, -1))
            wide = np.ptp(part, axis=0) if len(part) else np.zeros(3)
            axis = int(np.argmax(wide))
            if len(part) * scale > leaf_rows and len(part) > 1 and wide[axis] > 8 * reach:
                cut = float(np.median(part[:, axis]))
                low = part[:, axis] < cut
                if low.any():
                    left = grow(part[low])
                    right = grow(part[~low])
                    self.axis[me], self.at[me], self.child[me] = axis, cut, (left, right)
                    return me
            self.child[me] = (len(self.chunks), -1)
            self.chunks.append(max(1, int(np.ceil(len(part) * scale / (2 * leaf_rows)))))
            return me

        grow(sample)
        self.axis, self.at, self.child = np.array(self.axis), np.array(self.at), np.array(self.child)
        self.chunks = np.array(self.chunks)
        self.first_block = np.concatenate(([0], np.cumsum(self.chunks * (self.chunks + 1) // 2)))

    @property
    def blocks(self) -> int:
        return int(self.first_block[-1])

    def place(self, xyz: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, block, whether the row belongs to the block's cell, and its side: 2 in a block of one chunk, else 0 or 1."""
        row, node, own = np.arange(len(xyz)), np.zeros(len(xyz), int), np.ones(len(xyz), bool)
        ends = []
        while len(row):
            leaf = self.axis[node] < 0
            ends.append((row[leaf], self.child[node[leaf], 0], own[leaf]))
            row, node, own = row[~leaf], node[~leaf], own[~leaf]
            if not len(row):
                break
            off = xyz[row, self.axis[node]] - self.at[node]
            near = np.abs(off) <= self.reach
            home = (off >= 0).astype(int)
            row, own, node = (
                np.concatenate((row, row[near])),
                np.concatenate((own, np.zeros(near.sum(), bool))),
                np.concatenate((self.child[node, home], self.child[node[near], 1 - home[near]])),
            )
        row, cell, own = (np.concatenate(x) for x in zip(*ends, strict=True)) if ends else (row, node, own)
        k = self.chunks[cell]
        times = np.repeat(np.arange(len(row)), k)
        other = np.arange(len(times)) - np.repeat(np.cumsum(k) - k, k)
        row, cell, own, k = row[times], cell[times], own[times], k[times]
        mine = salt[row] % k
        i, j = np.minimum(mine, other), np.maximum(mine, other)
        side = np.where(i == j, 2, (mine == j).astype(int))
        return row, self.first_block[cell] + j * (j + 1) // 2 + i, own, side


class LocalTree:
    """Balanced k-d tree over the rows of ``xyz``; all queries of a call go down it together, level by level."""

    def __init__(self, xyz: np.ndarray, leaf: int = 12):
        n = len(xyz)
        self.xyz, self.order, self.levels = xyz, np.arange(n), []
        depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf)))) if n else 0
        for level in range(depth):
            edge = n * np.arange((1 << level) + 1) // (1 << level)
            node = np.repeat(np.arange(1 << level), np.diff(edge))
            now = xyz[self.order]
            axis = np.argmax(np.maximum.reduceat(now, edge[:-1]) - np.minimum.reduceat(now, edge[:-1]), axis=1)
            key = now[np.arange(n), axis[node]]
            by = np.lexsort((key, node))
            self.order, key = self.order[by], key[by]
            mid = n * (2 * np.arange(1 << level) + 1) // (2 << level)
            self.levels.append((axis, key[mid - 1], key[mid]))
        self.edge = n * np.arange((1 << depth) + 1) // (1 << depth)

    def near(self, q: np.ndarray, r: float, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query row, tree row and squared distance of all pairs within ``r``, in pieces made of at most ``most`` candidates."""
        if not len(q) or not len(self.order):
            return
        for at in range(0, len(q), 4096):
            row = np.arange(at, min(at + 4096, len(q)))
            node = np.zeros(len(row), int)
            for axis, low, high in self.levels:
                x = q[row, axis[node]]
                left, right = x - r <= low[node], x + r >= high[node]
                row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left], 2 * node[right] + 1))
            count = self.edge[node + 1] - self.edge[node]
            total = np.cumsum(count)
            begin = 0
            while begin < len(row):
                done = total[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(total, done + most, "right")))
                c = count[begin:end]
                rows = np.repeat(row[begin:end], c)
                seat = np.repeat(self.edge[node[begin:end]] - (np.cumsum(c) - c), c) + np.arange(len(rows))
                hit = self.order[seat]
                d2 = ((q[rows] - self.xyz[hit]) ** 2).sum(axis=1)
                ok = d2 <= r * r
                yield rows[ok], hit[ok], d2[ok]
                begin = end
