"""Suffix trees of number sequences, and what they answer in constant time.

``Tree`` is built by Ukkonen's algorithm, a symbol at a time.  Its nodes are
numbered in the order in which a walk enters them; the walk's list of the depth
from which each node is entered holds, between two leaves, the depth of their
lowest common ancestor as its least entry: the length of the longest common
extension of the two suffixes.  Least entries come from blocks and a table of
powers of two over the blocks, so a query costs the same at any length, and
many are answered together.
"""

from __future__ import annotations

#: Entries of a block of the walk.
BLOCK = 32


def ukkonen(text: list[int], size: int):
    """(start of each node's edge, its stop, {node * size + first symbol: child}, leaves in the order of their suffixes).

    ``text`` holds numbers below ``size`` and ends with one that is nowhere else."""
    n = len(text)
    start, stop, link, leaves = [0], [0], [0], []
    child: dict[int, int] = {}
    node, edge, length, open_ = 0, 0, 0, 0
    get = child.get
    for i, x in enumerate(text):
        open_ += 1
        last = 0  # inner node of this step that lacks its suffix link
        while open_:
            if not length:
                edge = i
            key = node * size + text[edge]
            below = get(key)
            if below is None:
                child[key] = len(start)
                if last:
                    link[last] = node
                last = 0
            else:
                begin = start[below]
                span = stop[below] - begin
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if text[begin + length] == x:
                    if last:
                        link[last] = node
                    length += 1
                    break
                inner = len(start)
                start.append(begin)
                stop.append(begin + length)
                link.append(0)
                child[key] = inner
                start[below] = begin + length
                child[inner * size + text[begin + length]] = below
                child[inner * size + x] = inner + 1
                if last:
                    link[last] = inner
                last = inner
            leaves.append(len(start))
            start.append(i)
            stop.append(n)
            link.append(0)
            open_ -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_ + 1
    return start, stop, child, leaves


class Tree:
    """The suffix tree of an array of numbers from 1 on (0 is put behind it)."""

    def __init__(self, symbols):
        import numpy as np

        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.n = len(symbols)
        start, stop, child, leaves = ukkonen([*symbols.tolist(), 0], size)
        nodes = len(start)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        below = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        order = np.argsort(keys)
        self._over, self._first, self._below = keys[order] // size, keys[order] % size, below[order]
        at = np.searchsorted(self._over, np.arange(nodes + 1)).tolist()
        below = self._below.tolist()

        # the walk: nodes in the order of entering, and where each one's subtree ends
        enter, leave, clock, path = [0] * nodes, [0] * nodes, 0, [0]
        while path:
            v = path.pop()
            if v < 0:
                leave[~v] = clock
                continue
            enter[v] = clock
            clock += 1
            i, j = at[v], at[v + 1]
            if i < j:
                path.append(~v)
                path += below[i:j][::-1]
            else:
                leave[v] = clock
        self._enter, self._leave = np.array(enter), np.array(leave)
        self._leaf = np.array(leaves)
        edge = np.array(stop) - np.array(start)
        edge[0] = 0
        depth = self._along(edge)
        entered = np.zeros(nodes, dtype=np.int64)
        entered[self._enter] = depth - edge  # the depth from which a node is entered
        self._least = Least(entered)
        self.place = self._enter[self._leaf]

    def _along(self, own):
        """For each node the sum of ``own`` over its path from the root."""
        import numpy as np

        steps = np.zeros(len(own) + 1, dtype=np.int64)
        np.add.at(steps, self._enter, own)
        np.subtract.at(steps, self._leave, own)
        return np.cumsum(steps)[self._enter]

    def extension(self, i, j):
        """Lengths of the longest common beginnings of the suffixes at i and j (arrays; i != j)."""
        import numpy as np

        a, b = self.place[i], self.place[j]
        return self._least(np.minimum(a, b) + 1, np.maximum(a, b))

    def ranks(self, falling: bool = False):
        """The rank of each suffix (the empty one first); ``falling``: by falling symbols, beginnings still first."""
        import numpy as np

        if not falling:
            return np.argsort(np.argsort(self.place))
        leaf = np.zeros(len(self._enter) + 1, dtype=np.int64)
        leaf[self.place + 1] = 1
        leaf = np.cumsum(leaf)
        count = leaf[self._leave] - leaf[self._enter]
        order = np.lexsort((np.where(self._first == 0, np.iinfo(np.int64).min, -self._first), self._over))
        over, below = self._over[order], self._below[order]
        before = np.cumsum(count[below]) - count[below]
        own = np.zeros(len(count), dtype=np.int64)
        own[below] = before - before[np.searchsorted(over, over)]
        return self._along(own)[self._leaf]


class Least:
    """Least entries of stretches of an array."""

    def __init__(self, values):
        import numpy as np

        blocks = -(-len(values) // BLOCK)
        self.rows = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        self.rows[:len(values)] = values
        rows = self.rows.reshape(blocks, BLOCK)
        self.ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
        self.back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.table = [rows.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            half, before = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(before[:-half], before[half:]))

    def __call__(self, i, j):
        """Least entries from i to j, both included (arrays, i <= j)."""
        import numpy as np

        a, b = i // BLOCK, j // BLOCK
        out = np.minimum(self.back[i], self.ahead[j])
        same = np.flatnonzero(a == b)
        if len(same):
            at = i[same, None] + np.arange(BLOCK)
            inside = at <= j[same, None]
            out[same] = np.where(inside, self.rows[np.where(inside, at, 0)], np.iinfo(np.int32).max).min(axis=1)
        far = np.flatnonzero(b - a > 1)
        if len(far):
            lo, hi = a[far] + 1, b[far]
            power = np.frexp((hi - lo).astype(np.float64))[1] - 1
            for k in np.unique(power).tolist():
                own = power == k
                x, y, t = lo[own], hi[own], self.table[k]
                out[far[own]] = np.minimum(out[far[own]], np.minimum(t[x], t[y - (1 << k)]))
        return out.astype(np.int64)
