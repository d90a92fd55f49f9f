"""Digests of lower-cased texts: set sizes of two texts' sketches, and sorted lists.

Windows and digests are those of ``digests.digest_lists``.  For a comparison no list of
digests leaves the worker: what it needs of each (w, k) is two numbers.  Texts come
lower-cased and are split by ``str.split``, whose white space is that of
``text.WHITESPACE_RUN``.

Rows that follow one another often have the same first text (a page's version 0).
Its digests are ranked once and become numbers; those of another text that lie in the
tokens shared with it, or with the text before, at the start or the end, are known, and
only the windows between are hashed and looked up.  Whatever the order of rows is, the
result is the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .digests import SLICE_BYTES, _in_order, _nested, _repeats, _same_start, md5

#: Rows whose texts are read from a batch together.
ROWS = 64
#: Digests beside those of the first text that are remembered from row to row.
MOST_OTHERS = 1 << 18
#: What stands before a token of that length.
PREFIXES = [n.to_bytes(4, "big") for n in range(256)]


class _Tokens:
    """A text's tokens with a space before and behind each, and the places of the spaces."""

    def __init__(self, text: str):
        words = text.split()
        self.data = f" {' '.join(words)} ".encode()
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.spaces = np.flatnonzero(self.bytes == 32)
        self.n = len(words)
        self.ids: dict[int, np.ndarray] = {}
        self.found: dict[int, np.ndarray] = {}
        self.sorted: list[np.ndarray] = []

    def shared(self, other: _Tokens) -> tuple[int, int]:
        """How many tokens at the start and at the end are those of ``other``."""
        if not self.n or not other.n:
            return 0, 0
        first = int(np.searchsorted(self.spaces, _same_start(self.bytes, other.bytes), side="left")) - 1
        back = len(self.data) - _same_start(self.bytes[::-1], other.bytes[::-1])
        return max(first, 0), max(len(self.spaces) - int(np.searchsorted(self.spaces, back, side="left")) - 1, 0)

    def hashed(self, w: int, start: int, stop: int) -> bytes:
        """The digests of the windows that start at the tokens from ``start`` on, up to ``stop``."""
        if stop <= start:
            return b""
        words = self.data[self.spaces[start] + 1:self.spaces[stop + w - 1]].split(b" ")
        raw = b"".join([PREFIXES[len(t)] + t if len(t) < 256 else len(t).to_bytes(4, "big") + t for t in words])
        at = [0, *np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 4).tolist()]
        return b"".join([md5(raw[i:j]).digest() for i, j in zip(at, at[w:])])

    def listed(self, ws: Sequence[int], least: int | None, before: _Tokens | None) -> _Tokens:
        """The text with its sorted lists; what it shares with the one before is taken from there."""
        if before is not None and before.data == self.data:
            return before
        first, last = self.shared(before) if before is not None else (0, 0)
        for w in ws:
            n = self.windows(w)
            old = before.found[w] if before is not None else np.empty((0, 16), np.uint8)
            head = min(max(first - w + 1, 0), n)
            tail = min(max(last - w + 1, 0), n - head)
            new = np.frombuffer(self.hashed(w, head, n - tail), np.uint8).reshape(-1, 16)
            self.found[w] = np.concatenate([old[:head], new, old[len(old) - tail:]])
            self.sorted.append(_in_order(self.found[w])[:least])
        return self

    def windows(self, w: int) -> int:
        return max(self.n - w + 1, 0)


def _halves(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0].copy(), both[:, 1].copy()


class _Known:
    """Numbers of digests for one w: those of the first text by rank, others as they come."""

    def __init__(self, base: _Tokens, w: int):
        high, low = _halves(base.hashed(w, 0, base.windows(w)))
        order = np.argsort(high)
        h, lo = high[order], low[order]
        if ((h[1:] == h[:-1]) & (lo[1:] != lo[:-1])).any():
            order = np.lexsort((low, high))
            h, lo = high[order], low[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
        ids = np.empty(len(h), np.int64)
        ids[order] = self.in_order = np.cumsum(new) - 1
        base.ids[w] = ids
        self.high, self.low, self.n = h[new], lo[new], int(new.sum())
        self.sets: dict[int, set[int]] = {}
        self.forget()

    def forget(self) -> None:
        self.others: dict[bytes, int] = {}
        self.all_high, self.all_low = self.high, self.low

    def numbers(self, raw: bytes) -> np.ndarray:
        """The numbers of digests; new ones get the next."""
        high, low = _halves(raw)
        at = np.searchsorted(self.high, high)
        inside = np.minimum(at, max(self.n - 1, 0))
        same = (at < self.n) & (self.high[inside] == high) if self.n else np.zeros(len(high), bool)
        found = same & (self.low[inside] == low) if self.n else same
        ids, before = np.where(found, at, -1), len(self.others)
        for i in np.flatnonzero(~found).tolist():
            k = int(at[i])  # others with the same first half stand behind
            while k < self.n and self.high[k] == high[i] and self.low[k] != low[i]:
                k += 1
            if k < self.n and self.high[k] == high[i]:
                ids[i] = k
            else:
                ids[i] = self.others.setdefault(raw[16 * i:16 * i + 16], self.n + len(self.others))
        if len(self.others) > before:
            more = _halves(b"".join([*self.others][before:]))
            self.all_high, self.all_low = np.concatenate([self.all_high, more[0]]), np.concatenate([self.all_low, more[1]])
        return ids

    def least(self, ids: np.ndarray, k: int) -> list[int]:
        """The first ``k`` of the digests' numbers, in the order of the digests."""
        high = self.all_high[ids]
        if len(ids) > 2 * k:
            low_ones = high <= np.partition(high, k - 1)[k - 1]
            ids, high = ids[low_ones], high[low_ones]
        return ids[np.lexsort((self.all_low[ids], high))][:k].tolist()

    def base_set(self, k: int) -> set[int]:
        if k not in self.sets:
            self.sets[k] = set(self.in_order[:k].tolist())
        return self.sets[k]


class _First:
    """A first text and the text that was compared with it last."""

    def __init__(self, text: str, ws: Sequence[int], ks: Sequence[int]):
        self.text, self.ws, self.ks = text, ws, ks
        self.base, self.before = _Tokens(text), None
        self.known = {w: _Known(self.base, w) for w in ws}

    def sizes(self, text: str) -> list[int]:
        """For each w and k: how many digests both sets share, and how many either holds."""
        cur, near = _Tokens(text), [self.base]
        if any(len(known.others) > MOST_OTHERS for known in self.known.values()):
            self.before = None
            for known in self.known.values():
                known.forget()
        if self.before is not None:
            near.append(self.before)
        (first, last), other = max([(cur.shared(x), x) for x in near], key=lambda s: sum(s[0]))
        out = []
        for w in self.ws:
            known, old, n = self.known[w], other.ids[w], cur.windows(w)
            head = min(max(first - w + 1, 0), n)
            tail = min(max(last - w + 1, 0), n - head)
            new = known.numbers(cur.hashed(w, head, n - tail)) if head + tail < n else old[:0]
            cur.ids[w] = np.concatenate([old[:head], new, old[len(old) - tail:]])
            out += self._cells(known, cur.ids[w])
        self.before = cur
        return out

    def _cells(self, known: _Known, ids: np.ndarray) -> list[int]:
        longest, out = max(len(ids), len(known.in_order)), []
        cut = max([k for k in self.ks if k < longest], default=0)
        least = known.least(ids, cut) if cut else []
        for k in self.ks:
            if k < longest:
                a, b = known.base_set(k), set(least[:k])
                shared, both = len(a & b), len(a) + len(b)
            else:
                held = np.zeros(len(known.all_high), bool)
                held[ids] = True
                shared = int(np.count_nonzero(held[:known.n]))
                both = known.n + int(np.count_nonzero(held))
            out += [shared, both - shared]
        return out


def shared_sizes(base, text, ws: Iterable[int], ks: Iterable[int]) -> Column:
    """array<int>: for each w and each k the sizes of the intersection and of the union
    of the two lower-cased texts' k least digests as sets."""
    ws, ks = tuple(int(w) for w in ws), tuple(int(k) for k in ks)
    width = 2 * len(ws) * len(ks)

    @F.arrow_udf("array<int>")
    def sizes(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        first: _First | None = None
        for bases, texts in batches:
            out: list[int] = []
            for at in range(0, len(bases), ROWS):
                for b, t in zip(bases.slice(at, ROWS).to_pylist(), texts.slice(at, ROWS).to_pylist()):
                    if first is None or first.text != b:
                        first = _First(b, ws, ks)
                    out += first.sizes(t)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, len(out) + 1, width, dtype=np.int32)), pa.array(out, pa.int32()))
    return sizes(*[F.col(t) if isinstance(t, str) else t for t in (base, text)])


def text_lists(text, ws: Iterable[int], least: int | None = None) -> Column:
    """struct<n_tokens, lists, repeats> of a lower-cased text: for each w the sorted digests of
    all windows, copies kept (``least``: only so many least ones), and the places (from 1) of
    digests that are those before them.  From these few numbers follows the size of the set of
    any first so many digests."""
    ws = tuple(int(w) for w in ws)

    @F.arrow_udf("struct<n_tokens: int, lists: array<array<string>>, repeats: array<array<int>>>")
    def lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def rows(counts: list[int], out: list[np.ndarray]) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(counts, pa.int32()), _nested(out, len(ws)), _repeats(out, len(ws))],
                                              names=["n_tokens", "lists", "repeats"])
        before: _Tokens | None = None
        for texts in batches:
            counts, out, held = [], [], 0
            for at in range(0, len(texts), ROWS):
                for t in texts.slice(at, ROWS).to_pylist():
                    one = _Tokens(t)
                    if counts and held + len(one.data) > SLICE_BYTES:
                        yield rows(counts, out)
                        counts, out, held = [], [], 0
                    before = one.listed(ws, least, before)
                    counts.append(one.n)
                    out += before.sorted
                    held += len(one.data)
            yield rows(counts, out)
    return lists(F.col(text) if isinstance(text, str) else text)
