"""Sorted digests of all windows of a text, by one Arrow UDF.

The digests are those of ``text.shingle_hashes`` (MD5 over length-prefixed
tokens).  The built-in expression builds an array of ``w`` strings and joins it
for every window; here a text's tokens are written behind one another once and a
window is a slice of those bytes.

Texts that follow one another in a task, or stand in one row, are often versions
of a page.  Windows that lie in the tokens that a text shares with the one before
it, at its start or at its end, have the digests that are known from there; only
those between are hashed.  Whatever the order of rows is, the result is the same.
"""

from __future__ import annotations

import binascii
import functools
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

try:  # the interpreter's own MD5 starts a digest in less time than the C library's
    from _md5 import md5
except ImportError:
    md5 = functools.partial(hashlib.md5, usedforsecurity=False)

#: Bytes of tokens (or one longer text) whose digests are handed back together.
SLICE_BYTES = 1 << 20


def _same_start(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries two arrays share."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class _Text:
    """A text's encoded tokens and, for each w, the digests of its windows in order."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        self.data, self.sizes, self.found, self.sorted = data, sizes, {}, []

    def shared(self, other: _Text) -> tuple[int, int]:
        """How many tokens at the start and at the end are those of ``other``."""
        first = int(np.searchsorted(np.cumsum(self.sizes), _same_start(self.data, other.data), side="right"))
        back = self.sizes[::-1][:_same_start(self.sizes[::-1], other.sizes[::-1])]
        return first, int(np.searchsorted(np.cumsum(back), _same_start(self.data[::-1], other.data[::-1]), side="right"))

    def hashed(self, ws: Sequence[int], least: int | None, starts: int | None, near: list[_Text]) -> _Text:
        """The text with its lists; what it shares with one of ``near`` is taken from there."""
        alike = [(self.shared(x), x) for x in near]
        (first, last), other = max(alike, key=lambda s: sum(s[0]), default=((0, 0), None))
        if other is not None and first == len(self.sizes) == len(other.sizes):
            return other
        at, raw = [0, *np.cumsum(self.sizes).tolist()], self.data.tobytes()
        for w in ws:
            n = max(len(self.sizes) - w + 1, 0)
            kept = n if starts is None else min(n, starts)
            old = other.found[w] if other else np.empty((0, 16), np.uint8)
            # the ends of lists that go on in the next chunk are not the ends of the texts
            whole = kept == n and other is not None and len(old) == max(len(other.sizes) - w + 1, 0)
            head = min(max(first - w + 1, 0), kept)
            tail = min(max(last - w + 1, 0), kept - head) if whole else 0
            end = kept - tail
            new = b"".join([md5(raw[i:j]).digest() for i, j in zip(at[head:end], at[head + w:end + w])])
            self.found[w] = np.concatenate([old[:head], np.frombuffer(new, np.uint8).reshape(-1, 16), old[len(old) - tail:]])
            self.sorted.append(_in_order(self.found[w])[:least])
        return self


def _in_order(digests: np.ndarray) -> np.ndarray:
    """Rows of 16 bytes, ascending."""
    halves = digests.view(">u8")
    high, low = halves[:, 0].astype(np.uint64), halves[:, 1].astype(np.uint64)
    order = np.argsort(high)
    high, behind = high[order], low[order]
    if ((high[1:] == high[:-1]) & (behind[1:] < behind[:-1])).any():
        order = np.lexsort((low, halves[:, 0].astype(np.uint64)))
    return digests[order]


def _texts(tokens: pa.Array) -> list[_Text]:
    """The rows' tokens one behind the other, each with its length before it (a null row has none)."""
    flat = tokens.flatten().cast(pa.large_binary())
    count = np.concatenate([[0], np.cumsum(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    sizes = np.diff(ends) + 4
    data = np.empty(int(sizes.sum()), np.uint8)
    prefix = (np.cumsum(sizes) - sizes)[:, None] + np.arange(4)
    data[prefix] = (sizes - 4).astype(">u4").view(np.uint8).reshape(-1, 4)
    body = np.ones(len(data), bool)
    body[prefix] = False
    if len(data):
        data[body] = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    at = np.concatenate([[0], np.cumsum(sizes)])[count].tolist()
    return [_Text(data[at[r]:at[r + 1]], sizes[count[r]:count[r + 1]]) for r in range(len(tokens))]


def _nested(lists: list[np.ndarray], width: int) -> pa.Array:
    """array<array<string>> of digests in hex, ``width`` lists a row."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    hexed = binascii.hexlify(b"".join(x.tobytes() for x in lists))
    places = np.arange(0, 32 * int(ends[-1]) + 1, 32, dtype=np.int64)
    strings = pa.LargeStringArray.from_buffers(int(ends[-1]), pa.py_buffer(places), pa.py_buffer(hexed)).cast(pa.string())
    inner = pa.ListArray.from_arrays(pa.array(ends), strings)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(lists) + 1, width, dtype=np.int32)), inner)


def _repeats(lists: list[np.ndarray], width: int) -> pa.Array:
    """array<array<int>>: the places (from 1) of the digests that are those before them."""
    places = []
    for x in lists:
        both = x.view(np.uint64)
        places.append(np.flatnonzero((both[1:] == both[:-1]).all(axis=1)).astype(np.int32) + np.int32(2))
    ends = np.concatenate([[0], np.cumsum([len(x) for x in places])]).astype(np.int32)
    inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*places, np.empty(0, np.int32)])))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(lists) + 1, width, dtype=np.int32)), inner)


def digest_lists(*tokens, ws: Iterable[int], least: int | None = None, starts: int | None = None) -> Column:
    """array<array<string>>: for each column of tokens and each w the sorted digests of all windows, copies kept.

    ``least``: only so many least digests of each list leave the worker, which is
    all that a sketch of that size needs.  ``starts``: only windows that start at
    one of the first so many tokens (those behind belong to the next chunk).
    """
    ws = tuple(int(w) for w in ws)

    @F.arrow_udf("array<array<string>>")
    def lists(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        before: list[_Text] = []
        for columns in batches:
            texts = [_texts(c) for c in (columns if isinstance(columns, tuple) else (columns,))]  # one column comes alone
            sizes = sum(np.array([len(t.data) for t in of]) for of in texts).cumsum()
            row = 0
            while row < len(sizes) or not len(sizes):
                end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + SLICE_BYTES, side="right")))
                out = []
                for same_row in zip(*[of[row:end] for of in texts]):
                    done: list[_Text] = []
                    for i, text in enumerate(same_row):
                        done.append(text.hashed(ws, least, starts, before[i:i + 1] + done[i - 1:i]))
                        out += done[i].sorted
                    before = done
                yield _nested(out, len(ws) * len(texts))
                row = end
                if not len(sizes):
                    break
    return lists(*[F.col(t) if isinstance(t, str) else t for t in tokens])


def _cut(digests: np.ndarray, n_runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted digests once each, their copies, the runs that have some and how many of them each has."""
    both = digests.view(np.uint64)
    firsts = np.flatnonzero(np.concatenate([[True], (both[1:] != both[:-1]).any(axis=1)])[:len(digests)])
    once = digests[firsts]
    leading = once[:, :4].copy().view(">u4")[:, 0].astype(np.uint64)
    runs, sizes = np.unique((leading * np.uint64(n_runs)) >> np.uint64(32), return_counts=True)
    return once, np.diff(np.append(firsts, len(digests))), runs, sizes


def digest_runs(tokens, n_tokens, ws: Iterable[int], run_digests: int, starts: int) -> Column:
    """array<struct<w, run, shingles, copies>>: the sorted digests of a chunk of a text of
    ``n_tokens`` tokens, for each w and cut into the text's runs by digest range.

    ``shingles`` are different, ``copies`` is null where each is there once.  Of a text
    without windows of some w there is one run without shingles."""
    ws = tuple(int(w) for w in ws)

    @F.arrow_udf("array<struct<w: int, run: int, shingles: array<string>, copies: array<bigint>>>")
    def runs(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        before: list[_Text] = []
        for part, due in batches:
            texts, due = _texts(part), due.to_pylist()
            sizes = np.array([len(t.data) for t in texts], np.int64).cumsum()
            row = 0
            while row < len(texts) or not texts:
                end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + SLICE_BYTES, side="right")))
                of_w, of_run, lengths, lists, copies, plain, ends = [], [], [], [], [], [], [0]
                for text, n in zip(texts[row:end], due[row:end]):
                    text = text.hashed(ws, None, starts, before)
                    before = [text]
                    for w, found in zip(ws, text.sorted):
                        if not len(found):
                            at, ones = ([0], [True]) if n < w else ([], [])
                            held = [0] * len(at)
                        else:
                            once, times, at, held = _cut(found, max(-(-(n - w + 1) // run_digests), 1))
                            ones = (np.maximum.reduceat(times, np.cumsum(held) - held) == 1).tolist()
                            lists.append(once)
                            copies.append(times)
                        of_w += [w] * len(at)
                        of_run += [int(r) for r in at]
                        lengths += [int(k) for k in held]
                        plain += ones
                    ends.append(len(of_w))
                yield _run_rows(of_w, of_run, lengths, lists, copies, plain, ends)
                row = end
                if not texts:
                    break
    return runs(*[F.col(c) if isinstance(c, str) else c for c in (tokens, n_tokens)])


def _run_rows(of_w: list[int], of_run: list[int], lengths: list[int], lists: list[np.ndarray], copies: list[np.ndarray],
              plain: list[bool], ends: list[int]) -> pa.Array:
    shingles = _nested([np.concatenate([*lists, np.empty((0, 16), np.uint8)])], 1).flatten().flatten()
    at = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    times = pa.array(np.concatenate([*copies, np.empty(0, np.int64)]).astype(np.int64))
    rows = pa.StructArray.from_arrays([
        pa.array(of_w, pa.int32()), pa.array(of_run, pa.int32()), pa.ListArray.from_arrays(at, shingles),
        pa.ListArray.from_arrays(at, times, mask=pa.array(plain, pa.bool_()))], names=["w", "run", "shingles", "copies"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
