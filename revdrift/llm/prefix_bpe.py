"""Byte-level BPE by prefix dynamic programming.

The encoding of every prefix of a byte string ends in exactly one token, and a
token can end the prefix of length i only if it may follow the last token of
the prefix in front of it, that is if those two tokens are what their joined
bytes encode to.  Storing that last token for each prefix gives the encoding of
all prefixes at once: appended bytes extend the table, and an edit recomputes
it only until the old entries hold again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Known, encode_texts
from .common import per_worker

#: Pieces after which the kept ids become the old generation, which goes when the next is full.
KEPT_PIECES = 300_000
#: Pairs of tokens whose order a worker keeps.
KEPT_PAIRS = 1_000_000


class PrefixBpe:
    """Encoder and decoder for the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.backwards: dict = {}  # byte before -> the same, with the token at -1
        for b, token in ranks.items():
            node = self.backwards
            for x in reversed(b):
                node = node.setdefault(x, {})
            node[-1] = token
        self.known: dict[int, bool] = {}  # may a token follow another, or begin
        self.coders: dict[str, _Coder] = {}  # by splitting pattern

    def merged(self, data: bytes) -> list[int]:
        """The definition, for a few bytes: merge the neighbours of lowest rank."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _may(self, key: int, before: int, token: int) -> bool:
        tokens = [token] if before < 0 else [before, token]
        may = self.merged(self.decode(tokens)) == tokens
        if len(self.known) >= KEPT_PAIRS:
            self.known.clear()
        self.known[key] = may
        return may

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Fill ``last`` (last token of each prefix, entry 0 unused) up to ``end``."""
        root, known = self.backwards, self.known
        for i in range(len(last), end + 1):
            node, j, ends = root, i, []
            while j and (node := node.get(data[j - 1])) is not None:
                j -= 1
                if -1 in node:
                    ends.append((j, node[-1]))
            while ends:
                j, token = ends.pop()
                key = last[j] * 0x100000000 + token
                may = known.get(key)
                if may is None:
                    may = self._may(key, last[j], token)
                if may:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token for byte {data[i - 1]}")

    def walk(self, last: list[int]) -> list[int]:
        """Tokens of the longest prefix."""
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """One match of the splitting pattern; a match that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        last = [-1]
        self.extend(piece, last, len(piece))
        return self.walk(last)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Prefixes:
    """The encoding of a byte string that grows and changes."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of [start, stop); returns how many entries were computed."""
        old, self.data = self.last[stop:], self.data[:start] + new + self.data[stop:]
        self.last = self.last[:start + 1]
        self.bpe.extend(self.data, self.last, start + len(new))
        same, computed = 0, len(new)
        for k in range(1, len(old)):
            self.bpe.extend(self.data, self.last, start + len(new) + k)
            computed += 1
            same = same + 1 if self.last[-1] == old[k] else 0
            if same >= self.bpe.longest:  # all that later entries can look at
                self.last += old[k + 1:]
                break
        return computed

    def ids(self, length: int | None = None) -> list[int]:
        """Of the whole string, or of a prefix."""
        return self.bpe.walk(self.last if length is None else self.last[:length + 1])


def load(ranks_path: str) -> PrefixBpe:
    """The coder of a file of base64 tokens and ranks, one for each worker."""
    def build():
        with open(ranks_path, "rb") as f:
            return PrefixBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    return per_worker(("prefix_bpe", ranks_path), build)


class _Coder:
    """Ids of blocks of text: matches of the pattern, each encoded on its own."""

    #: A word behind a space and marks behind it: two matches of the pattern, or one.
    WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?|#&*%$]*)")

    def __init__(self, bpe: PrefixBpe, pattern: str):
        import regex

        self.bpe, self.find = bpe, regex.compile(pattern).findall
        self.known, self.added = Known(), []
        self.cuts_marks = False  # done by _pieces
        self.young: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}

    def _pieces(self, block: str) -> list[bytes]:
        if m := self.WORD.fullmatch(block):
            word, marks = m.groups()
            return [(" " + word).encode(), marks.encode()] if marks else [(" " + word).encode()]
        return [m.encode() for m in self.find(" " + block)]

    def _learn(self, pieces: set[bytes]) -> None:
        """Encode pieces that are not kept, in order: each one's table goes on
        from the prefix that it shares with the one before."""
        new = []
        for p in pieces:
            if p not in self.young:
                ids = self.old.get(p)
                if ids is None:
                    new.append(p)
                else:
                    self.young[p] = ids
        before, last = b"", [-1]
        for p in sorted(new):
            whole = self.bpe.ranks.get(p)
            if whole is not None:
                self.young[p] = [whole]
                continue
            same = 0
            for x, y in zip(before, p):
                if x != y:
                    break
                same += 1
            del last[same + 1:]
            self.bpe.extend(p, last, len(p))
            self.young[p] = self.bpe.walk(last)
            before = p

    def _forget(self) -> None:
        if len(self.young) >= KEPT_PIECES:
            self.old, self.young = self.young, {}

    def whole(self, texts: list[str]) -> list:
        import numpy as np

        out = []
        for t in texts:
            pieces = [m.encode() for m in self.find(t)]
            self._learn(set(pieces))
            out.append(np.array([i for p in pieces for i in self.young[p]], dtype=np.uint32))
            self._forget()
        return out

    def behind_space(self, blocks):
        import numpy as np

        of = list(map(self._pieces, blocks.to_pylist()))
        self._learn(set(chain.from_iterable(of)))
        ids = [self.young[ps[0]] if len(ps) == 1 else [i for p in ps for i in self.young[p]] for ps in of]
        self._forget()
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(lengths.sum())), lengths


def encode_batches(ranks_path: str, pattern: str):
    """Batches of [doc_id, text] -> batches of [doc_id, ids]."""
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe = load(ranks_path)
        if pattern not in bpe.coders:
            bpe.coders[pattern] = _Coder(bpe, pattern)
        coder = bpe.coders[pattern]
        for b in batches:
            for row, ids, offsets in encode_texts(b.column(1), coder):
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(lists)), lists], names=["doc_id", "ids"])
    return run


def decode_batches(ranks_path: str):
    """Batches with ``ids`` -> the same with ``decoded``, their bytes."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        decode = load(ranks_path).decode
        for b in batches:
            ids = b.column("ids")
            decoded = [decode(one.tolist()) for one in _rows(ids)]
            yield b.append_column("decoded", pa.array(decoded, pa.binary()))
    return run


def _rows(lists):
    """The rows of an Arrow list array as numpy arrays."""
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    return [values[i:j] for i, j in zip(at[:-1], at[1:])]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[doc_id, ids] for each row: the ids of the whole text without special tokens.

    A null text counts as empty and has no ids.  Rows with null, equal or
    repeated ids are encoded one by one; other columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode_batches(ranks_path, pattern), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """``tokens`` [doc_id, ids] with ``decoded``, the bytes of the ids."""
    return tokens.select("doc_id", "ids").mapInArrow(decode_batches(ranks_path), "doc_id long, ids array<int>, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """[doc_id, n_tokens, ids_sha256, decoded_sha256]: encode(), decode() and
    the digests in one pass over the rows."""
    coder, back = encode_batches(ranks_path, pattern), decode_batches(ranks_path)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in back(coder(batches)):
            ids = _rows(b.column("ids"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x.astype(np.dtype("<u4")).tobytes()).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in b.column("decoded").to_pylist()], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
