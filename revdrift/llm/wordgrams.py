"""Words of whole texts as numbers, a batch at a time, for hashed features."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

#: Bytes of text (or one longer text) whose words are looked up together.
SLICE_BYTES = 4 << 20

_RUNS = re.compile("A+|a+|0+|(.)\\1+", re.S)


def number(text: str, salt: int = 0) -> int:
    """A stable number of a string."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), salt)


def shape(word: str) -> str:
    """The word with letters and digits by class and runs as one character."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word[0].isupper() and word[1:].islower():
            return "Aa"
    classes = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(lambda m: m[0][0], classes)


def mixed(x, salt: int, size: int):
    """Numbers to features below ``size - 1``."""
    import numpy as np

    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(32)) % np.uint64(size - 1)).astype(np.int64)


def slices(texts, make: Callable[[str], tuple[int, ...]], width: int, ascii_only: bool = False):
    """Runs of rows of an Arrow string array (nulls count as empty): yields
    (first row, document of each word, uint64 array words x width, rows) with
    the ``width`` numbers that ``make`` gives each distinct word.
    ``ascii_only``: A to Z are lowered, and only ASCII white space parts words."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = size[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        # taken, not sliced: ascii_lower() misreads an array whose bytes do not begin at 0
        part = pc.cast(pc.fill_null(texts.take(pa.array(np.arange(row, end))), ""), pa.large_string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(part)) if ascii_only else pc.utf8_split_whitespace(part)
        at = split.offsets.to_numpy().astype(np.int64)
        flat = split.values.slice(at[0], at[-1] - at[0])
        doc = np.repeat(np.arange(end - row), np.diff(at))
        distinct = flat.dictionary_encode()
        words = distinct.dictionary.to_pylist()
        numbers = np.array([make(w) for w in words], dtype=np.uint64).reshape(len(words), width)
        index = distinct.indices.to_numpy()
        full = np.array([bool(w) for w in words], dtype=bool)[index]
        yield row, doc[full], numbers[index[full]], end - row
        row = end


def distinct_features(families, n_docs: int, size: int):
    """(documents, features) of each document without repeats, by document.

    ``families``: pairs of arrays (documents ascending, features < ``size``).
    Works with a table of ``size`` flags for each of a few documents at a time."""
    import numpy as np

    docs, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    each = max(1, (16 << 20) // size)
    edges = np.arange(0, n_docs + each, each)
    at = [np.searchsorted(d, edges) for d, _ in families]
    flags = np.zeros(each * size, dtype=bool)
    for k in range(len(edges) - 1):
        for (d, f), a in zip(families, at):
            i, j = a[k], a[k + 1]
            flags[(d[i:j] - k * each) * size + f[i:j]] = True
        hit = np.flatnonzero(flags)
        flags[hit] = False
        docs.append(hit // size + k * each)
        found.append(hit % size)
    return np.concatenate(docs), np.concatenate(found)
