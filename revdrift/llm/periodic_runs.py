"""Periodic runs of words: stretches that repeat one period at least twice.

Each run has a root that is the longest Lyndon word at its place under the
rising or the falling order of words, so two candidates a place are enough: its
suffix is compared with the one a period further on, and the words before them
backwards, by longest common extensions in the suffix trees of the text and of
its reversal.

The trees stand only where a run can be.  A run of 12 words or more with period
q agrees with itself q words on in max(q, 12 - q) >= 6 neighbouring places, and
these cover it whole together with their repeats.  So it lies in a stretch that
is covered by six-word sequences which occur twice in it; everything else is
passed over by counting, which loses nothing at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffix_tree import Tree
from .wordgrams import SLICE_BYTES

#: Words of a run, at least.
LEAST = 12
#: Times that the stretches are narrowed before trees are built (any number gives the same runs).
ROUNDS = 4


def _lyndon(rank):
    """Lengths of the longest Lyndon words at each place, from the suffixes' ranks."""
    import numpy as np

    ranks = rank.tolist()
    n = len(ranks)
    smaller, path = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = ranks[i]
        while path and ranks[path[-1]] > r:
            path.pop()
        if path:
            smaller[i] = path[-1]
        path.append(i)
    return np.array(smaller, dtype=np.int64) - np.arange(n)


def runs_of(symbols, least: int = LEAST):
    """[start, length, period] of the runs of an array of numbers from 0 on, by start, then period."""
    import numpy as np

    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), dtype=np.int64)
    symbols = np.unique(symbols, return_inverse=True)[1] + 1
    forth = Tree(symbols)
    at = np.arange(n)
    i, p = [], []
    for falling in (False, True):
        length = _lyndon(forth.ranks(falling)[:n])
        inside = at + length < n
        i.append(at[inside])
        p.append(length[inside])
    i, p = np.divmod(np.unique(np.concatenate(i) * n + np.concatenate(p)), n)  # p < n
    right = forth.extension(i, i + p)
    del forth
    back = Tree(symbols[::-1])
    left = np.zeros(len(i), dtype=np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = back.extension(n - i[inner], n - i[inner] - p[inner])
    start, length = i - left, p + left + right
    found = (length >= 2 * p) & (length >= least)
    key, first = np.unique(start[found] * n + p[found], return_index=True)
    return np.column_stack([key // n, length[found][first], key % n])


def _stretches(words, doc, sequence: int):
    """Numbers of the stretches that words lie in, -1 for words outside; stretches
    are covered by sequences of so many words that occur twice in them."""
    import numpy as np

    inside, own = np.ones(len(words), dtype=bool), doc.astype(np.int64)
    for _ in range(ROUNDS):
        at = np.flatnonzero(inside)
        if len(at) < sequence:
            return np.full(len(words), -1)
        w, o = words[at].astype(np.uint64), own[at]
        last = len(at) - sequence + 1
        # neighbours in ``at`` of one stretch are neighbours in the text
        whole = np.flatnonzero(o[:last] == o[sequence - 1:])
        key = o[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(sequence):
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + w[whole + k]
        key ^= key >> np.uint64(32)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(order), dtype=bool)
        twice[:-1] |= same
        twice[1:] |= same
        steps = np.zeros(len(at) + 1, dtype=np.int64)
        hit = whole[order[twice]]
        np.add.at(steps, hit, 1)
        np.subtract.at(steps, hit + sequence, 1)
        covered = np.cumsum(steps[:-1]) > 0
        kept = at[covered]
        fresh = np.full(len(words), -1)
        if len(kept):
            o = o[covered]
            fresh[kept] = np.cumsum(np.append(True, (kept[1:] != kept[:-1] + 1) | (o[1:] != o[:-1]))) - 1
        if len(kept) == len(at) and (np.diff(fresh[kept]) == np.diff(own[kept])).all():
            break
        inside, own = fresh >= 0, fresh
    return fresh


def runs_in(words, doc, least: int = LEAST):
    """[document, start in ``words``, length, period] of all runs of documents that lie one behind the other."""
    import numpy as np

    sequence = -(-least // 2)
    stretch = _stretches(words, doc, sequence)
    at = np.flatnonzero(stretch >= 0)
    found = [np.empty((0, 4), dtype=np.int64)]
    for part in np.split(at, np.flatnonzero(np.diff(stretch[at])) + 1) if len(at) else []:
        if len(part) >= least:
            got = runs_of(words[part], least)
            if len(got):
                found.append(np.column_stack([np.full(len(got), doc[part[0]]), got[:, 0] + part[0], got[:, 1:]]))
    return np.concatenate(found)


def _slices(texts):
    """Runs of rows of an Arrow string array: (first row, words as numbers, their documents, the words, rows)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = size[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        part = pc.cast(pc.fill_null(texts.take(pa.array(np.arange(row, end))), ""), pa.large_string())
        split = pc.ascii_split_whitespace(part)
        at = split.offsets.to_numpy().astype(np.int64)
        flat = split.values.slice(at[0], at[-1] - at[0])
        full = np.flatnonzero(pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0)
        flat = flat.take(pa.array(full))
        doc = np.repeat(np.arange(end - row), np.diff(at))[full]
        yield row, flat.dictionary_encode().indices.to_numpy(), doc, flat, end - row
        row = end


def _found(least: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            for row, words, doc, flat, n in _slices(b.column(1)):
                count = np.bincount(doc, minlength=n)
                begins = np.cumsum(count) - count
                runs = runs_in(words, doc, least)
                dropped = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(dropped, runs[:, 1] + runs[:, 3], 1)
                np.subtract.at(dropped, runs[:, 1] + runs[:, 2], 1)
                kept = np.cumsum(dropped[:-1]) == 0
                left = np.append(0, np.cumsum(np.bincount(doc[kept], minlength=n)))
                collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), flat.filter(pa.array(kept))), pa.scalar(" ", pa.large_string()))
                runs[:, 1] -= begins[runs[:, 0]]
                fields = [pa.array(runs[:, k]) for k in (1, 2, 3)]
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(n + 1)).astype(np.int32)),
                                                 pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, n), pa.array(count), lists, pc.cast(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row for each row of ``docs``: [doc_id, n_words, runs, collapsed].

    Words are runs of other characters than ASCII white space, as they are.
    ``runs`` lists [start, length, period] (in words, from 0) by start, then
    period: each stretch with that smallest period which is at least ``least``
    words and two periods long and which neither neighbouring word continues.
    ``collapsed`` is the text's words, joined by one space, without those that
    any run contains behind its first period.

    Null and empty texts and texts without words have no runs and collapse to
    an empty text.  Rows that share an id, null ids and repeated rows are worked
    off one by one.  Other columns are ignored; an empty table gives no rows.
    No shuffle: a text is worked off whole by one task, in memory in proportion
    to its words (texts are taken some 4 MB at a time, a longer one alone).
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_found(least), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
