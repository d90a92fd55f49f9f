"""Whole texts to token ids, a batch at a time.

A byte-level BPE tokenizer splits text by a pattern before it merges, and no
match of that pattern runs from a non-white character into the space behind
it.  So a text's ids are those of its blocks, cut before each space that
follows a non-white character.  A coder gets a batch's distinct blocks once,
and the ids of the texts are gathered from them.  Nor does a match run from a
letter or digit into the marks behind it, so the library gets the stem that
blocks with other marks at their ends share once.  Texts in which a space
follows other white space go to the coder whole, as do those that hold the
string of one of the tokenizer's added tokens.
"""

from __future__ import annotations

import os
import re
import string

from .common import per_worker

#: Bytes of text (or one longer text) whose distinct blocks are encoded together.
SLICE_BYTES = 12 << 20
#: Ids (or those of one longer text) that are gathered together.
GATHERED = 1 << 20
#: Blocks that are joined into one text for the library.
JOINED = 500
#: Blocks whose ids a worker keeps, about.
KEPT_BLOCKS = 400_000
#: White space as any of the engines sees it, at the end (RE2 syntax).
WHITE_END = r"[\s\x{b}\p{Z}\x{85}\x{1c}-\x{1f}]$"
#: Marks that end a block; an apostrophe may belong to letters.
MARKS = re.escape("".join(c for c in string.punctuation if c != "'"))
#: A block that a match of the pattern ends in, before its last marks.
MARKED = f"(?s)^(?P<stem>.*[A-Za-z0-9])(?P<marks>[{MARKS}]+)$"
#: Texts that the library gets in one call.
TOGETHER = 8


class LibraryCoder:
    """A tokenizer file of the tokenizers library."""

    def __init__(self, path: str, special_as_text: bool):
        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        #: Strings that are ids of their own wherever they stand.
        self.added = [] if special_as_text else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        apart = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        #: Whether no token joins a letter or digit to a mark.
        self.cuts_marks = not any(re.search(f"[A-Za-z0-9][{MARKS}]", t) for t in vocab if t not in apart)
        self.opens = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids whose text begins with a space
        for token, i in vocab.items():
            self.opens[i] = token.startswith("\u0120")
        self.known = Known()

    def whole(self, texts: list[str]) -> list:
        import numpy as np

        return [np.array(e.ids, dtype=np.uint32) for at in range(0, len(texts), TOGETHER)  # what the library returns is large
                for e in self.tok.encode_batch_fast(texts[at:at + TOGETHER], add_special_tokens=False)]

    def behind_space(self, blocks):
        """(ids, lengths) of an Arrow array of blocks that each follow a space.  Those that
        end in no white space are joined: only their first tokens begin with a space."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        loose = pc.or_(pc.equal(blocks, ""), pc.match_substring_regex(blocks, WHITE_END))
        tight = blocks.filter(pc.invert(loose))
        cuts = np.append(np.arange(0, len(tight), JOINED), len(tight))
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), tight)
        joined = self.whole([" " + x for x in pc.binary_join(lists, pa.scalar(" ", tight.type)).to_pylist()])
        ids = np.concatenate([np.empty(0, np.uint32), *joined])
        lengths = np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids)))
        if len(lengths) != len(tight):
            raise ValueError("the tokenizer merges across spaces; it is not a byte-level BPE of this kind")
        if len(tight) == len(blocks):
            return ids, lengths
        apart = self.whole([" " + b for b in blocks.filter(loose).to_pylist()])
        ids = np.concatenate([ids, *apart])
        lengths = np.concatenate([lengths, np.array([len(p) for p in apart], dtype=np.int64)])
        which = np.argsort(np.argsort(loose.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return gather(ids, lengths, which), lengths[which]


def library_coder(path: str, special_as_text: bool = False) -> LibraryCoder:
    """The coder of a file, one for each worker process."""
    return per_worker(("library", path, special_as_text), lambda: LibraryCoder(path, special_as_text))


class Known:
    """Blocks whose ids are known, as arrays; the blocks of the last slice stay
    when there are too many."""

    def __init__(self):
        import numpy as np
        import pyarrow as pa

        self.blocks, self.ids, self.lengths = pa.array([], pa.large_string()), np.empty(0, np.uint32), np.empty(0, np.int64)

    def places(self, blocks, coder):
        """Numbers of distinct blocks; those that are new are encoded and added."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        place = pc.index_in(blocks, value_set=self.blocks)
        new = blocks.filter(place.is_null())
        place = place.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.blocks) + np.arange(len(new))
        ids, lengths = coder.behind_space(new)
        self.blocks = pa.concat_arrays([self.blocks, new])
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        if len(self.blocks) > KEPT_BLOCKS:
            self.blocks, self.ids, self.lengths = blocks, self.gathered(place), self.lengths[place]
            place = np.arange(len(blocks))
        return place

    def gathered(self, which):
        return gather(self.ids, self.lengths, which)


def gather(ids, lengths, which):
    """The runs of ``ids`` that ``which`` names, one after the other."""
    import numpy as np

    starts, n = np.cumsum(lengths) - lengths, lengths[which]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    at += np.repeat(starts[which] - (ends - n), n)
    return ids[at]


def behind_space(blocks, coder):
    """(ids, lengths) of distinct blocks that each follow a space."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    known = coder.known
    marked = pc.match_substring_regex(blocks, f"[A-Za-z0-9][{MARKS}]+$") if coder.cuts_marks else pa.array(np.zeros(len(blocks), bool))
    parts = pc.extract_regex(blocks.filter(marked), MARKED)
    if not len(parts):
        place = known.places(blocks, coder)
        return known.gathered(place), known.lengths[place]
    stems = pc.replace_with_mask(blocks, marked, parts.field("stem")).dictionary_encode()
    marks = parts.field("marks").dictionary_encode()
    behind = coder.whole(marks.dictionary.to_pylist())
    place = np.zeros((len(blocks), 2), dtype=np.int64)  # of the stem, of the marks (the first: none)
    place[:, 0] = known.places(stems.dictionary, coder)[stems.indices.to_numpy()]
    place[marked.to_numpy(zero_copy_only=False), 1] = 1 + marks.indices.to_numpy()
    place[:, 1] += len(known.lengths)
    ids = np.concatenate([known.ids, *behind])
    lengths = np.concatenate([known.lengths, np.array([0, *map(len, behind)], dtype=np.int64)])
    return gather(ids, lengths, place.ravel()), lengths[place].sum(axis=1)


def _encode(texts, coder):
    """Runs of rows of an Arrow array of texts without nulls, as (ids, offsets)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.split_pattern(texts, " ")
    at = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(at[0], at[-1] - at[0])
    at -= at[0]
    distinct = flat.dictionary_encode()
    words, which = distinct.dictionary, distinct.indices.to_numpy()
    first = np.zeros(len(flat), dtype=bool)
    first[at[:-1]] = True

    # white space (as any engine sees it) before a space inside a text
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    white = pc.match_substring_regex(words, WHITE_END).to_numpy(zero_copy_only=False)
    before = white[which] | empty[which] & ~first
    before[at[1:] - 1] = False
    loose = np.add.reduceat(before, at[:-1], dtype=np.int64) > 0
    for token in coder.added:
        loose |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    if loose.any():  # those whole, the others by blocks
        mask, row = pa.array(loose), 0
        whole = iter(coder.whole(texts.filter(mask).to_pylist()))
        for ids, offsets in _encode(pc.if_else(mask, pa.scalar("", texts.type), texts), coder):
            lists = [next(whole) if x else ids[i:j] for x, i, j in zip(loose[row:], offsets[:-1], offsets[1:])]
            yield np.concatenate(lists), np.cumsum([0, *map(len, lists)])
            row += len(lists)
        return

    used = np.zeros(len(words), dtype=bool)  # behind a space
    used[which[~first]] = True
    ids, n = behind_space(words.filter(pa.array(used)), coder)
    heads = coder.whole(flat.filter(pa.array(first)).to_pylist())
    which = which.astype(np.int64)
    which[first] = len(words) + np.arange(len(heads))
    lengths = np.zeros(len(words) + len(heads), dtype=np.int64)
    lengths[:len(words)][used] = n
    lengths[len(words):] = [len(h) for h in heads]
    ids = np.concatenate([ids, *heads])
    ends = np.concatenate([[0], np.cumsum(lengths[which])])[at]  # of rows
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + GATHERED, side="right")) - 1)
        yield gather(ids, lengths, which[at[row]:at[end]]), ends[row:end + 1] - ends[row]
        row = end


def encode_texts(texts, coder):
    """Runs of rows of an Arrow string array (nulls count as empty): yields
    (first row, uint32 ids, int64 offsets of the run's rows)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = size[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        part = pc.cast(pc.fill_null(texts.slice(row, end - row), ""), pa.large_string())
        for ids, offsets in _encode(part, coder):
            yield row, ids, offsets
            row += len(offsets) - 1
