"""Toxicity: noisy-channel restoring of disguised words, then a score.

A disguised word is a character lattice: a digit or sign may stand for letters
(leetspeak), marks or spaces may stand between letters, and a letter may be
repeated.  The Viterbi path of least cost under a character trigram model,
counted over all documents, is the restored word.  A run of spelt letters is one
lattice, in which each space is left out or parts two words; there the corpus's
common words have costs of their own.  A doubled letter is left out where that
makes an unknown word a common one.  The score is a logistic
regression on the distinct words of the restored text and their beginnings.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_left
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classifier import Classifier
from .common import bounded_batches, forget, per_worker, then_forget, written
from .language import LETTERS, _groups, _ngrams, _tables
from .wordgrams import SLICE_BYTES, distinct_features, mixed, number, slices

SIZE = 1 << 18

#: Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: Costs of the channel, in nats: a sign for a letter, the first and each
#: further repeated letter left out, a mark left out, a sign left out.
COST_SIGN, COST_REPEAT, COST_MORE, COST_MARK, COST_DROP = 1.0, 3.0, 0.2, 0.5, 12.0
#: Costs of a space between spelt letters that parts words, and of a letter of
#: a spelt run that is a word, at most (a corpus may lack 'I').
COST_SPACE, COST_ALONE = 2.0, 3.0
#: Cost of a plain word being disguised by doubled letters alone (most doubles are meant).
COST_PLAIN = 7.0
#: Letters of a run of single letters that are read as spelt words.
SPELT = 3
#: A word is common from this share of all words on: at any size, there are
#: 1 / share of them at most.
COMMON = 2e-6

_ENDS = re.compile(r"^[^\w@$|+(€£¡]+|[^\w@$|+(€£¡]+$")
_RUN_AT_END = re.compile(r"([@$|+(€£¡])\1\1+$")
_TWO, _THREE = re.compile(r"(.)\1", re.S), re.compile(r"(.)\1\1", re.S)


def is_spelt(run: list[str]) -> bool:
    """Are these words of one character spelt words (marks may stand between the letters)?"""
    return sum(w.isalpha() or w in SIGNS for w in run) >= SPELT


class Restorer:
    """Viterbi decoding under trigram costs (-log P(c | a, b), flat)."""

    def __init__(self, costs: bytes):
        import numpy as np

        end = 4 * LETTERS ** 3
        self.costs = np.frombuffer(costs[:end], dtype=np.float32).tolist()
        common = [line.split(":") for line in costs[end:].decode().split()]
        total = sum(int(n) for _, n in common)
        self.common = {w: math.log(total / int(n)) for w, n in common}
        self.sorted = sorted(self.common)
        self.letter = _tables()[0]
        self.known: dict[str, str] = {}

    def core(self, word: str) -> str:
        """Lower case, compatible forms, without marks at the ends."""
        if not (word.isascii() and word.isalpha()):
            if not word.isascii():
                word = unicodedata.normalize("NFKC", word)
            word = _RUN_AT_END.sub("", _ENDS.sub("", word))
        return word.lower()

    def word(self, word: str) -> str:
        """A word as it was meant; other words in lower case without marks."""
        core = self.core(word)
        if core.isalpha():
            if not _THREE.search(core):
                return self.undoubled(core) if _TWO.search(core) and core not in self.common else core
        elif not any(c.isalpha() for c in core) or core.isdigit():
            return core
        return self.decoded(core)

    def begins(self, text: str) -> bool:
        """Does a common word begin so?"""
        at = bisect_left(self.sorted, text)
        return at < len(self.sorted) and self.sorted[at].startswith(text)

    def undoubled(self, word: str) -> str:
        """The word, or the common word that it is with letters repeated if that is cheaper."""
        best, last = {"": 0.0}, ""
        for x in word:
            after = {}
            for text, cost in best.items():
                if self.begins(text + x):
                    after[text + x] = min(cost, after.get(text + x, cost))
                if x == last:
                    after[text] = min(cost + COST_REPEAT, after.get(text, math.inf))
            best, last = after, x
        at = [0, 0, *(int(self.letter[ord(x)]) for x in word), 0]
        kept = sum(self.costs[(a * LETTERS + b) * LETTERS + c] for a, b, c in zip(at, at[1:], at[2:]))
        return min([(kept, word), *((cost + COST_PLAIN + self.common[text], text) for text, cost in best.items() if text in self.common)])[1]

    def decoded(self, raw: str) -> str:
        if raw not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[raw] = self._viterbi(raw)
        return self.known[raw]

    def _viterbi(self, raw: str) -> str:
        # a state is (letter before, last letter, are we leaving out a run); a path is (path before, letter)
        best = {(0, 0, False): (0.0, None)}
        costs, letter = self.costs, self.letter
        # in a spelt run: (beginning of a common word, are we leaving out a run) with the path before the word
        walks: dict[tuple, tuple[float, object]] = {}
        last, spelt = "", " " in raw

        def ends():
            for (a, b, _), (cost, text) in best.items():
                end = costs[(a * LETTERS + b) * LETTERS]
                yield cost + (min(end, COST_ALONE) if spelt and b and not a else end), text, bool(b)
            for (word, _), (cost, text) in walks.items():
                if word in self.common:
                    yield cost + self.common[word], (text, word), True

        for x in raw:
            if x == " ":
                cost, text, _ = min((e for e in ends() if e[2]), key=itemgetter(0), default=(math.inf, None, True))
                if cost + COST_SPACE < best.get((0, 0, False), (math.inf,))[0]:
                    best[0, 0, False] = (cost + COST_SPACE, (text, x))
                continue
            repeats, last = last == x, x
            options = [(x, 0.0)] if x.isalpha() else [(y, COST_SIGN) for y in SIGNS.get(x, "")]
            after: dict[tuple, tuple[float, str]] = {}

            def put(state, cost, text):
                if state not in after or cost < after[state][0]:
                    after[state] = (cost, text)

            for (a, b, out), (cost, text) in best.items():
                for y, more in options:
                    c = int(letter[ord(y)]) if len(y) == 1 else 0
                    put((b, c, False), cost + more + costs[(a * LETTERS + b) * LETTERS + c], (text, y))
                if repeats and b:
                    put((a, b, True), cost + (COST_MORE if out else COST_REPEAT), text)
                if not x.isalpha():
                    put((a, b, out), cost + (COST_DROP if x in SIGNS or x.isalnum() else COST_MARK), text)
            if spelt:
                if (0, 0, False) in best:
                    walks["", False] = best[0, 0, False]
                best, after = after, {}
                for (word, out), (cost, text) in walks.items():
                    for y, more in options:
                        if self.begins(word + y):
                            put((word + y, False), cost + more, text)
                    if repeats and word:
                        put((word, True), cost + (COST_MORE if out else COST_REPEAT), text)
                    if not x.isalpha() and word:
                        put((word, out), cost + (COST_DROP if x in SIGNS or x.isalnum() else COST_MARK), text)
                walks = after
            else:
                best = after
        _, text, _ = min(ends(), key=itemgetter(0))
        letters = []
        while text:
            text, y = text
            letters.append(y)
        return "".join(reversed(letters)).strip()

    def alone(self, word: str) -> str:
        """A word of one character that is not of a spelt run."""
        return word if word.isalpha() or word in SIGNS else self.word(word)

    def text(self, text: str) -> str:
        """The restored words of a text, in lower case, with spelt words joined."""
        out, spelt = [], []
        for w in [*(text or "").split(), ""]:
            if len(w) == 1:
                spelt.append(w.lower())
                continue
            out += [self.decoded(" ".join(spelt))] if is_spelt(spelt) else map(self.alone, spelt)
            spelt = []
            if w:
                out.append(self.word(w))
        return " ".join(x for x in out if x)


def _counts(batches):
    """Batches of [doc_id, text] -> [code, n] of the task's letter trigrams."""
    import numpy as np
    import pyarrow as pa

    forget("language")  # the worker may be one of an earlier stage
    total = np.zeros(LETTERS ** 3, dtype=np.int64)
    for _, texts in _groups(batches, 2):
        _, code = _ngrams(texts)
        total += np.bincount(code, minlength=len(total))
    codes = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(total[codes])], names=["code", "n"])


def _words(batches):
    """[doc_id, text] -> [w, n]: the words of letters, parted as the scorer parts them, with their numbers."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    forget()
    for b in batches:
        texts = b.column(1)
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < len(texts):
            end = max(row + 1, int(np.searchsorted(size, (size[row - 1] if row else 0) + SLICE_BYTES, side="right")))
            part = pc.cast(texts.take(pa.array(np.arange(row, end))), pa.large_string())
            found = pc.utf8_split_whitespace(pc.utf8_lower(pc.drop_null(part))).flatten().value_counts()
            words, n = found.field(0), found.field(1)
            plain = pc.and_(pc.utf8_is_alpha(words), pc.greater(pc.utf8_length(words), 1))
            yield pa.RecordBatch.from_arrays([pc.cast(words.filter(plain), pa.string()), n.filter(plain)], names=["w", "n"])
            row = end


def common_words(rows: DataFrame, share: float = COMMON) -> list[tuple[str, int]]:
    """The words of letters that make up ``share`` or more of all of them in
    ``rows`` [doc_id, text], with their numbers, commonest first.

    All words of all rows are counted and written; only those of the share, which
    cannot be more than 1 / share, reach the driver."""
    counts = written(rows.mapInArrow(then_forget(_words), "w string, n long").groupBy("w").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return sorted(((r.w, r.n) for r in counts.filter(F.col("n") >= share * total).collect()), key=lambda x: (-x[1], x[0]))


def trigram_costs(docs: DataFrame, text_col: str = "text") -> bytes:
    """-log P(c | a, b) of letters, float32, and behind them the common words
    with their numbers, counted over all documents.

    The driver gets a count for each trigram, ``LETTERS`` cubed at most, and the
    common words.  Null and empty texts count nothing, repeated rows count each
    time, long texts are counted whole, other columns are ignored; an empty table
    gives equal costs and no words."""
    import numpy as np

    rows = bounded_batches(docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    got = rows.mapInArrow(_counts, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(LETTERS ** 3)
    for code, k in got:
        n[code] = k
    n = n.reshape(LETTERS, LETTERS, LETTERS)  # the middle is a letter; a word begins after (0, 0)
    n[0, 0] = n[0].sum(axis=1)
    back = (n.sum(axis=0) + 0.1) / (n.sum(axis=0).sum(axis=1, keepdims=True) + 0.1 * LETTERS)
    p = (n + 2 * back[None]) / (n.sum(axis=2, keepdims=True) + 2)
    costs = (-np.log(p)).astype(np.float32).tobytes()

    lines = "".join(f"{w}:{k}\n" for w, k in common_words(rows)).encode()
    return costs + lines.ljust((len(lines) + 3) // 4 * 4)


def restore(docs: DataFrame, costs: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[doc_id, restored] for each row; a null text is restored to an empty one.

    Repeated rows and ids and null ids are restored one by one, long texts whole;
    other columns are ignored, an empty table gives no rows."""
    held = docs.sparkSession.sparkContext.broadcast(costs)

    def run(batches):
        import pyarrow as pa

        r = Restorer(held.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.text(t) for t in b.column(1).to_pylist()], pa.string())],
                                             names=["doc_id", "restored"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, restored string")


def _of_word(word: str) -> tuple[int, int, int]:
    return number(word), number(word[:4], 4), number(word[:5], 5)


def features_of(held, key):
    """Features of restored texts, for the broadcast costs ``held`` known as ``key``."""
    def features(texts):
        import numpy as np

        forget(("restorer", key))
        r = per_worker(("restorer", key), lambda: Restorer(held.value))

        def make(w):
            single = len(w) == 1 and len(w.lower()) == 1
            return (*_of_word(r.alone(w.lower()) if single else r.word(w)), ord(w.lower()) if single else 0)

        for row, doc, words, n in slices(texts, make, 4):
            spelt = words[:, 3] > 0
            begins = np.flatnonzero(spelt & np.append(True, ~spelt[:-1] | (doc[1:] != doc[:-1])))
            ends = np.flatnonzero(spelt & np.append(~spelt[1:] | (doc[1:] != doc[:-1]), True)) + 1
            more, gone = [], np.zeros(len(doc), dtype=bool)
            for i, j in zip(begins.tolist(), ends.tolist()):
                run = [chr(c) for c in words[i:j, 3].tolist()] if j - i >= SPELT else []
                if is_spelt(run):
                    gone[i:j] = True
                    more += [(doc[i], *_of_word(w)) for w in r.decoded(" ".join(run)).split(" ")]
            kept = ~gone
            families = [(doc[kept], mixed(words[kept, k], k, SIZE)) for k in range(3)]
            if more:
                m = np.array(more, dtype=np.uint64).reshape(-1, 4)
                families += [(m[:, 0].astype(np.int64), mixed(m[:, k + 1], k, SIZE)) for k in range(3)]
            yield row, *distinct_features(families, n, SIZE), n
    return features


def toxicity(docs: DataFrame, text_col: str = "text") -> Classifier:
    """The classifier whose features restore text by the trigrams of ``docs``
    (1: toxic).

    Null and empty texts have no features.  Every row counts, also one that is
    repeated; texts of any length count and are scored whole; other columns are
    ignored.  An empty table gives a classifier without common words."""
    costs = trigram_costs(docs, text_col)
    held = docs.sparkSession.sparkContext.broadcast(costs)
    return Classifier(features_of(held, zlib.crc32(costs)), SIZE, label="toxic", folds=5, held_out=0)
