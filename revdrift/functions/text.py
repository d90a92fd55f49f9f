"""Column expressions for tokens, shingles and sketches.

Everything here returns a ``Column`` built from Spark built-ins, so it runs
inside the JVM and composes with the rest of a plan (pruning, pushdown).

Shingle contract (must match the published shingles bit for bit):

* text is lower-cased and split on Unicode whitespace, punctuation kept;
* a shingle is ``w`` consecutive tokens; its digest is the MD5 (lowercase hex)
  of the tokens, each written as a 4-byte big-endian *byte* length followed by
  its UTF-8 bytes;
* a document's shingle list is the ascending-sorted multiset of digests
  (duplicates kept); fewer than ``w`` tokens gives an empty list;
* a lambda-sketch is the first ``k`` entries of that sorted multiset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` treats as whitespace
# (``str.isspace``).  Java's ``\s`` is ASCII-only, so the class is spelled out:
# U+0009..U+000D, U+001C..U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
# Single characters below U+0100 are looked up in a table, the others stand behind
# one range test, so that a letter costs two tests and not one for each part.
WHITESPACE_RUN = (
    "[\\x{09}\\x{0a}\\x{0b}\\x{0c}\\x{0d}\\x{1c}\\x{1d}\\x{1e}\\x{1f}\\x{20}\\x{85}\\x{a0}"
    "[\\x{1680}-\\x{3000}&&[\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]]]+"
)

#: Lengths of tokens whose 4-byte prefix is looked up and not made.
SHORT = 128

#: sketch size used for lambda = inf (all shingles)
INF_K = 2147483647


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """lower-case, split on Unicode whitespace, drop empty strings."""
    parts = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), WHITESPACE_RUN)
    return F.array_remove(parts, "")


def encode_tokens(tokens) -> Column:
    """Each token as 4-byte big-endian byte length || UTF-8 bytes.

    The bytes are carried as a string column (a binary->string cast keeps the
    bytes verbatim) so that ``array_join`` can concatenate a window of them.
    """
    short = F.array(*[F.lit(n.to_bytes(4, "big")).cast("string") for n in range(SHORT)])

    def enc(t: Column) -> Column:
        prefix = F.unhex(F.lpad(F.hex(F.octet_length(t)), 8, "0")).cast("string")
        return F.concat(F.when(F.octet_length(t) < SHORT, F.get(short, F.octet_length(t))).otherwise(prefix), t)

    return F.transform(_col(tokens), enc)


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Catalyst may inline a projected column into a higher-order function's
    lambda; an array referenced per window would then be rebuilt for every
    window (quadratic per document).  Binding it through a one-element
    ``transform`` keeps it a single evaluation.
    """
    return F.get(F.transform(F.array(_col(value)), body), 0)


def _joined(encoded: Column, w: int, body) -> Column:
    """``body`` of a function that gives the ``w`` encoded tokens from a place (0-based) on.

    Runs of about the root of ``w`` tokens are joined first, so that a window is a few
    strings and not ``w``, and each token is copied twice.  Runs past the end are null."""
    size = min(range(1, w + 1), key=lambda r: r + w // r + w % r)

    def with_runs(runs: Column) -> Column:
        def window(i: Column) -> Column:
            singles = range(w - w % size, w)
            return F.concat(*[F.get(runs, i + at) for at in range(0, w - w % size, size)], *[F.get(encoded, i + at) for at in singles])
        return body(window)
    if size == 1:
        return with_runs(encoded)
    return let(F.transform(encoded, lambda t, i: F.concat(t, *[F.get(encoded, i + at) for at in range(1, size)])), with_runs)


def shingle_hashes(encoded, w) -> Column:
    """Unsorted MD5 digests of every window of ``w`` encoded tokens."""
    def windows(enc: Column) -> Column:
        n = F.size(enc)
        # sequence(1, 0) counts down, so clamp the bound and guard with when().
        starts = F.sequence(F.lit(0), F.greatest(n - w, F.lit(0)))

        def digests(window) -> Column:
            return F.transform(starts, lambda i: F.md5(window(i).cast("binary")))
        if isinstance(w, Column):
            every = digests(lambda i: F.array_join(F.slice(enc, i + 1, w), ""))
        else:
            every = _joined(enc, int(w), digests)
        return F.when(n >= w, every).otherwise(F.array().cast("array<string>"))

    w = w if isinstance(w, Column) else int(w)
    return let(encoded, windows)


def shingles(text, w) -> Column:
    """Sorted shingle multiset of a text column for window ``w``."""
    return F.sort_array(shingle_hashes(encode_tokens(tokenize(text)), w))


def sketch(sorted_shingles, k) -> Column:
    """First ``k`` entries of a sorted shingle multiset (k <= 0 -> empty)."""
    s = _col(sorted_shingles)
    k = k if isinstance(k, Column) else F.lit(int(k))
    return F.when(k <= 0, F.array().cast("array<string>")).otherwise(F.slice(s, 1, k))
