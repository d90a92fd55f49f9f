"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) once for every letter
behind it; a text's vector bundles (adds) those of its n-grams, and a language's
prototype bundles the texts of the language.  A document goes to the prototype
of largest cosine.  Bundling is linear, so the prototypes add up from the tasks'
sums, and nothing larger than languages x dimensions leaves a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_worker

#: Letters: a to z have numbers of their own, others share the rest; 0 separates words.
LETTERS = 64
DIMENSIONS = 1024
#: Documents (and characters, unless one is longer) that are bundled together.
GROUP, GROUP_CHARS = 256, 1 << 20


def _tables():
    """(number of each code point's letter, the letters' vectors under each rotation)."""
    import numpy as np

    def build():
        letter = np.zeros(0x110000, dtype=np.int32)
        for c in range(0x110000):
            if chr(c).isalpha():
                letter[c] = c - 96 if 97 <= c <= 122 else 27 + (c - 0xDF) % (LETTERS - 27)
        base = np.random.default_rng(7).choice(np.array([-1, 1], dtype=np.int8), size=(LETTERS, DIMENSIONS))
        return letter, [np.roll(base, k, axis=1) for k in range(3)]
    return per_worker("language", build)


def _ngrams(texts: list[str]):
    """(document of each n-gram, code of each n-gram) of lower-case texts."""
    import numpy as np

    letter, _ = _tables()
    lowered = [" " + (t or "").lower() + " " for t in texts]
    n = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered))
    x = letter[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    doc = np.repeat(np.arange(len(texts)), n)
    keep = np.ones(len(x), dtype=bool)  # runs of separators count as one
    keep[1:] = (x[1:] > 0) | (x[:-1] > 0) | (doc[1:] != doc[:-1])
    x, doc = x[keep], doc[keep]
    code = (x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:]
    own = (doc[:-2] == doc[2:]) & (x[1:-1] > 0)
    return doc[:-2][own], code[own]


def _vectors(codes):
    """Vectors of n-grams, a row for each code."""
    _, (third, second, first) = _tables()
    v = first[codes // LETTERS ** 2] * second[codes // LETTERS % LETTERS]
    v *= third[codes % LETTERS]
    return v


def _groups(batches, columns: int):
    """Lists of rows' columns, cut so that a group's characters stay bounded."""
    for b in batches:
        for at in range(0, len(b), GROUP):
            held, chars = [], 0
            for row in zip(*(b.column(i).slice(at, GROUP).to_pylist() for i in range(columns))):
                held.append(row)
                chars += len(row[1] or "")
                if chars >= GROUP_CHARS:
                    yield list(zip(*held))
                    held, chars = [], 0
            if held:
                yield list(zip(*held))


def _sums(batches):
    """[doc_id, text, lang] -> [lang, bundle] of the task's texts."""
    import numpy as np
    import pyarrow as pa

    counts: dict[str, np.ndarray] = {}
    for _, texts, langs in _groups(batches, 3):
        doc, code = _ngrams(texts)
        names = sorted(set(langs))
        of = np.array([names.index(x) for x in langs])[doc] if len(doc) else doc
        for k, name in enumerate(names):
            counts.setdefault(name, np.zeros(LETTERS ** 3, dtype=np.int64))
            counts[name] += np.bincount(code[of == k], minlength=LETTERS ** 3)
    for name, c in counts.items():
        codes, bundle = np.flatnonzero(c), np.zeros(DIMENSIONS)
        for at in range(0, len(codes), 8192):
            part = codes[at:at + 8192]
            bundle += c[part].astype(float) @ _vectors(part)
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([bundle.tolist()], pa.list_(pa.float64()))],
                                         names=["lang", "bundle"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[float]]:
    """The prototypes of the languages, from every row with a language.

    Rows without one teach nothing; null and empty texts add nothing.  The
    driver gets a vector for each language.
    """
    rows = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = rows.mapInArrow(_sums, "lang string, bundle array<double>")
    sums = parts.select("lang", F.posexplode("bundle").alias("dim", "v")).groupBy("lang", "dim").agg(F.sum("v").alias("v"))
    whole = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "v"))).alias("b"))
    return {r[0]: [x.v for x in r[1]] for r in whole.orderBy("lang").collect()}


def predict(docs: DataFrame, prototypes: dict[str, list[float]], id_col: str = "doc_id", text_col: str = "text",
            *keep: Column) -> DataFrame:
    """[doc_id, kept columns, lang_pred, score] for each row of ``docs``.

    ``score`` is the cosine to the prototype, 0 where it is negative.  Null
    texts, texts without a letter and models without a language give ``und``
    and 0; ties go to the first name.  Null and repeated ids are scored row by
    row; other columns are ignored; an empty table gives no rows.
    """
    names = sorted(prototypes)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        p = np.array([prototypes[n] for n in names], dtype=np.float64).reshape(len(names), DIMENSIONS)
        norm = np.linalg.norm(p, axis=1, keepdims=True)
        p = p / np.where(norm > 0, norm, 1)
        for b in batches:
            lang, score = [], []
            for _, texts in _groups([b], 2):
                doc, code = _ngrams(texts)
                seen = np.zeros(LETTERS ** 3, dtype=bool)
                seen[code] = True
                codes = np.flatnonzero(seen)
                place = np.cumsum(seen) - 1
                counts = np.bincount(doc * len(codes) + place[code], minlength=len(texts) * len(codes))
                counts = counts.reshape(len(texts), len(codes)).astype(np.float32)
                vectors = _vectors(codes).astype(np.float32)
                bundle = np.empty((len(texts), DIMENSIONS), dtype=np.float32)
                for i, row in enumerate(counts):
                    own = np.flatnonzero(row)
                    bundle[i] = row[own] @ vectors[own]
                size = np.linalg.norm(bundle, axis=1)
                cosine = (bundle @ p.T.astype(np.float32)) / np.where(size > 0, size, 1)[:, None]
                letters = np.bincount(doc, minlength=len(texts)) > 0
                for i in range(len(texts)):
                    known = letters[i] and len(names) > 0
                    best = int(cosine[i].argmax()) if known else -1
                    lang.append(names[best] if known else "und")
                    score.append(float(min(1, max(0, cosine[i, best]))) if known else 0.0)
            yield (b.drop_columns(["text"]).append_column("lang_pred", pa.array(lang, pa.string()))
                   .append_column("score", pa.array(score, pa.float64())))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, schema + ", lang_pred string, score double")
