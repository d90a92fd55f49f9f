"""Fit and apply logistic regressions on hashed features of whole texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from . import ftrl
from .common import bounded_batches, crc32_of_id, forget

#: Rows with a label that a model is fitted on, at most.
MOST_ROWS = 12_000


#: Rows that are scored and handed back together.
ROWS = 1024


def _parts(batches):
    for b in batches:
        yield from (b.slice(at, ROWS) for at in range(0, len(b), ROWS))


@dataclass(frozen=True)
class Classifier:
    """``features(texts)`` yields (first row, document of each feature,
    features, rows) for runs of an Arrow string array; features are below
    ``size - 1``.  ``label`` is the column of the labels' table; rows whose
    crc32(id as text) mod ``folds`` is ``held_out`` teach nothing."""

    features: Callable
    size: int
    label: str
    folds: int
    held_out: int

    def is_held_out(self, id_col: str = "doc_id") -> Column:
        return F.coalesce(crc32_of_id(id_col) % self.folds == self.held_out, F.lit(False))

    def fit(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            most: int = MOST_ROWS, **training) -> bytes:
        """The weights (float32), from at most ``most`` labelled documents.

        The sample is that of the smallest hashes of ids.  Null labels and ids
        teach nothing, of several labels of an id the largest counts, and of
        several rows of an id the text of the least hash: so one task gets the
        features of ``most`` rows at most.  Only the sample's ids and labels are
        broadcast.  An empty table gives weights of zero; other columns are ignored.
        """
        size, features = self.size, self.features
        known = labels.filter(F.col(self.label).isNotNull() & F.col(id_col).isNotNull() & ~self.is_held_out(id_col))
        sample = (known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(self.label).cast("int").alias("label"))
                  .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        least = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label"))  # one row for each id
        rows = bounded_batches(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(least.alias("r")).select("doc_id", "r.text", "r.label"))

        def featured(batches):
            import numpy as np
            import pyarrow as pa

            for b in batches:
                for row, doc, found, n in features(b.column(1)):
                    at = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(row, n), b.column(2).slice(row, n),
                         pa.ListArray.from_arrays(pa.array(at), pa.array(found.astype(np.int32)))],
                        names=["doc_id", "label", "features"])

        def trained(batches):
            import pyarrow as pa

            forget()
            x, y = [], []
            for b in batches:
                lists = b.column(2)
                at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                x += [values[i:j].copy() for i, j in zip(at[:-1], at[1:])]
                y += b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([ftrl.train(x, y, size, **training).tobytes()], pa.binary())], names=["weights"])

        ready = rows.mapInArrow(featured, "doc_id long, label int, features array<int>")
        model = ready.repartition(1).sortWithinPartitions("doc_id", F.hash("features")).mapInArrow(trained, "weights binary")
        found = model.first()  # no partition of an empty table runs a task
        return bytes(found[0]) if found else bytes(4 * size)

    def score(self, docs: DataFrame, weights: bytes, text_col: str = "text", *keep: str | Column) -> DataFrame:
        """The kept columns with ``score`` (0 to 1, higher: label 1 likelier)
        and ``predicted`` (1 from one half on) for each row.

        Null and empty texts are scored by the bias alone, repeated rows one by
        one, long texts whole.  Kept columns of the names ``score`` and
        ``predicted`` give way, any other names stay; an empty table gives no rows.
        """
        kept = docs.select(*keep).schema.fields
        own = [k for k, f in enumerate(kept) if f.name not in ("score", "predicted")]
        rows = bounded_batches(docs.select(F.col(text_col).cast("string"), *keep).toDF("text", *[f"kept{k}" for k in range(len(kept))]))
        schema = StructType([kept[k] for k in own]).add("score", DoubleType()).add("predicted", IntegerType())
        scores = self._scores(docs, weights)

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for b in _parts(batches):
                score = scores(b.column(0))
                yield pa.RecordBatch.from_arrays([*(b.column(1 + k) for k in own), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 names=schema.names)
        return rows.mapInArrow(run, schema)

    def choose(self, docs: DataFrame, weights: bytes, label: int, text_col: str = "text") -> DataFrame:
        """The rows of ``docs`` that are predicted as ``label``, with their columns of any names.

        Null and empty texts are judged by the bias alone, repeated rows one by
        one (so all stay or all go), long texts whole; an empty table stays empty.
        """
        at, scores = docs.columns.index(text_col), self._scores(docs, weights)

        def run(batches):
            import pyarrow as pa
            import pyarrow.compute as pc

            for b in _parts(batches):
                yield b.filter(pa.array((scores(pc.cast(b.column(at), pa.string())) >= 0.5) == bool(label)))
        return bounded_batches(docs).mapInArrow(run, docs.schema)

    def _scores(self, docs: DataFrame, weights: bytes):
        features, held = self.features, docs.sparkSession.sparkContext.broadcast(weights)

        def scores(texts):
            import numpy as np

            w = np.frombuffer(held.value, dtype=np.float32).astype(np.float64)
            total = np.full(len(texts), w[-1])
            for row, doc, found, n in features(texts):
                total[row:row + n] += np.bincount(doc, weights=w[found], minlength=n)
            return 1 / (1 + np.exp(-np.clip(total, -500, 500)))
        return scores
