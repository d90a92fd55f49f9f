"""Whitening of whole-number vectors by refined eigenvectors of their covariance.

Sums and covariance are added up by the tasks over the distinct vectors; the
driver gets a number for each pair of dimensions.  There float32 eigenvectors
are corrected by the iterations of Ogita and Aishima, a few matrix products each
in extended precision, which double the right digits every time.  Eigenvalues
too near one another for that (closer than the error bound of the step) are a
cluster: its part of the matrix, shifted by its mean, is solved by itself in the
same way, and its vectors are turned by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Components of a whitened vector, at most.
COMPONENTS = 16
#: Of the largest eigenvalue, the share below which a direction has no variance.
NO_VARIANCE = 1e-12
#: Iterations, at most; four bring float32 to the last digit.
ITERATIONS = 12
#: Vectors that are worked off together.
CHUNK = 4096


def refined(matrix):
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix, as float64.

    Eigenvalues nearer than some units of the last place of the largest entry
    are taken as equal: of their vectors any orthonormal ones are right."""
    import numpy as np

    a = np.asarray(matrix).astype(np.longdouble)
    x = _vectors(a, 32 * len(a) * float(np.finfo(np.longdouble).eps) * float(np.abs(a).max(initial=0)))
    for _ in range(3):
        x = x + x @ (np.eye(len(a), dtype=np.longdouble) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return values[order].astype(np.float64), (x * sign).astype(np.float64)


def _vectors(a, noise: float):
    """Eigenvectors in extended precision; gaps of ``noise`` or less are rounding.

    The first iterations are in float64, those near the end in extended precision."""
    import numpy as np

    n = len(a)
    one = np.eye(n, dtype=np.longdouble)
    a = a - one * (np.trace(a) / max(n, 1))
    size = float(np.abs(a).max(initial=0))
    if n < 2 or size <= noise:
        return one
    a, noise = a / size, noise / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    change, last, kind = 1.0, float(np.finfo(np.longdouble).eps), np.float64
    for _ in range(ITERATIONS):
        kind = kind if change > 1e-6 else np.longdouble
        y, b = x.astype(kind), a.astype(kind)
        r = np.eye(n, dtype=kind) - y.T @ y
        s = y.T @ b @ y
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        bound = 2 * float(np.sqrt((off * off).sum()) + np.sqrt((b * b).sum()) * np.sqrt((r * r).sum()))
        bound = max(bound, noise, 64 * n * float(np.finfo(kind).eps))
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > bound
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = (y + y @ e).astype(np.longdouble)
        change, solved = float(np.abs(e).max()), False
        for cluster in _clusters(value, bound) if change < 1e-3 else []:
            own = x[:, cluster]
            part = own.T @ (a @ own - own * value[cluster].mean())  # shifted first: what own lacks in orthogonality stays small
            part = (part + part.T) / 2
            if len(cluster) < n and np.ptp(np.diag(part)) + np.abs(part - np.diag(np.diag(part))).max() > noise:
                x[:, cluster] = own @ _vectors(part, noise)
                solved = True
        if kind is np.longdouble and change * change <= last and not solved:
            break
    return x


def _clusters(value, bound: float):
    """Groups of several columns whose eigenvalues are linked by gaps within the bound."""
    import numpy as np

    order = np.argsort(value, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(value[order]) > bound) + 1)
    return [p for p in parts if len(p) > 1]


@dataclass(frozen=True)
class Whitening:
    """What a fit learnt of the vectors of one length.  ``basis`` (bytes of
    float64, dimensions x components) turns a centred vector to its components,
    already divided by the roots of their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    basis: bytes
    explained: tuple[float, ...]
    identity_error: float

    def matrix(self):
        import numpy as np

        return np.frombuffer(self.basis).reshape(len(self.sums), len(self.explained))


def _by_length(lists):
    """(length, rows, rows x length) of an Arrow array of lists without nulls in them; null and empty lists are passed over."""
    import numpy as np

    at = lists.offsets.to_numpy().astype(np.int64)
    size = np.diff(at)
    valid = np.array(lists.is_valid())
    values = lists.values.to_numpy(zero_copy_only=False)
    valid &= size > 0
    for length in np.unique(size[valid]).tolist():
        rows = np.flatnonzero(valid & (size == length))
        for k in range(0, len(rows), CHUNK):
            own = rows[k:k + CHUNK]
            yield length, own, values[at[own][:, None] + np.arange(length)].astype(np.int64)


def _centred(x, n: int, sums):
    """n * x - S, exactly."""
    import numpy as np

    sums = np.array(sums, dtype=np.int64)
    if x.size and n * float(np.abs(x).max()) >= 2.0 ** 62:
        raise OverflowError("the number of vectors times their entries does not fit a long")
    return n * x - sums


def _sums(batches):
    """[x] -> [length, i, n, s] of a task."""
    import numpy as np
    import pyarrow as pa

    found: dict[int, list] = {}
    for b in batches:
        for length, rows, x in _by_length(b.column(0)):
            own = found.setdefault(length, [0, np.zeros(length, dtype=np.int64)])
            own[0] += len(rows)
            own[1] += x.sum(axis=0)
    for length, (n, s) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(length, length, dtype=np.int32)), pa.array(np.arange(length, dtype=np.int32)),
                                          pa.array(np.full(length, n, dtype=np.int64)), pa.array(s)], names=["length", "i", "n", "s"])


def _products(learnt: dict):
    """[x] -> [length, i, j, v]: sums of products of a task's centred vectors;
    with a basis of their components and, last, a one (so also of the components alone)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        found: dict[int, object] = {}
        for b in batches:
            for length, _, x in _by_length(b.column(0)):
                n, sums, basis = learnt[length]
                c = _centred(x, n, sums) / n
                if basis is not None:
                    c = c @ basis
                    c = np.column_stack([c, np.ones(len(c))])
                found[length] = found.get(length, 0) + c.T @ c
        for length, v in found.items():
            i, j = np.triu_indices(len(v))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), length, dtype=np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), pa.array(v[i, j])], names=["length", "i", "j", "v"])
    return run


def _added(x: DataFrame, learnt: dict) -> dict:
    """length -> the symmetric matrix of sums over all rows."""
    import numpy as np

    rows = (x.mapInArrow(_products(learnt), "length int, i int, j int, v double")
            .groupBy("length", "i", "j").agg(F.sum("v").alias("v")).collect())
    found: dict[int, object] = {}
    for length in {r.length for r in rows}:
        own = [r for r in rows if r.length == length]
        size = 1 + max(r.i for r in own)
        v = found[length] = np.zeros((size, size))
        for r in own:
            v[r.i, r.j] = v[r.j, r.i] = r.v
    return found


def quantised(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift of each entry as long; null for vectors that are
    null or hold null or non-finite entries."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift).cast("long")))


def fit(rows: DataFrame, vector_col: str = "x", components: int = COMPONENTS) -> dict[int, Whitening]:
    """length of vectors -> ``Whitening``, from the distinct vectors of ``rows``.

    ``vector_col`` holds arrays of whole numbers without nulls; null and empty arrays
    teach nothing, equal ones count once, vectors of each length are fitted by
    themselves.  Components without variance (all of them, of one vector or of
    equal entries) are left out; an empty table gives an empty result.  The
    distinct vectors are written once and read three times; the driver gets the
    sums and the products of each pair of dimensions, whatever the rows.
    """
    import numpy as np

    x = written(rows.select(F.col(vector_col).cast("array<long>").alias("x")).filter("x IS NOT NULL").distinct(), "distinct-vectors")
    sums: dict[int, tuple[int, list[int]]] = {}
    for r in (x.mapInArrow(_sums, "length int, i int, n long, s long").groupBy("length", "i")
              .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("length", "i").collect()):
        sums.setdefault(r.length, (r.n, []))[1].append(r.s)
    learnt, kept = {}, {}
    for length, v in _added(x, {k: (n, s, None) for k, (n, s) in sums.items()}).items():
        n, s = sums[length]
        values, vectors = refined(v / n)
        own = np.flatnonzero(values > NO_VARIANCE * max(values[0], 0))[:components]
        basis = vectors[:, own] / np.sqrt(values[own])
        learnt[length] = (n, s, basis)
        kept[length] = values[own] / (np.trace(v) / n) if len(own) else values[own]
    out = {}
    for length, w in _added(x, learnt).items():
        n, s, basis = learnt[length]
        mean = w[-1, :-1] / n
        off = w[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))
        out[length] = Whitening(n, tuple(s), basis.tobytes(), tuple(kept[length].tolist()), float(np.abs(off).max(initial=0)))
    return out


def whiten(rows: DataFrame, fitted: dict[int, Whitening], id_col: str = "vec_id", vector_col: str = "x") -> DataFrame:
    """[id, component, n, deviation, whitened, explained, identity_error]: a row
    for each row of ``rows`` and component from 1 on.

    ``deviation`` is the exact sum of squares of n * x - S (an error where it
    does not fit a long).  Null and empty vectors, and lengths that were not fitted or
    have no variance, give no rows; null and repeated ids stay as they are, other
    columns are ignored, an empty table gives no rows.  Narrow: the fit goes to
    the tasks (dimensions x components numbers).
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for length, own, x in _by_length(b.column(1)):
                model = fitted.get(length)
                if model is None or not model.explained:
                    continue
                t = _centred(x, model.n, model.sums)
                if t.size and length * float(np.abs(t).max()) ** 2 >= 2.0 ** 62:
                    deviation = [sum(v * v for v in r) for r in t.tolist()]  # whole numbers of any size; Arrow refuses what is no long
                else:
                    deviation = (t * t).sum(axis=1)
                white = (t / model.n) @ model.matrix()
                k, m = white.shape[1], len(own)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(own[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.n)), pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(white.reshape(-1)),
                     pa.array(np.tile(np.array(model.explained), m)), pa.array(np.full(m * k, model.identity_error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    given = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<long>").alias("x")).filter("x IS NOT NULL")
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(
        run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double").withColumnRenamed("id", id_col)
