"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token pieces of at most ``capacity`` ids, and only the number
of pieces of each length matters for the plan: at most ``capacity`` counts,
whatever the size of the corpus.  A configuration is a multiset of lengths that
fits one sequence; the program asks for the fewest configurations that cover
all counts.  Multiplicative weights solve it: the prices of lengths fall as
they are covered ahead of the others, and a knapsack dynamic program finds the
configuration of most value at the prices.  Whole copies of the configurations
are taken, what is left goes best-fit into the gaps and new sequences.  The
plan is a short table of slots; each piece finds its slot from its rank among
the pieces of its length.
"""

from __future__ import annotations

from collections import defaultdict
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import encode_texts, library_coder
from .common import forget, written

PIECES = "part int, row long, doc_id long, piece int, start long, length int, rank long, ids_crc32 long, ids array<int>"

Plan = list[tuple[dict[int, int], int]]  # (copies of each length, sequences of this kind)


def knapsack(prices, lengths, capacity: int):
    """For each size up to ``capacity``: the last length that the multiset of
    ``lengths`` (ascending) of most value takes (0: none)."""
    import numpy as np

    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        if fits[c]:
            value = best[c - lengths[:fits[c]]] + prices[:fits[c]]
            i = int(value.argmax())
            best[c], took[c] = value[i], lengths[i]
    return took.tolist()


def solve_program(counts: dict[int, int], capacity: int, rounds: int = 200, rate: float = 4.0) -> list[tuple[dict[int, int], float]]:
    """Fractional copies of configurations that cover ``counts``, up to a rest.

    By the end of round t, t / rounds of each count should be covered, and at
    most a round more is.  A length's price is its size times a weight that
    falls exponentially as it is covered ahead of that, and each length short
    of it gets the configuration of most value among those that hold it.
    """
    import numpy as np

    lengths = np.array(sorted(counts), dtype=np.int64)
    place = {x: i for i, x in enumerate(lengths.tolist())}
    need, covered = [float(counts[x]) for x in place], [0.0] * len(place)
    taken: dict[tuple, float] = defaultdict(float)
    for t in range(1, rounds + 1):
        ahead = np.array(covered) / need - t / rounds
        took = knapsack(lengths * np.exp(-rate * ahead), lengths, capacity)
        for x in reversed(place):
            short = need[place[x]] * t / rounds - covered[place[x]]
            if short <= 1e-9 * need[place[x]]:
                continue
            content, c = {x: 1}, capacity - x
            while took[c]:
                content[took[c]] = content.get(took[c], 0) + 1
                c -= took[c]
            most = min((need[place[y]] * min(1, (t + 1) / rounds) - covered[place[y]]) / a for y, a in content.items())
            copies = min(short / content[x], most)
            if copies <= 0:
                continue
            taken[tuple(sorted(content.items(), reverse=True))] += copies
            for y, a in content.items():
                covered[place[y]] += a * copies
    return [(dict(c), n) for c, n in taken.items()]


def whole_copies(taken: list[tuple[dict[int, int], float]]) -> Plan:
    """Rounded so that every run of configurations in the order of their
    lengths keeps its sum to within one copy."""
    plan, total = [], 0.0
    for content, n in sorted(taken, key=lambda t: sorted(t[0].items(), reverse=True), reverse=True):
        plan.append((content, int(total + n) - int(total)))
        total += n
    return plan


def best_fit(left: dict[int, int], plan: Plan, capacity: int) -> Plan:
    """Put the counts ``left`` into the gaps of ``plan`` and new sequences,
    longest first, each into the smallest gap that holds it."""
    gaps: dict[int, list] = defaultdict(list)
    for content, n in plan:
        gaps[capacity - sum(x * a for x, a in content.items())].append([content, n])
    for x in sorted(left, reverse=True):
        while left[x]:
            gap = min((g for g in gaps if g >= x and gaps[g]), default=None)
            if gap is None:
                each = min(capacity // x, left[x])
                n = left[x] // each
                gaps[capacity - each * x].append([{x: each}, n])
                left[x] -= each * n
                continue
            content, n = gaps[gap].pop()
            each = min(gap // x, left[x])
            use = min(n, left[x] // each)
            if use < n:
                gaps[gap].append([content, n - use])
            gaps[gap - each * x].append([content | {x: content.get(x, 0) + each}, use])
            left[x] -= each * use
    return [(c, n) for group in gaps.values() for c, n in group if n]


def plan_sequences(counts: dict[int, int], capacity: int, rounds: int = 200) -> Plan:
    """A plan whose sequences hold exactly ``counts``."""
    left, plan = dict(counts), []
    full = left.pop(capacity, 0)
    for content, n in whole_copies(solve_program(left, capacity, rounds) if left else []):
        n = min([n, *(left[x] // a for x, a in content.items())])
        if n:
            plan.append((content, n))
            for x, a in content.items():
                left[x] -= a * n
    plan = best_fit(left, plan, capacity)
    return plan + ([({capacity: 1}, full)] if full else [])


def slots(plan: Plan):
    """Arrays of the plan's slots, by length and then number: first slot,
    sequence of it, copies in a sequence, offset, length; and the first slot of each length."""
    import numpy as np

    rows, sequence = [], 0
    for content, n in plan:
        offset = 0
        for x in sorted(content, reverse=True):
            rows.append((x, sequence, content[x], offset, n * content[x]))
            offset += x * content[x]
        sequence += n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    first = np.cumsum(table[:, 4]) - table[:, 4]
    of_length = {}
    for x, f in zip(table[:, 0].tolist(), first.tolist()):
        of_length.setdefault(x, f)
    return first, table[:, 1], table[:, 2], table[:, 3], of_length


def _cutter(tokenizer: str, capacity: int, end_id: int, special_as_text: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        forget(("library", tokenizer, special_as_text))  # the worker may be one of an earlier stage
        part, row, seen = TaskContext.get().partitionId(), 0, np.zeros(capacity + 1, np.int64)
        for b in batches:
            for at, ids, offsets in encode_texts(b.column(1), library_coder(tokenizer, special_as_text)):
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
                n = np.diff(offsets)
                pieces = -(-n // capacity)
                of = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * capacity  # the first piece may be shorter
                start = np.where(piece > 0, head[of] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[of])
                order = np.argsort(length, kind="stable")
                by = length[order]
                edge = np.concatenate([[True], by[1:] != by[:-1]]) if len(by) else np.empty(0, bool)
                within = np.arange(len(by)) - np.repeat(np.flatnonzero(edge), np.diff(np.append(np.flatnonzero(edge), len(by))))
                rank = np.empty(len(by), np.int64)
                rank[order] = seen[by] + within
                seen += np.bincount(length, minlength=capacity + 1)
                at_ids = np.append(offsets[of] + start, offsets[-1])
                raw = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at_ids[:-1].tolist(), at_ids[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(of), part, np.int32)), pa.array(row + np.arange(len(of))),
                     b.column(0).slice(at, len(n)).take(pa.array(of)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length.astype(np.int32)), pa.array(rank), pa.array(crc, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at_ids.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    names=["part", "row", "doc_id", "piece", "start", "length", "rank", "ids_crc32", "ids"])
                row += len(of)
    return run


def _placer(plan: Plan):
    first, sequence, copies, offset, of_length = slots(plan)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        forget()  # the pieces are written, no task needs the tokenizer again
        for b in batches:
            length = b.column("length").to_numpy()
            slot = b.column("slot").to_numpy() + np.array([of_length[x] for x in length.tolist()], dtype=np.int64)
            e = np.searchsorted(first, slot, side="right") - 1
            within = slot - first[e]
            yield (b.drop_columns(["slot"])
                   .append_column("sequence_id", pa.array(sequence[e] + within // copies[e]))
                   .append_column("offset", pa.array(offset[e] + within % copies[e] * length)))
    return run


@dataclass
class Packing:
    """``pieces``: [part, row, ids] with the ids of each piece, as written;
    ``placed``: [part, row, doc_id, piece, start, length, ids_crc32, sequence_id,
    offset], with the unsigned crc32 of the ids as little-endian 32-bit integers."""

    pieces: DataFrame
    placed: DataFrame

    def sequences(self) -> DataFrame:
        """[sequence_id, ids]: the packed sequences."""
        rows = self.placed.select("part", "row", "sequence_id", "offset").join(self.pieces, ["part", "row"])
        held = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
        return held.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, rounds: int = 200,
         id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> Packing:
    """Pack the ids of all documents into few sequences of at most ``capacity``.

    A document's ids are those of its whole text (null: empty) and ``end_id``.
    Only documents longer than ``capacity`` are cut: the first piece takes the
    remainder, the others are full.  Null and repeated ids and equal texts are
    packed like all others; other columns are ignored; an empty table gives an
    empty packing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = written(rows.mapInArrow(_cutter(tokenizer, capacity, end_id, special_as_text), PIECES),
                     "pieces", compression="zstd")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    total = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    light = pieces.select("part", "row", "doc_id", "piece", "start", "length", "rank", "ids_crc32").join(before, ["part", "length"])
    placed = light.select("part", "row", "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank")).alias("slot")).mapInArrow(
        _placer(plan_sequences(total, capacity, rounds)),
        "part int, row long, doc_id long, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long")
    return Packing(pieces.select("part", "row", "ids"), placed)
