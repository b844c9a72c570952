"""Best-fit-decreasing packing of token documents into fixed-length sequences.

Each document is encoded, ended with an end id, and cut into pieces only where it
is longer than a sequence (the first piece takes the remainder, the others are
full). Best-fit decreasing looks at lengths only, and lengths are bounded by the
sequence length: the corpus is reduced to a histogram (at most ``max_len`` rows,
by grouped aggregation), the bins are planned on it, and each piece finds its
place by its rank among the pieces of its length.

The planner keeps the open bins by remaining capacity and a segment tree over
the capacities; one descent (logarithmic in ``max_len``) finds the tightest bin
that holds the next document. Documents of one length are placed a run at a time:
while bins of the tightest capacity last, best fit puts the next ones there, so a
run of equal bins is one step and one plan entry. The plan equals packing one
document after the other (a test compares the two).

A null or empty text is one piece holding only the end id; repeated doc_ids,
texts and ties are packed as rows of their own (ties in order of their rank in
the input); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, table
from .tokens import default_path, encoder

MAX_LEN = 2048
END_ID = 0


class CapacityTree:
    """Which capacities have an open bin; the smallest one of at least x."""

    def __init__(self, top: int):
        self.leaves = 1 << (top + 1).bit_length()
        self.any = np.zeros(2 * self.leaves, bool)

    def set(self, capacity: int, there: bool) -> None:
        i = self.leaves + capacity
        self.any[i] = there
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        i = self.leaves + least
        if self.any[i]:
            return least
        while i > 1 and not (i % 2 == 0 and self.any[i + 1]):
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


class BinPlan:
    """Steps of a plan by length: ranks from ``first_rank`` fill bins from
    ``first_bin`` on, ``per_bin`` pieces each, starting at ``offset``."""

    def __init__(self, steps: list[tuple[int, int, int, int, int]], n_bins: int):
        self.n_bins = n_bins
        rows = np.array(sorted(steps), np.int64).reshape(-1, 5)
        self.length, self.first_rank, self.first_bin, self.per_bin, self.offset = rows.T.copy()

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces given by length and rank within the length."""
        bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        values, at = np.unique(length[order], return_index=True)
        for value, rows in zip(values, np.split(order, at[1:])):
            lo, hi = np.searchsorted(self.length, [value, value + 1])
            step = lo + np.searchsorted(self.first_rank[lo:hi], rank[rows], "right") - 1
            j = rank[rows] - self.first_rank[step]
            bins[rows] = self.first_bin[step] + j // self.per_bin[step]
            offsets[rows] = self.offset[step] + j % self.per_bin[step] * value
        return bins, offsets


def best_fit_decreasing(histogram: dict[int, int], max_len: int = MAX_LEN) -> BinPlan:
    """Plan the bins for ``histogram[length]`` pieces of each length."""
    tree = CapacityTree(max_len)
    open_bins: defaultdict[int, deque[tuple[int, int]]] = defaultdict(deque)
    steps: list[tuple[int, int, int, int, int]] = []
    n_bins = 0

    def put(capacity: int, first: int, count: int) -> None:
        if capacity and count:
            open_bins[capacity].append((first, count))
            tree.set(capacity, True)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = max_len
                count = -(-left // (max_len // length))
                put(capacity, n_bins, count)
                n_bins += count
            first, count = open_bins[capacity].popleft()
            per_bin = min(capacity // length, left)
            used = min(count, left // per_bin)
            steps.append((length, rank, first, per_bin, max_len - capacity))
            if used < count:
                open_bins[capacity].appendleft((first + used, count - used))
            if not open_bins[capacity]:
                tree.set(capacity, False)
            put(capacity - per_bin * length, first, used)
            rank += used * per_bin
            left -= used * per_bin
    return BinPlan(steps, n_bins)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def cut_rows(tokenizer_path: str, max_len: int, end_id: int, keep_ids: bool):
    """mapInArrow function: (doc_id, text) to PIECES, and ``ids`` if kept. ``nth``
    ranks the task's pieces of one length."""

    def run(batches):
        enc = encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_len + 1, np.int64)
        for batch in batches:
            doc = batch.column(0)
            for at, ids, cuts in enc.encode(batch.column(1)):
                ids = np.insert(ids, cuts[1:], end_id).astype("<u4")
                n = np.diff(cuts) + 1
                cuts = np.concatenate([[0], np.cumsum(n)])
                pieces = -(-n // max_len)
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * max_len
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * max_len)
                length = np.where(piece == 0, head[row], max_len)
                order = np.argsort(length, kind="stable")
                values, first, counts = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.repeat(first - seen[values], counts)
                seen[values] += counts
                lo = cuts[row] + start
                view = memoryview(ids)
                crc = [zlib.crc32(view[a:b]) for a, b in zip(lo.tolist(), (lo + length).tolist())]
                columns = [
                    doc.slice(at, len(n)).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(nth),
                ]
                names = [c.split()[0] for c in PIECES.split(", ")]
                if keep_ids:  # the pieces of a block are its ids in order
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def place_rows(plan: BinPlan):
    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (0, 1))
            bins, offsets = plan.place(length, rank)
            columns = [*batch.columns[2:], batch.column(0), pa.array(bins), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[2:], "length", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, max_len: int = MAX_LEN, end_id: int = END_ID, tokenizer_path: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    """Pieces of (doc_id, text) rows with their sequence and place in it; with
    ``keep_ids`` also the ids, from which ``sequences`` builds the sequences."""
    small_batches(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    pieces = staged(docs.select(F.col("doc_id").cast("long"), "text")
                    .mapInArrow(cut_rows(tokenizer_path or default_path(), max_len, end_id, keep_ids), schema), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # one row per length, at most max_len of them
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_decreasing(histogram, max_len)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    columns = ["doc_id", "piece", "start", "ids_crc32", *(["ids"] if keep_ids else [])]
    types = dict(pieces.dtypes)
    out = ", ".join(f"{c} {types[c]}" for c in columns) + ", length long, sequence_id long, offset long"
    return pieces.join(bases, ["part", "length"]).select("length", (F.col("base") + F.col("nth")).alias("rank"), *columns).mapInArrow(place_rows(plan), out)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, ids) of ``pack(keep_ids=True)``; a
    sequence holds at most ``max_len`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents", "doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
