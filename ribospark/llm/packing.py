"""Best-fit packing: best-fit decreasing over all documents, planned on their length histogram.

Documents longer than the capacity are cut into full pieces, after a first piece that takes the rest.
Best-fit decreasing treats equal lengths alike, so the plan needs only how many pieces have each length:
at most ``capacity`` numbers, whatever the corpus size. The planner keeps open bins as runs of
consecutive sequence ids by remaining capacity, and a segment tree over the capacities finds the
tightest one that still holds a length in O(log capacity). A placement covers a run of ranks of one
length, so the plan stays small (a length adds at most two runs of bins).

Every piece then gets its rank among the pieces of its length: its place within its task, kept when the
pieces are written, plus the counts of the tasks before. No length, however common, meets in one task.

Edge cases: a null text is empty and makes a piece with the end id alone; null and repeated doc_ids are
packed like any other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table, tidied
from .tokens import encoder, gathered, tokenizer_path

CAPACITY = 1024
PIECES = "bucket int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long"
#: Placements in a plan: far above what two runs per length can lead to, and some MB at most.
MAX_PLAN = 4_000_000


class CapacityTree:
    """Segment tree over the capacities 0..capacity: which have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.size)

    def set(self, c: int, on: bool) -> None:
        i = c + self.size
        self.open[i] = on
        while i > 1:
            i >>= 1
            self.open[i] = self.open[2 * i] | self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least with an open bin."""
        i = least + self.size
        if self.open[i]:
            return least
        while i > 1:
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Best-fit decreasing. Per length its placements (first rank, first bin, pieces a bin, offset), and the bins.

    Rank r of a placement from rank f goes to bin ``first + (r-f) // per`` at
    ``offset + (r-f) % per * length``.
    """
    tree, runs, bins, made = CapacityTree(capacity), [[] for _ in range(capacity + 1)], 0, 0
    out: dict[int, list[tuple[int, int, int, int]]] = {}

    def put(c: int, first: int, n: int) -> None:
        if n and c:
            runs[c].append((first, n))
            tree.set(c, True)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        left, at, places = histogram[length], 0, []
        while left:
            c = tree.tightest(length)
            if c is None:
                c, per = capacity, capacity // length
                first, n = bins, -(-left // per)
                bins += n
            else:
                first, n = runs[c].pop()
                if not runs[c]:
                    tree.set(c, False)
                per = c // length
                if (use := -(-left // per)) < n:
                    put(c, first + use, n - use)
                    n = use
            took = min(left, n * per)
            places.append((at, first, per, capacity - c))
            full, rest = divmod(took, per)
            put(c - per * length, first, full)
            put(c - rest * length, first + full, 1 if rest else 0)
            left, at, made = left - took, at + took, made + 1
        out[length] = places
    if made > MAX_PLAN:
        raise RuntimeError(f"the plan has {made} placements")
    return out, bins


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens; only the first may be short."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def _pieces(path: str, spaces: str, end_id: int, capacity: int):
    names = ("bucket", "rank", "doc_id", "piece", "start", "length", "ids_crc32")
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def run(it):
        bucket, ranks = TaskContext.get().partitionId(), [0] * (capacity + 1)
        enc, end = encoder(path, spaces), np.array([end_id], "<u4").tobytes()
        for b in gathered(it):
            rows, texts = [], [t or "" for t in b.column("text").to_pylist()]
            for k, e in zip(b.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                ids = e + end
                for p, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((bucket, ranks[n], k, p, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
                    ranks[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        enc.shrink()

    return tidied(run)


def token_pieces(docs: DataFrame, tokenizer: str, spaces: str, end_id: int = 2, capacity: int = CAPACITY) -> tuple[DataFrame, str]:
    """A written table of pieces, each with its task (bucket) and its rank within that among its length."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(_pieces(tokenizer, spaces, end_id, capacity), PIECES), "pieces")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (bucket, rank, length, ...), as written, with sequence_id and offset."""
    counts = pieces.groupBy("bucket", "length").agg((F.max("rank") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, _ = plan(histogram, capacity)
    w = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bucket", "length", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    firsts = {n: [p[0] for p in ps] for n, ps in places.items()}

    def place(it):
        for b in it:
            seq, off = [], []
            for n, r, base in zip(*(b.column(c).to_pylist() for c in ("length", "rank", "before")), strict=True):
                f, first, per, at = places[n][bisect_right(firsts[n], r + base) - 1]
                q, m = divmod(r + base - f, per)
                seq.append(first + q)
                off.append(at + m * n)
            keep = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            new = [pa.array(seq, pa.int64()), pa.array(off, pa.int64())]
            yield pa.RecordBatch.from_arrays(keep + new, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return pieces.join(before, ["bucket", "length"]).mapInArrow(tidied(place), out)


def pack_documents(docs: DataFrame, tokenizer: str, spaces: str = "lead", end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    pieces, _ = token_pieces(docs, tokenizer, spaces, end_id, capacity)
    return pack(pieces, capacity)


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
