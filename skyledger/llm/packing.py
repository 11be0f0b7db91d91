"""Best-fit packing of tokenized documents into sequences of fixed length.

A plan needs only the number of pieces of each length, of which there are at
most as many as a sequence has tokens. It is made from these counts: pieces of
over a third of a sequence are matched, at most two to a sequence, the largest
with the largest that still fits beside it; smaller ones then go, from the
largest down, to the smallest gap that takes them. The plan says, for a range
of ranks among the pieces of one length, from which sequence on they go and at
which offset. Each piece then finds its place by its length and rank, without
ever meeting the others.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch
from .batches import in_rows, text_slices
from .tokens import MOST_CACHED, PieceEncoder, vocabulary_path

CAPACITY = 2048
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, first sequence, number, offset).

    Ranks start at 0 within a length; the n-th piece of an entry goes to the
    n-th sequence from its first one on.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    rank: dict[int, int] = defaultdict(int)
    entries: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens: (first sequence, number)
    sizes: list[int] = []  # the keys of gaps that hold any, ascending
    opened = 0

    def place(length: int, first: int, n: int, offset: int) -> None:
        entries.append((length, rank[length], first, n, offset))
        rank[length] += n
        left[length] -= n

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not gaps[gap]:
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        fits = bisect.bisect_right(large, capacity - length)
        partner = large[fits - 1] if fits else None
        if partner == length and left[length] < 2:
            partner = large[fits - 2] if fits > 1 else None
        if partner is None:
            n = left[length]
            place(length, opened, n, 0)
            free(capacity - length, opened, n)
        else:
            n = left[length] // 2 if partner == length else min(left[length], left[partner])
            place(length, opened, n, 0)
            place(partner, opened, n, length)
            free(capacity - length - partner, opened, n)
        opened += n
        large = [x for x in large if left[x]]

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                n, rows = (left[length] // each, each) if left[length] >= each else (1, left[length])
                for k in range(rows):
                    place(length, opened, n, k * length)
                free(capacity - rows * length, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            taken = min(n, left[length])
            free(gap, first + taken, n - taken)
            place(length, first, taken, capacity - gap)
            free(gap - length, first, taken)
    return entries


def document_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, cached: int = MOST_CACHED) -> DataFrame:
    """The pieces of each document and, for its task, the rank of each among those of its length."""
    path = path or vocabulary_path()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32")), ("task", pa.int32()), ("rank", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = PieceEncoder.of_worker(path, cached), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in text_slices(batches):
            ids, bounds = encoder.encode(batch.column("text"))
            totals = np.diff(bounds)
            pieces = -(-totals // capacity)
            doc = np.repeat(np.arange(len(totals)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (totals - 1) % capacity + 1
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            at = bounds[doc] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            within = np.arange(len(order)) - np.searchsorted(length[order], length[order])
            rank = np.empty(len(order), np.int64)
            rank[order] = within + seen[length[order]]
            seen += np.bincount(length, minlength=capacity + 1)
            yield in_rows({"doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start, "length": length, "ids_crc32": crc, "task": np.full(len(doc), task, np.int32), "rank": rank}, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, _PIECES)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, cached: int = MOST_CACHED) -> DataFrame:
    """One row per piece of each document, with its sequence and its place there.

    Reads ``doc_id`` and ``text``; other columns are ignored. Every row is a
    document: a null or empty text is the end id alone, a row that occurs twice
    is packed twice, a null id stays null. No rows give no rows. ``cached`` is
    how many text pieces a worker remembers, which trades memory for time.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "pieces")
    document_pieces(docs, path, capacity, cached).write.parquet(folder)
    pieces = spark.read.schema(_PIECES).parquet(folder)
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # One row per length at most.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    entries = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    ranked = pieces.join(per_task.drop("n"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset"))])
    kept = spark.sparkContext.broadcast(entries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_first, entry = np.int64(1) << 48, kept.value
        keys = entry[:, 0] * length_first + entry[:, 1]
        for batch in batches:
            if batch.num_rows:
                length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
                e = np.searchsorted(keys, length * length_first + rank, side="right") - 1
                columns = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
                yield in_rows(columns | {"sequence_id": entry[e, 2] + rank - entry[e, 1], "offset": entry[e, 4]}, schema)

    return ranked.mapInArrow(work, _PLACED)
