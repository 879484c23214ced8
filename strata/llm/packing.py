"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Lengths are integers up to the capacity, so one histogram (at most ``capacity``
rows) holds all that the placement needs. The driver runs best-fit decreasing
over it: a segment tree over remaining capacities finds the tightest open
sequences in logarithmic time, and equal pieces that go to equal sequences are
placed together. Tasks then look up their own pieces: a piece's rank among all
pieces of its length is its rank in its block plus the counts of earlier blocks.

Null texts are empty and still get the end token; repeated rows and null ids are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import saved
from strata.llm.subword import default_vocabulary, encoder
from strata.llm.words import slices

SLICE_BYTES = 1 << 19  # text encoded at once, as an encoder needs many times its size


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Token ids of every whole text and its end token, cut to at most ``capacity``.

    Only longer texts are cut; the first piece takes what is left over. Columns:
    ``id_col, piece, start, length, ids`` (little-endian 32-bit) and the piece's
    ``block`` and ``rank`` among the block's pieces of its length."""
    path = vocabulary or default_vocabulary()

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode, block = encoder(path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                bounds, flat = encode(part.column(1))
                raw = flat.tobytes()
                rows, piece, start, length, rank, ids = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    own, n, at, k = raw[4 * a:4 * b] + end, b - a + 1, 0, 0
                    while at < n:
                        size = (n - at - 1) % capacity + 1 if not k else capacity
                        rows.append(i), piece.append(k), start.append(at), length.append(size)
                        rank.append(seen[size])
                        seen[size] += 1
                        ids.append(own[4 * at:4 * (at + size)])
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([block] * len(rows), pa.int64()), pa.array(rank, pa.int64())],
                    names=["id", "piece", "start", "length", "ids", "block", "rank"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary, block long, rank long")
            .withColumnRenamed("id", id_col))


class CapacityTree:
    """Open sequences by remaining capacity, with the tightest fit in log time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.total = [0] * (2 * self.leaves)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, first: int, count: int) -> None:
        """``count`` sequences from number ``first`` on have ``left`` tokens free."""
        if count and left:
            self.open[left].append((first, count))
            self._change(left, 1)

    def pop(self, left: int) -> tuple[int, int]:
        self._change(left, -1)
        return self.open[left].pop()

    def _change(self, left: int, by: int) -> None:
        node = left + self.leaves
        while node:
            self.total[node] += by
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that is open."""
        node = need + self.leaves
        if self.total[node]:
            return need
        while node > 1:
            if not node & 1 and self.total[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.total[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Placement of ``counts[length]`` pieces, and the number of sequences.

    Rows ``(length, low, n, first, each, offset)``: pieces ranked ``low`` to
    ``low + n`` of that length fill sequences ``first`` on, ``each`` to a sequence,
    from ``offset`` on. The result is that of placing one piece at a time."""
    tree, rows, used = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            free = tree.tightest(length)
            if free is None:
                free = capacity
                first, many = used, -(-left // (capacity // length))
                used += many
            else:
                first, many = tree.pop(free)
            each = free // length
            n = min(left, many * each)
            full, rest = divmod(n, each)
            rows.append((length, rank, n, first, each, capacity - free))
            tree.add(free - each * length, first, full)
            if rest:
                tree.add(free - rest * length, first + full, 1)
            spare = full + bool(rest)
            tree.add(free, first + spare, many - spare)
            rank, left = rank + n, left - n
    return rows, used


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (see :func:`token_pieces`) with ``sequence_id`` and ``offset``."""
    blocks = saved(pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r.length: r.n for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = best_fit_decreasing(counts, capacity)
    plan = pieces.sparkSession.createDataFrame(
        rows, "length long, low long, n long, first long, each long, base long")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = (pieces.join(earlier, ["block", "length"])
              .withColumn("rank", F.col("rank") + F.col("earlier")).drop("earlier", "block"))
    step = F.col("rank") - F.col("low")
    return (ranked.join(F.broadcast(plan), "length")  # at most a few rows per length, whatever the input
            .where((step >= 0) & (step < F.col("n")))
            .withColumn("sequence_id", F.col("first") + F.floor(step / F.col("each")))
            .withColumn("offset", F.col("base") + step % F.col("each") * F.col("length"))
            .drop("rank", "low", "n", "first", "each", "base"))


def pack_documents(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """Every document's pieces with their ids and their place in the sequences."""
    return place(saved(token_pieces(docs, capacity=capacity, **options), "pieces"), capacity)


__all__ = ["token_pieces", "best_fit_decreasing", "place", "pack_documents", "CapacityTree"]
