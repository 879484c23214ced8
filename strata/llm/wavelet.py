"""Token-id shards as wavelet matrices: access, counting and occurrences in one file.

A shard holds the ids of consecutive documents. Bit plane by bit plane, from the
highest bit, ids are split stably into zeros and ones; each plane keeps its bits
and a running count of ones per 512 bits. The planes serve access, rank and
select without unpacking the shard.

Documents go to range partitions of ascending id; a shard is closed when it has
``SHARD_TOKENS`` ids. Shards are rows of a table that Spark writes, so a lost
task is written again. Null texts are empty (end id only); null ids come first;
repeated rows are separate documents; an empty table gives no shard.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import saved
from strata.llm.subword import default_vocabulary, encoder
from strata.llm.words import slices

MAGIC = b"WMAT"
BLOCK = 512                # bits between counts
SHARD_TOKENS = 1 << 22
AT_ONCE = 1 << 15          # ids split or merged at once, so that their places stay in the processor's cache


def _split(x: np.ndarray, bit: np.ndarray, out: np.ndarray) -> int:
    """Write the ids without the bit and then those with it to ``out``, in order; how many are without."""
    zeros = len(x) - int(np.count_nonzero(bit))
    low, high = 0, zeros
    for i in range(0, len(x), AT_ONCE):
        part, own = x[i:i + AT_ONCE], bit[i:i + AT_ONCE]
        ones = np.flatnonzero(own)      # a mask's own indexing is slow where its bits change often
        rest = np.flatnonzero(~own)
        out[low:low + len(rest)] = part[rest]
        out[high:high + len(ones)] = part[ones]
        low, high = low + len(rest), high + len(ones)
    return zeros


def _merge(x: np.ndarray, bit: np.ndarray, zeros: int, out: np.ndarray) -> None:
    """What ``_split`` was given, written to ``out``."""
    low, high = 0, zeros
    for i in range(0, len(x), AT_ONCE):
        part, own = out[i:i + AT_ONCE], bit[i:i + AT_ONCE]
        ones = np.flatnonzero(own)
        rest = np.flatnonzero(~own)
        part[rest] = x[low:low + len(rest)]
        part[ones] = x[high:high + len(ones)]
        low, high = low + len(rest), high + len(ones)


class WaveletMatrix:
    """Succinct sequence of non-negative integers below ``2 ** bits``."""

    def __init__(self, size: int, planes: list[np.ndarray], counts: list[np.ndarray], zeros: list[int]):
        self.size, self.planes, self.counts, self.zeros = size, planes, counts, zeros
        self.bits = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        n, planes, counts, zeros, spare = len(x), [], [], [], np.empty_like(x)
        words = -(-n // BLOCK) * (BLOCK // 64)
        for b in range(bits - 1, -1, -1):
            bit = (x >> x.dtype.type(b)) & x.dtype.type(1) != 0
            plane = np.zeros(words, np.uint64)
            packed = np.packbits(bit, bitorder="little")
            plane.view(np.uint8)[:len(packed)] = packed
            ones = np.bitwise_count(plane).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
            planes.append(plane)
            counts.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32))
            zeros.append(_split(x, bit, spare))
            x, spare = spare, x
        return cls(n, planes, counts, zeros)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position ``i``."""
        block, plane = i // BLOCK, self.planes[level]
        at, total = block * (BLOCK // 64), int(self.counts[level][block])
        end = i // 64
        total += int(np.bitwise_count(plane[at:end]).sum())
        if i % 64:
            total += (int(plane[end]) & ((1 << (i % 64)) - 1)).bit_count()
        return total

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            ones = self._ones(level, i)
            bit = int(self.planes[level][i // 64]) >> (i % 64) & 1
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, begin: int, end: int) -> tuple[int, int]:
        for level in range(self.bits):
            if value >> (self.bits - 1 - level) & 1:
                begin, end = (self.zeros[level] + self._ones(level, p) for p in (begin, end))
            else:
                begin, end = (p - self._ones(level, p) for p in (begin, end))
        return begin, end

    def count(self, value: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of ``value`` in positions ``begin`` to ``end``."""
        a, b = self._range(value, begin, self.size if end is None else end)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) such bit of a plane."""
        counts = self.counts[level].astype(np.int64)
        held = counts if bit else np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(held, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * 8:block * 8 + 8].view(np.uint8), bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(held[block])])

    def occurrences(self, value: int) -> list[int]:
        """Positions of ``value`` in ascending order."""
        first, last = self._range(value, 0, self.size)
        found = []
        for i in range(first, last):
            for level in range(self.bits - 1, -1, -1):
                bit = value >> (self.bits - 1 - level) & 1
                i = self._select(level, bit, i - self.zeros[level] if bit else i)
            found.append(i)
        return found

    def decode(self) -> np.ndarray:
        """The whole sequence, merging the planes from the lowest bit up."""
        x = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        spare = np.empty_like(x)
        for level in range(self.bits - 1, -1, -1):
            x[self.zeros[level]:] |= x.dtype.type(1 << (self.bits - 1 - level))
            _merge(x, self._bits(level), self.zeros[level], spare)
            x, spare = spare, x
        return x.astype("<u4")

    def to_bytes(self) -> bytes:
        parts = [MAGIC, struct.pack("<BQ", self.bits, self.size)]
        for plane, counts, zeros in zip(self.planes, self.counts, self.zeros, strict=True):
            parts += [struct.pack("<Q", zeros), counts.astype("<u4").tobytes(), plane.astype("<u8").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        bits, size = struct.unpack_from("<BQ", data, 4)
        at, blocks, planes, counts, zeros = 13, -(-size // BLOCK), [], [], []
        for _ in range(bits):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            counts.append(np.frombuffer(data, "<u4", blocks + 1, at + 8))
            at += 8 + 4 * (blocks + 1)
            planes.append(np.frombuffer(data, "<u8", blocks * (BLOCK // 64), at))
            at += blocks * (BLOCK // 8)
        return cls(size, planes, counts, zeros)


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The shards, written and read again: ``part, shard, ids, lengths, data``.

    ``data`` is the wavelet matrix file; ``ids`` and ``lengths`` name its documents in
    order. Shards in order of ``(part, shard)`` hold the documents in order of id."""
    path = vocabulary or default_vocabulary()

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        bits = max(int(encode.library.get_vocab_size()) - 1, end_id).bit_length()
        names, lengths, parts, size, shard = [], [], [], 0, 0

        def closed():
            matrix = WaveletMatrix.build(np.concatenate(parts), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([shard], pa.int64()),
                 pa.array([names], pa.list_(kind)), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([matrix.to_bytes()], pa.binary())], names=["part", "shard", "ids", "lengths", "data"])
        for batch in batches:
            kind = batch.schema.field(0).type
            for rows in slices(batch):
                bounds, flat = encode(rows.column(1))
                flat = np.insert(flat, bounds[1:], end_id)
                names += rows.column(0).to_pylist()
                lengths += (np.diff(bounds) + 1).tolist()
                parts.append(flat)
                size += len(flat)
                if size >= shard_tokens:
                    yield closed()
                    names, lengths, parts, size, shard = [], [], [], 0, shard + 1
        if parts:
            yield closed()

    kind_sql = docs.schema[id_col].dataType.simpleString()
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text")))
    shards = ordered.mapInArrow(run, f"part long, shard long, ids array<{kind_sql}>, lengths array<long>, data binary")
    return saved(shards, "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents from the files: ``id, start, n_tokens, ids`` (little-endian 32-bit).

    The shards' first places are broadcast, a row for each shard, so that ids are not shuffled."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, names, lengths, data = (batch.column(k).slice(row, 1) for k in range(5))
                lengths = lengths.flatten().to_numpy(zero_copy_only=False)
                raw = WaveletMatrix.from_bytes(data[0].as_buffer()).decode().tobytes()
                ends = np.cumsum(lengths)
                ids = [raw[4 * (b - n):4 * b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                n = len(lengths)
                for a in range(0, n, 1000):
                    b = min(n, a + 1000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part[0].as_py()] * (b - a), pa.int64()),
                         pa.array([shard[0].as_py()] * (b - a), pa.int64()), names.flatten().slice(a, b - a),
                         pa.array((ends - lengths)[a:b]), pa.array(lengths[a:b]), pa.array(ids[a:b], pa.binary())],
                        names=["part", "shard", "id", "inner", "n_tokens", "ids"])

    kind = shards.schema["ids"].dataType.elementType.simpleString()
    docs = shards.mapInArrow(run, f"part long, shard long, id {kind}, inner long, n_tokens long, ids binary")
    sizes = shards.select("part", "shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    past = (Window.unboundedPreceding, -1)
    of_part = (sizes.groupBy("part").agg(F.sum("n").alias("n"))  # one row per partition
               .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*past)), F.lit(0)).alias("p")))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*past)), F.lit(0))
    bases = (sizes.select("part", "shard", inside.alias("s")).join(of_part, "part")
             .select("part", "shard", (F.col("s") + F.col("p")).alias("base")))
    return (docs.join(F.broadcast(bases), ["part", "shard"])
            .select("id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids"))


__all__ = ["WaveletMatrix", "write_shards", "read_shards"]
