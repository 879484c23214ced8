"""Alignment of two tokenizers' tokens and how often their ids meet, corpus-wide.

A text's bytes (a space and the text) are covered once by the tokens of A, a byte-level
BPE, and once by those of B, a piece model. Where tokens of both end, the text is cut
into groups; an A and a B token whose bytes overlap are linked. An id pair's count is
the number of documents that hold it linked.

The counts come from an inverted index: documents are dealt to blocks, and a block has
for each of its id pairs a compressed bitmap of the documents that hold it (16-bit
numbers, or plain bits where these are shorter) and multiplicity planes: bit k of a
document's links less one, for the documents in the bitmap. Blocks hold different
documents, so a pair's bitmaps are merged by adding their population counts; the counts
then go back to the blocks, whose postings add them up per document.

Both tokenizers cut a text before white space that follows something else, so texts are
handled as units of white space and what follows it; a unit is encoded and aligned once
per worker and remembered. Texts are read whole. Texts that are null, empty, or that
either tokenizer does not give back byte by byte have no tokens and all numbers 0.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import saved
from strata.llm.piece_lattice import MARK, default_model
from strata.llm.subword import _WIDE_SPACE, default_vocabulary
from strata.llm.words import bounds_and_bytes, slices, span_hashes

BLOCK_DOCS = 8192          # documents of a block: their numbers fit 16 bits
BLOCK_BYTES = 8 << 20      # text of a block; a longer document is a block of its own
REMEMBERED = 300_000       # units a worker keeps between blocks
PAIR_BITS = 25             # a pair is one number: ids of both vocabularies are below 2**25
_BITSET = BLOCK_DOCS // 8  # bytes of a plain bitmap

MIXED = ("kind int, block long, row int, id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
         "a int, b int, n_docs int, bits binary, planes binary")


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is visible, else the next above 255."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    names, spare = {chr(b): b for b in visible}, 256
    for b in range(256):
        if chr(b) not in names or names[chr(b)] != b:
            names[chr(spare)] = b
            spare += 1
    return names


class _Bytes:
    """Bytes of a vocabulary's entries, as one array."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        at = np.repeat(self.begin[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.data[at].tobytes()


class Aligner:
    """Units of texts to aligned tokens, under one pair of tokenizers."""

    def __init__(self, vocabulary: str, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocabulary)
        self.a.encode_special_tokens = True     # their strings inside texts are plain text
        self.b = b = SentencePieceProcessor(model_file=model)
        names = byte_names()
        self.a_bytes = {i: bytes(names[c] for c in t) if all(c in names for c in t) else t.encode()
                        for t, i in self.a.get_vocab().items()}
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.mark = b.piece_to_id(MARK)
        self.a_table, self.b_table = _Bytes([self.a_bytes.get(i, b"") for i in range(max(self.a_bytes) + 1)]), _Bytes(self.b_bytes)
        # Units are cut only where no piece can lie across and nothing but spaces is changed.
        self.cut = (b.normalize("A é １ ﬁ x") == (MARK + "A é １ ﬁ x").replace(" ", MARK)
                    and not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces) and b.id_to_piece(self.mark) == MARK)
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.groups: list[bytes] = []
        self._rows: list[np.ndarray] = []
        self._links: list[np.ndarray] = []
        self._n_links = 0

    def _alone(self, raw: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of one unit under A and B, or None where either does not give it back."""
        text = raw.decode("utf-8", "replace")
        a = self.a.encode(text, add_special_tokens=False).ids
        # B puts a mark before what it encodes: it stands for a unit's own space, or is taken away again.
        if text[0] == " ":
            b = self.b.encode(text[1:]) if text[1:] else [self.mark]
        else:
            b = self.b.encode(text)[1:]
        same = b"".join(self.a_bytes[i] for i in a) == raw and b"".join(self.b_bytes[i] for i in b) == raw
        return (a, b) if same else None

    def _together(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of units that follow each other as in a text, or None where this cannot be told apart."""
        raw = b" a" + b"".join(raws)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return None
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:], num_threads=1), np.int64)
        ends = np.cumsum([2, *map(len, raws)])
        for ids, table in ((a, self.a_table), (b, self.b_table)):
            if table.joined(ids) != raw or not np.isin(ends, np.cumsum(table.size[ids])).all():
                return None
        return tuple(ids[np.cumsum(table.size[ids]) > 2] for ids, table in ((a, self.a_table), (b, self.b_table)))

    def learn(self, keys: list[int], raws: list[bytes]) -> None:
        """Encodes and aligns new units. Those that end in no white space and hold no mark are
        encoded as one text, since tokens never cross the white space they begin with."""
        plain = [self.cut and len(r) < 4096 and r[-1] > 32 and b"\xe2\x96\x81" not in r
                 and (r[-1] < 128 or not r.decode("utf-8", "replace")[-1].isspace()) for r in raws]
        order = [i for i, p in enumerate(plain) if p]
        found = self._together([raws[i] for i in order]) if order else None
        if found is None:
            order, parts = [], []
        else:
            parts = [found]
        taken = set(order)
        for i, raw in enumerate(raws):
            if i not in taken and (ids := self._alone(raw)) is not None:
                order.append(i)
                parts.append((np.array(ids[0], np.int64), np.array(ids[1], np.int64)))
        rows = np.zeros((len(raws), 7), np.int64)
        texts = [b""] * len(raws)
        if order:
            a, b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            numbers, links, groups = self.align(a, b, np.cumsum([len(raws[i]) for i in order]))
            at = np.array(order)
            rows[at, 0], rows[at, 1:5] = 1, numbers
            upto = self._n_links + np.cumsum(numbers[:, 3])
            rows[at, 5], rows[at, 6] = upto - numbers[:, 3], upto
            self._links.append(links)
            self._n_links += len(links)
            for i, t in zip(order, groups, strict=True):
                texts[i] = t
        first = len(self.groups)
        self.index.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.groups += texts
        self._rows.append(rows)

    def align(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Tokens of units one after the other, whose bytes end at ``ends``: tokens of A and B,
        groups and links per unit; the id pair of every link; and every unit's groups as text, each closed by a semicolon.

        Between two neighbouring token ends there is one token of A and one of B: that is a link."""
        a_end, b_end = np.cumsum(self.a_table.size[a]), np.cumsum(self.b_table.size[b])
        both, cuts = np.intersect1d(a_end, b_end, assume_unique=True), np.union1d(a_end, b_end)
        links = a[np.searchsorted(a_end, cuts)] << PAIR_BITS | b[np.searchsorted(b_end, cuts)]
        upto = np.stack([np.searchsorted(x, ends, "right") for x in (a_end, b_end, both, cuts)], 1)
        numbers = np.diff(upto, axis=0, prepend=0)
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        place = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        ids = np.concatenate([a, b])[place]
        last = np.concatenate([np.append(g[1:] != g[:-1], True) for g in (a_group, b_group)])
        mark = np.where(last, np.repeat([ord("|"), ord(";")], [len(a), len(b)]), ord(",")).astype(np.uint8)[place]
        size = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, 10))
        end = np.cumsum(size + 1)
        out = np.zeros(int(end[-1]), np.uint8)
        out[end - 1] = mark
        for k in range(int(size.max())):
            there = size > k
            out[end[there] - 2 - k] = 48 + ids[there] // 10 ** k % 10
        raw, stop = out.tobytes(), end[upto[:, 0] + upto[:, 1] - 1]
        return numbers, links, [raw[i:j] for i, j in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]

    @property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Per unit: sound, tokens of A and B, groups, links, place of its links; per place: the id pair."""
        if len(self._rows) > 1:
            self._rows, self._links = [np.concatenate(self._rows)], [np.concatenate(self._links)] if self._links else []
        return (self._rows[0] if self._rows else np.zeros((0, 7), np.int64),
                self._links[0] if self._links else np.zeros(0, np.int64))

    def starts(self, bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where units begin: each text, and each space or newline after a byte that is not white space."""
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        if not self.cut or not len(data):
            return first
        solid = data > 32
        for lead, low, high in _WIDE_SPACE:
            at = np.flatnonzero(data[:len(data) - len(lead)] == lead[0])
            hit = (data[at + len(lead)] >= low[0]) & (data[at + len(lead)] <= high[0])
            for k in range(1, len(lead)):
                hit &= data[at + k] == lead[k]
            solid[at[hit] + len(lead)] = False
        cuts = np.flatnonzero(((data[1:] == 32) | (data[1:] == 10)) & solid[:-1]) + 1
        return np.union1d(first, cuts)

    def units(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text number and unit number of every unit; texts that are null or empty have none."""
        column = column.cast(pa.large_string())
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string()))
        bounds, data = bounds_and_bytes(pc.if_else(pc.equal(pc.fill_null(pc.binary_length(column), 0), 0),
                                                   pa.scalar("", pa.large_string()), spaced))
        starts = self.starts(bounds, data)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data))
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        known = [self.index.get(k) for k in keys.tolist()]
        new = [i for i, k in enumerate(known) if k is None]
        if new:
            raw = data.tobytes()
            self.learn(keys[new].tolist(), [raw[starts[i]:ends[i]] for i in first[new].tolist()])
            known = [self.index[k] for k in keys.tolist()]
        return np.searchsorted(bounds, starts, "right") - 1, np.array(known, np.int64)[inverse]


@functools.lru_cache(maxsize=2)
def aligner(vocabulary: str, model: str) -> Aligner:
    """One aligner per worker process and pair of tokenizers."""
    return Aligner(vocabulary, model)


class _Block:
    """Documents and postings of one block."""

    def __init__(self, number: int, align: Aligner):
        self.number, self.align, self.docs, self.size = number, align, 0, 0
        self.parts: list[tuple] = []
        if len(align.index) > REMEMBERED:
            align.forget()

    def add(self, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """Takes documents in and returns their rows."""
        text, unit = self.align.units(texts)
        rows, n = self.align.tables[0], len(texts)
        bad = np.bincount(text[rows[unit, 0] == 0], minlength=n) > 0
        keep = ~bad[text] if len(text) else np.zeros(0, bool)
        text, unit = text[keep], unit[keep]
        sums = [np.zeros(n, np.int64) for _ in range(4)]
        for k, out in enumerate(sums):
            np.add.at(out, text, rows[unit, k + 1])
        groups, at = self.align.groups, np.searchsorted(text, np.arange(n + 1))
        units = unit.tolist()
        digests = [hashlib.sha256(b"".join(map(groups.__getitem__, units[i:j]))[:-1]).hexdigest() if j > i else ""
                   for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        both, times = np.unique(text * max(len(rows), 1) + unit, return_counts=True)
        self.parts.append((both // max(len(rows), 1) + self.docs, both % max(len(rows), 1), times))
        place = np.arange(self.docs, self.docs + n, dtype=np.int32)
        self.docs += n
        return _mixed(n, kind=np.zeros(n, np.int32), block=np.full(n, self.number), row=place, id=ids.cast(pa.int64()),
                      n_a=sums[0], n_b=sums[1], n_groups=sums[2], n_links=sums[3], groups=pa.array(digests, pa.string()))

    def postings(self) -> pa.RecordBatch:
        """A row per id pair: the documents that hold it as a compressed bitmap, and planes of their links."""
        doc, unit, times = (np.concatenate(x) if self.parts else np.zeros(0, np.int64) for x in zip(*self.parts, strict=True))
        rows, pairs = self.align.tables
        size = rows[unit, 6] - rows[unit, 5]
        at = np.repeat(rows[unit, 5] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        links = np.repeat(times, size)
        key = pairs[at] * BLOCK_DOCS + np.repeat(doc, size)
        order = np.argsort(key, kind="stable")
        key, links = key[order], links[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        links = np.add.reduceat(links, first) if len(first) else links
        key = key[first]
        pair, doc = key // BLOCK_DOCS, (key % BLOCK_DOCS).astype("<u2")
        begin = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
        end = np.append(begin[1:], len(pair))
        most = np.maximum.reduceat(links, begin) if len(begin) else links
        raw, bits, planes = doc.tobytes(), [], []
        for i, j, m in zip(begin.tolist(), end.tolist(), most.tolist(), strict=True):
            if 2 * (j - i) > _BITSET:
                plain = np.zeros(BLOCK_DOCS, bool)
                plain[doc[i:j]] = True
                bits.append(np.packbits(plain).tobytes())
            else:
                bits.append(raw[2 * i:2 * j])
            planes.append(b"".join(np.packbits(links[i:j] - 1 >> k & 1).tobytes() for k in range((m - 1).bit_length())))
        names = pair[begin]
        n = len(begin)
        return _mixed(n, kind=np.ones(n, np.int32), block=np.full(n, self.number), a=(names >> PAIR_BITS).astype(np.int32),
                      b=(names & (1 << PAIR_BITS) - 1).astype(np.int32), n_docs=(end - begin).astype(np.int32),
                      bits=pa.array(bits, pa.binary()), planes=pa.array(planes, pa.binary()))


_TYPES = {"kind": pa.int32(), "block": pa.int64(), "row": pa.int32(), "id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
          "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string(), "a": pa.int32(), "b": pa.int32(),
          "n_docs": pa.int32(), "bits": pa.binary(), "planes": pa.binary()}


def _mixed(n: int, **columns) -> pa.RecordBatch:
    """Rows of documents (kind 0) or of postings (kind 1); what is not given is null."""
    arrays = [pa.nulls(n, t) if name not in columns else columns[name] if isinstance(columns[name], pa.Array)
              else pa.array(columns[name], t) for name, t in _TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_TYPES))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str | None = None, model: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Aligned documents ``(block, row, id, n_a, n_b, n_groups, n_links, groups)`` and the
    postings ``(block, a, b, n_docs, bits, planes)`` of their id pairs, both saved."""
    a, b = vocabulary or default_vocabulary(), model or default_model()

    def run(batches) -> Iterator[pa.RecordBatch]:
        align, base, k, block = aligner(a, b), TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            for part in slices(batch):
                size = part.column(1).nbytes
                if block and (block.docs + part.num_rows > BLOCK_DOCS or block.size + size > BLOCK_BYTES):
                    yield block.postings()
                    block = None
                for begin in range(0, part.num_rows, BLOCK_DOCS):
                    rows = part.slice(begin, BLOCK_DOCS)
                    if block and block.docs + rows.num_rows > BLOCK_DOCS:
                        yield block.postings()
                        block = None
                    if block is None:
                        block, k = _Block(base + k, align), k + 1
                    block.size += size
                    yield block.add(rows.column(0), rows.column(1))
        if block:
            yield block.postings()

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    both = saved(plain.mapInArrow(run, MIXED), "alignment")
    return (both.where("kind = 0").select(F.col("block").alias("block"), "row", "id", "n_a", "n_b", "n_groups", "n_links", "groups"),
            both.where("kind = 1").select("block", "a", "b", "n_docs", "bits", "planes"))


def unpack(n_docs: int, bits: bytes, planes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a posting and the links of each."""
    if 2 * n_docs > _BITSET:
        docs = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))
    else:
        docs = np.frombuffer(bits, "<u2").astype(np.int64)
    links, width = np.ones(n_docs, np.int64), -(-n_docs // 8)
    for k in range(len(planes) // width):
        plane = np.frombuffer(planes, np.uint8, width, k * width)
        links += np.unpackbits(plane, count=n_docs).astype(np.int64) << k
    return docs, links


def pair_counts(postings: DataFrame) -> DataFrame:
    """``(a, b, docs, best)``: documents that hold each pair linked, and whether that is the A id's highest.

    Only population counts are shuffled, added up in each task first."""
    counts = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("docs"))
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """Per document: ``n_a, n_b, n_groups, n_links``, ``n_best`` (links whose pair is the most
    frequent of its A id, ties included), ``count_sum`` (the pairs' counts added over the
    links) and ``groups_sha256`` ('' without tokens).

    Null ids and repeated ids are separate documents, each counted; an empty table gives an
    empty result; other columns than the two are not read."""
    found, postings = index(docs, id_col, text_col, vocabulary, model)
    known = postings.join(pair_counts(postings), ["a", "b"]).select("block", "n_docs", "bits", "planes", "docs", "best")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.column("row").to_numpy()
        n = int(rows.max()) + 1 if len(rows) else 0
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        n_docs, freq = right.column("n_docs").to_numpy(), right.column("docs").to_numpy()
        first = right.column("best").to_numpy()
        bits, planes = right.column("bits"), right.column("planes")
        flat = ((2 * n_docs <= _BITSET) & (pc.binary_length(planes).to_numpy() == 0))
        if flat.any():      # most pairs: a short list of documents, one link in each
            at = np.frombuffer(b"".join(bits.filter(pa.array(flat)).to_pylist()), "<u2")
            np.add.at(total, at, np.repeat(freq[flat], n_docs[flat]))
            np.add.at(best, at, np.repeat(first[flat], n_docs[flat]).astype(np.int64))
        rest = np.flatnonzero(~flat)
        kept = right.select(["bits", "planes"]).take(pa.array(rest))
        for i, b, p in zip(rest.tolist(), kept.column("bits").to_pylist(), kept.column("planes").to_pylist(), strict=True):
            at, links = unpack(int(n_docs[i]), b, p)
            total[at] += links * freq[i]
            if first[i]:
                best[at] += links
        return pa.table([left.column("id"), *[left.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
                         pa.array(best[rows]), pa.array(total[rows]), left.column("groups")], names=_RESULT)

    out = found.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        add, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)


_RESULT = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

__all__ = ["Aligner", "aligner", "index", "unpack", "pair_counts", "align_tokenizers"]
