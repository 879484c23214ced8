"""Removal of passages that repeat across documents, by hashing units of lines.

A unit is a line, cut after sentence ends so that a passage inside a line is
made of whole units too. Units are normalised (A-Z lower-cased, white space as
one gap) and hashed; one of fewer than ``unit_words`` words is hashed with as many
units after it as make up ``unit_words``. As a passage may lie inside a unit or in
lines broken elsewhere, the words are fingerprinted as well: of every ``min_words``
words in a row the run of ``GRAM`` words of least hash, so that each repeated
passage has a digest in common with its repeats.

Digests seen more than once point at the places where texts may repeat. There every
run of ``min_words`` words is hashed and grouped over all documents, so a passage
reaches to its first and last word, not to whole units. The earliest occurrence of a
run, ranked by document id and place, is kept; the words of every other occurrence
are a repeat and are removed, but never those of the earliest if they overlap.
Removed spans are byte offsets into the original UTF-8 text.

Null texts stay null and have no words. Rows of one id and equal text are one
occurrence and are treated alike; null ids rank first. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.llm.bitmap import bitmap, hit, may_be_in
from strata.llm.graph import saved
from strata.llm.words import _LOWER, bounds_and_bytes, mix, run_hashes, slices, span_hashes, word_spans
from strata.session import small_batches

UNIT_WORDS = 4
MIN_WORDS = 30
GRAM = 8             # words of a fingerprint
HELD = 1 << 20       # digests, or runs, dealt together
PARTS_EACH = 32      # parts that digests are dealt to, per partition of the input
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


class Layout:
    """Words of some texts: their hashes, offsets per text and bytes."""

    def __init__(self, column: pa.Array):
        self.bounds, self.data = bounds_and_bytes(column)
        self.starts, self.ends, self.offsets = word_spans(self.bounds, self.data)
        self.hashes = span_hashes(_LOWER[self.data], self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)
        self.text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.offsets))

    def digests(self, head: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Digest of each run of words."""
        return mix(run_hashes(self.hashes, head, end) + (end - head).astype(np.uint64))

    def units(self, unit_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of every unit, short ones with units after them."""
        lines = np.concatenate([[0], np.cumsum(self.data == 10)])
        last = _STOP[self.data[self.ends - 1]]
        last[:-1] |= lines[self.starts[1:]] > lines[self.ends[:-1]]
        last[self.offsets[1:][self.offsets[1:] > self.offsets[:-1]] - 1] = True
        end = np.flatnonzero(last) + 1
        head = np.concatenate([[0], end[:-1]])
        to = np.searchsorted(end, head + unit_words)
        whole = to < len(end)
        head, end = head[whole], end[to[whole]]
        whole = self.text[head] == self.text[end - 1]
        return head[whole], end[whole]

    def runs(self, words: int) -> np.ndarray:
        """First word of every run of ``words`` words within one text."""
        head = np.arange(max(0, len(self.hashes) - words + 1))
        return head[self.text[head] == self.text[head + words - 1]]

    def fingerprints(self, gram: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of each run of ``gram`` words that has the least hash of some ``min_words`` words."""
        runs, n = self.runs(min_words), len(self.hashes) - gram + 1
        if not len(runs):
            return (np.zeros(0, np.int64),) * 2
        head, width = np.arange(n), min_words - gram + 1
        own = mix(run_hashes(self.hashes, head, head + gram)) | np.uint64(1)
        least = np.zeros(n + width - 1, np.uint64)       # by run, after ``width - 1`` places; 0 where there is none
        least[runs + width - 1] = _slid(own, width, np.minimum)[runs]
        head = np.flatnonzero(_slid(least, width, np.maximum)[:n] == own)
        return head, head + gram

    def anchors(self, unit_words: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and digest of all units and fingerprints."""
        if not len(self.hashes):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        both = [self.units(unit_words), self.fingerprints(min(GRAM, min_words), min_words)]
        head, end = (np.concatenate(x) for x in zip(*both, strict=True))
        return head, end, self.digests(head, end)


def _slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each ``width`` values in a row."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def _split(key: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple]:
    """Each key below ``parts`` that occurs in the sorted ``key``, with its rows of ``columns``."""
    bounds = np.searchsorted(key, np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        yield i, [c[bounds[i]:bounds[i + 1]] for c in columns]


def _packed(columns: list[np.ndarray]) -> bytes:
    """64-bit columns in planes of 16 bits, as the upper ones of small numbers take no room once compressed."""
    return b"".join(np.ascontiguousarray(c.view("<u2").reshape(-1, 4).T).tobytes() for c in columns)


def _unpacked(values: pa.ChunkedArray, columns: int) -> list[np.ndarray]:
    """The columns of all rows of :func:`_packed` bytes, joined."""
    rows = [np.frombuffer(v.as_buffer(), "<u2").reshape(columns, 4, -1).transpose(0, 2, 1) for v in values if len(v.as_buffer())]
    if not rows:
        return [np.zeros(0, np.int64)] * columns
    return list(np.ascontiguousarray(np.concatenate(rows, axis=1)).view("<i8")[..., 0])


def _again(texts: DataFrame, unit_words: int, min_words: int, parts: int) -> np.ndarray:
    """Bitmap of the anchors that occur more than once (and of a few more: 32 bits and the part tell them apart)."""
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def anchors(batches) -> Iterator[pa.RecordBatch]:
        def out():
            digest, n = np.unique(np.concatenate(held), return_counts=True)
            digest = np.repeat(digest, np.minimum(n, 2))
            rows = [(i, own.tobytes()) for i, (own,) in _split(digest >> shift, parts, digest.astype("<u4"))]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())],
                                              names=["part", "digests"])
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text=2):
                held.append(Layout(part.column(2)).anchors(unit_words, min_words)[2])
                size += len(held[-1])
                if size >= HELD:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def seen(table: pa.Table) -> pa.Table:
        digest, n = np.unique(np.concatenate([np.frombuffer(v.as_buffer(), "<u4") for v in table["digests"]]), return_counts=True)
        return pa.table({"cell": digest[n > 1].astype(np.int64)})
    return bitmap(texts.mapInArrow(anchors, "part int, digests binary").groupBy("part").applyInArrow(seen, "cell long"))


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, begin and end of the ranges, in order of document and begin, with those that meet made one."""
    reach = np.maximum.accumulate((doc << 32) + end)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] << 32) + begin[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], begin[at], reach[np.append(at[1:], len(doc)) - 1] & 0xFFFFFFFF if len(at) else reach


def _numbered(k: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Number of each row's document, from sorted rows."""
    return np.cumsum(np.concatenate([[0], (k[1:] != k[:-1]) | (order[1:] != order[:-1])])[:len(k)]).astype(np.int64)


def _run_rows(texts: DataFrame, unit_words: int, min_words: int, parts: int) -> DataFrame:
    """``(part, runs, known)``: runs of ``min_words`` words that hold, or lie in, an anchor seen again.

    ``runs`` has digest, ``k``, order and place of runs dealt by digest; of those read together only
    the ones in the text of the earliest. The others are repeats already: ``known`` has their ranges."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(_again(texts, unit_words, min_words, parts))
    twins = texts.groupBy("k").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi")
    several = context.broadcast(bitmap(twins.select(F.col("k").alias("cell"))))
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def found(held: list) -> pa.RecordBatch:
        k, order, many, place, digest = (np.concatenate(x) for x in zip(*held, strict=True))
        rank = np.lexsort((order, k))
        begin = (np.cumsum(many) - many)[rank]
        k, order, many = k[rank], order[rank], many[rank]
        doc = _numbered(k, order)
        many[1:][doc[1:] == doc[:-1]] = 0            # rows of one id and text are one occurrence
        of = np.repeat(np.arange(len(k)), many)      # runs by document and place
        runs = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(len(of))
        place, digest, number = place[runs], digest[runs], doc[of]
        sort = np.argsort(digest, kind="stable")
        digest, of, place, number = digest[sort], of[sort], place[sort], number[sort]
        new = np.ones(len(digest), bool)
        new[1:] = digest[1:] != digest[:-1]
        own = number == number[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        rows = [(i, _packed(c), b"") for i, c in _split(
            digest[own] >> shift, parts, digest[own].view(np.int64), k[of[own]], order[of[own]], place[own])]
        again = np.sort((of[~own] << 32) + place[~own])
        of, begin, end = _merged(again >> 32, again & 0xFFFFFFFF, (again & 0xFFFFFFFF) + min_words)
        part = (mix(k[of].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        sort = np.argsort(part, kind="stable")
        rows += [(i, b"", _packed(c)) for i, c in _split(
            part[sort], parts, k[of][sort], order[of][sort], begin[sort], (end - begin)[sort])]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(
            pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], names=["part", "runs", "known"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text=2):
                own = Layout(part.column(2))
                head, end, digest = own.anchors(unit_words, min_words)
                seen = hit(shared.value, digest)
                head, end = head[seen], end[seen]
                change = np.zeros(len(own.hashes) + 1, np.int64)
                np.add.at(change, np.maximum(own.offsets[own.text[head]], np.minimum(head, end - min_words)), 1)
                np.add.at(change, np.maximum(head, end - min_words) + 1, -1)
                runs = own.runs(min_words)
                runs = runs[np.cumsum(change)[runs] > 0]
                text = own.text[runs]
                k = part.column(0).to_numpy()
                held.append((k, np.where(hit(several.value, k), part.column(1).to_numpy() | 1, 0),
                             np.bincount(text, minlength=len(k)), runs - own.offsets[text], own.digests(runs, runs + min_words)))
                size += len(runs) + len(k)
                if size >= HELD:
                    yield found(held)
                    held, size = [], 0
        if held:
            yield found(held)

    return texts.mapInArrow(run, "part int, runs binary, known binary")


def repeats(texts: DataFrame, unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """``(k, order, places)``: first word and end of what each text of ``texts(k, mark, text)`` has that occurs earlier elsewhere.

    ``k`` is the rank of a text's id. ``order`` is 0, or ``mark | 1`` where texts of one ``k`` may differ."""
    parts = 1 << (PARTS_EACH * texts.rdd.getNumPartitions() - 1).bit_length()
    blocks = max(1, parts // 4)

    def pick(table: pa.Table) -> pa.Table:
        digest, k, order, place = _unpacked(table["runs"], 4)
        sort = np.argsort(digest, kind="stable")
        same = digest[sort[1:]] == digest[sort[:-1]]
        several = np.zeros(len(sort), bool)
        several[1:] = same
        several[:-1] |= same
        sort = sort[several]
        sort = sort[np.lexsort((place[sort], order[sort], k[sort], digest[sort]))]
        digest, k, order, place = digest[sort], k[sort], order[sort], place[sort]
        new = np.ones(len(digest), bool)
        new[1:] = digest[1:] != digest[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        same = (k == k[first]) & (order == order[first])
        # Where a text repeats itself at once, the words of the earliest run stay.
        begin = np.where(same, np.maximum(place, place[first] + min_words), place)
        away = ~same | (place != place[first])
        known = _unpacked(table["known"], 4)
        k, order, begin, size = (np.concatenate([a[away], b]) for a, b in zip(
            (k, order, begin, place + min_words - begin), known, strict=True))
        block = (mix(k.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)
        sort = np.argsort(block, kind="stable")
        rows = [(i, _packed(c)) for i, c in _split(block[sort], blocks, k[sort], order[sort], begin[sort], size[sort])]
        return pa.table({"block": pa.array([i for i, _ in rows], pa.int32()), "ranges": pa.array([r for _, r in rows], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        k, order, begin, size = _unpacked(table["ranges"], 4)
        sort = np.lexsort((begin, order, k))
        k, order, begin, size = k[sort], order[sort], begin[sort], size[sort]
        doc = _numbered(k, order)
        first = np.searchsorted(doc, np.arange(doc[-1] + 2))
        doc, begin, end = _merged(doc, begin, begin + size)
        places = pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["begin", "end"])
        ends = np.searchsorted(doc, np.arange(len(first))).astype(np.int32)
        return pa.table({"k": k[first[:-1]], "order": order[first[:-1]], "places": pa.ListArray.from_arrays(pa.array(ends), places)})

    return (_run_rows(texts, unit_words, min_words, parts)
            .groupBy("part").applyInArrow(pick, "block int, ranges binary")
            .groupBy("block").applyInArrow(gather, "k long, order long, places array<struct<begin: int, end: int>>"))


def _ranked(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``__k``, a long in the order of the ids, nulls first: the id itself if that can be."""
    least = -(1 << 63)
    if isinstance(docs.schema[id_col].dataType, IntegralType) and docs.where(F.col(id_col) == least).isEmpty():
        return docs.withColumn("__k", F.coalesce(F.col(id_col).cast("long"), F.lit(least)))
    ids = docs.select(F.col(id_col).alias("__id")).distinct().orderBy("__id").withColumn("__k", F.monotonically_increasing_id())
    return docs.join(saved(ids, "ids"), F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")


def _spans(starts: np.ndarray, ends: np.ndarray, base: int, places: pa.StructScalar) -> list[tuple[int, int]]:
    """Byte spans of the words in the ranges ``places``; ranges that meet are one."""
    begin, end = (places.values.field(k).to_numpy() for k in (0, 1))
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8)]))
    return [(int(starts[a] - base), int(ends[b - 1] - base))
            for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True)]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from the text, and ``removed_spans``.

    A cut leaves a newline where words stood on both sides of it."""
    rest = [c for c in docs.columns if c != text_col]
    mark, ranked = F.xxhash64(text_col), _ranked(docs, id_col)
    with small_batches(docs.sparkSession):
        found = repeats(ranked.select(F.col("__k").alias("k"), mark.alias("mark"), F.col(text_col).alias("text")), unit_words, min_words)
        found = saved(found.select(F.col("k").alias("__of"), F.col("order").alias("__order"), F.col("places").alias("__places")), "repeats")
    own = (F.col("__order") == 0) | (F.col("__order") == mark.bitwiseOR(F.lit(1).cast("long")))
    # Texts that have no repeat are not sent on: a bitmap of those that have some lets few others through.
    may_have = may_be_in(found.select(F.xxhash64("__of").alias("cell")))(F.xxhash64("__k"))
    joined = ranked.where(may_have).join(found, (F.col("__k") == F.col("__of")) & own, "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col), F.col("__places"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text=len(rest)):
                column, places = part.column(len(rest)), part.column(len(rest) + 1)
                spans: list = [[] for _ in range(part.num_rows)]
                touched = np.flatnonzero(~places.is_null().to_numpy(zero_copy_only=False))
                texts = column.to_pylist() if len(touched) else None
                if len(touched):
                    own = Layout(column)
                    for i in touched.tolist():
                        words = slice(own.offsets[i], own.offsets[i + 1])
                        spans[i] = _spans(own.starts[words], own.ends[words], own.bounds[i], places[i])
                        if spans[i]:
                            raw, kept, cut = texts[i].encode(), [], 0
                            for x, y in [*spans[i], (None, None)]:
                                kept.append(raw[cut:x].strip() if cut else raw[cut:x].rstrip())
                                cut = y
                            texts[i] = b"\n".join(k for k in kept if k).decode()
                    column = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(rest)], column,
                     pa.array([[{"begin": a, "end": b} for a, b in s] for s in spans],
                              pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                    names=[*(f"c{k}" for k in range(len(rest) + 1)), "removed"])

    kinds = [joined.schema[i].dataType.simpleString() for i in range(len(rest) + 1)]
    schema = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    removed = "array<struct<begin: bigint, end: bigint>>"
    cut = joined.mapInArrow(run, f"{schema}, removed {removed}")
    named = {c: F.col(f"c{i}") for i, c in enumerate([*rest, text_col])}
    cut = cut.select(*[named[c].alias(c) for c in docs.columns], F.col("removed").alias("removed_spans"))
    whole = ranked.where(~may_have).select(*[F.col(f"`{c}`") for c in docs.columns], F.array().cast(removed).alias("removed_spans"))
    return whole.union(cut)


__all__ = ["Layout", "repeats", "remove_repeats"]
