"""N-best piece segmentation: forward Viterbi, then backward A* over the lattice.

The lattice of a text has an arc for every vocabulary piece between two positions;
the score of a path is the sum of its pieces' scores, and a character without piece
costs ``UNKNOWN`` and is written as its byte pieces. No piece crosses the start of a
space mark, so the lattice falls apart into words: best and second-best forward
scores of many new words are computed together in numpy and remembered per worker,
with the best segmentation by back pointers; the A* search, guided by the exact forward
scores, lists the segmentations of words of more than ``WIDE`` characters and of the few
words whose alternatives can be among a text's N best. The second to the last of these
are a text's best ids with the listed alternatives of those words in their places.

Null and empty texts have no pieces and score 0. Decoding joins pieces and bytes,
turns marks into spaces and drops the leading one.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.subword import Encoder
from strata.llm.words import slices

MARK = "▁"
WIDE = 32              # characters of the longest word handled in numpy
LISTED = 1 << 16       # words whose segmentations are remembered per worker
_UNITS = re.compile(MARK + r"+[^" + MARK + r"\n]*|[^" + MARK + r"\n]+|\n")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _mixed(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(29))


class Lattice(Encoder):
    """Best and n-best segmentations of texts under a piece model."""

    space_first = True
    has_extra = True

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor
        self.model = sp = SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.scores = np.array([sp.get_score(i) for i in range(n)])
        self.pieces = {names[i]: i for i in plain}
        self.longest = max(map(len, self.pieces))
        self.unknown = min((self.scores[i] for i in plain if self.scores[i] > -1e8), default=0.0) - 10
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown_id = sp.unk_id()
        # A character without piece is paid with the first of its bytes.
        self.cost = np.append(self.scores, 0.0)
        self.cost[self.unknown_id] = self.unknown
        for b, i in self.bytes.items():
            self.cost[i] = 0.0 if b & 0xC0 == 0x80 else self.unknown
        of_byte = {i: b for b, i in self.bytes.items()}
        self.output = [bytes([of_byte[i]]) if i in of_byte else b"" if sp.is_control(i) else names[i].replace(MARK, " ").encode()
                       for i in range(n)]
        # Texts are cut into words only if the model changes nothing but spaces.
        sample = "A é １ ﬁ x"
        self.identity = sp.normalize(sample) == MARK + sample.replace(" ", MARK)
        self.added = [MARK.encode()]
        self.line_end = np.array(self.best("\n")[0], "<u4")
        h = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(h)
        self.hashes, self.hash_ids = h[order], np.array(list(self.pieces.values()))[order]
        self.lists: dict[str, list[tuple[float, tuple[int, ...]]]] = {}
        self._tables()

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_ODD) + ord(c) + 1) & (1 << 64) - 1
        return h ^ h >> 29

    def _arcs(self, word: str, end: int) -> Iterator[tuple[int, int, float]]:
        """Start, piece id (or -1 for a character without piece) and score of arcs to ``end``."""
        for begin in range(max(0, end - self.longest), end):
            piece = self.pieces.get(word[begin:end])
            if piece is not None:
                yield begin, piece, self.scores[piece]
        if word[end - 1:end] not in self.pieces:
            yield end - 1, -1, self.unknown

    def spelled(self, char: str) -> tuple[int, ...]:
        """Byte pieces of a character without piece, or the unknown piece."""
        return tuple(self.bytes[b] for b in char.encode()) if self.bytes else (self.unknown_id,)

    def forward(self, word: str) -> list[float]:
        """Best score from the start to every position."""
        best = [0.0]
        for end in range(1, len(word) + 1):
            best.append(max(best[a] + s for a, _, s in self._arcs(word, end)))
        return best

    def nbest(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations, best first.

        Paths grow from the end; the forward score of where a path has got to is
        exactly the best way to complete it, so paths leave the queue in order. Of
        equal totals the path with least left goes first, then the one of lower ids."""
        best, found = self.forward(word), []
        queue: list[tuple[float, int, tuple[int, ...], float]] = [(-best[-1], len(word), (), 0.0)]
        while queue and len(found) < n:
            total, at, path, done = heapq.heappop(queue)
            if not at:
                found.append((-total, path))
                continue
            for begin, piece, score in self._arcs(word, at):
                own = (piece,) if piece >= 0 else self.spelled(word[begin:at])
                heapq.heappush(queue, (-(best[begin] + score + done), begin, own + path, done + score))
        return found

    def best(self, text: str) -> tuple[tuple[int, ...], float]:
        found = [self.nbest(u, 1)[0] for u in _UNITS.findall(text)]
        return tuple(i for _, ids in found for i in ids), sum(s for s, _ in found)

    def whole(self, text: str) -> list[int]:
        return list(self.best(self.model.normalize(text))[0])

    def _ids_of(self, words: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Best ids of words, and how much worse their second-best segmentation is."""
        words = [w.replace(" ", MARK) for w in words]
        out: list = [None] * len(words)
        worse = np.full(len(words), np.inf)
        for size, rows in itertools.groupby(sorted(range(len(words)), key=lambda i: len(words[i])),
                                            key=lambda i: len(words[i])):
            rows = list(rows)
            if size > WIDE:
                for i in rows:
                    two = self.nbest(words[i], 2)
                    out[i] = list(two[0][1])
                    worse[i] = two[0][0] - two[1][0] if len(two) > 1 else np.inf
                continue
            chars = np.array([list(map(ord, words[i])) for i in rows], np.uint64)
            first, second, arcs = self._viterbi(chars)
            worse[rows] = first[:, -1] - second[:, -1]
            for k, i in enumerate(rows):
                at, path = size, []
                while at:
                    begin, piece = arcs[at][0][k], int(arcs[at][1][k])
                    path.append([piece] if piece >= 0 else self.spelled(words[i][begin:at]))
                    at = int(begin)
                out[i] = [p for part in reversed(path) for p in part]
        return out, worse

    def _viterbi(self, chars: np.ndarray):
        """Two best forward scores of words of one length, and the best arc to each position."""
        n, size = chars.shape
        first, second = np.full((n, size + 1), -np.inf), np.full((n, size + 1), -np.inf)
        first[:, 0] = 0
        arcs: list = [None]
        found, h = [], np.zeros((n, size), np.uint64)
        for length in range(1, min(size, self.longest) + 1):
            span = size - length + 1
            h = h[:, :span] * _ODD + chars[:, length - 1:] + np.uint64(1)
            key = _mixed(h)
            at = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
            hit = self.hashes[at] == key
            ids = np.where(hit, self.hash_ids[at], -1)
            found.append((ids, np.where(hit, self.scores[self.hash_ids[at]], self.unknown if length == 1 else -np.inf)))
        for end in range(1, size + 1):
            begin, piece = np.zeros(n, np.int64), np.full(n, -1)
            for length in range(min(end, self.longest), 0, -1):
                a = end - length
                ids, score = found[length - 1]
                one, two = first[:, a] + score[:, a], second[:, a] + score[:, a]
                better = one > first[:, end]
                second[:, end] = np.maximum(np.maximum(np.minimum(one, first[:, end]), second[:, end]), two)
                begin[better], piece[better] = a, ids[better, a]
                first[:, end] = np.maximum(first[:, end], one)
            arcs.append((begin, piece))
        return first, second, arcs

    def listed(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        if len(self.lists) > LISTED:
            self.lists.clear()
        if word not in self.lists:
            self.lists[word] = self.nbest(word, n)
        return self.lists[word]

    def combined(self, units: list[str], n: int) -> list[tuple[float, tuple[int, ...]]]:
        """How much worse than the best a text's ``n`` best segmentations are, and which
        of its segmentations each unit has in them.

        A segmentation that differs in another unit than the ``n - 1`` with the
        closest alternatives is no better than each of these alone."""
        found: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for own in (self.listed(u, n) for u in units):
            found = heapq.nlargest(n, ((a + s - own[0][0], (*p, k)) for a, p in found for k, (s, _) in enumerate(own)),
                                   key=lambda x: x[0])
        return found

    def variants(self, ids: np.ndarray, units: list[str], places: list[int], picks: list[tuple[int, ...]], n: int) -> list[np.ndarray]:
        """A text's best ids with other segmentations of ``units``, which begin at ``places``."""
        order = sorted(range(len(units)), key=lambda j: places[j])
        out = []
        for pick in picks:
            parts, at = [], 0
            for j in order:
                if pick[j]:
                    own = self.listed(units[j], n)
                    parts += [ids[at:places[j]], np.array(own[pick[j]][1], "<u4")]
                    at = places[j] + len(own[0][1])
            out.append(np.concatenate([*parts, ids[at:]]))
        return out

    def encode(self, column: pa.Array, n: int):
        """Offsets and ids of each text's best segmentation, its score, and scores and ids of the ``n`` best."""
        texts = column
        if not self.identity:
            texts = pa.array([self.model.normalize(t or "")[1:].replace(MARK, " ") for t in column.to_pylist()], pa.string())
        bounds, flat = self(texts)
        rows = len(bounds) - 1
        score = np.zeros(rows)
        known = self.cost[flat]
        filled = bounds[:-1] < bounds[1:]
        score[filled] = np.add.reduceat(known, bounds[:-1][filled]) if filled.any() else 0
        listed: list = [([], [])] * rows
        if self.seen is None:
            return bounds, flat, score, listed
        data, text, starts, ends, spaced, extra, odd = self.seen
        order = np.lexsort((extra, text))
        begin = np.searchsorted(text[order], np.arange(rows + 1))
        raw = data.tobytes()

        def unit(j: int) -> str:
            return (MARK if spaced[j] else "") + raw[starts[j]:ends[j]].decode()

        def best_of(i: int, units: list[str], places: list[int]):
            ids = flat[bounds[i]:bounds[i + 1]]
            found = self.combined(units, n)
            return ([float(score[i] + d) for d, _ in found],
                    [ids, *self.variants(ids, units, places, [p for _, p in found[1:]], n)])
        for i in np.flatnonzero(filled & ~odd).tolist():
            own = order[begin[i]:begin[i + 1]][:n - 1]
            own = own[np.isfinite(extra[own])]
            listed[i] = best_of(i, [unit(j) for j in own], (self.at[own] - bounds[i]).tolist())
        for i in np.flatnonzero(odd).tolist():
            units = _UNITS.findall(self.model.normalize(texts[i].as_py()))
            places = np.cumsum([0, *(len(self._first(u)) for u in units)]).tolist()
            own = sorted(range(len(units)), key=lambda k: self._margin(units[k]))[:n - 1]
            listed[i] = best_of(i, [units[k] for k in own], [places[k] for k in own])
        return bounds, flat, score, listed

    def _first(self, unit: str) -> tuple[int, ...]:
        return (self.lists[unit] if unit in self.lists else self.nbest(unit, 1))[0][1]

    def _margin(self, unit: str) -> float:
        two = self.listed(unit, 2)[:2] if unit in self.lists else self.nbest(unit, 2)
        return two[0][0] - two[1][0] if len(two) > 1 else np.inf

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.output.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


@functools.lru_cache(maxsize=2)
def lattice(model: str) -> Lattice:
    """One lattice per worker process and model."""
    return Lattice(model)


def encode_pieces(docs: DataFrame, n: int = 4, id_col: str = "doc_id", text_col: str = "text",
                  model: str | None = None) -> DataFrame:
    """``(id_col, ids, score, nbest_scores, nbest_ids, decoded)`` per row: the best
    segmentation (little-endian 32-bit ids), scores and ids of the ``n`` best, the best
    first, and the best ids decoded again."""
    path = model or default_model()

    def run(batches) -> Iterator[pa.RecordBatch]:
        own = lattice(path)
        for batch in batches:
            for part in slices(batch):
                bounds, flat, score, listed = own.encode(part.column(1), n)
                ids = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(score),
                     pa.array([s for s, _ in listed], pa.list_(pa.float64())),
                     pa.array([[x.tobytes() for x in p] for _, p in listed], pa.list_(pa.binary())),
                     pa.array([own.decode(x) for x in ids], pa.string())],
                    names=["id", "ids", "score", "nbest_scores", "nbest_ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary, score double, nbest_scores array<double>, nbest_ids array<binary>, decoded string")
            .withColumnRenamed("id", id_col))


__all__ = ["Lattice", "lattice", "encode_pieces", "default_model"]
