"""Token ids of whole texts under a byte-level BPE vocabulary file.

Byte-level BPE cuts a text by a fixed pattern and encodes each piece on its
own. Where single spaces or newlines stand between other characters, the
pattern cuts before the space and on both sides of the newline. So a text whose
white space comes only singly is a row of words, found here by numpy over the
bytes of many texts; each new word goes to the tokenizers library once and its
ids are kept in a table of fixed size. A text with other runs of white space,
or with an added token of the vocabulary, goes to the library whole.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from strata.llm.words import bounds_and_bytes, span_hashes

TABLE_BITS = 22            # words remembered per worker: one slot each
STORE = 1 << 24            # ids remembered per worker
LEARNT_AT_ONCE = 1 << 13   # new words that go to the library together

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# UTF-8 forms of white space outside ASCII, as lead bytes and the range of the rest.
_WIDE_SPACE = [(b"\xc2", b"\x85", b"\x85"), (b"\xc2", b"\xa0", b"\xa0"), (b"\xe1\x9a", b"\x80", b"\x80"),
               (b"\xe2\x80", b"\x80", b"\x8a"), (b"\xe2\x80", b"\xa8", b"\xa9"), (b"\xe2\x80", b"\xaf", b"\xaf"),
               (b"\xe2\x81", b"\x9f", b"\x9f"), (b"\xe3\x80", b"\x80", b"\x80")]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _odd_texts(bounds: np.ndarray, data: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Texts whose white space is not all single and inside, or that hold an added token."""
    gap = _GAP[data]
    at = [np.flatnonzero(gap[1:] & gap[:-1])]
    filled = bounds[:-1] < bounds[1:]
    at += [p[gap[p]] for p in (bounds[:-1][filled], bounds[1:][filled] - 1)]
    for lead, low, high in _WIDE_SPACE:
        first = np.flatnonzero(data[:len(data) - len(lead)] == lead[0])
        if len(first):
            hit = (data[first + len(lead)] >= low[0]) & (data[first + len(lead)] <= high[0])
            for k in range(1, len(lead)):
                hit &= data[first + k] == lead[k]
            at.append(first[hit])
    for token in added:
        raw, found = None, np.flatnonzero(data == token[0])
        if len(found):
            raw, begin = data.tobytes(), 0
            while (begin := raw.find(token, begin)) >= 0:
                at.append(np.array([begin]))
                begin += 1
    odd = np.zeros(len(bounds) - 1, bool)
    odd[np.searchsorted(bounds, np.concatenate(at), "right") - 1] = True
    return odd & filled


class Encoder:
    """Arrow texts to token ids as little-endian unsigned 32-bit integers."""

    space_first = False   # whether a text's first word counts as one after a space
    has_extra = False     # whether a number is kept with each word

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(vocabulary)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.line_end = np.array(self.whole("\n"), "<u4")
        self._tables()

    def _tables(self) -> None:
        slots = 1 << TABLE_BITS
        self.words = np.zeros(slots, np.uint64)
        self.begin = np.zeros(slots, np.uint32)
        self.size = np.zeros(slots, np.uint32)
        self.extra = np.zeros(slots, np.float32) if self.has_extra else None
        self.ids = np.zeros(STORE, "<u4")
        self.used = 0

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _ids_of(self, words: list[str]) -> tuple[list[list[int]], np.ndarray | float]:
        """Ids of single words, through the library's own cutting and model, and their extra numbers."""
        tokenize = self.library.model.tokenize
        pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str("\n".join(words) + "\n")]
        known = {p: [t.id for t in tokenize(p)] for p in set(pieces)}
        out, own, end = [], [], self.library.pre_tokenizer.pre_tokenize_str("\n")[0][0]
        for p in pieces:
            if p == end:
                out.append(own)
                own = []
            else:
                own += known[p]
        return out, 0.0

    def _learn(self, keys: np.ndarray, starts, ends, raw: bytes, lead: np.ndarray) -> None:
        """Put new words into the table, some at a time: the library's objects for one are many times its size."""
        for i in range(0, len(keys), LEARNT_AT_ONCE):
            self._learn_some(*(x[i:i + LEARNT_AT_ONCE] for x in (keys, starts, ends)), raw, lead[i:i + LEARNT_AT_ONCE])

    def _learn_some(self, keys: np.ndarray, starts, ends, raw: bytes, lead: np.ndarray) -> None:
        words = [(" " if s else "") + raw[a:b].decode()
                 for a, b, s in zip(starts.tolist(), ends.tolist(), lead.tolist(), strict=True)]
        found, extra = self._ids_of(words)
        size = np.array([len(x) for x in found], np.int64)
        if self.used + size.sum() > len(self.ids):
            self.words[:] = 0
            self.used = 0
            if size.sum() > len(self.ids):
                self.ids = np.zeros(int(size.sum()), "<u4")
        begin = self.used + np.cumsum(size) - size
        self.ids[self.used:self.used + size.sum()] = np.fromiter((i for x in found for i in x), "<u4", size.sum())
        self.used += int(size.sum())
        slot = (keys & np.uint64(len(self.words) - 1)).astype(np.int64)
        self.words[slot], self.begin[slot], self.size[slot] = keys, begin, size
        if self.has_extra:
            self.extra[slot] = extra

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids; null texts are empty."""
        bounds, data = bounds_and_bytes(column)
        n = len(bounds) - 1
        if not len(data):
            self.seen = None
            return np.zeros(n + 1, np.int64), np.zeros(0, "<u4")
        odd = _odd_texts(bounds, data, self.added)
        cut = (data == 32) | (data == 10)
        edge = np.zeros(len(data) + 1, bool)
        edge[:-1] = cut
        edge[bounds] = True
        ends = np.flatnonzero(edge)          # every word, blank ones too, ends at a cut or a text's end
        starts = np.empty_like(ends)
        starts[0] = 0
        starts[1:] = ends[:-1] + cut[np.minimum(ends[:-1], len(data) - 1)] * (ends[:-1] < len(data))
        text = np.searchsorted(bounds, starts, "right") - 1
        keep = (starts < ends) & ~odd[np.minimum(text, n - 1)]
        starts, ends, text = starts[keep], ends[keep], text[keep]
        opener = data[np.maximum(starts - 1, 0)]
        inside = starts > bounds[text]
        spaced, lined = inside & (opener == 32), inside & (opener == 10)
        if self.space_first:
            spaced |= ~inside
        keys = span_hashes(data, starts, ends) ^ (spaced.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        keys |= np.uint64(1) << np.uint64(63)  # never the empty slot
        todo, raw = np.arange(len(keys)), None
        sizes = np.zeros(len(keys), np.int64)
        extra = np.zeros(len(keys), np.float32)
        # Slots are shared: words learnt in this call may push each other out, so ids are copied round by round.
        rounds = []
        while len(todo):
            slot = (keys[todo] & np.uint64(len(self.words) - 1)).astype(np.int64)
            hit = self.words[slot] == keys[todo]
            got, s = todo[hit], slot[hit]
            if len(got):
                size = self.size[s].astype(np.int64)
                sizes[got] = size
                step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                rounds.append((got, size, step, self.ids[np.repeat(self.begin[s].astype(np.int64), size) + step]))
                if self.has_extra:
                    extra[got] = self.extra[s]
            todo = todo[~hit]
            if len(todo):
                raw = raw or data.tobytes()
                new, first = np.unique(keys[todo], return_index=True)
                one = np.unique(new & np.uint64(len(self.words) - 1), return_index=True)[1]
                at = todo[first[one]]
                self._learn(keys[at], starts[at], ends[at], raw, spaced[at])
        self.seen = (data, text, starts, ends, spaced, extra, odd)
        total = sizes + lined * len(self.line_end)
        place = np.cumsum(total) - total
        flat = np.empty(int(total.sum()), "<u4")
        for k, piece in enumerate(self.line_end):
            flat[place[lined] + k] = piece
        place += lined * len(self.line_end)
        for got, size, step, ids in rounds:
            flat[np.repeat(place[got], size) + step] = ids
        self.at = place  # of the ids of each word that was found here
        count = np.bincount(text, weights=total, minlength=n).astype(np.int64)
        if odd.any():
            strings = column.cast(pa.large_string())
            extra = {i: np.array(self.whole(strings[i].as_py()), "<u4") for i in np.flatnonzero(odd).tolist()}
            ends_at = np.cumsum(count)
            parts = [extra[i] if i in extra else flat[ends_at[i] - count[i]:ends_at[i]] for i in range(n)]
            before = ends_at - count
            count = np.array([len(p) for p in parts], np.int64)
            self.at = place + (np.cumsum(count) - count - before)[text]
            flat = np.concatenate(parts)
        return np.concatenate([[0], np.cumsum(count)]), flat


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(vocabulary)


def forget() -> None:
    """Give back the tables of the encoders that earlier tasks left in this worker process."""
    encoder.cache_clear()


__all__ = ["Encoder", "encoder", "forget", "default_vocabulary"]
