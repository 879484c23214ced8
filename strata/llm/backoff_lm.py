"""Language-model scores from a weighted backoff automaton over words.

Every word and every two-word sequence of the training texts is a state. The arcs
of a state are the discounted sequences of one word more (three words at most), and
its failure arc leads to the state one word shorter with the mass left over; the
root holds all words with discounted counts and one unknown word. Each token of a
text follows an arc of the current state, mixed with the shorter state's weight, or
takes the failure arc first. A text starts at the root.

Counts cover all words and all sequences of all training texts. Texts are kept in
blocks of ``BLOCK`` tokens. A block's distinct sequences of three words go, packed,
to the part that their first word is dealt to; there the sequences of all blocks are
counted, and a block gets back the counts of its own: those of each first word, of
each two words and of each three, and how many words follow the shorter ones. With
these the block's texts walk the automaton. Words and pairs seen over ``SPLIT`` times
are dealt by the words after them, and what the parts cannot tell of them is counted
before and broadcast. Also broadcast are the ``TABLE`` most frequent words, whose
numbers stand for them in packed sequences (other words stand there as hashes).

Tokens are A-Z lower-cased runs of bytes other than white space, then one end
token. Null texts are empty (end token only); null ids are never held out;
without training texts every token is unknown with probability 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import saved
from strata.llm.words import mix, slices, word_hashes

STATES = 2048
TABLE = 1 << 19
COUNTED_AT_ONCE = 1 << 21
BLOCK = 1 << 20             # tokens kept and walked together; a longer text is a block of its own
PART = 1 << 21              # tokens, about, whose sequences are counted together
LEAST_PARTS = 64
FEW = 1 << 21               # distinct words of which three have their numbers in 64 bits
SPLIT = 1 << 22             # words and pairs seen oftener are dealt by what follows them
END = np.uint64(1)          # stands for the end token among word hashes
DISCOUNT = 0.75             # taken off the count of every sequence of two or three words
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_CODEC = pa.Codec("zstd", compression_level=1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts with end tokens, and their offsets per text."""
    h, offsets = word_hashes(column)
    h = np.where(h <= END, np.uint64(2), h)    # 0 is no word
    flat = np.insert(h, offsets[1:], END)
    return flat, offsets + np.arange(len(offsets))


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _ODD[0] + second * _ODD[1])


def _triple_keys(pairs: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mix(pairs * _ODD[2] + third)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers in planes of bytes, compressed plane by plane; :func:`_unpacked` reads them."""
    head, body = [], []
    for x in columns:
        x = np.ascontiguousarray(x).astype("<u8", copy=False)
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        planes = [_CODEC.compress(p.tobytes(), asbytes=True) for p in x.view(np.uint8).reshape(-1, 8)[:, :width].T]
        head += [len(x), width, *map(len, planes)]
        body += planes
    return np.array([len(head), *head], "<u4").tobytes() + b"".join(body)


def _unpacked(raw: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    head, at, out = iter(np.frombuffer(raw, "<u4", n, 4).tolist()), 4 + 4 * n, []
    for size in head:
        x = np.zeros((size, 8), np.uint8)
        for k, length in enumerate([next(head) for _ in range(next(head))]):
            x[:, k] = np.frombuffer(_CODEC.decompress(raw[at:at + length], size, asbytes=True), np.uint8)
            at += length
        out.append(x.view("<u8").reshape(-1))
    return out


def _joined(bodies: pa.ChunkedArray) -> list[np.ndarray]:
    """The columns of all rows of :func:`_packed` bytes, joined."""
    return [np.concatenate(x) for x in zip(*(_unpacked(v.as_py()) for v in bodies), strict=True)]


def _parts(n: int) -> int:
    """The least power of two that is at least ``n`` and ``LEAST_PARTS``."""
    return 1 << (max(n, LEAST_PARTS) - 1).bit_length()


def _dealt(key: np.ndarray, parts: int) -> np.ndarray:
    return (key >> np.uint64(65 - parts.bit_length())).astype(np.int64)


def _words(texts: DataFrame) -> DataFrame:
    """``(key, c)``: hash and count of each distinct token; counts of many texts are shuffled packed."""
    parts = _parts(2 * texts.rdd.getNumPartitions())

    def count(batches) -> Iterator[pa.RecordBatch]:
        def out():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(_dealt(keys, parts), np.arange(parts + 1))
            at = np.flatnonzero(np.diff(ends))
            rows = [_packed(np.diff(keys[ends[i]:ends[i + 1]], prepend=np.uint64(0)), n[ends[i]:ends[i + 1]]) for i in at.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(rows, pa.binary())], names=["part", "body"])
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text=0):
                held.append(tokens(part.column(0))[0])
                size += len(held[-1])
                if size >= COUNTED_AT_ONCE:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def merge(table: pa.Table) -> pa.Table:
        rows = [_unpacked(v.as_py()) for v in table["body"]]
        keys, of = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in rows]), return_inverse=True)
        n = np.bincount(of, weights=np.concatenate([c for _, c in rows]))
        return pa.table({"key": keys.view(np.int64), "c": n.astype(np.int64)})
    return texts.mapInArrow(count, "part int, body binary").groupBy("part").applyInArrow(merge, "key long, c long")


def _after(texts: DataFrame, wanted: np.ndarray, length: int) -> DataFrame:
    """``(hist, next, c)``: the words after the ``wanted`` words (``length`` 1) or pairs (2), and their counts."""
    wanted = np.sort(wanted)

    def count(batches) -> Iterator[pa.RecordBatch]:
        def out():
            hist, after = (np.concatenate(x) for x in zip(*held, strict=True))
            _, at, n = np.unique(_pair_keys(hist, after), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(hist[at].view(np.int64)), pa.array(after[at].view(np.int64)),
                                               pa.array(n.astype(np.int64))], names=["hist", "next", "c"])
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text=0):
                flat, offsets = tokens(part.column(0))
                at = np.flatnonzero(np.arange(len(flat)) - np.repeat(offsets[:-1], np.diff(offsets)) >= length)
                hist = flat[at - 1] if length == 1 else _pair_keys(flat[at - 2], flat[at - 1])
                own = _place(wanted, hist) < len(wanted)
                held.append((hist[own], flat[at][own]))
                size += len(held[-1][0])
                if size >= COUNTED_AT_ONCE:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()
    return texts.mapInArrow(count, "hist long, next long, c long").groupBy("hist", "next").agg(F.sum("c").alias("c"))


def _place(among: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key among sorted ones, or their number."""
    if not len(among):
        return np.zeros(len(keys), np.int64)
    at = np.searchsorted(among, keys)
    return np.where(among[np.minimum(at, len(among) - 1)] == keys, at, len(among))


class Often:
    """Counts of the words or pairs seen over ``SPLIT`` times, and the number of words after each."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, after: DataFrame | None):
        order = np.argsort(keys)
        self.keys, self.counts, self.kinds = keys[order], counts[order], np.zeros(len(keys), np.int64)
        if after is not None:
            found = after.groupBy("hist").agg(F.count(F.lit(1)).alias("kinds")).toArrow()
            self.kinds[_place(self.keys, found["hist"].to_numpy().view(np.uint64))] = found["kinds"].to_numpy()

    def has(self, keys: np.ndarray) -> np.ndarray:
        return _place(self.keys, keys) < len(self.keys)

    def put(self, keys: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> None:
        """Fills in the counts and kinds of those of the ``keys`` that are here."""
        at = _place(self.keys, keys)
        own = at < len(self.keys)
        counts[own], kinds[own] = self.counts[at[own]], self.kinds[at[own]]


class Automaton:
    """The broadcast part of the model: frequent words, arcs between the most frequent, failure arcs."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, kinds: int, once: int, twice: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.total, self.kinds = total, kinds
        self.discount = (once + 1) / (once + 2 * twice + 2)
        top = np.lexsort((words, -counts))
        self.by_code = words[top]                            # the most frequent first
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.codes = np.empty(len(words) + 1, np.int64)
        self.codes[rank[top]] = np.arange(len(words))
        self.nothing, self.escape = len(words), len(words) + 1  # no word; a word that is not among the frequent ones
        self.codes[-1] = self.escape
        self.state = np.zeros(len(words) + 1, np.int32)      # 0 is the root
        self.state[rank[top[:STATES]]] = np.arange(1, len(top[:STATES]) + 1)
        self.texts = self.keys = None
        self.ends = 0
        self.often, self.often_pairs = (Often(np.zeros(0, np.uint64), np.zeros(0, np.int64), None) for _ in range(2))

    def __getstate__(self) -> dict:
        return {k: None if k == "texts" else v for k, v in self.__dict__.items()}  # training texts stay on the driver

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Place of each token among the frequent words, or their number."""
        return _place(self.words, tokens)

    def root_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability at the root of words seen ``counts`` times; 0 is the unknown word."""
        if not self.total:
            return np.zeros(len(counts))
        mass = np.where(counts > 0, counts - self.discount, self.discount * self.kinds)
        return np.log10(mass / self.total)

    def pack(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words, and the hashes of those that have none, in turn; hash 0 is no word."""
        code = np.where(words == 0, self.nothing, self.codes[self.find(words)])
        return code, words[code == self.escape]

    def unpack(self, code: np.ndarray, others: np.ndarray) -> np.ndarray:
        words = np.append(self.by_code, np.zeros(2, np.uint64))[code.astype(np.int64)]
        words[code == self.escape] = others
        return words

    def _link(self) -> None:
        """Arcs between states and failure arcs of states to the root, from the training texts."""
        top = self.words[self.state[:-1] > 0]
        after = saved(_after(self.texts, top, 1), "arcs")
        own = Often(top, self.counts[self.state[:-1] > 0], after)
        names = np.sort(top)

        def both(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_place(names, batch.column(1).to_numpy().view(np.uint64)) < len(names)))
        arcs = after.mapInArrow(both, after.schema).toArrow()   # STATES squared rows at most
        source, target = (arcs[c].to_numpy().view(np.uint64) for c in ("hist", "next"))
        self.fail = np.zeros(STATES + 1)
        self.fail[self.state[self.find(own.keys)]] = _fail(own.kinds, own.counts)
        a, b = (self.state[self.find(x)].astype(np.int64) for x in (source, target))
        key = a * (STATES + 1) + b
        counts = np.append(self.counts, 0)
        weight = _mixed(arcs["c"].to_numpy(), counts[self.find(source)], self.fail[a] + self.root_log(counts[self.find(target)]))
        order = np.argsort(key)
        self.keys, self.arcs = key[order], weight[order]

    def read(self, tokens: np.ndarray, offsets: np.ndarray) -> tuple:
        """Per text: base and model sums of what is known here by words and two-word arcs, and known tokens."""
        if self.keys is None:
            self._link()
        at = self.find(tokens)
        known = at < len(self.words)
        counts = np.append(self.counts, 0)[at]
        state = self.state[at].astype(np.int64)
        before = np.concatenate([[0], state[:-1]])[:len(state)]
        before[offsets[:-1]] = 0
        key = before * (STATES + 1) + state
        arc = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        hit = (state > 0) & (before > 0)
        if len(self.keys):
            hit &= self.keys[arc] == key
        else:
            hit[:] = False
        step = self.fail[before]
        step[known] += self.root_log(counts[known])
        step[hit] = self.arcs[arc[hit]]
        base = np.where(known, np.log10(counts + 1.0), 0.0)
        begin = offsets[:-1]
        return np.add.reduceat(base, begin), np.add.reduceat(step, begin), np.add.reduceat(known.astype(np.int64), begin)


def _fail(kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of the mass that states leave to the shorter one; all of it without arcs."""
    return np.log10(np.where(kinds > 0, DISCOUNT * kinds / np.maximum(counts, 1), 1.0))


def _mixed(counts: np.ndarray, of: np.ndarray, step: np.ndarray) -> np.ndarray:
    """log10 weight of arcs seen ``counts`` times of ``of``, mixed with ``step``, that of the failure arc; ``step`` if not seen."""
    own = np.maximum(counts - DISCOUNT, 0.0) / np.maximum(of, 1)
    return np.where(counts > 0, np.log10(own + 10.0 ** step), step)


def train(texts: DataFrame) -> tuple[Automaton, DataFrame]:
    """Automaton from all rows of ``texts(text)``, and the whole table of word counts."""
    words = saved(_words(texts), "words")
    level = F.least("c", F.lit(1 << 16))
    steps = words.groupBy(level.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("s")).orderBy("c").collect()
    kinds, total = sum(r.n for r in steps), sum(r.s for r in steps)
    of = {r.c: r.n for r in steps}
    cut, held = 1 << 16, of.get(1 << 16, 0)
    for r in steps[::-1]:
        if r.c < 1 << 16:
            if held + r.n > TABLE:
                break
            held += r.n
            cut = r.c
    frequent = words.where(F.col("c") >= cut)
    if held > TABLE:  # more words than the table holds are seen over 65536 times
        frequent = frequent.orderBy(F.desc("c"), "key").limit(TABLE)
    frequent = frequent.toArrow()
    model = Automaton(frequent["key"].to_numpy().view(np.uint64), frequent["c"].to_numpy(), total, kinds,
                      of.get(1, 0), of.get(2, 0))
    model.texts = texts
    often = words.where((F.col("c") > SPLIT) | (F.col("key") == int(END))).toArrow()
    keys, counts = often["key"].to_numpy().view(np.uint64), often["c"].to_numpy()
    model.ends = int(counts[keys == END].sum())
    keys, counts = keys[keys != END], counts[keys != END]
    if len(keys):
        after = saved(_after(texts, keys, 1), "after")
        model.often = Often(keys, counts, after)
        pairs = after.where(F.col("c") > SPLIT).toArrow()
        keys = _pair_keys(*(pairs[c].to_numpy().view(np.uint64) for c in ("hist", "next")))
        if len(keys):
            model.often_pairs = Often(keys, pairs["c"].to_numpy(), _after(texts, keys, 2))
    return model, words


class Sequences:
    """The distinct sequences of three words of some texts in the order they are dealt in.

    Tokens come as :meth:`Automaton.pack` numbers them. A sequence stands at each token but the last
    of its text; its third word is 0 where the text has none. Sequences are sorted by part, then by
    their words; ``pairs`` has the places where another two words begin in a part."""

    def __init__(self, model: Automaton, code: np.ndarray, others: np.ndarray, offsets: np.ndarray, counted: np.ndarray, parts: int):
        local = self._number(model, code, others)
        nothing = np.uint64(len(self.words) - 1)
        last = np.zeros(len(code) + 1, bool)
        last[offsets[1:] - 1] = True
        self.at = np.flatnonzero(~last[:-1])
        first, second = local[self.at], local[self.at + 1]
        third = np.where(last[self.at + 1], nothing, np.append(local, nothing)[self.at + 2])
        if len(self.words) <= FEW:
            triple, self.of = _distinct((first << np.uint64(42)) | (second << np.uint64(21)) | third)
            pair, third = triple >> np.uint64(21), triple & np.uint64(FEW - 1)
            first, second = pair >> np.uint64(21), pair & np.uint64(FEW - 1)
        else:
            pair, of = _distinct((first << np.uint64(32)) | second)
            triple, self.of = _distinct((of.astype(np.uint64) << np.uint64(32)) | third)
            low = np.uint64(0xFFFFFFFF)
            pair, third = pair[triple >> np.uint64(32)], triple & low
            first, second = pair >> np.uint64(32), pair & low
        self.counts = np.bincount(self.of, weights=np.repeat(counted, np.diff(offsets))[self.at], minlength=len(triple)).astype(np.int64)
        at = np.flatnonzero(_changes(pair))
        words = self.words[first[at]]
        self.keys = _pair_keys(words, self.words[second[at]])
        key = np.where(model.often.has(words), self.keys, mix(words))
        many = np.diff(np.append(at, len(pair)))
        often, key = np.repeat(model.often_pairs.has(self.keys), many), np.repeat(key, many)
        self.keys = np.repeat(self.keys, many)
        key[often] = _triple_keys(self.keys[often], self.words[third[often]])
        part = _dealt(key, parts)
        order = np.argsort(part, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.of = back[self.of]                                # sequence of each token that has one
        part, pair, first, self.third, self.counts = part[order], pair[order], first[order], third[order], self.counts[order]
        self.ends = np.searchsorted(part, np.arange(parts + 1))
        self.pairs = np.flatnonzero(_changes(pair, part))
        self.second, self.keys = second[order[self.pairs]], self.keys[order[self.pairs]]
        self.firsts = np.flatnonzero(_changes(first, part))
        self.first = first[self.firsts]
        self.seconds = np.diff(np.append(np.searchsorted(self.pairs, self.firsts), len(self.pairs)))  # pairs of each first word
        self.thirds = np.diff(np.append(self.pairs, len(part)))

    def _number(self, model: Automaton, code: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Numbers of the tokens among the distinct words: frequent ones first, then others, then no word."""
        rank = np.zeros(model.escape + 1, np.uint64)
        rank[code] = 1
        used = np.flatnonzero(rank[:model.nothing])
        rank[used] = np.arange(len(used), dtype=np.uint64)
        rare, of = _distinct(others)
        local = rank[code]
        local[code == model.escape] = len(used) + of
        self.words = np.concatenate([model.by_code[used], rare, np.zeros(1, np.uint64)])
        self.codes = np.concatenate([used, np.full(len(rare), model.escape), [model.nothing]])
        self.escape = model.escape
        return local

    def _pack(self, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = self.codes[local]
        return code, self.words[local[code == self.escape]]

    def dealt(self) -> Iterator[tuple[int, bytes]]:
        """Each part that has sequences, and these."""
        a, b = np.searchsorted(self.firsts, self.ends), np.searchsorted(self.pairs, self.ends)
        for i in np.flatnonzero(np.diff(self.ends)).tolist():
            one, two, three = slice(a[i], a[i + 1]), slice(b[i], b[i + 1]), slice(self.ends[i], self.ends[i + 1])
            yield i, _packed(*self._pack(self.first[one]), self.seconds[one], *self._pack(self.second[two]), self.thirds[two],
                             *self._pack(self.third[three]), self.counts[three])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place among them of each key."""
    return np.unique(keys, return_inverse=True)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return new


def _sample_of(of: np.ndarray, n: int) -> np.ndarray:
    """A row of each of ``n`` kinds, from the kind of each row."""
    at = np.empty(n, np.int64)
    at[of] = np.arange(len(of))
    return at


def _counted(model: Automaton) -> Callable[[pa.Table], pa.Table]:
    """What a part answers each asked block: counts and kinds of its first words and pairs, and counts of its sequences."""
    def count(table: pa.Table) -> pa.Table:
        rows = [_unpacked(v.as_py()) for v in table["body"]]
        sizes = [[len(r[i]) for r in rows] for i in (2, 5, 8)]

        def words(i):
            return np.concatenate([model.unpack(r[i], r[i + 1]) for r in rows])
        first, second, third = words(0), words(3), words(6)
        seconds, thirds, n = (np.concatenate([r[i] for r in rows]).astype(np.int64) for i in (2, 5, 8))
        of_first = np.repeat(np.arange(len(first)), seconds)
        of_pair = np.repeat(np.arange(len(second)), thirds)
        keys = _pair_keys(first[of_first], second)
        distinct, three = _distinct(_triple_keys(keys[of_pair], third))
        at = _sample_of(three, len(distinct))
        c3 = np.bincount(three, weights=n).astype(np.int64)
        distinct, two = _distinct(keys)
        at_pair = _sample_of(two, len(distinct))
        c2 = np.bincount(two[of_pair], weights=n, minlength=len(at_pair)).astype(np.int64)
        k3 = np.bincount(two[of_pair[at]], weights=(c3 > 0) & (third[at] != 0), minlength=len(at_pair)).astype(np.int64)
        names, one = _distinct(first)
        c1 = np.bincount(one[of_first[of_pair]], weights=n, minlength=len(names)).astype(np.int64)
        k2 = np.bincount(one[of_first[at_pair]], weights=c2 > 0, minlength=len(names)).astype(np.int64)
        ends = [np.concatenate([[0], np.cumsum(x)]) for x in sizes]
        block, body = table["block"].to_numpy(), []
        asked = np.flatnonzero(block >= 0)
        for i in asked.tolist():
            a, b, c = (slice(e[i], e[i + 1]) for e in ends)
            body.append(_packed(c1[one[a]], k2[one[a]], c2[two[b]], k3[two[b]], c3[three[c]]))
        return pa.table({"block": block[asked], "part": table["part"].to_numpy()[asked], "body": pa.array(body, pa.binary())})
    return count


def _blocks(model: Automaton, batches, asked: bool) -> Iterator[pa.RecordBatch]:
    """Texts in blocks, packed; blocks that are only counted have negative numbers."""
    part_id, number = TaskContext.get().partitionId(), 0
    held, size = [], 0

    def out():
        ids = pa.concat_arrays([x[0] for x in held])
        flat, lengths, counted = (np.concatenate([x[i] for x in held]) for i in (1, 2, 3))
        words, local = np.unique(flat, return_inverse=True)
        code = model.pack(words)[0][local]
        block = (part_id << 32) + number
        return pa.RecordBatch.from_arrays(
            [pa.array([block if asked else -1 - block]), pa.array([len(flat)]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             pa.array([_packed(code, flat[code == model.escape], lengths, counted)], pa.binary())], names=["block", "size", "ids", "body"])
    for batch in batches:
        for part in slices(batch):
            flat, offsets = tokens(part.column(1))
            held.append((part.column(0), flat, np.diff(offsets), part.column(2).to_numpy(zero_copy_only=False).astype(np.int64)))
            size += len(flat)
            if size >= BLOCK:
                yield out()
                held, size, number = [], 0, number + 1
    if held:
        yield out()


def _texts(body: bytes) -> tuple[np.ndarray, ...]:
    """Tokens of a block as :meth:`Automaton.pack` numbers them, offsets per text, and whether each text is counted."""
    code, others, lengths, counted = _unpacked(body)
    return code.astype(np.int64), others, np.concatenate([[0], np.cumsum(lengths.astype(np.int64))]), counted.astype(np.int64)


def _walk(model: Automaton, offsets: np.ndarray, own: Sequences, c1, k2, c2, k3, c3) -> tuple[np.ndarray, ...]:
    """Known tokens, base and model sums per text, from the counts of its sequences."""
    n = int(offsets[-1])
    model.often.put(own.words[own.first], c1, k2)
    model.often_pairs.put(own.keys, c2, k3)
    c1, k2 = (np.repeat(x, own.seconds) for x in (c1, k2))

    def placed(x):
        out = np.zeros(n, np.int64)
        out[own.at] = x[own.of]
        return out
    c1, k2, c2, k3 = (placed(np.repeat(x, own.thirds)) for x in (c1, k2, c2, k3))
    c3 = placed(c3)
    seen = c1.copy()
    seen[offsets[1:] - 1] = model.ends
    step = model.root_log(seen)
    before = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    at = np.flatnonzero(before >= 1)
    step[at] = _mixed(c2[at - 1], c1[at - 1], _fail(k2[at - 1], c1[at - 1]) + step[at])
    at = at[before[at] >= 2]
    at = at[k3[at - 2] > 0]
    step[at] = _mixed(c3[at - 2], c2[at - 2], _fail(k3[at - 2], c2[at - 2]) + step[at])
    begin = offsets[:-1]
    return (np.add.reduceat((seen > 0).astype(np.int64), begin), np.add.reduceat(np.log10(seen + 1.0), begin),
            np.add.reduceat(step, begin))


def score(docs: DataFrame, model: Automaton, words: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          training: Column | None = None) -> DataFrame:
    """``(id_col, n_tokens, n_known, train_tokens, base_score, score)`` per row, log10.

    ``training`` tells the rows of ``docs`` that are the training texts, which then are dealt but
    once; without it the model's own are dealt beside ``docs``. Counts of ``words`` come back with
    the sequences they begin, so that the table itself is not joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    mark = F.lit(False) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), mark.alias("counted"))
    form = f"block long, size long, ids array<{kind}>, body binary"
    blocks = saved(rows.mapInArrow(lambda batches: _blocks(shared.value, batches, True), form), "texts")
    kept, size = blocks.select("block", "body"), blocks.agg(F.sum("size")).first()[0] or 0
    if training is None and model.total:
        others = model.texts.select(F.lit(None).cast(kind).alias("id"), F.col("text"), F.lit(True).alias("counted"))
        kept = kept.unionByName(others.mapInArrow(lambda batches: _blocks(shared.value, batches, False), form).select("block", "body"))
        size += model.total
    parts = _parts(-(-size // PART))

    def deal(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [*Sequences(shared.value, *_texts(body.as_py()), parts).dealt()]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
                                                  pa.array([b for _, b in rows], pa.binary())], names=["part", "block", "body"])

    def walk(texts: pa.Table, answers: pa.Table) -> pa.Table:
        own, names = shared.value, ["id", "n_tokens", "n_known", "base", "score"]
        if not texts.num_rows:
            raise ValueError("counts without their texts")
        code, others, offsets, counted = _texts(texts["body"][0].as_py())
        asked = Sequences(own, code, others, offsets, counted, parts)
        counts = _joined(answers.sort_by("part")["body"]) if answers.num_rows else [np.zeros(0)] * 5
        found = _walk(own, offsets, asked, *(c.astype(np.int64) for c in counts))
        return pa.table([texts["ids"].combine_chunks().flatten(), pa.array(np.diff(offsets)), *map(pa.array, found)], names=names)

    answers = kept.mapInArrow(deal, "part int, block long, body binary").groupBy("part").applyInArrow(
        lambda table: _counted(shared.value)(table), "block long, part int, body binary")
    found = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        walk, f"id {kind}, n_tokens long, n_known long, base double, score double")
    shift = math.log10(model.total + model.kinds + 1)
    return found.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                        (F.col("base") - F.col("n_tokens") * shift).alias("base_score"), "score")


__all__ = ["Automaton", "Sequences", "train", "score", "tokens"]
