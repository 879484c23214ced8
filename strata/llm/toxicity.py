"""Toxicity of whole texts: a bidirectional gated recurrent network over words.

A word's input is a hashed word embedding plus the embeddings of its character
n-grams, so unseen compounds of known stems are recognised. Two gated recurrent
passes run over windows of ``WINDOW`` words that overlap by half; attention pools
each window's states into one logit, and a text's logit is its highest window.
The network is trained here in numpy from labelled texts: gradients flow through
each text's highest window.

Training texts are a bounded, hash-ordered sample of distinct texts (``SAMPLE`` per
class, weighted back to the classes' distinct texts, as a text of many copies would
drown all others); scoring covers all windows of all texts. Null, blank and
very short texts are padded windows and get a score too. Without labels of both
classes every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.subword import forget
from strata.llm.words import bounds_and_bytes, mix, slices, span_hashes, word_spans, _LOWER

SAMPLE = 1000        # distinct labelled texts per class at most
WINDOW, STRIDE = 32, 16
DIM, HIDDEN = 8, 8
GRAMS = (3, 5)       # lengths of character n-grams in bytes, word ends included
BUCKETS = 1 << 15    # hashed character n-grams; as many hashed words
AT_ONCE = 4096       # windows run together
WORDS_AT_ONCE = 1 << 14  # distinct words whose n-grams are taken together
EPOCHS = 12


def _grams(low: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character n-grams of some words, word by word, and their number per word."""
    begin = np.cumsum(size + 2) - (size + 2)
    buffer = np.full(int((size + 2).sum()) + max(GRAMS), 32, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    buffer[np.repeat(begin + 1, size) + step] = low[np.repeat(starts, size) + step]
    owner = np.repeat(np.arange(len(size)), size + 2)
    inner = np.arange(len(owner)) - np.repeat(begin, size + 2)
    left = np.repeat(size + 2, size + 2) - inner
    rows, grams = [], []
    for n in GRAMS:
        at = np.flatnonzero((left >= n) | (inner == 0))
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + buffer[at + k]
        rows.append(owner[at])
        grams.append((mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
    rows, grams = np.concatenate(rows), np.concatenate(grams)
    return grams[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(size))


class Features:
    """Distinct words of some texts, their character n-grams and their windows."""

    def __init__(self, column: pa.Array):
        bounds, data = bounds_and_bytes(column)
        low = _LOWER[data]
        starts, ends, self.offsets = word_spans(bounds, data)
        keys = span_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        self.words, first, self.word_of = np.unique(keys, return_index=True, return_inverse=True)
        size, begin = (ends - starts)[first], starts[first]
        blocks = [_grams(low, begin[i:i + WORDS_AT_ONCE], size[i:i + WORDS_AT_ONCE]) for i in range(0, len(size), WORDS_AT_ONCE)]
        self.grams, self.gram_count = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*blocks or [((), ())], strict=True))
        self.gram_starts = np.cumsum(self.gram_count) - self.gram_count
        self.bucket = (self.words & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.pad = len(size)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of every overlapping window, and the text each belongs to."""
        n = np.diff(self.offsets)
        many = np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1
        text = np.repeat(np.arange(len(n)), many)
        k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        start = np.maximum(0, np.minimum(k * STRIDE, (n - WINDOW)[text]))
        at = start[:, None] + np.arange(WINDOW)
        inside = at < n[text][:, None]
        words = np.append(self.word_of, self.pad)
        return words[np.where(inside, at + self.offsets[:-1][text][:, None], len(words) - 1)], text


def _inputs(model: dict, f: Features) -> np.ndarray:
    """Input vector of each distinct word."""
    if not len(f.words):
        return np.zeros((0, DIM), np.float32)
    grams = np.empty((len(f.words), DIM), np.float32)
    for i in range(0, len(grams), WORDS_AT_ONCE):
        begin = f.gram_starts[i:i + WORDS_AT_ONCE]
        own = f.grams[begin[0]:begin[-1] + f.gram_count[i + len(begin) - 1]]
        grams[i:i + len(begin)] = np.add.reduceat(model["gram"][own], begin - begin[0])
    return grams / np.sqrt(f.gram_count)[:, None].astype(np.float32) + model["word"][f.bucket]


def _gates(model: dict, f: Features, x: np.ndarray) -> list[np.ndarray]:
    """Gate inputs of each distinct word and of padding, which keeps the state."""
    out = []
    for d in "fb":
        pad = np.zeros((1, 3 * HIDDEN), np.float32)
        pad[0, :HIDDEN] = 40
        out.append(np.concatenate([x @ model["W" + d] + model["B" + d], pad]))
    return out


def _forward(model: dict, gates: list[np.ndarray], windows: np.ndarray, pad: int, keep: list | None = None):
    """Logit of each window; ``keep`` collects what the backward pass needs."""
    n, h = len(windows), HIDDEN
    states = np.empty((WINDOW, n, 2 * h), np.float32)
    for side, d in enumerate("fb"):
        state, inner = np.zeros((n, h), np.float32), model["U" + d]
        for t in range(WINDOW) if not side else range(WINDOW - 1, -1, -1):
            g, a = gates[side][windows[:, t]], state @ inner
            zr = np.tanh((g[:, :2 * h] + a[:, :2 * h]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h:] + r * a[:, 2 * h:])
            if keep is not None:
                keep.append((side, t, state, z, r, new, a[:, 2 * h:]))
            state = new + z * (state - new)
            states[t, :, side * h:side * h + h] = state
    score = states @ model["a"]
    score[(windows == pad).T] = -30
    score = np.exp(score - score.max(0))
    weight = score / score.sum(0)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    return pooled @ model["w"] + model["c"], states, weight, pooled


def _logits(model: dict, f: Features, windows: np.ndarray) -> np.ndarray:
    gates = _gates(model, f, _inputs(model, f))
    return np.concatenate([_forward(model, gates, windows[i:i + AT_ONCE], f.pad)[0]
                           for i in range(0, len(windows), AT_ONCE)] or [np.zeros(0, np.float32)])


def _gradients(model: dict, f: Features, windows: np.ndarray, slope: np.ndarray):
    """Logits of ``windows`` and, for loss slopes ``slope(logits)``, all gradients."""
    used, local = np.unique(windows, return_inverse=True)
    used = used[used < f.pad]
    local = local.reshape(windows.shape)
    count = f.gram_count[used]
    flat = np.repeat(f.gram_starts[used] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    owner = np.repeat(np.arange(len(used)), count)
    scale = (1 / np.sqrt(count)).astype(np.float32)
    x = model["word"][f.bucket[used]].copy()
    np.add.at(x, owner, model["gram"][f.grams[flat]] * scale[owner][:, None])
    gates, keep, h = _gates(model, f, x), [], HIDDEN
    logits, states, weight, pooled = _forward(model, gates, local, len(used), keep)
    s = slope(logits).astype(np.float32)
    grad = {"w": pooled.T @ s, "c": s.sum()}
    d_pool = s[:, None] * model["w"]
    d_weight = np.einsum("tnh,nh->tn", states, d_pool)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    grad["a"] = np.einsum("tn,tnh->h", d_score, states)
    d_states = weight[:, :, None] * d_pool + d_score[:, :, None] * model["a"]
    d_gates = [np.zeros_like(g) for g in gates]
    for side, d in enumerate("fb"):
        grad["U" + d] = np.zeros_like(model["U" + d])
        carry = np.zeros((len(windows), h), np.float32)
        for k, t, state, z, r, new, inner in reversed(keep):
            if k != side:
                continue
            carry = carry + d_states[t, :, side * h:side * h + h]
            d_new = carry * (1 - z) * (1 - new * new)
            d_z = carry * (state - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            outer = np.concatenate([d_z, d_r, d_new], 1)
            np.add.at(d_gates[side], local[:, t], outer)
            back = np.concatenate([d_z, d_r, d_new * r], 1)
            grad["U" + d] += state.T @ back
            carry = carry * z + back @ model["U" + d].T
        d_gates[side][-1] = 0
        own = d_gates[side][:len(used)]
        grad["W" + d], grad["B" + d] = x.T @ own, own.sum(0)
    d_x = sum(d_gates[i][:len(used)] @ model["W" + d].T for i, d in enumerate("fb"))
    grad["word"], grad["gram"] = np.zeros_like(model["word"]), np.zeros_like(model["gram"])
    np.add.at(grad["word"], f.bucket[used], d_x)
    np.add.at(grad["gram"], f.grams[flat], (d_x * scale[:, None])[owner])
    return logits, grad


def _start(f: Features, labels: np.ndarray, rng) -> tuple[dict, np.ndarray]:
    """First weights, and each word's evidence: how much oftener label 1 has its rarest n-gram.

    The first channel of an n-gram's embedding starts at its evidence (a score of how much
    oftener label 1 has it), the others at random. Training also learns without that, from
    more texts and in more passes."""
    def normal(*shape, by=0.3):
        return rng.normal(0, by, shape).astype(np.float32)
    model = {"word": normal(BUCKETS, DIM, by=0.02), "gram": normal(BUCKETS, DIM, by=0.02),
             "a": normal(2 * HIDDEN), "w": normal(2 * HIDDEN), "c": np.float32(0)}
    for d in "fb":
        model |= {"W" + d: normal(DIM, 3 * HIDDEN), "U" + d: normal(HIDDEN, 3 * HIDDEN),
                  "B" + d: np.zeros(3 * HIDDEN, np.float32)}
        model["B" + d][:HIDDEN] = -1
    ones, zeros = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for label, a, b in zip(labels.tolist(), f.offsets[:-1].tolist(), f.offsets[1:].tolist(), strict=True):
        word = np.unique(f.word_of[a:b])        # a text at a time, so that memory is that of the longest
        count = f.gram_count[word]
        flat = np.repeat(f.gram_starts[word] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        (ones if label else zeros)[np.unique(f.grams[flat])] += 1
    rate = (ones + zeros + 1) / (len(labels) + 2)
    p, q = ones / max(1, labels.sum()), zeros / max(1, (1 - labels).sum())
    z = (p - q) / np.sqrt(rate * (1 / max(1, labels.sum()) + 1 / max(1, (1 - labels).sum())))
    model["gram"][:, 0] += (np.clip(z, -2, 6) * 0.2).astype(np.float32)
    return model, np.append(np.maximum.reduceat(z[f.grams], f.gram_starts), -9)


def train(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """The network's weights from labelled whole texts."""
    rng, f = np.random.default_rng(seed), Features(texts)
    windows, text = f.windows()
    model, evidence = _start(f, labels, rng)
    first = np.searchsorted(text, np.arange(len(labels)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step, score = 0, evidence[windows].max(1)
    for epoch in range(epochs):
        if epoch >= 2:
            score = _logits(model, f, windows)
        best = np.lexsort((score, text))[np.append(first[1:], len(text)) - 1]
        order = rng.permutation(len(labels))
        for i in range(0, len(order), 128):
            own = order[i:i + 128]

            def slope(logits, own=own):
                return weights[own] * (1 / (1 + np.exp(-logits)) - labels[own]) / len(own)
            _, grad = _gradients(model, f, windows[best[own]], slope)
            step += 1
            rate = 0.02 * min(1, step / 20) * (1 - 0.8 * epoch / epochs)
            for k, g in grad.items():
                m, v = moments[k]
                m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                moments[k] = (m, v)
                model[k] = (model[k] - rate * (m / (1 - 0.9 ** step))
                            / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label", sample: int = SAMPLE) -> dict:
    """Train on at most ``sample`` distinct texts per class, chosen by hash of the text."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(text_col).alias("hash"))
    return _fit(rows.select("label", "hash"), rows.where("label in (0, 1)").select("hash", "text"), sample)


def fit_joined(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "label",
               sample: int = SAMPLE) -> dict:
    """:func:`fit` of the documents that have labels under the same ``key``.

    Texts are hashed before the join: ids and hashes are shuffled, and the texts of the
    sample alone are fetched by their hashes."""
    hashed = docs.select(F.col(key).alias("id"), F.xxhash64(text_col).alias("hash"))
    marks = labels.select(F.col(key).alias("id"), F.col(label_col).cast("int").alias("label"))
    return _fit(hashed.join(marks, "id").select("label", "hash"), docs.select(F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")), sample)


def _fit(rows: DataFrame, texts: DataFrame, sample: int) -> dict:
    """Train on the ``(hash, text)`` rows of the texts chosen from ``(label, hash)``, a row for each labelled text."""
    # Kept by the executors: written out, this small table would be a file for each shuffle partition.
    kinds = rows.where("label in (0, 1)").groupBy("label", "hash").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.DISK_ONLY)
    try:
        return _fit_kinds(kinds, texts, sample)
    finally:
        kinds.unpersist()


def _fit_kinds(kinds: DataFrame, texts: DataFrame, sample: int) -> dict:
    """Train on the ``texts`` of at most ``sample`` hashes per class of ``kinds(label, hash, n)``."""
    sizes = {r.label: (r.rows, r.kinds) for r in kinds.groupBy("label").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("kinds")).collect()}
    total = sum(n for n, _ in sizes.values())
    if len(sizes) < 2:
        return {"share": sizes[1][0] / total if 1 in sizes else 0.0}
    chosen = pa.concat_tables([kinds.where(F.col("label") == k).orderBy("hash").limit(sample).select("label", "hash").toArrow() for k in (0, 1)])
    chosen = F.broadcast(kinds.sparkSession.createDataFrame(chosen))
    table = (texts.join(chosen, "hash").groupBy("label", "hash").agg(F.min("text").alias("text"))
             .orderBy("label", "hash").toArrow().combine_chunks())
    labels = table["label"].to_numpy().astype(np.float64)
    weights = np.where(labels == 1, sizes[1][1] / labels.sum(), sizes[0][1] / (1 - labels).sum())
    weights = weights / weights.mean()
    return train(table["text"].combine_chunks(), labels, weights)


def score(docs: DataFrame, model: dict, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The ``carry`` columns of ``docs`` (all if None) with ``toxicity`` and ``n_windows``.

    ``toxicity`` is the probability of label 1; a carried column of that name is replaced.
    Texts that are carried go to the workers once."""
    added = ("toxicity", "n_windows")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
                       *([] if text_col in carry else [F.col(text_col).alias("scored")]))
    at = carry.index(text_col) if text_col in carry else len(carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        for batch in batches:
            for part in slices(batch, text=at):
                f = Features(part.column(at))
                windows, text = f.windows()
                first = np.searchsorted(text, np.arange(part.num_rows))
                if "share" in model:
                    found = np.full(part.num_rows, model["share"])
                else:
                    top = np.maximum.reduceat(_logits(model, f, windows), first).astype(np.float64)
                    found = 1 / (1 + np.exp(-top))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(carry)], pa.array(found), pa.array(np.diff(np.append(first, len(text))))],
                    names=[*part.schema.names[:len(carry)], *added])

    schema = ", ".join(f"c{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(carry)))
    scored = rows.mapInArrow(run, (schema + ", " if schema else "") + "toxicity double, n_windows long")
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *added)


__all__ = ["fit", "fit_joined", "train", "score", "Features"]
