"""Document quality by attention-based multiple-instance learning (operator 7).

A text is a bag of passages.  Every passage is described by what can be counted
in its bytes (kinds of characters, words and their forms, repeated words) and encoded by one
hidden layer; gated attention (tanh times sigmoid) turns the encodings into
weights that sum to one, and a logistic function of the weighted encoding is the
text's score.  Passages have no labels: the weights are learned from the labels
of whole texts, by gradient steps over a bounded sample.

All passages of a text count, however long it is.  Defined results: null and
empty texts are one passage without words; repeated rows get equal scores;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import released, slices, text_slices, tidy
from quillmill.llm.labelled import labelled_sample, unique_texts

#: Labelled texts used for fitting at most.
SAMPLE = 6_000
#: Words of a passage.
PASSAGE = 48
HIDDEN, GATE = 24, 12

_CLASSES = 10
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _QUOTE, _SYMBOL, _WIDE, _CONTROL = range(_CLASSES)


def _byte_classes() -> np.ndarray:
    out = np.full(256, _SYMBOL, np.uint8)
    out[:32] = _CONTROL
    out[[9, 11, 12, 13, 32]] = _SPACE
    out[10] = _LINE
    out[48:58], out[65:91], out[97:123] = _DIGIT, _UPPER, _LOWER
    for c in ".,;:!?":
        out[ord(c)] = _STOP
    for c in "\"'()":
        out[ord(c)] = _QUOTE
    out[128:] = _WIDE
    return out


_CLASS = _byte_classes()
N_FEATURES = _CLASSES + 13


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of texts without nulls, and each text's bounds among them."""
    texts = pc.cast(texts, pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    kinds = _CLASS[data]
    blank = (kinds == _SPACE) | (kinds == _LINE)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    begin = np.flatnonzero(~blank & (first[:n] | np.concatenate([[True], blank[:-1]]))) if n else np.zeros(0, np.int64)
    word_until = np.searchsorted(begin, offsets)  # words before each text's bounds
    counts = np.diff(word_until)
    pieces = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(pieces)])
    total = int(bounds[-1])
    doc = np.repeat(np.arange(len(texts)), pieces)
    at = np.arange(total) - bounds[doc]
    first_word = word_until[doc] + at * PASSAGE
    start = np.where(at == 0, offsets[doc], begin[np.minimum(first_word, max(0, len(begin) - 1))] if len(begin) else 0)
    stop = np.append(start[1:], n)
    stop = np.where(np.append(doc[1:] != doc[:-1], True), offsets[doc + 1], stop)
    words = np.minimum(PASSAGE, np.maximum(0, word_until[doc + 1] - first_word)).astype(float)

    def summed(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return (total[stop] - total[start]).astype(float)

    out = np.zeros((total, N_FEATURES))
    size = np.maximum(1, stop - start)
    for c in range(_CLASSES):
        out[:, c] = summed(kinds == c) / size
    some = np.maximum(1, words)
    ends = np.searchsorted(np.flatnonzero(blank), begin) if n else np.zeros(0, np.int64)
    blanks = np.flatnonzero(blank)
    end = np.where(ends < len(blanks), blanks[np.minimum(ends, max(0, len(blanks) - 1))] if len(blanks) else n, n)
    if n:
        limit = offsets[np.searchsorted(offsets, begin, side="right").clip(max=len(offsets) - 1)]
        end = np.minimum(end, limit)
    passage = np.searchsorted(start, begin, side="right") - 1 if total else np.zeros(0, np.int64)
    # several empty texts can start at one place; the last of them owns it
    length = (end - begin).astype(float)
    by = lambda v: np.bincount(passage, v, minlength=total) / some
    last = data[np.maximum(end - 1, 0)] if n else np.zeros(0, np.uint8)
    head = kinds[begin] if n else np.zeros(0, np.uint8)
    tail = _CLASS[last]
    out[:, 10] = by(length) / 10
    out[:, 11] = np.sqrt(np.maximum(0, by(length**2) - by(length) ** 2)) / 10
    out[:, 12] = by(head == _UPPER)
    out[:, 13] = by(tail == _SYMBOL)
    out[:, 14] = by((tail == _STOP) & (last == 33))
    out[:, 15] = by((tail == _STOP) & (last == 46))
    out[:, 16] = by((length == 1) & (head == _SYMBOL))
    out[:, 17] = by(length <= 3)
    out[:, 18] = by(length >= 14)
    if n:
        # the same bytes, in whatever order, count as the same word
        value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value[blank] = 0
        hashes = np.add.reduceat(value, begin) if len(begin) else np.zeros(0, np.uint64)
        key = passage.astype(np.uint64) * np.uint64(0x100000001B3) ^ hashes
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        out[:, 19] = by(again)
    out[:, 20] = summed(kinds == _LINE) / some
    out[:, 21] = words / PASSAGE
    out[:, 22] = np.log1p(counts[doc]) / 8
    return out, bounds


class GatedAttention:
    """The network; its parameters are a few thousand numbers."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.p = {"w": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE), "a": draw(GATE, 1)[:, 0] * 0.1, "c": draw(HIDDEN, 1)[:, 0] * 0.1, "d": np.zeros(1)}

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.p
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(z @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["a"]
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        top = np.maximum.reduceat(e, bounds[:-1])
        k = np.exp(e - top[doc])
        attention = k / np.add.reduceat(k, bounds[:-1])[doc]
        bag = np.add.reduceat(h * attention[:, None], bounds[:-1])
        y = 1 / (1 + np.exp(-np.clip(bag @ p["c"] + p["d"][0], -30, 30)))
        return y, (z, h, t, s, attention, bag, doc)

    def gradients(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        out, (z, h, t, s, attention, bag, doc) = self.forward(x, bounds)
        g = (out - y) * weight / weight.sum()
        dbag = g[:, None] * p["c"]
        dh = attention[:, None] * dbag[doc]
        da = np.einsum("ij,ij->i", h, dbag[doc])
        mean = np.add.reduceat(attention * da, bounds[:-1])
        de = attention * (da - mean[doc])
        dts = de[:, None] * p["a"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh += dt @ p["v"].T + ds @ p["u"].T
        dz = dh * (1 - h * h)
        return {"w": z.T @ dz, "b": dz.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de, "c": bag.T @ g, "d": np.array([g.sum()])}

    def fit(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, batch: int = 256, rate: float = 0.01, seed: int = 7) -> None:
        """Adam over shuffled batches of texts."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        sizes = np.diff(bounds)
        for r in range(rounds):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                rows = order[at : at + batch]
                inner = np.concatenate([[0], np.cumsum(sizes[rows])])
                take = np.repeat(bounds[rows] - inner[:-1], sizes[rows]) + np.arange(inner[-1])
                step += 1
                now = rate * 0.5 * (1 + np.cos(np.pi * r / rounds))
                for k, g in self.gradients(x[take], inner, y[rows], weight[rows]).items():
                    g = g + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def score(self, texts: pa.Array) -> np.ndarray:
        x, bounds = passages(texts)
        return self.forward(x, bounds)[0]


def fit_quality(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", folds: int = 4, held_out: int = 2, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> GatedAttention:
    """Fitted on a bounded sample of the labels outside the held-out fold; without
    labels, texts or one of the two labels the score is constant."""
    model = fit(*labelled_sample(docs, labels, label_col, folds=folds, held_out=held_out, most=most, text_col=text_col, id_col=id_col))
    released()
    return model


def fit(texts: list[str], labels: list[int], prior: float | None = None) -> GatedAttention:
    """prior: the share of good texts to expect, where the sample's differs."""
    model = GatedAttention()
    texts, labels = unique_texts(texts, labels)
    if len(set(labels)) < 2:
        model.p["c"][:] = 0
        model.p["d"][0] = 4.0 if not labels or labels[0] else -4.0
        return model
    y = np.array(labels, float)
    prior = prior if prior else float(y.mean())
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    parts = [passages(pa.array(texts[a:b], pa.string())) for a, b in slices(map(len, texts), 2_000_000)]
    sizes = np.concatenate([np.diff(b) for _, b in parts])
    model.fit(np.concatenate([x for x, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]), y, weight)
    return model


def score_quality(docs: DataFrame, model: GatedAttention, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score double (0 to 1)."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays([ids, pa.array(shared.value.score(texts.fill_null("")), pa.float64())], [id_col, "score"])

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), f"`{id_col}` {kind}, score double")


def keep_good(docs: DataFrame, model: GatedAttention, *, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs that reach the threshold, all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            done = 0
            for rows, texts in text_slices(pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(at).cast(pa.string())], ["", "t"])):
                scores = shared.value.score(texts.fill_null(""))
                yield batch.slice(done, len(rows)).filter(pa.array(scores >= threshold))
                done += len(rows)

    return docs.mapInArrow(tidy(run), docs.schema)
