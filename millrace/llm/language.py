"""Language identification by averaged hashed subword embeddings.

Words are lower-cased (A-Z), framed by a boundary byte and cut into byte
n-grams of 2 to 4; n-grams are hashed to rows of an embedding table, averaged
over the whole text, and classified by a linear softmax, trained by stochastic
gradient descent in numpy.  A temperature fitted on rows left out of the
training calibrates the probability; below ``reject`` the answer is ``und``.
By default ``fit`` takes the probability that all but ``REJECTED`` of those
rows reach.

Null texts and texts without a letter are ``und`` with score 0.  The sample is
bounded: about ``per_label`` rows per language and ``sample_rows`` in all, of
at most ``sample_chars`` characters each.  Ties between languages go to the
first in code-point order.  Repeated rows get equal answers; long texts are
averaged whole; an empty table gives an empty result, and without any labelled
row every answer is ``und``.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, SPACE, U, mix64, spans, text_chunks
from .scratch import small, stored

GRAMS = (2, 3, 4)
#: Share of the calibration rows that a derived threshold rejects at most.
REJECTED = 0.01


def held_out(key: str | Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id as text falls to the fold; false for a null id."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def word_grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct word its hashed n-grams (flat, with starts), the words' order in the text, and where rows start."""
    starts, ends = spans(~SPACE[data], offsets[1:-1])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    size = ends - starts
    packed = LOWER[data][np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(packed)]).dictionary_encode()
    known = words.dictionary
    text = np.frombuffer(b"\n".join([b"", *known.to_pylist(), b""]), np.uint8).astype(U)
    edges = np.flatnonzero(text == U(10))
    flat, owner = [], []
    inside = np.cumsum(text == U(10)) - 1  # the word that a byte belongs to, or opens
    value = np.zeros(len(text), U)
    for n in range(1, max(GRAMS) + 1):
        value = value[: len(text) - n + 1] * U(257) + text[n - 1 :] + U(1)
        if n in GRAMS:
            last = np.arange(len(value)) + n - 1
            whole = inside[np.maximum(last - 1, 0)] == inside[: len(value)]
            at = np.flatnonzero(whole)
            flat.append((mix64(value[at] + U(n << 40)) % U(buckets)).astype(np.int64))
            owner.append(inside[at])
    owner, flat = np.concatenate(owner), np.concatenate(flat)
    order = np.argsort(owner, kind="stable")
    flat = flat[order]
    firsts = np.searchsorted(owner[order], np.arange(len(edges)))
    return flat, firsts, words.indices.to_numpy(), np.searchsorted(starts, offsets)


@dataclass
class Model:
    """A trained classifier: one row of class scores per bucket."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of each row."""
        flat, firsts, order, rows = word_grams(data, offsets, len(self.table))
        n = len(self.labels)
        sums = np.zeros((len(rows) - 1, n + 1))
        if len(order):
            grams = np.hstack([self.table[flat], np.ones((len(flat), 1), np.float32)])
            per_word = np.add.reduceat(grams, firsts[:-1], axis=0).astype(np.float64)
            full = np.flatnonzero(np.diff(rows))
            sums[full] = np.add.reduceat(per_word[order], rows[:-1][full], axis=0)
        logits = (sums[:, :n] / np.maximum(sums[:, n:], 1) + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], buckets: int = 1 << 14, width: int = 16, epochs: int = 4, rate: float = 0.5, reject: float | None = 0.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over single texts; every tenth text is left out for calibration.

    With ``reject`` None the threshold is derived from the calibration rows.
    """
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    bags = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        flat, firsts, order, _ = word_grams(data, np.array([0, len(data)]), buckets)
        times = np.repeat(np.bincount(order, minlength=len(firsts) - 1), np.diff(firsts)) if len(order) else np.zeros(0)
        ids, back = np.unique(flat, return_inverse=True)
        count = np.bincount(back, times, len(ids)) if len(ids) else np.zeros(0)
        bags.append((ids, (count / max(count.sum(), 1)).astype(np.float32)))
    weight = len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1))
    e = rng.normal(0, 0.1, (buckets, width)).astype(np.float32)
    w, b = rng.normal(0, 0.1, (width, len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    hold = np.arange(len(y)) % 10 == 9
    learn = np.flatnonzero(~hold)
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        for i in rng.permutation(learn):
            ids, share = bags[i]
            if not len(ids):
                continue
            v = share @ e[ids]
            z = v @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(weight[y[i]], 10)
            back = w @ p
            w -= lr * np.outer(v, p)
            b -= lr * 0.1 * p
            e[ids] -= lr * 10 * share[:, None] * back[None, :]
    model = Model(names, e @ w, b, 1.0, reject or 0.0)
    cal = [i for i in np.flatnonzero(hold) if len(bags[i][0])] or [i for i in learn if len(bags[i][0])]
    z = np.array([bags[i][1] @ model.table[bags[i][0]] + b for i in cal]).reshape(-1, len(names))

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(cal)), y[cal]]))

    if len(cal):
        model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
        if reject is None:
            best = 1 / np.exp((z - z.max(axis=1, keepdims=True)) / model.temperature).sum(axis=1)
            # Below 1 by more than the rounding of probabilities.
            model.reject = min(float(np.quantile(best, REJECTED, method="lower")), 1 - 1e-12)
    return model


def sample(docs: DataFrame, per_label: int, sample_rows: int, sample_chars: int, text: str, label: str, key: str) -> tuple[list[str], list[str]]:
    """A bounded, hash-ordered sample of labelled rows outside the held-out fold."""
    rows = docs.where(F.col(key).isNotNull() & ~held_out(key) & F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(text).alias("text"), F.col(label).alias("label"), F.xxhash64(text, F.lit("sample")).alias("h")).where(F.length("text") <= sample_chars)
    counts = stored(rows.groupBy("label").count(), "labels")
    part = rows.join(small(counts), "label").where(F.pmod("h", F.lit(1 << 30)) < F.lit(float(1 << 30)) * per_label / F.col("count"))
    got = part.orderBy("h", "text").limit(sample_rows).select("text", "label").collect()
    return [r["text"] for r in got], [r["label"] for r in got]


def fit(docs: DataFrame, per_label: int = 700, sample_rows: int = 6000, sample_chars: int = 20_000, reject: float | None = None, text: str = "text", label: str = "lang", key: str = "doc_id") -> Model | None:
    """Train on a bounded sample; None if no row is labelled."""
    texts, labels = sample(docs, per_label, sample_rows, sample_chars, text, label, key)
    return train(texts, labels, reject=reject) if texts else None


def identify(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = [], []
            letters = batch.column(2).to_pylist()
            for first, last, data, offsets in text_chunks(batch.column(3)):
                if model is None:
                    pred += ["und"] * (last - first)
                    score += [0.0] * (last - first)
                    continue
                p = model.scores(data, offsets)
                for i, best in enumerate(p.argmax(axis=1), first):
                    sure = letters[i] and p[i - first, best] >= model.reject
                    pred.append(model.labels[best] if sure else "und")
                    score.append(float(p[i - first, best]) if letters[i] else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
