"""Quality classifier: a factorisation machine over words, structure and metadata.

Features of a text are its hashed words (frequencies of unit length), statistics
of its structure and metadata columns (each cut in bins, one feature a bin).  A
factorisation machine gives each feature a weight and ``RANK`` factors and adds
the products of the factors of all pairs of features, here words with words,
words with structure and structure with metadata.  Neither training nor scoring
makes the pairs: the sum over pairs is half of ``(sum v x)^2 - sum (v x)^2`` for
each factor, linear in the number of features.

It is trained by AdaGrad on the logistic loss over a bounded sample: at most
``TRAIN_ROWS`` labelled rows (those with the smallest hash of their id) and
``TRAIN_BYTES`` of their text, none of the held-out quarter (``held_out``).  Only
features seen in training have a weight, at most ``2**BITS`` words and a few
hundred bins whatever the corpus.  Every whole text is scored, in Arrow batches.

Labels, lang, source and doc_id are no features.  The metadata column is n_chars
(where the documents have it): its magnitude, and whether it is null.

Defined cases: null and empty texts are scored by their structure and metadata;
null labels do not train, nor do rows without text or id; an id labelled several
times counts as bad if any label says so, and trains with its shortest text;
with labels of one kind only, every score is that label; without labelled rows
it is 0.5; a sample does not depend on how the tables are split; repeated rows
are separate texts; extra columns pass through and cannot clash (only ``score``
is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .io import apply_bound, carried, carry, crc_bucket, training_texts
from .words import Words, chunks

BITS = 17
RANK = 8
THRESHOLD = 0.7
TRAIN_ROWS = 10_000
TRAIN_BYTES = 32 << 20
EPOCHS = 4
RATE = 0.1
#: AdaGrad's first sum of squares, penalty of the factors, spread of their start.
FIRST, PENALTY, SPREAD = 1e-2, 1e-4, 0.05
#: Weight of a bin beside the words' unit length.
BIN_VALUE = 0.5
BINS = 24
METADATA = ("n_chars",)

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
UPPER, DIGIT, STOP, MARK = (np.zeros(256, bool) for _ in range(4))
UPPER[0x41:0x5B] = True
DIGIT[0x30:0x3A] = True
STOP[list(b".?!,;:")] = True
#: Other ASCII signs.
MARK[[b for b in range(0x21, 0x7F) if not LETTER[b] and not DIGIT[b] and not STOP[b]]] = True


class Model(NamedTuple):
    """Intercept, and weight and factors of every feature (0 where not trained)."""

    intercept: float
    weights: np.ndarray
    factors: np.ndarray


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bins of a share: fine near zero, 0 exactly where there is none."""
    x = part / np.maximum(whole, 1)
    return np.where(part > 0, 1 + np.ceil(np.sqrt(np.clip(x, 0, 1)) * (BINS - 2)), 0)


def _magnitude(x: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(x, 0) + 1)


def structure(words: Words) -> list[np.ndarray]:
    """Bins of each text's statistics: its length, word length, and the shares of
    distinct words, repeated neighbours, upper case, digits, stops, other signs,
    words with such a sign at their end, lines and bytes of words."""
    data, texts, n = words.data, len(words.counts), words.counts
    length = np.diff(words.offsets)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[words.offsets])

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[words.first])

    doc = np.repeat(np.arange(texts), n)
    order = np.lexsort((words.hash, doc))
    h, d = words.hash[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    again = np.zeros(len(h), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    letters = per_text(LETTER[data])
    spoken = np.add.reduceat(np.append(words.end - words.begin, 0), np.minimum(words.first[:-1], len(doc))) * (n > 0)
    last = data[words.end - 1] if len(doc) else data[:0]
    return [
        _magnitude(n), 2 * _magnitude(spoken / np.maximum(n, 1)), _share(np.bincount(d[fresh], minlength=texts), n),
        _share(per_word(again), n), _share(per_text(UPPER[data]), letters), _share(per_text(DIGIT[data]), length),
        _share(per_text(STOP[data]), length), _share(per_text(MARK[data]), length),
        _share(per_word(MARK[last]), n), _share(per_text(data == 0x0A), n), _share(spoken, length)]


STATISTICS = 11


def features(part: pa.RecordBatch, metadata: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, value), by text, of a batch of texts and metadata."""
    words = Words(part.column("text"))
    texts = len(words.counts)
    doc = np.repeat(np.arange(texts), words.counts)
    bucket = (words.hash >> np.uint64(64 - BITS)).astype(np.int64)
    both, times = np.unique(doc << BITS | bucket, return_counts=True)
    docs, feature = both >> BITS, both & ((1 << BITS) - 1)
    value = np.log1p(times)
    value /= np.sqrt(np.bincount(docs, value * value, minlength=texts))[docs] if len(docs) else 1
    bins = structure(words)
    for name in metadata:
        column = part.column(name).cast(pa.float64(), safe=False)
        x = column.fill_null(0.0).to_numpy(zero_copy_only=False)
        bins.append(np.where(column.is_null().to_numpy(zero_copy_only=False), BINS - 1,
                             np.clip(_magnitude(np.nan_to_num(x)), 0, BINS - 2)))
    own = [(1 << BITS) + BINS * i + np.clip(b, 0, BINS - 1).astype(np.int64) for i, b in enumerate(bins)]
    docs = np.concatenate([docs, *[np.arange(texts)] * len(own)])
    order = np.argsort(docs, kind="stable")
    return (docs[order], np.concatenate([feature, *own])[order],
            np.concatenate([value, np.full(texts * len(own), BIN_VALUE)])[order])


def size_of(metadata: Sequence[str]) -> int:
    return (1 << BITS) + BINS * (STATISTICS + len(metadata))


def logits(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, texts: int, model: Model) -> np.ndarray:
    """Scores before the logistic function: linear in the number of features, by
    the identity of squares."""
    out = np.bincount(doc, value * model.weights[feature], minlength=texts) + model.intercept
    for f in range(RANK):
        x = value * model.factors[feature, f]
        out += (np.bincount(doc, x, minlength=texts) ** 2 - np.bincount(doc, x * x, minlength=texts)) / 2
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Trainer:
    """AdaGrad on the logistic loss, a text at a time."""

    def __init__(self, size: int):
        self.w, self.v = np.zeros(size), np.random.default_rng(13).normal(0, SPREAD, (size, RANK))
        self.w2, self.v2 = np.full(size, FIRST), np.full((size, RANK), FIRST)
        self.w0, self.w02 = 0.0, FIRST
        self.seen = np.zeros(size, bool)

    def logit(self, f: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[f] * x[:, None]
        return float(self.w0 + self.w[f] @ x + ((vx.sum(axis=0) ** 2) - (vx * vx).sum(axis=0)).sum() / 2)

    def learn(self, f: np.ndarray, x: np.ndarray, label: float) -> None:
        """One step; the features ``f`` are distinct."""
        v = self.v[f]
        vx = v * x[:, None]
        total = vx.sum(axis=0)
        error = sigmoid(self.w0 + self.w[f] @ x + ((total ** 2) - (vx * vx).sum(axis=0)).sum() / 2) - label
        step = error * x
        self.w2[f] += step * step
        self.w[f] -= RATE * step / np.sqrt(self.w2[f])
        step = error * x[:, None] * (total - vx) + PENALTY * v
        self.v2[f] += step * step
        self.v[f] = v - RATE * step / np.sqrt(self.v2[f])
        self.w02 += error * error
        self.w0 -= RATE * error / np.sqrt(self.w02)
        self.seen[f] = True


def _fit(batches: Iterator[pa.RecordBatch], metadata: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(feature, weight, factors) of the features seen; -1 is the intercept."""
    rows, labels = [], []
    for batch in batches:
        for part in chunks(batch, "text"):
            doc, feature, value = features(part, metadata)
            cuts = np.searchsorted(doc, np.arange(1, part.num_rows))
            rows += zip(np.split(feature.astype(np.int32), cuts), np.split(value.astype(np.float32), cuts))
            labels += part.column("label").to_pylist()
    if not rows:
        return
    model = Trainer(size_of(metadata))
    if len(set(labels)) == 1:
        model.w0 = 40.0 if labels[0] else -40.0
    else:
        for epoch in range(EPOCHS):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                model.learn(*rows[i], labels[i])
    used = np.flatnonzero(model.seen)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.append(used, -1)), pa.array(np.append(model.w[used], model.w0)),
        pa.array([*model.v[used].tolist(), []], pa.list_(pa.float64()))], ["feature", "weight", "factors"])


def held_out() -> Column:
    return crc_bucket("doc_id", 4) == 2


def _metadata(docs: DataFrame) -> list[str]:
    return [c for c in METADATA if c in docs.columns]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """The machine learned from the labelled rows that are not held out."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    metadata = _metadata(docs)
    learned = training_texts(docs, known, rows, size, metadata).mapInArrow(
        apply_bound(_fit, metadata), "feature long, weight double, factors array<double>").toPandas()
    n = size_of(metadata)       # at most so many rows
    weights, factors = np.zeros(n, np.float32), np.zeros((n, RANK), np.float32)
    feature, weight = learned["feature"].to_numpy(np.int64), learned["weight"].to_numpy(np.float64)
    own = feature >= 0
    weights[feature[own]] = weight[own]
    if own.any() and (trained := learned["factors"][own]).map(len).all():
        factors[feature[own]] = np.stack(trained.to_numpy())
    return Model(float(weight[~own].sum()), weights, factors)


def _score(batches: Iterator[pa.RecordBatch], metadata: Sequence[str], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [np.zeros(0)]
        for part in chunks(carried(batch, ["text", *metadata]), "text"):
            scores.append(sigmoid(logits(*features(part, metadata), part.num_rows, model)))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(scores))], ["row", "score"])


def score(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) and ``score``, the probability (0 to
    1) that the whole text is of good quality."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    metadata = _metadata(docs)
    rows = carry(docs, keep, ["text", *metadata])
    return (rows.mapInArrow(apply_bound(_score, metadata, model),
                            StructType([rows.schema["row"], StructField("score", DoubleType())]))
            .select("row.*", "score"))
