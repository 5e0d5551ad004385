"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its lower-cased words, of its
word pairs, and of its skip-grams (pairs with one or two words between), in
2**22 buckets.  The model is fitted by FTRL-proximal: a learning rate a
coordinate and an L1 penalty that keeps all but the telling coordinates at
exactly zero, so the weights sent to the scoring tasks are few.

Training reads a bounded sample: ``TRAIN_ROWS`` labelled rows (those with the
smallest hash of their id, so an unbiased sample), and of these no more than
``TRAIN_BYTES`` of text.  Scoring reads every whole text, in Arrow batches.

Defined cases: null and empty texts have no feature and get the score of the
intercept; rows whose label, text or id is null do not train; an id labelled
several times counts as toxic if any label says so, and trains with its shortest
text; the sample does not depend on how the tables are split; without labelled
rows (or without a toxic one) every score is 0; extra columns are ignored by the
score, pass through and cannot clash (only the score's own column is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .io import apply_bound, carried, carry, crc_bucket, training_texts
from .words import PUNCTUATION, Words, chunks, mix

BITS = 22
THRESHOLD = 0.7
TRAIN_ROWS = 20_000
TRAIN_BYTES = 64 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.1
SKIPS = (1, 2, 3)       # distance of the second word: pair, skip-grams


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every feature occurrence, by text."""
    words = Words(pc.utf8_lower(texts), space=PUNCTUATION)
    h, m = words.hash, len(words.begin)
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    last = np.repeat(words.first[1:], words.counts)
    docs, buckets = [doc], [h >> np.uint64(64 - BITS)]
    for d in SKIPS:
        at = np.flatnonzero(np.arange(m) + d < last)
        pair = mix(h[at] * np.uint64(2 * d + 1) + (h[at + d] ^ np.uint64(d)))
        docs.append(doc[at])
        buckets.append(pair >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(buckets).astype(np.int64)


def feature_sets(texts: pa.Array) -> list[np.ndarray]:
    """Distinct buckets of each text."""
    doc, bucket = features(texts)
    both = np.unique(doc << BITS | bucket)
    cuts = np.searchsorted(both, np.arange(1, len(texts)) << BITS)
    return [(s & ((1 << BITS) - 1)).astype(np.int32) for s in np.split(both, cuts)]


class Ftrl:
    """FTRL-proximal over binary features; the intercept has no L1 penalty."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.z0 = self.n0 = 0.0

    def weights(self, f: np.ndarray) -> np.ndarray:
        z = self.z[f]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[f])) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0
        return w

    @property
    def intercept(self) -> float:
        return -self.z0 / ((BETA + np.sqrt(self.n0)) / ALPHA + L2)

    def learn(self, f: np.ndarray, label: int) -> None:
        w, w0 = self.weights(f), self.intercept
        g = sigmoid(w0 + w.sum()) - label
        n = self.n[f]
        self.z[f] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[f] = n + g * g
        self.z0 += g - (np.sqrt(self.n0 + g * g) - np.sqrt(self.n0)) / ALPHA * w0
        self.n0 += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights that are not zero; bucket -1 is the intercept."""
    sets, labels = [], []
    for batch in batches:
        for part in chunks(batch, "text"):
            sets += feature_sets(part.column("text"))
            labels += part.column("label").to_pylist()
    model = Ftrl()
    if 0 < sum(labels):
        for epoch in range(EPOCHS):
            for i in np.random.default_rng(epoch).permutation(len(sets)):
                model.learn(sets[i], labels[i])
        f = np.flatnonzero(np.abs(model.z) > L1)
        w = model.weights(f)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(f, -1)), pa.array(np.append(w, model.intercept))], ["bucket", "weight"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights learned from the labelled rows outside the held-out
    third (see ``held_out``)."""
    known = (labels.where(F.col("toxic").isNotNull()).where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    weights = training_texts(docs, known, rows, TRAIN_BYTES).mapInArrow(
        _fit, "bucket long, weight double").collect()       # L1 keeps them few
    return (np.array([r["bucket"] for r in weights], np.int64),
            np.array([r["weight"] for r in weights], np.float64))


def held_out():
    return crc_bucket("doc_id", 3) == 1


def _score(batches: Iterator[pa.RecordBatch], buckets: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    dense = np.zeros(1 << BITS, np.float32)
    dense[buckets[buckets >= 0]] = weights[buckets >= 0]
    intercept = weights[buckets < 0].sum()
    for batch in batches:
        scores = [np.zeros(0)]
        for part in chunks(carried(batch, ["text"]), "text"):
            doc, bucket = features(part.column("text").fill_null(""))
            hit = np.flatnonzero(dense[bucket])
            both = np.unique(doc[hit] << BITS | bucket[hit])
            sums = np.bincount(both >> BITS, dense[both & ((1 << BITS) - 1)], minlength=part.num_rows)
            scores.append(sigmoid(sums + intercept) if len(weights) else np.zeros(part.num_rows))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(scores))], ["row", "score"])


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: Sequence[str]) -> DataFrame:
    """(row, score): the columns ``keep`` as one struct, the score of the whole text."""
    rows = carry(docs, keep, ["text"])
    return rows.mapInArrow(apply_bound(_score, *model),
                           StructType([rows.schema["row"], StructField("score", DoubleType())]))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], out: str = "score",
          keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with the score of every whole text
    (0 to 1) in column ``out``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    return scored(docs, model, keep).select("row.*", F.col("score").alias(out))
