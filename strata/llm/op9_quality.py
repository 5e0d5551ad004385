"""Quality rules: text statistics and a calibrated n-gram classifier.

Statistics of whole texts (see ``statistics``) fail a text with fewer than 20
words or with more than 30 % of its words in repeated 8-word windows.  The rest
is judged by a logistic regression over hashed n-grams: characters (code points,
2 and 3) and words (1 and 2), each family as relative frequencies.  It is
trained by AdaGrad on a bounded sample of labelled rows (``TRAIN_ROWS``, those
with the smallest hash of their id, and at most ``TRAIN_BYTES`` of their text);
a fifth of the sample is kept apart to calibrate probabilities (Platt scaling).
A text is kept when its probability of good quality reaches ``THRESHOLD``.
Statistics and scores cover every whole text, in Arrow batches.

Defined cases: a null text counts as empty (0 everywhere, ``base_failed``);
an id labelled several times counts as bad if any label says so, and trains with
its shortest text; null labels, texts and ids do not train; the sample does not
depend on how the tables are split; without labelled rows of both kinds the
statistics alone decide; repeated rows are separate texts; extra columns pass
through and cannot clash (only the columns added here are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .io import apply_bound, carried, carry, training_texts
from .words import Words, chunks, covered, mix, span_hashes

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

BITS = 18
FAMILIES = 4
SCALE = 50.0
RATE = 0.5
EPOCHS = 5
TRAIN_ROWS = 10_000
TRAIN_BYTES = 32 << 20
THRESHOLD = 0.5

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(words: Words) -> dict[str, np.ndarray]:
    """Per text: n_words; word_chars, code points in words; n_symbols, characters
    of ``#*$%&|<>``; n_dup_lines, lines with a word that equal an earlier line;
    n_repeat_words, words in 8-word windows that occur twice or more."""
    data, offsets, texts = words.data, words.offsets, len(words.counts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[offsets])

    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.begin] = 1
    inside[words.end] -= 1
    points = (np.cumsum(inside, dtype=np.int8)[:-1] > 0) & ((data & 0xC0) != 0x80)

    # Lines: spans between line feeds and text borders.
    feed = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([offsets[:-1], feed + 1]))
    end = np.sort(np.concatenate([offsets[1:], feed]))
    filled = np.searchsorted(words.begin, end) > np.searchsorted(words.begin, start)
    start, end = start[filled], end[filled]
    doc = np.searchsorted(offsets, start, "right") - 1
    dup_lines = _later_equals(span_hashes(data, start, end), doc, texts)

    hashes, at = words.windows(REPEAT_WINDOW)
    doc = np.repeat(np.arange(texts), words.counts)[at]
    keys = _keyed(hashes, doc)
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    repeated = covered(at[twice], REPEAT_WINDOW, len(words.begin))
    return {
        "n_words": words.counts,
        "word_chars": per_text(points),
        "n_symbols": per_text(SYMBOLS[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.diff(np.append(0, np.cumsum(repeated))[words.first]),
    }


def _keyed(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1)))


def _later_equals(hashes: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Per text, how many of its hashes equal an earlier one of it."""
    keys = _keyed(hashes, doc)
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(doc[order[1:][equal]], minlength=texts)


def characters(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for every character of a chunk, equal for equal characters only,
    and the texts' offsets in characters."""
    data = words.data
    lead = (data & 0xC0) != 0x80        # first byte of a character
    at = np.flatnonzero(lead)
    size = np.diff(np.append(at, len(data)))
    code = data[at].astype(np.uint64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << np.uint64(6) | (data[at[more] + k] & 0x3F)
    return code, np.append(0, np.cumsum(lead))[words.offsets]


def families(words: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bucket of every n-gram by family, with each text's range of them."""
    code, offsets = characters(words)
    lo, hi = offsets[:-1], offsets[1:]
    out = []
    pair = code[:-1] << np.uint64(32) | code[1:] if len(code) > 1 else code[:0]
    triple = mix(pair[:-1]) + code[2:] if len(code) > 2 else code[:0]
    for k, grams in ((2, pair), (3, triple)):
        bucket = (mix(grams + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.uint32)
        out.append((bucket, lo, np.maximum(hi - k + 1, lo)))
    h = words.hash
    double = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else h[:0]
    for k, grams in ((1, h), (2, double)):
        out.append(((grams >> np.uint64(64 - BITS)).astype(np.uint32), words.first[:-1],
                    np.maximum(words.first[1:] - k + 1, words.first[:-1])))
    return out


def vectors(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and values of each text."""
    parts = families(words)
    for d in range(len(words.counts)):
        index, value = [], []
        for f, (bucket, lo, hi) in enumerate(parts):
            own = bucket[lo[d]:hi[d]]
            if len(own):
                distinct, n = np.unique(own, return_counts=True)
                index.append(distinct.astype(np.int32) + (f << BITS))
                value.append((n * (SCALE / len(own))).astype(np.float32))
        yield (np.concatenate(index) if index else np.zeros(0, np.int32),
               np.concatenate(value) if value else np.zeros(0, np.float32))


def logits(words: Words, weights: np.ndarray, intercept: float) -> np.ndarray:
    out = np.full(len(words.counts), intercept)
    for f, (bucket, lo, hi) in enumerate(families(words)):
        sums = np.append(0.0, np.cumsum(weights[f << BITS:(f + 1) << BITS][bucket], dtype=np.float64))
        n = hi - lo
        hi = np.minimum(hi, len(sums) - 1)
        lo = np.minimum(lo, len(sums) - 1)
        out += np.where(n > 0, SCALE * (sums[hi] - sums[lo]) / np.maximum(n, 1), 0.0)
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated logit: damped Newton steps on logits of
    unit spread; smoothed targets keep separable samples finite."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    spread = float(z.std()) or 1.0
    x = np.column_stack([z / spread, np.ones(len(z))])

    def loss(ab):
        m = x @ ab
        return float((np.logaddexp(0, m) - target * m).sum())

    at = np.zeros(2)
    for _ in range(100):
        p = sigmoid(x @ at)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return (at[0] / spread, at[1]) if at[0] > 0 else (1.0, 0.0)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Calibrated weights that are not zero; number -1 is the intercept."""
    rows, labels = [], []
    for batch in batches:
        for part in chunks(batch, "text"):
            rows += vectors(Words(part.column("text")))
            labels += part.column("label").to_pylist()
    y = np.array(labels, np.float64)
    if not 0 < y.sum() < len(y):
        return
    test = np.arange(len(y)) % 5 == 4
    w, g2 = np.zeros(FAMILIES << BITS), np.full(FAMILIES << BITS, 1e-2)
    w0, g0 = 0.0, 1e-2
    train = np.flatnonzero(~test)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(train):
            f, x = rows[i]
            error = sigmoid(w0 + w[f] @ x) - y[i]
            step = error * x
            g2[f] += step * step
            w[f] -= RATE * step / np.sqrt(g2[f])
            g0 += error * error
            w0 -= RATE * error / np.sqrt(g0)
    if 0 < y[test].sum() < test.sum():
        a, b = _platt(np.array([w0 + w[f] @ x for (f, x), t in zip(rows, test) if t]), y[test])
        w, w0 = a * w, a * w0 + b
    used = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), pa.array(np.append(w[used], w0))], ["feature", "weight"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float] | None:
    """Dense weights (a fixed number) and intercept, None without both labels."""
    known = (labels.where(F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    learned = training_texts(docs, known, rows, TRAIN_BYTES).mapInArrow(
        _fit, "feature long, weight double").toPandas()
    if not len(learned):
        return None
    weights = np.zeros(FAMILIES << BITS, np.float32)
    feature, weight = learned["feature"].to_numpy(), learned["weight"].to_numpy()
    weights[feature[feature >= 0]] = weight[feature >= 0]
    return weights, float(weight[feature < 0].sum())


def _judge(batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, float] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[list[np.ndarray]] = []
        for part in chunks(carried(batch, ["text"]), "text"):
            words = Words(part.column("text"))
            stats = statistics(words)
            n = stats["n_words"]
            failed = (n < MIN_WORDS) | (100 * stats["n_repeat_words"] > REPEAT_PERCENT * n)
            p = sigmoid(logits(words, *model)) if model else np.ones(len(n))
            found.append([*(stats[s].astype(np.int64) for s in STATISTICS), failed,
                          ~failed & (p >= THRESHOLD), p])
        if found:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row")] + [pa.array(np.concatenate(c)) for c in zip(*found)], ["row", *ADDED])


#: The columns that ``judge`` adds.
ADDED = [*STATISTICS, "base_failed", "kept", "probability"]


def judge(docs: DataFrame, model: tuple[np.ndarray, float] | None, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with the statistics, base_failed,
    kept and probability."""
    rows = carry(docs, [c for c in (docs.columns if keep is None else keep) if c not in ADDED], ["text"])
    schema = StructType([rows.schema["row"], *(StructField(s, LongType()) for s in STATISTICS),
                         StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
                         StructField("probability", DoubleType())])
    return rows.mapInArrow(apply_bound(_judge, model), schema).select("row.*", *ADDED)
