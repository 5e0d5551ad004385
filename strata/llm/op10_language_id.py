"""Language ID by mixture inference: every text is a blend of languages.

Training counts hashed character n-grams (1 to 3 letters, word ends marked) of
all labelled rows outside the held-out quarter, summed per language by Spark.  A text is then a draw from a
mixture of the languages' n-gram distributions: expectation-maximisation
estimates its language proportions.  The set of languages is chosen by
penalised likelihood: starting from the likeliest single language, the next
language (in order of its share under all languages) joins while it raises
``log likelihood - PENALTY * languages * log(n-grams)``.

``lang_pred`` is the language with the largest proportion, ``score`` that
proportion.  Letters are lower-cased; digits, punctuation and white space only
separate words.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
no languages; ties go to the alphabetically first language; without labelled
rows every text is ``und``; at most ``LANGUAGES`` languages are learned, those with the
most labelled rows (of equal ones the alphabetically first), which bounds the
model whatever values the column holds; repeated rows are separate texts; extra
columns pass through and cannot clash (only the columns added here are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from .io import apply_bound, carried, carry, crc_bucket
from .words import chunks, mix

BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
ROUNDS = 10
PENALTY = 3.0
UNKNOWN = "und"
LANGUAGES = 128
#: Text bytes handled at once: a character takes about 100 bytes meanwhile.
PIECE = 1 << 18


def lower_letters(points: np.ndarray) -> np.ndarray:
    """Code points as lower-case letters, 0 for all that is no letter."""
    seen = np.flatnonzero(np.bincount(points))
    table = np.zeros(int(seen[-1]) + 1 if len(seen) else 1, np.uint32)
    for c in seen.tolist():
        if (s := chr(c)).isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table[points]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram, and whether each text has a letter."""
    strings = texts.to_pylist()
    points = np.frombuffer("".join(f"\0{s or ''}\0" for s in strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = lower_letters(points)
    # Runs of separators become one; every text begins and ends with one.
    lengths = np.array([len(s or "") for s in strings])
    doc = np.repeat(np.arange(len(strings)), lengths + 2)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0) | (doc[1:] != doc[:-1])
    code, doc = code[keep].astype(np.uint64) + np.uint64(1), doc[keep]
    has = np.zeros(len(strings), bool)
    has[doc[code > 1]] = True
    docs, buckets = [], []
    h = np.zeros(len(code), np.uint64)
    for k in ORDERS:
        m = len(code) - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + code[k - 1:]
        ok = doc[:m] == doc[k - 1:]
        ok &= code[:m] > 1 if k == 1 else (code[:m] > 1) | (code[1:m + 1] > 1)
        for i in range(1, k - 1):       # no word end inside
            ok &= code[i:i + m] > 1
        docs.append(doc[:m][ok])
        buckets.append(mix(h[ok] + np.uint64(k)) >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(buckets).astype(np.int64), has


def gram_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their counts, text by text (none without letters)."""
    doc, bucket, has = grams(texts)
    order = np.argsort(doc, kind="stable")
    bucket = bucket[order]
    cuts = np.searchsorted(doc[order], np.arange(len(texts) + 1))
    for d in range(len(texts)):
        if not has[d]:
            yield bucket[:0], bucket[:0]
            continue
        part = bucket[cuts[d]:cuts[d + 1]]
        if len(part) > 1 << 13:
            counts = np.bincount(part, minlength=1 << BITS)
            filled = np.flatnonzero(counts)
            yield filled, counts[filled]
        else:
            yield np.unique(part, return_counts=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in chunks(batch, "text", PIECE):
            langs = part.column("lang").to_pylist()
            doc, bucket, _ = grams(part.column("text"))
            for lang in set(langs):
                own = np.array([x == lang for x in langs])[doc]
                more = np.bincount(bucket[own], minlength=1 << BITS)
                total[lang] = total[lang] + more if lang in total else more
    for lang, counts in total.items():
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(filled)), pa.array(filled), pa.array(counts[filled])],
            ["lang", "bucket", "n"])


def held_out():
    return crc_bucket("doc_id", 4) == 2


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their n-gram probabilities, one column each.

    At most 2**BITS counts of LANGUAGES languages reach the driver, whatever the corpus."""
    known = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out())
    most = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    learned = [r["lang"] for r in most.collect()]
    counted = (known.where(F.col("lang").isin(learned)).mapInArrow(_count, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counted["lang"].unique())
    counts = np.full((1 << BITS, len(langs)), SMOOTHING)
    for i, lang in enumerate(langs):
        own = counted[counted["lang"] == lang]
        counts[own["bucket"].to_numpy(), i] += own["n"].to_numpy()
    return langs, (counts / counts.sum(axis=0)).astype(np.float64)


def _em(p: np.ndarray, n: np.ndarray, total: float, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of the mixture's parts and the log likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        joint = p @ share
        share = share * ((n / joint) @ p) / total
    return share, float(n @ np.log(p @ share))


def infer(p: np.ndarray, logs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Proportions of all languages (0 for those not selected); ``p``: n-gram
    probabilities (n-grams x languages), ``logs``: their logarithms, ``n``: counts."""
    n = n.astype(np.float64)
    total = n.sum()
    single = n @ logs
    chosen, best = [int(single.argmax())], single.max() - PENALTY * np.log(total + 1)
    share = np.zeros(p.shape[1])
    share[chosen[0]] = 1.0
    if p.shape[1] == 1:
        return share
    blend, _ = _em(p, n, total, 4)
    for lang in np.argsort(-blend, kind="stable"):
        if int(lang) in chosen:
            continue
        trial = [*chosen, int(lang)]
        part, likelihood = _em(p[:, trial], n, total)
        value = likelihood - PENALTY * len(trial) * np.log(total + 1)
        if value <= best:
            break
        chosen, best = trial, value
        share[:] = 0
        share[trial] = part
    return share


def _predict(batches: Iterator[pa.RecordBatch], langs: list[str], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    logs = np.log(table)
    for batch in batches:
        pred, score, mixture = [], [], []
        for part in chunks(carried(batch, ["text"]), "text", PIECE):
            for buckets, n in gram_counts(part.column("text")):
                if not len(buckets) or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    mixture.append([])
                    continue
                share = infer(table[buckets], logs[buckets], n)
                top = int(share.argmax())
                pred.append(langs[top])
                score.append(min(1.0, float(share[top])))
                mixture.append([(langs[i], float(share[i])) for i in np.argsort(-share, kind="stable") if share[i] > 0])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row")] + [
                pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                pa.array([[{"lang": a, "share": b} for a, b in m] for m in mixture], kind)],
            ["row", *ADDED])


#: The columns that ``predict`` adds.
ADDED = ["lang_pred", "score", "languages"]


def judged(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: Sequence[str]) -> DataFrame:
    """(row, lang_pred, score, languages): the columns ``keep`` as one struct."""
    rows = carry(docs, keep, ["text"])
    schema = StructType([
        rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("languages", ArrayType(StructType([
            StructField("lang", StringType()), StructField("share", DoubleType())])))])
    return rows.mapInArrow(apply_bound(_predict, *model), schema)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with lang_pred, score and languages
    (the selected languages with their proportions, largest first) of every whole text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    return judged(docs, model, keep).select("row.*", *ADDED)
