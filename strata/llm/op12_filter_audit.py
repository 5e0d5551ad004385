"""Filter interaction audit: what every order of five filters would remove.

Each document fails or passes five filters (``conditions``).  Spark counts the
documents of every part by these five outcomes; a part's counts, reshaped to
2 x 2 x 2 x 2 x 2 (axis: filter; 0 passes, 1 fails), are a contingency tensor.
Every figure of a step is a contraction of that tensor with one selector an
axis, pass ``[1, 0]``, fail ``[0, 1]`` or all ``[1, 1]``: what a step removes
passes all earlier filters and fails its own, what it fails alone passes all
others, and so on.  One ``einsum`` contracts all steps of all 120 orders.

No order runs over the documents again: the texts are read once, only ids,
outcomes and a SHA-256 of each text are shuffled, and the contractions work on
32 numbers a part, in as many tasks as there are parts.

Filter E (an equal text with a smaller doc_id) needs the smallest id of every
text.  Equal rows are first added up by id and text, then by text and part, both
with partial aggregation, so a text that a third of all rows share reaches one
task as a few rows a part; no group of copies is gathered or joined.

Defined cases: a null text is empty, a null lang the part ``''`` (also that of
the language ``''``); a document without id has no smaller id and never fails E,
nor is its id smaller than another; repeated rows are separate documents, and
equal texts of one id do not fail each other; an id labelled several times
counts as good (toxic) if any label says so; labels of unknown documents and
extra columns are ignored; without documents there is no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
_FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_AUDIT = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in _FIGURES)


def conditions(text: Column, words: Column) -> dict[str, Column]:
    """When a (not null) text with these words fails the filters A to D."""
    upper = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper > UPPER_PERCENT * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def outcomes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, docs, good, toxic): documents by part and outcome; bit i
    of ``pattern`` (the first filter has the highest) is set when filter i fails."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(c, 1 << (len(FILTERS) - 1 - i)).otherwise(0)
            for i, c in enumerate(conditions(F.col("text"), F.col("words")).values())]
    rows = (docs.select("doc_id", text.alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
            .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
            .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), sum(bits, F.lit(0)).alias("pattern"))
            .groupBy("doc_id", "part", "sha", "pattern").agg(F.count(F.lit(1)).alias("n")))
    known = (labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality").cast("int") == 1).alias("good"), F.max(F.col("toxic").cast("int") == 1).alias("toxic"))
        .select(F.col("doc_id").alias("labelled"), F.xxhash64("doc_id").alias("key"), "good", "toxic"))
    # A null id meets no label; the text's hash as its key spreads such rows.
    keyed = rows.withColumn("key", F.when(F.col("doc_id").isNull(), F.xxhash64("sha")).otherwise(F.xxhash64("doc_id")))
    judged = (keyed.join(known, (keyed["key"] == known["key"]) & (keyed["doc_id"] == known["labelled"]), "left")
              .select("doc_id", "part", "sha", "pattern", "n", F.coalesce("good", F.lit(False)).alias("good"),
                      F.coalesce("toxic", F.lit(False)).alias("toxic")))
    # Rows of a text by part and label, the smallest id's counted apart.
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    texts = judged.groupBy("sha", "pattern", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min(own).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("sha"))
    first = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    passes = texts.withColumn("passes", F.col("without_id") + first)
    split = passes.select("part", "good", "toxic", F.explode(F.array(
        F.struct("pattern", F.col("passes").alias("n")),
        F.struct((F.col("pattern") + 1).alias("pattern"), (F.col("n") - F.col("passes")).alias("n")))).alias("o"))
    return split.groupBy("part", F.col("o.pattern").alias("pattern")).agg(
        F.sum("o.n").alias("docs"), F.sum(F.when(F.col("good"), F.col("o.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("o.n")).otherwise(0)).alias("toxic"))


def selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """(order, step) of every step, and for each figure its selectors: steps x
    axes x 2."""
    steps = [("".join(order), k) for order in permutations(FILTERS) for k in range(len(FILTERS))]

    def stack(choose) -> np.ndarray:
        return np.array([[choose(order, k, f) for f in FILTERS] for order, k in steps], np.int64)
    return steps, {
        "kept": stack(lambda order, k, f: PASS if order.index(f) <= k else ALL),
        "removed": stack(lambda order, k, f: FAIL if f == order[k] else PASS if order.index(f) < k else ALL),
        "failing": stack(lambda order, k, f: FAIL if f == order[k] else ALL),
        "unique_fails": stack(lambda order, k, f: FAIL if f == order[k] else PASS),
    }


def contract(tensors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Parts x steps: each part's tensor contracted with each step's selectors."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *np.moveaxis(chosen, 1, 0), optimize="greedy")


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, chosen = selectors()
    for batch in batches:
        parts = batch.num_rows
        if not parts:
            continue
        cells = batch.column("cells")
        own = np.repeat(np.arange(parts), cells.value_lengths().to_numpy())
        pattern, *counts = (c.to_numpy() for c in cells.flatten().flatten())
        tensors = np.zeros((len(counts), parts, 1 << len(FILTERS)), np.int64)
        tensors[:, own, pattern] = counts
        docs, good, toxic = tensors.reshape(len(counts), parts, *[2] * len(FILTERS))
        found = {name: contract(docs, chosen[name]) for name in ("kept", "removed", "unique_fails")}
        found["redundant"] = contract(docs, chosen["failing"]) - found["removed"]
        found["good_lost"], found["toxic_lost"] = (contract(t, chosen["removed"]) for t in (good, toxic))
        acting = np.array([order[k] for order, k in steps])
        found["shapley"] = np.zeros_like(found["removed"])
        for f in FILTERS:
            found["shapley"][:, acting == f] = found["removed"][:, acting == f].sum(axis=1, keepdims=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(batch.column("part").to_pylist(), len(steps)), pa.string()),
            pa.array([order for order, _ in steps] * parts), pa.array([k + 1 for _, k in steps] * parts, pa.int32()),
            pa.array(acting.tolist() * parts), *(pa.array(found[c].ravel()) for c in _FIGURES)],
            ["part", "filter_order", "step", "filter", *_FIGURES])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order of the filters and step (see the module's notes):
    part, filter_order, step (from 1), filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, the documents that the
    filter removes, summed over all orders."""
    cells = F.collect_list(F.struct("pattern", "docs", "good", "toxic"))      # 32 at most
    return outcomes(docs, labels).groupBy("part").agg(cells.alias("cells")).mapInArrow(_audit, _AUDIT)
