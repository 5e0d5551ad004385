"""Training-data pipeline over ``documents`` (operators of ``strata.llm``).

``STAGES`` lists the stages in order.  Each takes the documents that its
predecessor kept, learns, where it learns, from those alone, and returns the
columns of ``documents``; the last one returns the packed pieces.

* language ID: a document stays if it has a language, whatever its mixture; one
  without a letter goes;
* toxicity: a document with a score of 0.7 or more goes;
* n-gram Jaccard join: the smallest doc_id of each class of near copies stays;
* substring dedup: words in repeated 35-word windows go, every document stays,
  with all its other words and their white space as they are;
* best-fit packing: one row a piece of a document.

Operators carry the columns of ``documents`` in one struct, so that extra columns
never clash with theirs.  Null ids, texts and languages are handled as the
operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import op1_toxicity as toxicity
from strata.llm import op10_language_id as language
from strata.llm.io import stage, table
from strata.llm.op3_packing import pack_documents
from strata.llm.op6_substring_dedup import WINDOW, judged
from strata.llm.op8_ngram_jaccard import one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    langs, grams = language.fit(docs)
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged_docs = language.judged(docs, (langs, grams), docs.columns)
    return judged_docs.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, docs.columns).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = judged(docs, docs.columns, WINDOW, True)
    kind = dict(docs.dtypes)
    now = {}
    if "n_chars" in kind:       # the count of the text that is left
        now["n_chars"] = (F.when(F.col("n_removed") > 0, F.char_length("row.text").cast(kind["n_chars"]))
                          .otherwise(F.col("row.n_chars")).alias("n_chars"))
    return cut.select(*(now.get(c, F.col(f"row.`{c}`")) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: The learned stages cannot be written in SQL; the tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each result stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
