"""Registered queries: the operators with their production parameters over
their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_toxicity as toxicity
from . import op2_sentencepiece as sentencepiece
from . import op9_quality as quality
from . import op10_language_id as language
from . import op11_lloyd as lloyd
from . import op13_quality_fm as quality_fm
from .io import table
from .op3_packing import pack_documents
from .op4_sharding import shard_rows
from .op5_ann import search
from .op6_substring_dedup import drop_repeats
from .op7_chat_format import digests, format_windows
from .op8_ngram_jaccard import jaccard_classes, jaccard_counts
from .op12_filter_audit import audit
from .oracle import ORACLE_SQL


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode_checked(docs, sentencepiece.load()).drop("text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, F.col("vec_id") % 20 == 0, k=20)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeats(docs, with_text=False)


#: A conversation whose texts hold control strings of common templates.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(-7).alias("conv_id"), F.lit(turn).alias("turn"), F.lit(role).alias("role"),
                 F.lit(CONTROL_TEXT).alias("text")) for turn, role in enumerate(["user", "assistant"])))))
    return digests(format_windows(turns.unionByName(more)))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8 with the number of links; op8's own columns are those of its SQL."""
    return jaccard_counts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, ["doc_id"]).select(
        "doc_id", *quality.STATISTICS, "base_failed", "kept", "probability")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs), ["doc_id"]).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "languages")


#: Components of the vectors that are clustered.
DIMENSION = 64


def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"), DIMENSION)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model, ["doc_id"]).select(
        "doc_id", quality_fm.held_out().alias("held_out"), "score",
        (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_ann": op5_ann,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "ngram_jaccard_links": ngram_jaccard_links,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_lloyd": op11_lloyd,
    "op12_filter_audit": op12_filter_audit,
    "op13_quality_fm": op13_quality_fm,
}
