"""The corpus pipeline against brute-force versions of its stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from strata.llm.op10_language_id import UNKNOWN

from .helpers import DOCS, ODD, documents, stored, text, words
from .test_models import crc
from .test_pairs import brute_classes, brute_cut

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rows, labels = [], []
    passage = text(77, 60)
    for i in range(180):
        w = text(i if i % 9 else i // 18, 70).split()       # near copies among them
        if i % 4 == 0:
            w[3], w[20], w[41] = "zzidiot", "zzscum", "zztrash"
        if i % 7 == 3:
            w += passage.split()
        rows.append((i, " ".join(w), "en" if i % 2 else "de", f"s{i % 5}"))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(300, "123 456 !!", "en", "s1"), (301, None, "en", "s1"), (302, "", None, None)]
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("corpus")
    rows, labels = corpus()
    # An extra column with an operator's own name.
    docs = documents(spark, rows).withColumn("score", F.lit("kept"))
    docs.write.parquet(str(base / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(base / "labels.parquet"))
    return str(base)


def as_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_every_stage_does_its_own_job(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "ngram_jaccard", "substring_dedup", "packing"]
    toxic = {i for i, _, t in corpus()[1] if t}
    for name, stage in corpus_pipeline.STAGES:
        before = as_rows(docs)
        after = stored(spark, stage(spark, docs, tables), tmp_path / name)
        if name != "packing":
            assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
            assert {r[0] for r in after.select("score").distinct().collect()} == {"kept"}
            left = as_rows(after)
        if name == "language_id":
            assert sorted(left, key=str) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=str)
        elif name == "toxicity":
            gone = {r[0] for r in before} - {r[0] for r in left}
            assert gone == toxic and any(crc(i, 3) == 1 for i in gone)
        elif name == "ngram_jaccard":
            assert sorted(r[0] for r in left) == sorted({c for *_, c in brute_classes(before)})
            assert len(left) < len(before)
        elif name == "substring_dedup":
            assert sorted((i, t) for i, t, *_ in left) == sorted((i, kept) for i, *_, kept in brute_cut(before))
            assert {(r.doc_id, r.n_chars) for r in after.collect()} == {(i, len(t)) for i, t, *_ in left}
            assert sum(len(words(t)) for _, t, *_ in left) < sum(len(words(t)) for _, t, *_ in before)
        else:
            assert sum(r.n_tokens for r in after.collect()) == sum(len(words(t)) for _, t, *_ in before)
            assert {r.doc_id for r in after.collect()} == {r[0] for r in before}
        docs = after


def test_run_is_the_chain_of_stages(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert got.columns == ["doc_id", "piece", "first_token", "n_tokens", "bin_id", "bin_offset"]
    ids = {r.doc_id for r in got.collect()}
    assert ids and ids < {r.doc_id for r in docs.collect()}


def test_odd_and_empty_documents_pass_all_stages(spark, tmp_path):
    for name, rows in (("odd", ODD), ("empty", [])):
        base = tmp_path / name
        df = documents(spark, rows) if rows else spark.createDataFrame([], DOCS)
        df.write.parquet(str(base / "documents.parquet"))
        spark.createDataFrame([], LABELS).write.parquet(str(base / "labels.parquet"))
        got = {r.doc_id for r in corpus_pipeline.run(spark, str(base)).collect()}
        assert got == ({None, 5, 6, 7, 8, 10, 11} - {6} if rows else set())


def test_substring_stage_leaves_clean_documents_as_they_are(spark, tmp_path):
    passage = text(78, 50)
    rows = [(1, "def f(x):\n\n    return  x\n", "en", "a"), (2, f"a\n\tb {passage}", "en", "a"), (3, f"{passage}\nc  d\n", "en", "a")]
    docs = stored(spark, documents(spark, rows), tmp_path / "d")
    got = corpus_pipeline.substring_dedup(spark, docs, "")
    assert got.schema.simpleString() == docs.schema.simpleString()
    want = {1: rows[0][1], 2: "a\n\tb", 3: "c  d\n"}
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {i: (t, len(t)) for i, t in want.items()}


def test_queries_are_registered():
    names = list(queries())
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert {"op6_substring_dedup", "op7_chat_format", "op8_ngram_jaccard"} <= set(oracle_sql())
    assert UNKNOWN == "und"
