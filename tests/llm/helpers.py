"""Small tables and brute-force versions."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, schema=DOCS):
    """Documents from (doc_id, text, lang, source) rows, in a few partitions."""
    full = [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in rows]
    df = spark.createDataFrame(full, schema)
    return df.repartition(3) if full else df


def stored(spark, df, path):
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


#: Nulls in every column, empty, blank and very long texts, ties, repeated rows.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (None, "a text without an id", "de", "b"),
    (None, None, None, None), (5, "one", "en", "a"), (5, "one", "en", "a"), (6, "One", "en", None),
    (7, "w " * 50_000, "en", "a"), (8, "x" * 100_000, "en", "a"), (9, "12 34 !!", "en", "b"),
    (10, "日本語 テキスト \U0001f642", "ja", "c"), (11, "same words here again now", "en", "a"),
    (12, "same words here again now", "en", "b"),
]


def text(seed, n, vocabulary=2000, prefix="w"):
    """``n`` pseudo-random words."""
    out, x = [], seed * 2654435761 + 12345
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"{prefix}{(x >> 33) % vocabulary}")
    return " ".join(out)
