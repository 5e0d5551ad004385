"""Deterministic surrogate keys and row fingerprints.

Keys are taken from the md5 of an unambiguous text of the inputs: every part is
written with its length in front (``V<length>:<text>``), a null as ``N``, so no
value can look like a delimiter, a null or another split of the same letters.
They are run-to-run stable (unlike ``monotonically_increasing_id``) and
reproducible outside Spark.

``stable_key`` is the first 15 hex digits (60 bits, a positive BIGINT) for
dimension members; collisions follow the birthday bound (about n^2 / 2^61),
negligible up to ~10^8 members.  ``wide_key`` is the whole digest (128 bits, hex)
for facts.  A natural key that occurs more than once gets an occurrence number
as a further part (``occurrence``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# The marks before a value and for a null.
VALUE_MARK, NULL_MARK = "V", "N"


def _part(c: Column | str) -> Column:
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.lit(VALUE_MARK), F.char_length(text).cast("string"), F.lit(":"), text),
                      F.lit(NULL_MARK))


def key_text(*cols: Column | str) -> Column:
    """The canonical string a key is computed from."""
    return F.concat(*[_part(c) for c in cols])


def wide_key(*cols: Column | str) -> Column:
    """128-bit key as 32 hex digits."""
    return F.md5(key_text(*cols))


def stable_key(*cols: Column | str) -> Column:
    """60-bit positive BIGINT key."""
    return F.conv(F.substring(wide_key(*cols), 1, 15), 16, 10).cast("bigint")


def row_hash(*cols: Column | str) -> Column:
    """Content fingerprint (same construction)."""
    return stable_key(*cols)


def occurrence(natural_key: Sequence[str], order: Sequence[str]) -> Column:
    """1, 2, ... among the rows of one natural key, ordered by ``order`` (rows
    equal in all of it are interchangeable)."""
    return F.row_number().over(Window.partitionBy(*natural_key).orderBy(*order))
