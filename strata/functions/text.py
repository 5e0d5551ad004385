"""Text standardisation and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the legal-suffix rewrite turns a
# trailing "INC." (after upper-casing, with any spaces before it) into " INC".
LEGAL_SUFFIX_PATTERN = r"\s*INC\.$"
LEGAL_SUFFIX_REPLACEMENT = " INC"


def clean_text(c: Column | str) -> Column:
    """Upper-case, trim, collapse inner whitespace, normalise a trailing "INC."."""
    c = F.col(c) if isinstance(c, str) else c
    collapsed = F.regexp_replace(F.trim(F.upper(c)), r"\s+", " ")
    return F.regexp_replace(collapsed, LEGAL_SUFFIX_PATTERN, LEGAL_SUFFIX_REPLACEMENT)


def label(code: Column | str, desc: Column | str, sep: str = "-") -> Column:
    """``code-desc`` display label; a missing part is skipped, not propagated."""
    return F.concat_ws(sep, code, desc)


def normalize_name(name: str) -> str:
    """Column-name normalisation used at the scan boundary: drop dots and
    spaces so names never need back-quoting downstream ("Invoice.Number" ->
    "InvoiceNumber")."""
    return name.replace(".", "").replace(" ", "")
