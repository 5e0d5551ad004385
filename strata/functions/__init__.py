"""Column expressions: everything here returns a ``Column`` and stays inside
Spark's code-generated expression evaluation (no Python UDFs)."""

from strata.functions.dates import (calendar_columns, month_id, quarter_id,
                                    working_day)
from strata.functions.keys import occurrence, row_hash, stable_key, wide_key
from strata.functions.predicates import (all_present, any_missing, blank,
                                         changed, first_reason, is_sentinel)
from strata.functions.text import clean_text, label, normalize_name

__all__ = [
    "calendar_columns", "month_id", "quarter_id", "working_day",
    "occurrence", "row_hash", "stable_key", "wide_key",
    "all_present", "any_missing", "blank", "changed", "first_reason", "is_sentinel",
    "clean_text", "label", "normalize_name",
]
