"""Predicates used by quality rules and change detection."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """True when the value is null or only whitespace."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def is_sentinel(c: Column | str, sentinels: Sequence[str] = ("NA",)) -> Column:
    """True when the trimmed value is one of the sentinel spellings of 'missing'."""
    return F.coalesce(F.trim(_col(c)).isin(list(sentinels)), F.lit(False))


def any_missing(cols: Iterable[Column | str]) -> Column:
    """Disjunction of ``isNull`` over the columns."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def all_present(cols: Iterable[Column | str]) -> Column:
    """Conjunction of ``isNotNull`` over the columns."""
    return reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in cols])


def changed(new_cols: Sequence[Column], old_cols: Sequence[Column]) -> Column:
    """Null-safe 'any tracked value differs' (null -> value counts as a change)."""
    return reduce(lambda a, b: a | b,
                  [~n.eqNullSafe(o) for n, o in zip(new_cols, old_cols)])


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Reason of the first rule whose predicate holds, else null.

    A null predicate counts as 'does not hold', so rules over nullable inputs
    need no extra guards."""
    expr = None
    for reason, predicate in rules:
        cond = F.coalesce(predicate, F.lit(False))
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr if expr is not None else F.lit(None).cast("string")
