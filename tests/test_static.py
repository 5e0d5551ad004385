"""Library-wide rules, checked on the source."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "strata"
EVERY = {p: p.read_text() for p in ROOT.rglob("*.py")}
# The training-data operators may choose their style and have their own bounds.
SOURCES = {p: text for p, text in EVERY.items() if "llm" not in p.relative_to(ROOT).parts}


def _hits(pattern, sources=SOURCES):
    return sorted(f"{p.relative_to(ROOT)}:{i + 1}"
                  for p, text in sources.items()
                  for i, line in enumerate(text.splitlines())
                  if re.search(pattern, line) and not line.lstrip().startswith("#"))


def test_no_cross_joins_local_checkpoints_or_python_udfs():
    assert _hits(r"\.crossJoin\(|localCheckpoint\(", EVERY) == []
    assert _hits(r"@F\.udf|F\.udf\(|pandas_udf|\.rdd\.|toPandas") == []


def _files(hits):
    return {h.split(":")[0] for h in hits}


def test_collect_only_for_bounded_control_tables():
    hits = _hits(r"\.collect\(\)")
    assert len(hits) == 1 and _files(hits) == {"sources/tables.py"}      # settings_lookup


def test_coalesce_one_only_for_control_tables():
    hits = _hits(r"\.coalesce\(1\)")
    assert len(hits) == 1 and _files(hits) == {"sources/writers.py"}     # write_control_table
