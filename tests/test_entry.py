"""The entry point without the optional subpackage."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_entry_imports_without_the_training_data_operators():
    code = ("import sys; sys.modules['strata.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\n"
            "assert 'monthly_brand_net' in e.queries() and 'pipeline' not in e.queries()\n"
            "assert not [q for q in e.queries() if q.startswith('op')]\n"
            "assert set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "strata").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "strata.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
