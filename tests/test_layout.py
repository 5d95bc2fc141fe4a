"""What may import what."""

import ast
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def imports(path):
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.ImportFrom):
            yield node.module or ""
        elif isinstance(node, ast.Import):
            yield from (n.name for n in node.names)


def test_nothing_imports_the_optional_subpackage():
    for p in (ROOT / "panelforge").rglob("*.py"):
        if "llm" not in p.parts:
            assert not [m for m in imports(p) if "llm" in m], p


def test_only_scoring_reads_the_answer_key():
    for p in (ROOT / "panelforge").rglob("*.py"):
        if p.name not in ("lakehouse.py", "scorecards.py", "synth.py", "__main__.py", "queries.py") and "llm" not in p.parts:
            assert "truth_" not in p.read_text(), p


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "issue_count" in df.columns
