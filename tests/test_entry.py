"""The entry file with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def names(root):
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    return set(subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split())


def test_entry_without_the_subpackage(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "textloom", tmp_path / "textloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    rest = names(tmp_path)
    assert {"topic_counts", "lexicon_counts"} <= rest and not any(n.startswith("op") or n == "pipeline" for n in rest)
    (tmp_path / "textloom/llm/__pycache__").mkdir(parents=True)
    assert names(tmp_path) == rest


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "textloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text()


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables here")
def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
