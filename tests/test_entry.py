"""The registry, with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

from helpers import ROOT

import __spark_entry__ as entry


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_are_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "docmill", tmp_path / "docmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'xml_shred' in q and 'pipeline' not in q, len(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_it():
    for f in Path(ROOT / "docmill").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "llm" not in f.read_text(), f
