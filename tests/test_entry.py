"""The driver's contract holds with and without the training-data subpackage."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("tocsin.llm") or name == "corpus_pipeline":
            raise ImportError(name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as contract
from tocsin.plans.queries import QUERIES
assert set(contract.queries()) == set(QUERIES) == set(contract.oracle_sql())
"""


def test_queries_without_the_subpackage():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tocsin").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "tocsin.llm" not in path.read_text(), path
