"""The driver's contract without the libraries of the training-data operators."""

from __future__ import annotations

import os
import subprocess
import sys

import __spark_entry__ as entry
from oracle_sql import ORACLE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_missing_library_leaves_the_other_queries():
    code = ("import sys\n"
            "for name in ('xxhash', 'zstandard', 'regex', 'cohortlab.llm'):\n"
            "    sys.modules[name] = None\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), len(e.oracle_sql()))\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True, timeout=120)
    assert out.stdout.split() == [str(len(ORACLE))] * 2


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
