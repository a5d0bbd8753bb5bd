"""The table queries are there whatever the text operators lack."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from tidemark.catalog.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as entry; print(len(entry.queries()), len(entry.oracle_sql()))"


@pytest.mark.parametrize("missing", ["xxhash", "zstandard", "public_tokenizers", "tidemark.llm", "corpus_pipeline"])
def test_table_queries_survive_a_missing_module(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; {COUNT}"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[-2:] == [str(len(QUERIES))] * 2, done.stderr[-500:]


def test_a_missing_module_of_the_library_is_an_error():
    code = f"import sys; sys.modules['tidemark.plans.gold'] = None; {COUNT}"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "tidemark.plans.gold" in done.stderr
