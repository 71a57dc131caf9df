"""Every registered query against its DuckDB twin on the smallest test folder."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from revlens.plans.catalog import QUERIES
from tools.oracle_check import compare, duck_connection

ROOT = Path(entry.__file__).parent
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(small_dir):
    return duck_connection(small_dir)


def test_every_query_of_the_warehouse_has_oracle_sql():
    """The corpus queries that SQL cannot express have brute-force tests in tests/llm instead."""
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_corpus_queries(tmp_path):
    """Both corpus folders and the pipeline may be deleted."""
    shutil.copytree(ROOT / "revlens", tmp_path / "revlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.split() == list(QUERIES), out.stderr


def test_entry_works_without_a_package_that_only_the_corpus_queries_need():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.split() == list(QUERIES), out.stderr


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, small_dir, name):
    assert compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], small_dir)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == [
        "country",
        "total_pedidos_perdidos",
        "receita_perdida",
        "pct_receita_perdida",
    ]
