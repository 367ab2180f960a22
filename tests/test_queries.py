"""Every terrain query against its SQL, on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from orograph import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("null" if pd.isna(v) else f"{float(v):.9g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v) for v in r) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sql, name):
    a, b = queries.QUERIES[name](spark, SF).toPandas(), sql.sql(queries.SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert len(a) > 0
    assert rows(a) == rows(b)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 500 * 64
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_does_without_the_text_subpackage(tmp_path, pipeline):
    """With both text folders gone, and corpus_pipeline.py gone or left behind, the entry has the other queries and the other tests can be collected."""
    tree = tmp_path / "tree"
    shutil.copytree(Path(__file__).parents[1], tree, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *([] if pipeline else ["corpus_pipeline.py"])))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()), *sorted(e.oracle_sql()))"], cwd=tree, capture_output=True, text=True)
    assert said.stdout.split() == [*sorted(queries.QUERIES), *sorted(queries.SQL)], said.stderr
    assert subprocess.run([sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"], cwd=tree, capture_output=True).returncode == 0
