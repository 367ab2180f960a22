"""Text queries against their SQL, on the smallest tables, and that the rest of the package does without this subpackage."""

import ast
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from orograph.llm import queries

from ..test_queries import SF, TABLES, rows
from .helpers import COLUMNS, clashing, documents


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    a, b = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.SQL[name]).df()
    assert len(a) and sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)


def test_nothing_else_imports_this_subpackage():
    for file in Path(queries.__file__).parents[1].rglob("*.py"):
        if "llm" not in file.parts:
            names = [n for x in ast.walk(ast.parse(file.read_text())) if isinstance(x, (ast.Import, ast.ImportFrom)) for n in [getattr(x, "module", None) or "", *(a.name for a in x.names)]]
            assert not any("llm" in n.split(".") for n in names), file


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
        assert i == 4 or docs.columns == columns and docs.where("n_chars <> length(text)").isEmpty()
    assert counts[0] > counts[1] >= counts[2] >= counts[3] >= counts[4] > 0
    assert corpus_pipeline.run(spark, SF).agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, name):
    """No rows, null and empty texts, rows that come twice, and columns with the names of helpers: no crash; the own columns come back, clean documents with them."""
    stage = dict(corpus_pipeline.STAGES)[name]
    empty = spark.createDataFrame([], COLUMNS)
    assert stage(spark, empty, SF).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (None, None, None, None, None)] * 2, COLUMNS)
    assert stage(spark, nothing, SF).count() == {"quality rules": 0, "line dedup": 6, "SimHash near-dedup": 1, "benchmark decontamination": 6, "packing": 6}[name]
    names = ["_m", "_f", "_u", "_k1", "_k2", "_doc", "_mark", "_own", "_text", "_cut", "made", "own", "kept", "items", "n_words", "spans", "least", "hit_spans", "clean_text", "start"]
    docs = clashing(documents(spark), *names)
    found = stage(spark, docs, SF)
    if name == "packing":
        assert found.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    else:
        assert found.columns == docs.columns and found.count() > 5
        assert found.where(" or ".join(f"{c} <> 'own'" for c in names)).isEmpty() and not found.where("doc_id = 16").isEmpty()
