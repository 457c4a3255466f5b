"""Every registered query against its SQL on the smallest tables."""

import json
from pathlib import Path

import pytest

from suite import harvest_queries
from suite.all_queries import ORACLES, QUERIES
from suite.check import compare, duck


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert len(result) > 0
    if name in ORACLES:
        assert compare(result, connection.execute(ORACLES[name]).df()) == ""


def test_entry(spark, sf_dir):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name, n_rows", [("read_repository_files", 1500), ("read_org_files", 2940)])
def test_json_arrays_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch, name, n_rows):
    pages = spark.range(1500).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "'<p>' AS html")
    suppliers = spark.range(1500).selectExpr("id AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey")
    for table, rows in (("pages", pages), ("supplier", suppliers)):
        rows.coalesce(2).write.parquet(f"{tmp_path}/sf/{table}.parquet")
    monkeypatch.setattr(harvest_queries, "shared_folder", lambda spark: f"{tmp_path}/files")
    QUERIES[name](spark, f"{tmp_path}/sf").collect()
    sizes = [len(json.loads(f.read_text())) for f in Path(tmp_path, "files").rglob("part-*.txt")]
    assert sum(sizes) == n_rows and max(sizes) <= 200
