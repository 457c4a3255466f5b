"""The registered queries on the smallest tables: against their SQL where there is one."""

import pytest

from citeloom.llm.queries import ORACLES, QUERIES
from suite.check import duck, text_rows


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, connection, name):
    expected = connection.execute(ORACLES[name]).df()
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(result.columns) == sorted(expected.columns)
    assert text_rows(result) == text_rows(expected)


def test_entry_point_has_them_all(spark):
    import __spark_entry__ as contract

    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names} and "pipeline" in names


@pytest.mark.parametrize(
    "name,kinds",
    {
        "op2_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
        "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op5_license_scan": {
            "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
            "base_labels": "string", "labels": "string", "score": "double",
        },
        "op7_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
        "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op10_secret_scan": {
            "doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string",
        },
        "op11_whitening": {
            "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
            "identity_error": "double",
        },
        "op12_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
        "op13_periodic_runs": {
            "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
            "runs_sha256": "string", "collapsed_sha256": "string",
        },
    }.items(),
)
def test_contracts(spark, sf_dir, name, kinds):
    result = dict(QUERIES[name](spark, sf_dir).dtypes)
    assert {c: result.get(c) for c in kinds} == kinds
