"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import normalised, oracle_rows

import __spark_entry__ as contract
from workload.queries import QUERIES
from workload.sql import ORACLE

ROWS_ONLY = {"topk_ivf_probed"}


def test_all_queries_but_the_listed_ones_have_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(ORACLE[name], sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == normalised(columns, expected)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert rows and all(r["result"] is not None for r in rows)
    assert any(r["sources"] for r in rows)
