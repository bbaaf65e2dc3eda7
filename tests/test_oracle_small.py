"""A sample of registered queries against their DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
SAMPLE = ["portfolio_lowest_risk", "portfolio_metrics", "clean_dates", "row_constraints", "quality_score",
          "target_matching", "features_derived", "one_hot", "select_k_best", "roc_auc", "hosmer_lemeshow",
          "backtest_realised", "benchmark_random"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "data_quarter"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
