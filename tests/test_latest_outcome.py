"""The last observation per loan, hashed instead of sorted."""

import datetime as dt

from pyspark.sql import functions as F

from tranche.operators.targets import latest_outcome, match_outcomes
from tranche.session import ensure_compiled

ROWS = [(1, 1, "Fully Paid", dt.date(2001, 1, 2)), (1, 2, "Charged Off", dt.date(2001, 1, 1)), (1, 3, "Current", None),
        (2, -5, "Charged Off", dt.date(1, 1, 1)), (2, None, "Current", dt.date(1, 1, 1)),
        (3, None, "Default", None), (3, -(1 << 31), "Current", None), (4, 2**31 - 1, "Current", dt.date(9999, 12, 30)), (4, None, "Charged Off", dt.date(9999, 12, 31)),
        (5, 2, None, dt.date(1960, 5, 5)), (5, 1, "Default", dt.date(1960, 5, 5)), (6, 1, "Default", dt.date(1960, 5, 5)), (6, 9, "Current", dt.date(1960, 5, 4))]
SCHEMA = "id long, obs_seq int, loan_status string, outcome_date date"


def test_last_observation_wins_without_a_sort(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = latest_outcome(df)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: (r["outcome_flag"], r["last_outcome_date"]) for r in got.collect()} == {
        1: (0, dt.date(2001, 1, 2)), 2: (1, dt.date(1, 1, 1)), 3: (0, None), 4: (1, dt.date(9999, 12, 31)), 5: (None, dt.date(1960, 5, 5)), 6: (1, dt.date(1960, 5, 5))}
    other = df.withColumn("obs_seq", F.col("obs_seq").cast("long") * 10**6)      # no int: compared as they are
    assert sorted(latest_outcome(other).collect()) == sorted(got.collect())
    loans = spark.range(8)
    assert {r["id"]: r["label"] for r in match_outcomes(loans, df).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1, 7: 0}


def test_stages_too_large_for_the_compiler_run_by_operators(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        ensure_compiled(spark)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "20000")
        ensure_compiled(spark)
        assert spark.conf.get(key) == "20000"
    finally:
        spark.conf.set(key, before)
