"""Cleaning, row rules and derived properties on fixture rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tranche.functions import cleaning as cl
from tranche.functions import rows as rw


def test_parsers(spark):
    df = spark.createDataFrame([(" 36 months", "12.5%", "Jan-85", "< 1 year"), ("60", "bad", "Aug-03", "10+ years"),
                                ("x", "45%", "2016-01-01", "3 years"), (None, None, "junk", "n/a")],
                               "term string, rate string, d string, emp string")
    r = df.select(cl.term_months("term").alias("t"), cl.percent_to_fraction("rate").alias("r"),
                  cl.month_year_date("d").alias("d"), cl.emp_length_years("emp").alias("e"),
                  cl.emp_length_years("emp", legacy=True).alias("el"), cl.emp_length_enum_years("emp").alias("ee")).collect()
    assert [x["t"] for x in r] == [36, 60, None, None]
    assert r[0]["r"] == pytest.approx(0.125) and r[1]["r"] is None
    assert [x["d"] for x in r] == [dt.date(1985, 1, 1), dt.date(2003, 8, 1), dt.date(2016, 1, 1), None]
    assert [x["e"] for x in r] == [0.5, 10.0, 3.0, None]
    assert [x["el"] for x in r] == [1.0, 10.0, 3.0, None]
    assert [x["ee"] for x in r] == [0.5, 12.0, 3.0, None]


def test_row_rules(spark):
    schema = ("funded_amnt double, installment double, int_rate double, term int, sub_grade string, "
              "home_ownership string, verification_status string, purpose string, zip_code string, addr_state string, "
              "fico_range_low int, fico_range_high int, application_type string, annual_inc_joint double")
    good = (10000.0, 333.33, 0.125, 36, "B2", "RENT", "Verified", "debt_consolidation", "94105", "CA", 700, 720,
            "Individual", None)
    fico = good[:10] + (720, 700) + good[12:]
    term = good[:3] + (48,) + good[4:]
    joint = good[:12] + ("Joint App", None)
    df = spark.createDataFrame([good, fico, term, joint], schema)
    v = [r[0] for r in df.select(rw.constraint_violations(set(df.columns))).collect()]
    assert v[0] == []
    assert "fico_high_below_low" in v[1]
    assert v[2] == ["term_invalid"]
    assert v[3] == ["joint_without_joint_income"]


def test_derived_properties(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1), dt.date(2010, 1, 1), 700, 720, 10000.0, 75000.0)],
                               "issue_d date, earliest_cr_line date, lo int, hi int, amt double, inc double")
    r = df.select(rw.credit_age_years().alias("age"), rw.fico_midpoint("lo", "hi").alias("mid"),
                  rw.loan_to_income("amt", "inc").alias("lti")).first()
    assert 5.5 <= r["age"] <= 6.5
    assert r["mid"] == 710.0
    assert r["lti"] == pytest.approx(10000 / 75000)


def test_tiers_and_status(spark):
    df = spark.createDataFrame([(.08, "Fully Paid"), (.05, "Charged Off"), (.15, "Current"), (.25, "Default"),
                                (.35, "Late (31-120 days)")], "p double, s string")
    r = df.select(rw.risk_tier("p"), rw.is_default_status("s")).collect()
    assert [x[0] for x in r] == ["MEDIUM", "MEDIUM", "HIGH", "HIGH", "VERY_HIGH"]
    assert [x[1] for x in r] == [0, 1, 0, 1, 1]


def test_backtest_row_props(spark):
    df = spark.createDataFrame([(4500.0, 5000.0, 3), (0.0, 5000.0, 0)], "used double, total double, n int")
    r = df.select(rw.utilisation("used", "total"), rw.average_loan("used", "n")).collect()
    assert r[0][0] == pytest.approx(0.9) and r[0][1] == pytest.approx(1500)
    assert r[1][1] == 0.0
