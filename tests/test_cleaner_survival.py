"""Cleaner, row split, duplicates by hash, quality gate, survival, calibration report."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tranche.operators import calibration as cal
from tranche.operators import cleaner as cn
from tranche.operators import metrics as mt
from tranche.operators import quality as qa
from tranche.operators import survival as sv
from tranche.operators.quantiles import ordered_bits, value_of
from tranche.plans import workflow as wf


def test_ordered_bits_follow_the_doubles(spark):
    rng = random.Random(8)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf,
              1.0, math.nextafter(1.0, 2), math.nextafter(2.0, 0), 2.0, 0.1, -0.1]
    values += [math.ldexp(1.0, e) for e in range(-1074, 1024, 7)] + [math.nextafter(math.ldexp(1.0, e), 0) for e in range(-1070, 1024, 7)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(3000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b")).collect()
    assert all(value_of(r["b"]) == r["v"] for r in got)
    by_value = sorted(got, key=lambda r: r["v"])
    assert [r["b"] for r in by_value] == sorted(r["b"] for r in got)
    nan = spark.createDataFrame([(math.nan,), (None,)], "v double").select(ordered_bits(F.col("v")).alias("b")).collect()
    assert nan[0]["b"] > max(r["b"] for r in got) and nan[1]["b"] is None


ROWS = [(1, "a", 1.0, None), (1, "a", 1.0, None), (1, "a", 1.0, None), (2, None, float("nan"), 0), (2, None, float("nan"), 0), (3, "b", 0.0, 1),
        (3, "b", -0.0, 1), (4, "c", 2.0, 1), (None, "c", None, 4), (4, None, None, None), (None, 4, None, None)]


@pytest.mark.parametrize("hashes", [qa.row_hash, lambda df: [F.lit(7).cast("long")], lambda df: [F.xxhash64(df.columns[0])]])
def test_duplicates_survive_equal_hashes(spark, hashes):
    df = spark.createDataFrame([(a, None if b is None else str(b), c, d) for a, b, c, d in ROWS], "i int, t string, x double, j int")
    want = df.count() - df.distinct().count()
    got = qa.duplicate_profile(df, hashes=hashes).first()
    assert (got["total_rows"], got["duplicate_rows"]) == (11, want) and want == 4
    assert qa.duplicate_profile(df.limit(0), hashes=hashes).first()["duplicate_rows"] == 0


def test_gate_scores_of_all_splits_equal_single_scores(spark):
    rng = random.Random(2)
    rows = [(s, i % 50, None if rng.random() < 0.1 else rng.lognormvariate(0, 2), rng.choice("ab")) for s in ("train", "validation", "backtest") for i in range(300)]
    df = spark.createDataFrame(rows, "split string, i int, x double, t string")
    got = {r["split"]: r for r in qa.quality_scores(df, "split", ["train", "validation", "backtest"]).collect()}
    for s, r in got.items():
        one = qa.quality_score(df.where(F.col("split") == s).drop("split")).first().asDict()
        assert {k: v for k, v in r.asDict().items() if k != "split"} == pytest.approx(one)
    with pytest.raises(wf.QualityGateError, match="backtest"):
        wf.quality_gate(df.where("split <> 'backtest'"), 0.1)


def test_cleaner_strategies_flags_and_report(spark):
    rows = [(i, " 36 months" if i else "none", f"{i}%", float(i), "10+ years") for i in range(20)] + [(99, None, "x%", 5000.0, None), (100, "60", None, None, "n/a")]
    df = spark.createDataFrame(rows, "id int, term_raw string, revol_util_raw string, annual_inc double, emp_length string")
    done = cn.clean_data(df, ["annual_inc"], {"annual_inc": "mean", "term": "drop"})
    got = {r["id"]: r for r in done.rows.collect()}
    assert sorted(got) == [*range(1, 20), 100] and got[100]["annual_inc"] == pytest.approx((sum(range(20)) + 5000) / 21)
    n = {(r["section"], r["column_name"]): r["n"] for r in done.report.collect()}
    assert n["rows_in", None] == 22 and n["rows_out", None] == 20 and n["rows_dropped", None] == 2
    assert n["unparsed", "term"] == 1 and n["unparsed", "revol_util"] == 1 and n["unparsed", "emp_length_years"] == 1
    assert n["outliers", "annual_inc"] == 1 and n["filled", "annual_inc"] == 1 and n["missing", "annual_inc"] == 1
    kept = cn.clean_data(df, ["annual_inc"]).rows
    assert [r["outlier_columns"] for r in kept.where("id IN (5, 99)").orderBy("id").collect()] == [[], ["annual_inc"]]
    for bad in ("interpolate", {"annual_inc": "zero"}, {"nowhere": "drop"}):
        with pytest.raises(ValueError, match="unknown"):
            cn.clean_data(df, ["annual_inc"], bad)


def test_row_split(spark):
    rows = [(1, 5000.0, 36, 700, 720, "94110", None), (2, None, 36, 700, 720, "94110", None), (3, 1.0, 48, 900, 720, "9411", -1.0), (None, 1.0, 60, None, None, None, 2.0)]
    df = spark.createDataFrame(rows, "id int, funded_amnt double, term int, fico_range_low int, fico_range_high int, zip_code string, tot_cur_bal double")
    v = cn.validate_rows(df)
    assert [tuple(r) for r in v.valid.collect()] == [rows[0]] and v.valid.columns == df.columns
    bad = {r["id"]: sorted(r["violations"]) for r in v.quarantined.collect()}
    assert bad == {2: ["funded_amnt_not_positive"], 3: ["fico_high_below_low", "fico_range_low_out_of_range", "term_invalid", "tot_cur_bal_negative", "zip_code_length"],
                   None: ["id_missing", "zip_code_missing"]}
    assert {r["rule"]: r["rows"] for r in v.report.collect()}["quarantined"] == 3
    empty = cn.validate_rows(df.limit(0))
    assert empty.valid.collect() == [] and empty.quarantined.collect() == [] and empty.report.collect() == []
    all_good = cn.validate_rows(df.limit(1))
    assert all_good.valid.count() == 1 and all_good.quarantined.count() == 0


def test_survival_by_hand(spark):
    d = dt.date(2016, 1, 1)
    listing = spark.createDataFrame([(i, d, "2016Q1") for i in range(7)], "id int, issue_d date, data_quarter string")
    day = lambda n: d + dt.timedelta(n)
    outcomes = spark.createDataFrame(
        [(0, "Current", day(10)), (0, "Charged Off", day(40)), (0, "Charged Off", day(70)), (1, "Fully Paid", day(45)), (2, "Default", day(10)),
         (3, "Charged Off", day(-5)), (4, "Charged Off", day(-5)), (4, "Current", day(100)), (5, "Charged Off", day(95))], "id int, loan_status string, outcome_date date")
    got = {r["id"]: (r["event"], r["days"], r["period"]) for r in sv.time_to_default(listing, outcomes).collect()}
    assert got == {0: (1, 40, 1), 1: (0, 45, 1), 2: (1, 10, 0), 4: (0, 100, 3), 5: (1, 95, 3)}
    assert {r["id"]: (r["event"], r["days"]) for r in sv.time_to_default(listing, outcomes, horizon_days=50).collect()}[5] == (0, 50)
    km = {r["period"]: r for r in sv.kaplan_meier(sv.time_to_default(listing, outcomes)).collect()}
    assert [(km[p]["at_risk"], km[p]["events"], km[p]["censored"]) for p in (0, 1, 3)] == [(5, 1, 0), (4, 1, 1), (2, 1, 1)]
    assert [km[p]["survival"] for p in (0, 1, 3)] == pytest.approx([0.8, 0.6, 0.3])
    assert km[3]["survival_se"] == pytest.approx(0.3 * math.sqrt(1 / 20 + 1 / 12 + 1 / 2))
    ended = spark.createDataFrame([("q", 0, 1), ("q", 1, 1), ("q", 1, 1)], "data_quarter string, period int, event int")
    assert [r["survival"] for r in sv.kaplan_meier(ended).orderBy("period").collect()] == pytest.approx([2 / 3, 0.0])


def test_weibull_times_fall_with_risk(spark):
    rng = random.Random(6)
    rows = [(x := rng.gauss(0, 1), int(rng.random() < 0.8), int(300 * math.exp(-x) * rng.weibullvariate(1, 1.5))) for _ in range(600)]
    model = sv.fit_aft(spark.createDataFrame(rows, "risk double, event int, days int"), ["risk"])
    assert -1.4 < model.coefficients[0] < -0.6


def test_calibration_report_equals_single_metrics(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.3), rng.random(), rng.choice([0.0, 0.1, 0.3, 0.55, 1.0])) for _ in range(800)]
    df = spark.createDataFrame(rows, "label int, p double, p_cal double")
    r = cal.calibration_report(df).first()
    for name, col in (("original", "p"), ("calibrated", "p_cal")):
        assert r[f"{name}_brier_score"] == pytest.approx(mt.score_summary(df, p=col).first()["brier_score"])
        assert r[f"{name}_ece"] == pytest.approx(mt.expected_calibration_error(df, p=col).first()[0])
    assert r["calibration_slope"] == pytest.approx(cal.calibration_slope(df, "p_cal")[0])


def test_run_without_calibration_and_benchmarks(spark):
    """The raw scores are used, and no benchmark is made."""
    from tranche.plans.feature_plan import FeaturePlan
    out = wf.run(spark, "/root/testdata/sf0.001", wf.RunConfig(calibrate=None, benchmarks=(), features=FeaturePlan(max_features=8), gate=False))
    steps = [r["step"] for r in out["audit"].collect()]
    assert "calibration" not in steps and "benchmark_random" not in steps and "model" in steps
    assert not {"benchmark_market", "benchmark_random", "benchmark_compare"} & set(out)
