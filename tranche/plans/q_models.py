"""Queries on MLlib models, calibration, the two skip-greedy selections,
audit tables and user batch functions; those without an SQL form are rows-only."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import audit as au
from ..operators import calibration as cal
from ..operators import models as md
from ..operators import portfolio as pf
from ..operators import quality as qa
from ..session import ensure_checkpoint_dir, materialize
from ..sources.loans import loan_table
from .feature_plan import FeaturePlan
from .inputs import labelled_loans
from .q_portfolio import CAND_SQL, POLICY
from .registry import register, rounded
from .views import LABELLED_SQL, LOANS_SQL, OUTCOMES_SQL, with_views


def model_frames(spark, sf, max_features: int = 50):
    """Fit the feature plan on training rows; assembled train / validation /
    backtest matrices, checkpointed to the shared folder (cuts lineage for
    the iterative optimisers and survives executor loss)."""
    ensure_checkpoint_dir(spark)
    # the labelled table feeds both the fit and the transform: compute it once
    df = materialize(labelled_loans(spark, sf), "labelled")
    fitted = FeaturePlan(max_features=max_features).fit(df.where(F.col("split") == "train"), stored=True)
    mat = fitted.assemble(fitted.transform(df)).select("id", "data_quarter", "split", "label", "features")
    mat = materialize(mat, "features")
    return fitted, {s: mat.where(F.col("split") == s) for s in ("train", "validation", "backtest")}


def _coef_table(spark, model, names):
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, model.coefficients.toArray())] +
                                 [("(intercept)", float(model.intercept))], "feature string, coefficient double")


@register("train_logistic")
def q_train_logistic(spark, sf):
    """M1 + M6 + M7: L2 logistic regression (C = 1) on the training rows;
    validation scores."""
    fitted, fr = model_frames(spark, sf)
    m = md.train(fr["train"], md.ModelConfig("logistic"))
    return md.score(m, fr["validation"]).select("id", "data_quarter", "label", "p", "margin")


@register("train_forest")
def q_train_forest(spark, sf):
    """M2: random forest (100 trees, depth 10); validation scores."""
    fitted, fr = model_frames(spark, sf)
    m = md.train(fr["train"], md.ModelConfig("random_forest"))
    return md.score(m, fr["validation"]).select("id", "data_quarter", "label", "p")


@register("train_gbt")
def q_train_gbt(spark, sf):
    """M3: gradient-boosted trees (100 rounds, depth 6, step .1, shares .8);
    validation scores."""
    fitted, fr = model_frames(spark, sf)
    m = md.train(fr["train"], md.ModelConfig("gbt"))
    return md.score(m, fr["validation"]).select("id", "data_quarter", "label", "p")


@register("grid_search")
def q_grid_search(spark, sf):
    """M4 + M5: 5-fold search over five C and two penalties on ROC-AUC, refit best."""
    fitted, fr = model_frames(spark, sf)
    model, res = md.grid_search(fr["train"], md.ModelConfig("logistic"), parallelism=6, stored=True)
    return spark.createDataFrame(pd.DataFrame(res))


@register("grid_folds", with_views("""
SELECT label, fold, CAST((n - fold + 4) // 5 AS BIGINT) AS n FROM (
 SELECT label, COUNT(*) AS n FROM labelled WHERE split = 'train' GROUP BY label), (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold)
WHERE n > fold""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL))
def q_grid_folds(spark, sf):
    """M5: rows of each class per fold of the training loans."""
    train = labelled_loans(spark, sf).where(F.col("split") == "train").select("id", "label")
    return md.fold_column(train).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    """M8: top ten |coefficients| of the logistic model."""
    fitted, fr = model_frames(spark, sf)
    m = md.train(fr["train"], md.ModelConfig("logistic"))
    return md.feature_importance(m, fitted.feature_names, 10)


@register("class_weights", with_views("""
SELECT label, round(SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)), 6) AS weight, COUNT(*) AS n
FROM labelled WHERE split = 'train' GROUP BY label""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL))
def q_class_weights(spark, sf):
    """Balanced class weights of the training loans (option, off by default)."""
    train = labelled_loans(spark, sf).where(F.col("split") == "train").select("label")
    return rounded(md.with_class_weights(train).groupBy("label").agg(F.first("weight").alias("weight"),
                                                                     F.count(F.lit(1)).alias("n")))


def _calibrated(spark, sf, kind):
    fitted, fr = model_frames(spark, sf)
    m = md.train(fr["train"], md.ModelConfig("logistic"))
    val = md.score(m, fr["validation"])
    c = (cal.PlattCalibrator() if kind == "platt" else cal.IsotonicCalibrator()).fit(val)
    return c.transform(md.score(m, fr["backtest"])), c


@register("platt")
def q_platt(spark, sf):
    """M9: Platt scaling fitted on validation, applied to backtest rows."""
    s, _ = _calibrated(spark, sf, "platt")
    return s.select("id", "data_quarter", "label", "p", "p_cal")


@register("isotonic")
def q_isotonic(spark, sf):
    """Isotonic calibration fitted on validation, applied to backtest."""
    s, _ = _calibrated(spark, sf, "isotonic")
    return s.select("id", "data_quarter", "label", "p", "p_cal")


@register("calibration_report")
def q_calibration_report(spark, sf):
    """Before / after calibration quality on backtest rows."""
    s, _ = _calibrated(spark, sf, "platt")
    return cal.calibration_report(s)


@register("calibration_slope")
def q_calibration_slope(spark, sf):
    """V9: calibration slope / intercept of the deterministic score."""
    s = labelled_loans(spark, sf).withColumnRenamed("pd", "p")
    slope, intercept = cal.calibration_slope(s)
    return spark.createDataFrame([(slope, intercept)], "calibration_slope double, calibration_intercept double")


@register("temporal_cv")
def q_temporal_cv(spark, sf):
    """D3: expanding-window validation over quarters (3 splits)."""
    df = materialize(labelled_loans(spark, sf).where(F.col("split").isin("train", "validation")), "labelled")
    qs = [r[0] for r in df.select("data_quarter").distinct().collect()]
    return spark.createDataFrame(pd.DataFrame(md.temporal_cv(df, FeaturePlan(), md.ModelConfig("logistic"), qs, stored=True)))


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_BALANCED_SQL = _recursive(with_views("""
SELECT data_quarter, loan_id, CAST(amt AS DOUBLE) AS investment_amount, default_probability,
 round(expected_return, 6) AS expected_return, risk_grade FROM s WHERE amt IS NOT NULL""", LOANS_SQL, CAND_SQL, """
grades AS MATERIALIZED (SELECT risk_grade, row_number() OVER (ORDER BY risk_grade) AS g FROM (SELECT DISTINCT risk_grade FROM cand))""", """
c AS MATERIALIZED (
 SELECT cand.*, g, row_number() OVER (PARTITION BY data_quarter
   ORDER BY expected_return / (default_probability + 0.01e0) DESC, loan_id) AS n
 FROM cand JOIN grades USING (risk_grade) WHERE reason IS NULL AND ticket > 1)""", """
s AS (
 SELECT data_quarter, CAST(0 AS BIGINT) AS n, CAST(5000 AS DECIMAL(18,4)) AS rest,
  [CAST(0 AS DECIMAL(18,4)) FOR i IN range(100)] AS used, CAST(NULL AS DECIMAL(18,4)) AS amt, CAST(NULL AS BIGINT) AS loan_id,
  CAST(NULL AS DOUBLE) AS default_probability, CAST(NULL AS DOUBLE) AS expected_return, CAST(NULL AS VARCHAR) AS risk_grade
 FROM (SELECT DISTINCT data_quarter FROM c)
 UNION ALL
 SELECT data_quarter, n, CAST(rest - COALESCE(a, 0) AS DECIMAL(18,4)),
  [CAST(CASE WHEN i + 1 = g THEN used[i + 1] + COALESCE(a, 0) ELSE used[i + 1] END AS DECIMAL(18,4)) FOR i IN range(100)],
  CAST(a AS DECIMAL(18,4)), loan_id, default_probability, expected_return, risk_grade
 FROM (SELECT c.data_quarter, c.n, c.g, s.rest, s.used, c.loan_id, c.default_probability, c.expected_return, c.risk_grade,
   CASE WHEN LEAST(c.ticket, 1500 - s.used[c.g]) > 1 AND LEAST(c.ticket, 1500 - s.used[c.g]) <= s.rest
        THEN LEAST(c.ticket, 1500 - s.used[c.g]) END AS a
  FROM s JOIN c ON c.data_quarter = s.data_quarter AND c.n = s.n + 1))"""))

_POLICY_SQL = _recursive(with_views("""
SELECT data_quarter, loan_id, CAST(amount AS DOUBLE) AS amount, default_probability FROM s WHERE taken""", LOANS_SQL, """
c AS MATERIALIZED (
 SELECT data_quarter, id AS loan_id, CAST(funded_amnt AS DECIMAL(18,4)) AS amount, pd AS default_probability,
  row_number() OVER (PARTITION BY data_quarter ORDER BY pd, id) AS n
 FROM loans WHERE pd <= 0.15e0 AND funded_amnt IS NOT NULL)""", """
s AS (
 SELECT data_quarter, CAST(0 AS BIGINT) AS n, CAST(5000 AS DECIMAL(18,4)) AS rest, false AS taken, CAST(NULL AS BIGINT) AS loan_id,
  CAST(NULL AS DECIMAL(18,4)) AS amount, CAST(NULL AS DOUBLE) AS default_probability
 FROM (SELECT DISTINCT data_quarter FROM c)
 UNION ALL
 SELECT c.data_quarter, c.n, CAST(CASE WHEN c.amount <= s.rest THEN s.rest - c.amount ELSE s.rest END AS DECIMAL(18,4)),
  c.amount <= s.rest, c.loan_id, c.amount, c.default_probability
 FROM s JOIN c ON c.data_quarter = s.data_quarter AND c.n = s.n + 1)"""))


@register("portfolio_balanced", _BALANCED_SQL)
def q_portfolio_balanced(spark, sf):
    """K6: balanced selection (score / (p + .01), 30 % grade cap, skip-greedy)."""
    loans = loan_table(spark, sf)
    c = pf.filter_candidates(pf.candidates(loans, policy=POLICY), POLICY)
    sel = pf.select_balanced(c, POLICY)
    return rounded(sel.select("data_quarter", "loan_id", F.col("investment_amount").cast("double").alias("investment_amount"),
                              "default_probability", "expected_return", "risk_grade"))


@register("policy_select", _POLICY_SQL)
def q_policy_select(spark, sf):
    """K7: policy selection (p <= .15, lowest risk, whole funded amounts
    that fit the rest, 5 000 per quarter)."""
    loans = loan_table(spark, sf)
    preds = loans.select(F.col("id").alias("loan_id"), F.col("pd").alias("default_probability"),
                         (F.col("pd") * 1.4).alias("risk_score"))
    return pf.policy_select(preds, loans, budget=5000.0, max_risk_tolerance=0.15) \
        .select("data_quarter", "loan_id", F.col("amount").cast("double").alias("amount"), "default_probability")


@register("lineage")
def q_lineage(spark, sf):
    """A15 + S7: lineage record of the cleaning step (before / after)."""
    raw = loan_table(spark, sf)
    from ..functions.cleaning import clean_loans
    return au.lineage_row(spark, "clean_loans", raw, clean_loans(raw), {"step": "D8"})


@register("report_table")
def q_report_table(spark, sf):
    """Long report table (section, metric, value, status)."""
    loans = loan_table(spark, sf)
    sel = pf.select_lowest_risk(pf.filter_candidates(pf.candidates(loans, policy=POLICY), POLICY), POLICY)
    sections = {"data": qa.quality_score(loans).drop("passed_validation"),
                "investment": pf.portfolio_metrics(sel).agg(F.sum("total_investment").alias("total_investment"),
                                                            F.sum("loan_count").alias("loan_count"),
                                                            F.avg("avg_risk_score").alias("avg_risk_score"))}
    return au.report_table(sections, {"quality_score": ("min", 0.8), "avg_risk_score": ("max", 0.25)})


def _doc_stats(pdf: pd.DataFrame) -> pd.DataFrame:
    text = pdf["text"].fillna("")
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": text.str.split().str.len().astype("int64"),
                         "n_chars": text.str.len().astype("int64")})


@register("batch_apply", """
SELECT doc_id, CAST(len([x FOR x IN regexp_split_to_array(COALESCE(text, ''), '\\s+') IF x <> '']) AS BIGINT) AS n_words,
 CAST(length(COALESCE(text, '')) AS BIGINT) AS n_chars FROM documents""")
def q_batch_apply(spark, sf):
    """G1: a user pandas function over Arrow batches of whole documents."""
    from ..sources.tables import table
    return au.batch_apply(table(spark, sf, "documents").select("doc_id", "text"), _doc_stats,
                          "doc_id long, n_words long, n_chars long", batch_size=500)
