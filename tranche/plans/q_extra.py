"""Queries: ROC curve series, early-delinquency labels, provenance,
combined validation and the end-to-end run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compliance as cp
from ..operators import metrics as mt
from ..operators import quality as qa
from ..operators.prefix import running_sum
from ..sources.loans import loan_table, loans_with_payments, outcome_table
from .inputs import labelled_loans
from .registry import register, rounded
from .views import LABELLED_SQL, LOANS_SQL, OUTCOMES_SQL, with_views


def roc_curve(df, label="label", p="p"):
    """(threshold, tpr, fpr) at every distinct score, from grouped
    counts and a scalable running sum."""
    g = df.groupBy(p).agg(F.sum(F.col(label)).cast("long").alias("_pos"),
                          (F.count(F.lit(1)) - F.sum(F.col(label))).cast("long").alias("_neg"))
    tot = g.agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_Nn")).first()
    P, N = F.lit(tot["_P"]), F.lit(tot["_Nn"])
    c = running_sum(g, ["_pos", "_neg"], [p])
    return c.select(F.col(p).alias("threshold"), ((P - F.col("_pos_cum") + F.col("_pos")) / P).alias("tpr"),
                    ((N - F.col("_neg_cum") + F.col("_neg")) / N).alias("fpr"))


@register("roc_curve", with_views("""
SELECT p AS threshold, round((tp_all - pos_cum + pos) * 1.0e0 / tp_all, 6) AS tpr,
 round((tn_all - neg_cum + neg) * 1.0e0 / tn_all, 6) AS fpr
FROM (SELECT p, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg,
  SUM(SUM(label)) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_cum,
  SUM(COUNT(*) - SUM(label)) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum
 FROM (SELECT label, pd AS p FROM labelled) GROUP BY p),
 (SELECT SUM(label) AS tp_all, COUNT(*) - SUM(label) AS tn_all FROM labelled)""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL))
def q_roc_curve(spark, sf):
    """ROC curve points of the deterministic score."""
    return rounded(roc_curve(labelled_loans(spark, sf).withColumnRenamed("pd", "p")))


def early_delinquency(listing, outcomes, months: int = 3,
                      statuses=("Late (31-120 days)", "Charged Off", "Default")):
    """1 when a delinquent status is observed within ``months`` of
    issue; the first such date is the time to default (NULL = censored)."""
    obs = (outcomes.where(F.col("loan_status").isin(list(statuses)))
           .join(listing.select("id", F.col("issue_d").alias("_issue")), "id")
           .where(F.col("outcome_date") <= F.add_months("_issue", months))
           .groupBy("id").agg(F.min("outcome_date").alias("first_delinquency_date")))
    out = listing.join(obs, "id", "left")
    return out.select("id", "first_delinquency_date",
                      F.col("first_delinquency_date").isNotNull().cast("int").alias("early_default"),
                      F.datediff("first_delinquency_date", "issue_d").alias("days_to_default"))


@register("early_delinquency_label", with_views("""
SELECT l.id, d.first_date AS first_delinquency_date, CAST(d.first_date IS NOT NULL AS INTEGER) AS early_default,
 datediff('day', l.issue_d, d.first_date) AS days_to_default
FROM loans l LEFT JOIN (
 SELECT o.id, MIN(o.outcome_date) AS first_date FROM outcomes o JOIN loans x ON o.id = x.id
 WHERE o.loan_status IN ('Late (31-120 days)', 'Charged Off', 'Default')
   AND o.outcome_date <= x.issue_d + INTERVAL 3 MONTH GROUP BY o.id) d ON l.id = d.id""", LOANS_SQL, OUTCOMES_SQL))
def q_early_delinquency(spark, sf):
    """Proxy label from delinquency within three months of issue."""
    return early_delinquency(loan_table(spark, sf).select("id", "issue_d"), outcome_table(spark, sf))


@register("feature_provenance")
def q_feature_provenance(spark, sf):
    """Fitted feature names with their source block and compliance."""
    from .feature_plan import FeaturePlan
    lab = labelled_loans(spark, sf)
    fitted = FeaturePlan(max_features=0).fit(lab.where(F.col("split") == "train"))
    blocks = []
    from ..functions import features as fx
    cols = set(lab.columns)
    for block, fn in (("loan", fx.loan_block), ("borrower", fx.borrower_block), ("credit", fx.credit_block),
                      ("derived", fx.derived_block)):
        names = lab.select(*fn(cols)).columns
        blocks += [(n, block) for n in names]
    blocks += [(n, "category") for n in lab.select(*fitted.dummy_exprs(cols)).columns]
    reg = spark.createDataFrame(blocks, "feature_name string, block string")
    return cp.provenance(reg, cp.feature_compliance(spark, [b[0] for b in blocks]))


@register("validate_run_data")
def q_validate_run_data(spark, sf):
    """Quality rules per split, the temporal split check and the
    feature-name compliance, as one table of rule rows."""
    lab = labelled_loans(spark, sf)
    parts = []
    for s in ("train", "validation", "backtest"):
        r = qa.quality_rules(lab.where(F.col("split") == s).drop("split", "label"), s)
        parts.append(r.select("validation_type", "is_valid", "errors"))
    t = qa.temporal_split_check(lab).select(F.lit("temporal_split_validation").alias("validation_type"),
                                            "is_valid", "errors")
    c = cp.compliance_summary(cp.feature_compliance(spark, loans_with_payments(spark, sf).columns)).select(
        F.lit("feature_compliance").alias("validation_type"), (F.col("prohibited_features") == 0).alias("is_valid"),
        F.concat(F.col("prohibited_features").cast("string"), F.lit(" prohibited")).alias("errors"))
    out = parts[0]
    for p in parts[1:] + [t, c]:
        out = out.unionByName(p)
    return out


@register("end_to_end")
def q_end_to_end(spark, sf):
    """3.1: the whole run (labels, gate, features, logistic model, Platt
    calibration, selection on backtest quarters, backtest against the market
    and random benchmarks) as its report."""
    from .workflow import RunConfig, run
    return run(spark, sf, RunConfig())["report"]


_SCORED = "scored AS (SELECT label, pd AS p FROM labelled)"
_AUC_ONE = """(SELECT SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)) FROM (
 SELECT p, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg,
  SUM(COUNT(*) - SUM(label)) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum
 FROM scored GROUP BY p))"""


@register("alerts", with_views(f"""
SELECT metric, round(value, 6) AS value, direction, "limit" FROM (
 SELECT 'roc_auc' AS metric, {_AUC_ONE} AS value, 'min' AS direction, 0.7e0 AS "limit"
 UNION ALL SELECT 'brier_score', (SELECT AVG((p - label) * (p - label)) FROM scored), 'max', 0.2e0)
WHERE (direction = 'min' AND value < "limit") OR (direction = 'max' AND value > "limit")""",
                                LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL, _SCORED))
def q_alerts(spark, sf):
    """Alert rows for run metrics outside their limits."""
    from ..operators import audit as au
    s = labelled_loans(spark, sf).withColumnRenamed("pd", "p")
    a = mt.roc_auc(s).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    b = mt.score_summary(s).select(F.lit("brier_score").alias("metric"), F.col("brier_score").alias("value"))
    return rounded(au.alerts(a.unionByName(b), {"roc_auc": ("min", 0.7), "brier_score": ("max", 0.2)}))


_LEAK_SQL = " OR ".join([f"regexp_matches(column_name, '{p}')" for p in
                         [".*pymnt.*", ".*rec_.*", "chargeoff.*", "settlement.*", "collection.*", "recovery.*"]])
_FIELDS_SQL = ("'loan_status','last_pymnt_d','last_pymnt_amnt','next_pymnt_d','total_rec_prncp','total_rec_int',"
               "'recoveries','collection_recovery_fee','out_prncp','out_prncp_inv'")


def _summary_sql():
    from .views import PAYMENTS_SQL
    return with_views(f"""
SELECT 'rows' AS item, CAST(COUNT(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM labelled
UNION ALL SELECT 'columns', (SELECT CAST(COUNT(*) AS DOUBLE) FROM (DESCRIBE SELECT * FROM labelled)
  WHERE column_name NOT IN ('term_raw', 'revol_util_raw')), NULL
UNION ALL SELECT 'prevalence', round(AVG(label), 6), NULL FROM labelled
UNION ALL SELECT 'dropped:' || column_name, NULL, 'listing-time compliance' FROM (DESCRIBE SELECT * FROM wide)
 WHERE {_LEAK_SQL} OR column_name IN ({_FIELDS_SQL})""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL, PAYMENTS_SQL)


@register("data_summary", _summary_sql())
def q_data_summary(spark, sf):
    """Rows, columns, prevalence, dropped leaking columns with reasons."""
    from ..operators import audit as au
    w = loans_with_payments(spark, sf)
    dropped = {c: "listing-time compliance" for c in cp.leaking_columns(w.columns)}
    return rounded(au.data_summary(labelled_loans(spark, sf), "label", dropped))


_AVAIL_COLS = ("id loan_amnt funded_amnt term int_rate installment grade sub_grade annual_inc home_ownership "
               "verification_status emp_length purpose addr_state issue_d earliest_cr_line dti delinq_2yrs "
               "inq_last_6mths open_acc total_acc pub_rec revol_bal loan_status is_default pd data_quarter revol_util "
               "emp_length_years split").split()


_PROFILED = ("id loan_amnt term int_rate grade sub_grade annual_inc home_ownership verification_status emp_length purpose addr_state "
             "dti delinq_2yrs inq_last_6mths open_acc total_acc pub_rec loan_status is_default").split()


@register("column_profiles", with_views("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing, "
    f"CASE WHEN COUNT(DISTINCT {c}) <= 50 THEN COUNT(DISTINCT {c}) END AS distinct_values, TRUE AS within_five_percent FROM loans" for c in _PROFILED)))
def q_column_profiles(spark, sf):
    """Profiles of every quarter, stored and put together: rows, missing
    and distinct values; estimates of up to 50 values are exact, all are held
    against the exact count."""
    from ..operators import audit as au
    from ..session import materialize
    loans = loan_table(spark, sf).select("data_quarter", *_PROFILED)
    merged = au.merge_profiles(materialize(au.column_profile(loans, "loans", "data_quarter"), "profiles"))
    exact = loans.agg(*[F.count_distinct(c).alias(c) for c in _PROFILED]).unpivot([], _PROFILED, "column_name", "exact")
    d = F.col("distinct_estimate")
    return merged.join(exact, "column_name").select("column_name", "rows", "missing", F.when(d <= 50, d).alias("distinct_values"),
                                                    (F.abs(d - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_five_percent"))


@register("metric_variance", with_views("""
SELECT round(var_pop(brier), 6) AS variance, var_pop(brier) < 0.05e0 AS stable FROM (
 SELECT data_quarter, AVG((pd - label) * (pd - label)) AS brier FROM labelled GROUP BY data_quarter)""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL))
def q_metric_variance(spark, sf):
    """Variance of the Brier score over the quarters, against its limit."""
    by = mt.score_summary(labelled_loans(spark, sf).withColumnRenamed("pd", "p"), by=["data_quarter"])
    return rounded(qa.metric_variance_rule(by, "brier_score"))


@register("availability_rules", with_views(f"""
SELECT round(prevalence, 6) AS prevalence, round(min_availability, 6) AS min_availability,
 prevalence >= 0.01 AS prevalence_ok, min_availability > 0.8 AS availability_ok FROM (
 SELECT AVG(label) AS prevalence, LEAST({', '.join(f'COUNT({c}) * 1.0e0 / COUNT(*)' for c in _AVAIL_COLS)}) AS min_availability
 FROM labelled)""", LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL))
def q_availability_rules(spark, sf):
    """Prevalence >= 1 % and every column present in > 80 % of rows."""
    return rounded(qa.availability_rules(labelled_loans(spark, sf).drop("revol_util_raw"), "label"))


@register("roi_proxy", with_views("""
SELECT id, round(CASE WHEN loan_amnt > 0 THEN ((CASE WHEN is_default = 1 THEN installment * term * 0.3e0
 ELSE installment * term END) - loan_amnt) / loan_amnt END, 6) AS roi_proxy FROM loans"""))
def q_roi_proxy(spark, sf):
    """Instalment-based ROI proxy (a default collects 30 % of the instalments)."""
    from ..functions.returns import instalment_roi
    return rounded(loan_table(spark, sf).select("id", instalment_roi("installment", "term", "loan_amnt", "is_default")
                                                .alias("roi_proxy")))


@register("synthetic_label")
def q_synthetic_label(spark, sf):
    """X9 draw: seeded, repeatable Bernoulli label from the synthetic
    probability (rows-only: the hash has no SQL twin)."""
    from ..operators import targets as tg
    return tg.synthetic_label(loan_table(spark, sf)).select("id", "synthetic_probability", "label")
