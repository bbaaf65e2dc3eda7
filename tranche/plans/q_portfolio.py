"""Queries: portfolio selection and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import portfolio as pf
from ..sources.loans import loan_table
from ..sources.tables import table
from .registry import register, rounded
from .views import LOANS_SQL, with_views

POLICY = pf.PortfolioPolicy()

CAND_SQL = """
cand AS (
 SELECT data_quarter, id AS loan_id,
  CAST(COALESCE(funded_amnt, loan_amnt, 0e0) AS DECIMAL(18,4)) AS loan_amount,
  CAST(LEAST(COALESCE(funded_amnt, loan_amnt, 0e0), 25e0) AS DECIMAL(18,4)) AS ticket,
  pd AS default_probability,
  (1 - pd) * COALESCE(int_rate, 0e0) - pd * 0.7e0 AS expected_return,
  COALESCE(sub_grade, 'Unknown') AS risk_grade, CAST(COALESCE(term, 36) AS INTEGER) AS term,
  COALESCE(int_rate, 0e0) AS interest_rate,
  CASE WHEN pd > 0.25e0 THEN 'default_probability'
       WHEN (1 - pd) * COALESCE(int_rate, 0e0) - pd * 0.7e0 < 0.05e0 THEN 'expected_return'
       WHEN COALESCE(funded_amnt, loan_amnt, 0e0) <= 0 THEN 'loan_amount' END AS reason
 FROM loans)"""

OUT_COLS = """data_quarter, loan_id, CAST(loan_amount AS DOUBLE) AS loan_amount,
 CAST(investment_amount AS DOUBLE) AS investment_amount, default_probability,
 round(expected_return, 6) AS expected_return, risk_grade, term, round(interest_rate, 6) AS interest_rate"""


def _views():
    from .views import LOANS_SQL
    return (LOANS_SQL, CAND_SQL)


def _ranked(order: str) -> tuple[str, str]:
    return (f"""ranked AS (
 SELECT *, SUM(ticket) OVER (PARTITION BY data_quarter ORDER BY {order}
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM cand WHERE reason IS NULL)""",
            """sel AS (
 SELECT *, CASE WHEN cum <= 5000 THEN ticket ELSE 5000 - (cum - ticket) END AS investment_amount
 FROM ranked WHERE cum <= 5000 OR (cum - ticket <= 5000 AND 5000 - (cum - ticket) > 1))""")


def _sel_sql(order: str, body: str, extra: tuple = ()) -> str:
    return with_views(body, *_views(), *_ranked(order), *extra)


def _sel_out(df):
    return rounded(df.select(
        "data_quarter", "loan_id", F.col("loan_amount").cast("double").alias("loan_amount"),
        F.col("investment_amount").cast("double").alias("investment_amount"), "default_probability",
        "expected_return", "risk_grade", "term", "interest_rate"))


def lowest_risk_selection(spark, sf):
    loans = loan_table(spark, sf)
    c = pf.filter_candidates(pf.candidates(loans, policy=POLICY), POLICY)
    return pf.select_lowest_risk(c, POLICY)


@register("portfolio_lowest_risk", _sel_sql("default_probability, loan_id", f"SELECT {OUT_COLS} FROM sel"))
def q_lowest_risk(spark, sf):
    """K4 per quarter: 5 000 budget, 25 tickets, lowest default probability first."""
    return _sel_out(lowest_risk_selection(spark, sf))


@register("portfolio_highest_ev", _sel_sql("expected_return DESC, loan_id", f"SELECT {OUT_COLS} FROM sel"))
def q_highest_ev(spark, sf):
    """K5 per quarter: highest expected return first."""
    loans = loan_table(spark, sf)
    c = pf.filter_candidates(pf.candidates(loans, policy=POLICY), POLICY)
    return _sel_out(pf.select_highest_expected_value(c, POLICY))


_METRICS_CTES = (
"""m AS (
 SELECT data_quarter, CAST(SUM(investment_amount) AS DOUBLE) AS total_investment, COUNT(*) AS loan_count,
  AVG(default_probability) AS avg_risk_score, AVG(expected_return) AS avg_expected_return,
  STDDEV_POP(default_probability) AS default_risk_std, MAX(default_probability) AS max_default_risk,
  MIN(default_probability) AS min_default_risk, STDDEV_POP(expected_return) AS return_std
 FROM sel GROUP BY data_quarter),
gs AS (
 SELECT data_quarter, MAX(share) AS concentration_risk FROM (
  SELECT data_quarter, CAST(SUM(investment_amount) AS DOUBLE) / CAST(SUM(SUM(investment_amount)) OVER (PARTITION BY data_quarter) AS DOUBLE) AS share
  FROM sel GROUP BY data_quarter, risk_grade) GROUP BY data_quarter),
q AS (SELECT DISTINCT data_quarter FROM loans),
mm AS (
 SELECT q.data_quarter, COALESCE(total_investment, 0) AS total_investment, COALESCE(loan_count, 0) AS loan_count,
  COALESCE(avg_risk_score, 0) AS avg_risk_score, COALESCE(avg_expected_return, 0) AS avg_expected_return,
  COALESCE(default_risk_std, 0) AS default_risk_std, COALESCE(max_default_risk, 0) AS max_default_risk,
  COALESCE(min_default_risk, 0) AS min_default_risk, COALESCE(return_std, 0) AS return_std,
  COALESCE(concentration_risk, 0) AS concentration_risk,
  COALESCE(avg_expected_return / (return_std + 1e-8), 0) AS sharpe_ratio
 FROM q LEFT JOIN m ON q.data_quarter = m.data_quarter LEFT JOIN gs ON q.data_quarter = gs.data_quarter)""",
)



def lowest_risk_metrics(spark, sf):
    loans = loan_table(spark, sf)
    sel = lowest_risk_selection(spark, sf)
    return pf.portfolio_metrics(sel, groups=loans)


@register("portfolio_metrics", _sel_sql("default_probability, loan_id", """
SELECT data_quarter, total_investment, loan_count, round(avg_risk_score, 6) AS avg_risk_score,
 round(avg_expected_return, 6) AS avg_expected_return, round(default_risk_std, 6) AS default_risk_std,
 round(max_default_risk, 6) AS max_default_risk, round(min_default_risk, 6) AS min_default_risk,
 round(return_std, 6) AS return_std, round(concentration_risk, 6) AS concentration_risk,
 round(sharpe_ratio, 6) AS sharpe_ratio FROM mm""", _METRICS_CTES))
def q_portfolio_metrics(spark, sf):
    """K9 per quarter over the lowest-risk portfolio (zeros for empty quarters)."""
    m = rounded(lowest_risk_metrics(spark, sf))
    return m.withColumn("sharpe_ratio", F.round("sharpe_ratio", 6))


@register("portfolio_grade_share", _sel_sql("default_probability, loan_id", """
SELECT data_quarter, risk_grade, round(CAST(SUM(investment_amount) AS DOUBLE)
  / CAST(SUM(SUM(investment_amount)) OVER (PARTITION BY data_quarter) AS DOUBLE), 6) AS share
FROM sel GROUP BY data_quarter, risk_grade"""))
def q_grade_share(spark, sf):
    """K9: invested share per sub-grade and quarter."""
    return rounded(pf.share_by(lowest_risk_selection(spark, sf), "risk_grade"))


@register("portfolio_term_share", _sel_sql("default_probability, loan_id", """
SELECT data_quarter, term, round(CAST(SUM(investment_amount) AS DOUBLE)
  / CAST(SUM(SUM(investment_amount)) OVER (PARTITION BY data_quarter) AS DOUBLE), 6) AS share
FROM sel GROUP BY data_quarter, term"""))
def q_term_share(spark, sf):
    """K9: invested share per term and quarter."""
    return rounded(pf.share_by(lowest_risk_selection(spark, sf), "term"))


@register("portfolio_constraints", _sel_sql("default_probability, loan_id", """
SELECT t.data_quarter, CAST(total AS DOUBLE) AS total_investment, loans AS loan_count,
 total > 5000 AS over_budget, loans < 100 AS below_min_diversity,
 round(CAST(top AS DOUBLE) / 5000e0, 6) AS max_grade_share_of_budget,
 round(CAST(top AS DOUBLE) / CAST(total AS DOUBLE), 6) AS max_grade_share_of_invested,
 CAST(top AS DOUBLE) / 5000e0 > 0.30e0 AS concentration_exceeded
FROM t JOIN tp ON t.data_quarter = tp.data_quarter""", (
    "pg AS (SELECT data_quarter, risk_grade, SUM(investment_amount) AS amt FROM sel GROUP BY ALL)",
    "t AS (SELECT data_quarter, SUM(investment_amount) AS total, COUNT(*) AS loans FROM sel GROUP BY ALL)",
    "tp AS (SELECT data_quarter, MAX(amt) AS top FROM pg GROUP BY ALL)")))
def q_constraints(spark, sf):
    """K8 checks per quarter."""
    return rounded(pf.constraint_report(lowest_risk_selection(spark, sf), POLICY))


@register("decision_summary", _sel_sql("default_probability, loan_id", """
SELECT data_quarter, 'lowest_risk' AS selection_strategy, 5000e0 AS budget_allocated,
 total_investment AS budget_used, round(total_investment / 5000e0, 6) AS budget_utilization,
 loan_count AS loans_selected,
 round(CASE WHEN loan_count > 0 THEN total_investment / loan_count ELSE 0 END, 6) AS avg_investment_per_loan,
 round(avg_risk_score, 6) AS avg_default_probability,
 round(avg_expected_return * total_investment, 6) AS estimated_annual_return,
 total_investment <= 5000 AS budget_constraint_ok, max_default_risk <= 0.25e0 AS max_default_risk_ok,
 avg_expected_return >= 0.05e0 AS min_expected_return_ok, concentration_risk <= 0.30e0 AS grade_concentration_ok
FROM mm""", _METRICS_CTES))
def q_decision_summary(spark, sf):
    """Summary and compliance flags per quarter."""
    s = rounded(pf.decision_summary(lowest_risk_metrics(spark, sf), POLICY))
    return s.withColumn("estimated_annual_return", F.round("estimated_annual_return", 6))


@register("candidates_expected_return", with_views("""
SELECT data_quarter, loan_id, CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(ticket AS DOUBLE) AS ticket,
 default_probability, round(expected_return, 6) AS expected_return, risk_grade, term,
 round(interest_rate, 6) AS interest_rate, round(ev, 6) AS expected_value, reason FROM (
 SELECT *, CAST(ticket AS DOUBLE) * expected_return AS ev FROM cand)""", *_views()))
def q_candidates(spark, sf):
    """K0 + K2 + D15: every loan as a candidate with its expected return,
    the money expected on its ticket, and the F2 reason it fails (or NULL)."""
    from ..functions.returns import expected_value
    c = pf.candidates(loan_table(spark, sf), policy=POLICY)
    return rounded(c.select(
        "data_quarter", "loan_id", F.col("loan_amount").cast("double").alias("loan_amount"),
        F.col("ticket").cast("double").alias("ticket"), "default_probability", "expected_return", "risk_grade",
        "term", "interest_rate",
        expected_value(F.col("ticket").cast("double"), F.col("interest_rate"), F.col("default_probability"),
                       POLICY.roi_method, POLICY.recovery_rate).alias("expected_value"),
        pf.risk_filter_reason(POLICY).alias("reason")))


@register("candidates_scored", with_views("""
SELECT c.data_quarter, c.loan_id, CAST(c.loan_amount AS DOUBLE) AS loan_amount, round(s.score, 6) AS default_probability,
 round((1 - s.score) * c.interest_rate - s.score * 0.7e0, 6) AS expected_return, c.risk_grade,
 CASE WHEN s.score > 0.25e0 THEN 'default_probability' WHEN (1 - s.score) * c.interest_rate - s.score * 0.7e0 < 0.05e0 THEN 'expected_return'
  WHEN c.loan_amount <= 0 THEN 'loan_amount' END AS reason
FROM cand c JOIN scores s ON c.loan_id = s.id""", LOANS_SQL, CAND_SQL, """
scores AS (SELECT l_orderkey AS id, AVG(l_discount + l_tax) / 3e0 AS score FROM lineitem GROUP BY l_orderkey)"""))
def q_candidates_scored(spark, sf):
    """F5 + J5: candidates from a score table of its own, joined on the id;
    loans without a score are left out."""
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg((F.avg(F.col("l_discount") + F.col("l_tax")) / 3).alias("pd"))
    c = pf.candidates(loan_table(spark, sf), scores, POLICY)
    return rounded(c.select("data_quarter", "loan_id", F.col("loan_amount").cast("double").alias("loan_amount"), "default_probability",
                            "expected_return", "risk_grade", pf.risk_filter_reason(POLICY).alias("reason")))


@register("risk_filter_reasons", with_views("""
SELECT data_quarter, COALESCE(reason, 'passed') AS reason, COUNT(*) AS n FROM cand GROUP BY ALL""", *_views()))
def q_risk_filter(spark, sf):
    """candidates per quarter by the first rule they fail."""
    return pf.risk_filter_counts(pf.candidates(loan_table(spark, sf), policy=POLICY), POLICY)
