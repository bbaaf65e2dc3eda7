"""Queries on time to default."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import survival as sv
from ..sources.loans import loan_table, outcome_table
from .registry import register, rounded
from .views import LOANS_SQL, OUTCOMES_SQL, with_views

_DURATIONS_SQL = """
durations AS (
 SELECT id, data_quarter, CASE WHEN first_day IS NOT NULL THEN 1 ELSE 0 END AS event,
  COALESCE(first_day, last_day) AS days, COALESCE(first_day, last_day) // 30 AS period
 FROM (
  SELECT l.id, l.data_quarter, MAX(datediff('day', l.issue_d, o.outcome_date)) AS last_day,
   MIN(CASE WHEN o.loan_status IN ('Charged Off', 'Default', 'Does not meet the credit policy. Status:Charged Off')
       THEN datediff('day', l.issue_d, o.outcome_date) END) AS first_day
  FROM loans l JOIN outcomes o ON o.id = l.id WHERE o.outcome_date >= l.issue_d GROUP BY l.id, l.data_quarter)
)"""


def _durations(spark, sf):
    return sv.time_to_default(loan_table(spark, sf).select("id", "issue_d", "data_quarter"), outcome_table(spark, sf))


@register("time_to_default", with_views("""
SELECT id, event, CAST(days AS INTEGER) AS days, CAST(period AS INTEGER) AS period FROM durations""", LOANS_SQL, OUTCOMES_SQL, _DURATIONS_SQL))
def q_time_to_default(spark, sf):
    """Days from issue to default, or to the end of observation."""
    return _durations(spark, sf).select("id", "event", "days", "period")


@register("kaplan_meier", with_views("""
SELECT data_quarter, CAST(period AS INTEGER) AS period, at_risk, events, censored, round(hazard, 6) AS hazard, round(survival, 6) AS survival,
 round(survival * sqrt(COALESCE(spread, 0)), 6) AS survival_se FROM (
 SELECT *, product(1 - hazard) OVER w AS survival,
  SUM(CASE WHEN at_risk > events THEN events * 1.0e0 / (at_risk * (at_risk - events)) END) OVER w AS spread FROM (
  SELECT *, events * 1.0e0 / at_risk AS hazard FROM (
   SELECT data_quarter, period, CAST(SUM(event) AS BIGINT) AS events, CAST(COUNT(*) - SUM(event) AS BIGINT) AS censored,
    CAST(SUM(COUNT(*)) OVER (PARTITION BY data_quarter ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS at_risk
   FROM durations GROUP BY data_quarter, period))
 WINDOW w AS (PARTITION BY data_quarter ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
                                      LOANS_SQL, OUTCOMES_SQL, _DURATIONS_SQL))
def q_kaplan_meier(spark, sf):
    """Survival curve of every issue quarter."""
    return rounded(sv.kaplan_meier(_durations(spark, sf)))


@register("aft_survival")
def q_aft_survival(spark, sf):
    """Weibull model of the days to default on the fitted features, learnt
    on the training quarters; a tenth's and the median time per validation loan."""
    from .q_models import model_frames
    _, frames = model_frames(spark, sf, max_features=20)
    model = sv.fit_aft(frames["train"].join(_durations(spark, sf).select("id", "event", "days"), "id"))
    q = vector_to_array("quantiles")
    return (model.transform(frames["validation"].select("id", "data_quarter", "features"))
            .select("id", "data_quarter", q[0].alias("days_to_10_percent"), q[1].alias("median_days")))
