"""Time to default with censoring (D21): durations, survival curves, a model.

A loan's clock starts at issue.  It stops with the first default observation
(an event), or with its last observation of any kind (censored: the default,
if there is one, comes later).  Everything is a grouped aggregate; the curve
works on one row per group and period.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import OUTCOME_DEFAULT_STATUSES

PERIOD_DAYS = 30


def time_to_default(listing: DataFrame, outcomes: DataFrame, statuses=None, horizon_days: int | None = None) -> DataFrame:
    """id, event (1: defaulted), days from issue to the event or to the end of
    observation, period (days div 30) per listed loan; further columns of
    ``listing`` (id, issue_d) pass through.

    Loans without any observation, or observed before issue only, have no
    duration and are left out.  Observations before issue do not count.  With
    ``horizon_days`` observation ends there for every loan.  The outcome rows
    are combined per loan before they meet the loans."""
    hit = F.col("loan_status").isin(list(statuses or OUTCOME_DEFAULT_STATUSES))
    dated = (outcomes.select("id", "loan_status", "outcome_date").join(listing.select("id", F.col("issue_d").alias("_issue")), "id")
             .withColumn("_days", F.datediff("outcome_date", "_issue")).where(F.col("_days") >= 0))
    per = dated.groupBy("id").agg(F.min(F.when(hit, F.col("_days"))).alias("_first"), F.max("_days").alias("_last"))
    end = F.col("_last") if horizon_days is None else F.least("_last", F.lit(horizon_days))
    event = F.coalesce(F.col("_first") <= end, F.lit(False))
    return (listing.join(per, "id").withColumn("event", event.cast("int"))
            .withColumn("days", F.when(event, F.col("_first")).otherwise(end))
            .withColumn("period", F.floor(F.col("days") / PERIOD_DAYS).cast("int")).drop("_first", "_last"))


def kaplan_meier(durations: DataFrame, by: str = "data_quarter") -> DataFrame:
    """Survival per group and period: at_risk, events, censored, hazard,
    survival (running product of 1 - hazard) and its Greenwood error.

    Loans censored in a period are at risk in it.  The rows are counted once
    per (group, period); the windows hold one group's periods."""
    per = durations.groupBy(by, "period").agg(F.sum("event").alias("events"), (F.count(F.lit(1)) - F.sum("event")).alias("censored"))
    w = Window.partitionBy(by).orderBy("period")
    gone = F.sum(F.col("events") + F.col("censored")).over(w.rowsBetween(0, Window.unboundedFollowing))
    risk = per.withColumn("at_risk", gone).withColumn("hazard", F.col("events") / F.col("at_risk"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # a hazard of 1 ends the curve; before that the product is a sum of logs
    ended = F.max((F.col("events") == F.col("at_risk")).cast("int")).over(upto) == 1
    product = F.exp(F.sum(F.when(F.col("hazard") < 1, F.log1p(-F.col("hazard"))).otherwise(0.0)).over(upto))
    spread = F.sum(F.try_divide(F.col("events"), F.col("at_risk") * (F.col("at_risk") - F.col("events")))).over(upto)
    return (risk.withColumn("survival", F.when(ended, 0.0).otherwise(product))
            .withColumn("survival_se", F.col("survival") * F.sqrt(F.coalesce(spread, F.lit(0.0))))
            .select(by, "period", "at_risk", "events", "censored", "hazard", "survival", "survival_se"))


def fit_aft(durations: DataFrame, features: list[str] | str = "features", quantiles=(0.1, 0.5), max_iter: int = 100):
    """Weibull regression of the days to default on features, censored loans
    included (MLlib's distributed fit; a day is added, since times must be
    positive).  ``features`` is a vector column or names to assemble."""
    if not isinstance(features, str):
        durations = VectorAssembler(inputCols=list(features), outputCol="_aft", handleInvalid="skip").transform(durations)
        features = "_aft"
    rows = durations.select(F.col(features).alias("features"), (F.col("days") + 1).cast("double").alias("time"),
                            F.col("event").cast("double").alias("censor"))
    return AFTSurvivalRegression(featuresCol="features", labelCol="time", censorCol="censor", maxIter=max_iter,
                                 quantileProbabilities=list(quantiles), quantilesCol="quantiles").fit(rows)
