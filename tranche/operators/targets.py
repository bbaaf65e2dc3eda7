"""Labels from later outcome observations.

Outcome files repeat loan ids; the last observation (by date, then
sequence) wins.  The dedupe is a grouped ``max_by`` (partial aggregation
before the shuffle), then one left join to the listings on ``id``; loans
without an outcome are censored and labelled 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import OUTCOME_DEFAULT_STATUSES, SYNTHETIC_GRADE_PROBABILITY, SYNTHETIC_UNKNOWN_PROBABILITY


def _flag(statuses) -> "F.Column":
    return F.col("loan_status").isin(list(statuses)).cast("int")


def _observed(outcomes: DataFrame) -> "F.Column":
    """The order of observations, by date, then sequence (missing: first).  Of
    a date and an int it is one long: with a struct as its buffer, ``max_by``
    would sort all rows instead of hashing them."""
    kinds = [outcomes.schema[c].dataType.simpleString() for c in ("outcome_date", "obs_seq")]
    if kinds != ["date", "int"]:
        return F.struct("outcome_date", "obs_seq")
    day = F.coalesce(F.unix_date("outcome_date").cast("long"), F.lit(-(1 << 30)))      # years 1 to 9999 are far inside
    return day * F.lit(1 << 33) + F.coalesce(F.col("obs_seq").cast("long") + F.lit((1 << 31) + 1), F.lit(0))


def latest_outcome(outcomes: DataFrame, statuses=OUTCOME_DEFAULT_STATUSES) -> DataFrame:
    """Last observation per loan id: (id, outcome_flag, outcome_date)."""
    return outcomes.groupBy("id").agg(
        F.max_by(_flag(statuses), _observed(outcomes)).alias("outcome_flag"),
        F.max("outcome_date").alias("last_outcome_date"))


def match_outcomes(listing: DataFrame, outcomes: DataFrame, window_months: int | None = None,
                   statuses=OUTCOME_DEFAULT_STATUSES, outcome_quarters: list[str] | None = None,
                   label: str = "label") -> DataFrame:
    """J1 (+J2, J3): listings with ``label`` (default flag of the last valid
    observation, 0 when none) and ``censored``.

    ``window_months``: an observation counts only when made at least that
    many months after the loan's issue date (J2; None = every observation).
    ``outcome_quarters``: only observations in these quarters count (J3).
    """
    obs = outcomes
    if outcome_quarters is not None:
        obs = obs.where(F.col("outcome_quarter").isin(list(outcome_quarters)))
    if window_months is not None:
        issued = listing.select("id", F.col("issue_d").alias("_issue_d"))
        obs = (obs.join(issued, "id")
               .where(F.col("outcome_date") >= F.add_months("_issue_d", window_months)).drop("_issue_d"))
    last = latest_outcome(obs, statuses)
    return (listing.join(last, "id", "left")
            .withColumn("censored", F.col("outcome_flag").isNull())
            .withColumn(label, F.coalesce(F.col("outcome_flag"), F.lit(0)))
            .drop("outcome_flag"))


def match_outcomes_by_split(listing: DataFrame, outcomes: DataFrame, windows: dict[str, int | None],
                            split_col: str = "split", label: str = "label",
                            outcome_quarters: dict[str, list[str]] | None = None) -> DataFrame:
    """J2 + J3 per split: each split has its own observation window (months
    after issue) and, with ``outcome_quarters``, its own quarters in which
    observations count (a split without an entry: all).  Both tables are
    bounded by the number of splits and quarters and broadcast."""
    spark = listing.sparkSession
    quarters = outcome_quarters or {}
    win = spark.createDataFrame([(k, v, quarters.get(k)) for k, v in windows.items()], f"{split_col} string, _win int, _quarters array<string>")
    issued = listing.select("id", split_col, F.col("issue_d").alias("_issue_d")).join(F.broadcast(win), split_col)
    obs = (outcomes.join(issued, "id")
           .where(F.col("_win").isNull() | (F.col("outcome_date") >= F.expr("add_months(_issue_d, _win)")))
           .where(F.col("_quarters").isNull() | F.array_contains("_quarters", F.col("outcome_quarter"))))
    last = latest_outcome(obs)
    return (listing.join(last, "id", "left")
            .withColumn("censored", F.col("outcome_flag").isNull())
            .withColumn(label, F.coalesce(F.col("outcome_flag"), F.lit(0))).drop("outcome_flag"))


def synthetic_probability(df: DataFrame, grade_col: str = "sub_grade", rate_col: str = "int_rate") -> DataFrame:
    """X9 probability: sub-grade probability (unknown .15) + .1 * min-max
    scaled rate, clipped to [.001, .60]; missing where the rate is.  Min and max come from one
    aggregate and enter as literals."""
    table = F.create_map(*[x for g, p in SYNTHETIC_GRADE_PROBABILITY.items() for x in (F.lit(g), F.lit(p))])
    base = F.coalesce(F.element_at(table, F.col(grade_col)), F.lit(SYNTHETIC_UNKNOWN_PROBABILITY))
    from .rows import scalars
    mm = scalars(df.agg(F.min(rate_col).alias("_rmin"), F.max(rate_col).alias("_rmax")))
    lo, hi = F.lit(mm["_rmin"]).cast("double"), F.lit(mm["_rmax"]).cast("double")
    scaled = F.try_divide(F.col(rate_col) - lo, hi - lo)
    p = F.when(F.col(rate_col).isNotNull(), F.least(F.lit(0.60), F.greatest(F.lit(0.001), base + scaled * 0.1)))
    return df.withColumn("synthetic_probability", p)


def synthetic_label(df: DataFrame, seed: int = 42, label: str = "label") -> DataFrame:
    """X9 draw: label = u < probability, u in (0, 1) from a seeded hash of
    the id (repeatable, unlike an unseeded random draw); 0 where the
    probability is missing."""
    u = (F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)
    return synthetic_probability(df).withColumn(label, F.coalesce((u < F.col("synthetic_probability")).cast("int"), F.lit(0)))
