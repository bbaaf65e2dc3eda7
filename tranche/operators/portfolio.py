"""Budget-constrained loan selection per quarter.

Money is DECIMAL(18,4): the greedy rules compare running totals with the
budget, and float rounding flips ties.  K4 and K5 are running sums over one
quarter's candidates in rank order; K6 and K7, which skip, are scans in bounded
batches (``greedy.py``).  None loops over rows on the driver.

Scale: a quarter may hold a third of all loans, so a plain window over the
quarter would be one huge task.  ``select_budgeted`` first adds up tickets per
score bucket and filters out, before any row is shuffled, the buckets that the
budget cannot reach.  Then it prunes exactly: rows are salted into ``salt_buckets`` sub-groups and a row whose running
total *inside its sub-group* already exceeds the budget cannot be selected
(its quarter-wide running total is at least as large), so only the head of
each sub-group survives.  The exact quarter-wide window then runs on the
survivors, which number at most ``salt_buckets * (budget / min ticket + 1)``
per quarter.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, replace
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import PORTFOLIO_DEFAULTS
from ..functions.returns import expected_return, rate_fraction
from ..session import materialize
from .greedy import BATCH, greedy_scan

MONEY = "decimal(18,4)"


@dataclass(frozen=True)
class PortfolioPolicy:
    budget: float = PORTFOLIO_DEFAULTS["budget_per_quarter"]
    ticket_size: float = PORTFOLIO_DEFAULTS["ticket_size"]
    max_default_probability: float = PORTFOLIO_DEFAULTS["max_default_probability"]
    min_expected_return: float = PORTFOLIO_DEFAULTS["min_expected_return"]
    max_concentration_per_grade: float = PORTFOLIO_DEFAULTS["max_concentration_per_grade"]
    min_loan_diversity: int = PORTFOLIO_DEFAULTS["min_loan_diversity"]
    recovery_rate: float = PORTFOLIO_DEFAULTS["default_recovery_rate"]
    roi_method: str = "simple"
    strategy: str = "lowest_risk"
    group_col: str = "data_quarter"
    salt_buckets: int = 64

    def with_(self, **kw) -> "PortfolioPolicy":
        return replace(self, **kw)


def _money(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast(MONEY)


# ---------------------------------------------------------------- K0 / K2
def candidates(loans: DataFrame, scores: DataFrame | None = None, policy: PortfolioPolicy = PortfolioPolicy(),
               score_col: str = "pd") -> DataFrame:
    """K0: one candidate per scored loan.  Scores join the loans on ``id``
    (J5: by key, never by position); loans without a score are left out."""
    g = policy.group_col
    df = loans if scores is None else loans.drop(score_col).join(scores.select("id", score_col), "id")
    amount = F.coalesce(F.col("funded_amnt"), F.col("loan_amnt"), F.lit(0.0))
    rate = F.coalesce(rate_fraction("int_rate") if df.schema["int_rate"].dataType.simpleString() == "string" else F.col("int_rate"), F.lit(0.0))
    p = F.col(score_col)
    return df.select(
        F.col(g), F.col("id").alias("loan_id"),
        _money(amount).alias("loan_amount"),
        _money(F.least(amount, F.lit(policy.ticket_size))).alias("ticket"),
        p.alias("default_probability"),
        expected_return(rate, p, policy.roi_method, policy.recovery_rate).alias("expected_return"),
        F.coalesce(F.col("sub_grade"), F.lit("Unknown")).alias("risk_grade"),
        F.coalesce(F.col("term"), F.lit(36)).cast("int").alias("term"),
        rate.alias("interest_rate"),
    )


# ---------------------------------------------------------------- F2 / F3
def risk_filter_reason(policy: PortfolioPolicy = PortfolioPolicy()) -> Column:
    """first failing rule wins; NULL = passes."""
    return (F.when(F.col("default_probability") > policy.max_default_probability, F.lit("default_probability"))
             .when(F.col("expected_return") < policy.min_expected_return, F.lit("expected_return"))
             .when((F.col("loan_amount") <= 0) | (F.col("ticket") <= 0), F.lit("loan_amount")))


def filter_candidates(cands: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    return cands.where(risk_filter_reason(policy).isNull())


def risk_filter_counts(cands: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """F2 counts per quarter and reason ('passed' for survivors)."""
    return (cands.select(policy.group_col, F.coalesce(risk_filter_reason(policy), F.lit("passed")).alias("reason"))
            .groupBy(policy.group_col, "reason").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- K4 / K5
def _order(strategy: str) -> list[Column]:
    if strategy == "highest_expected_value":
        return [F.col("expected_return").desc(), F.col("loan_id").asc()]
    if strategy == "balanced_portfolio":
        return [F.col("balance_score").desc(), F.col("loan_id").asc()]
    return [F.col("default_probability").asc(), F.col("loan_id").asc()]


SCORE_BUCKETS = 4096


def _bucket(rank: Column, null_first: bool) -> Column:
    """A bucket that grows with ``rank``, whatever its range; missing values
    and NaN at the ends where the sort puts them."""
    first, last = F.lit(-1), F.lit(SCORE_BUCKETS + 1)
    r = rank.cast("double")
    return (F.when(r.isNull(), first if null_first else last).when(F.isnan(r), last if null_first else first)
            .otherwise(F.floor((F.atan(r) / math.pi + 0.5) * SCORE_BUCKETS).cast("int")))


def cut_by_score(cands: DataFrame, bucket: Column, policy: PortfolioPolicy) -> DataFrame:
    """The candidates that a running total in rank order can still reach: the
    ticket totals of all earlier score buckets of their group, added up before
    the shuffle, do not exceed the budget.  The table of last buckets has one
    row per group."""
    g = policy.group_col
    totals = cands.groupBy(g, bucket.alias("_b")).agg(F.sum("ticket").alias("_t"))
    before = F.sum("_t").over(Window.partitionBy(g).orderBy("_b")) - F.col("_t")
    last = totals.withColumn("_before", before).where(F.col("_before") <= _money(policy.budget)).groupBy(g).agg(F.max("_b").alias("_last"))
    # written, so that Spark knows its size and broadcasts it only if small
    return cands.join(materialize(last, "last-buckets"), g).where(bucket <= F.col("_last")).drop("_last")


def select_budgeted(cands: DataFrame, order: list[Column], policy: PortfolioPolicy = PortfolioPolicy(),
                    bucket: Column | None = None) -> DataFrame:
    """Fill the budget in rank order; the first loan that overflows gets the
    rest when the rest exceeds 1; nothing after it is taken.  Returns the
    selected rows with ``investment_amount``.

    With a score ``bucket`` (which follows the order's first key) the rows
    beyond the budget are filtered out before any row is shuffled."""
    g, B = policy.group_col, _money(policy.budget)
    if bucket is not None:
        cands = cut_by_score(cands, bucket, policy)
    salt = F.pmod(F.xxhash64("loan_id"), F.lit(policy.salt_buckets))
    w_local = Window.partitionBy(g, "_salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pruned = (cands.withColumn("_salt", salt)
              .withColumn("_lprev", F.coalesce(F.sum("ticket").over(w_local), _money(0)))
              .where(F.col("_lprev") <= B).drop("_salt", "_lprev"))
    w = Window.partitionBy(g).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = pruned.withColumn("_cum", F.sum("ticket").over(w)).withColumn("_prev", F.col("_cum") - F.col("ticket"))
    rest = B - F.col("_prev")
    take = (F.col("_cum") <= B) | ((F.col("_prev") <= B) & (rest > 1))
    inv = F.when(F.col("_cum") <= B, F.col("ticket")).otherwise(rest)
    return ranked.where(take).withColumn("investment_amount", inv.cast(MONEY)).drop("_cum", "_prev")


def select_lowest_risk(cands: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """K4: by default probability ascending (id breaks ties)."""
    return select_budgeted(cands, _order("lowest_risk"), policy, _bucket(F.col("default_probability"), True))


def select_highest_expected_value(cands: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """K5: by expected return descending (id breaks ties)."""
    return select_budgeted(cands, _order("highest_expected_value"), policy, _bucket(-F.col("expected_return"), False))


# ---------------------------------------------------------------- K6
def _decimal(x: float) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.0001"), ROUND_HALF_UP)


def select_balanced(cands: DataFrame, policy: PortfolioPolicy = PortfolioPolicy(), batch: int = BATCH) -> DataFrame:
    """K6: rank by expected_return / (p + .01) descending; a per-grade cap of
    ``budget * max_concentration_per_grade`` shrinks the ticket; a loan is
    taken when its (shrunk) amount exceeds 1 and fits the rest of the budget;
    otherwise it is skipped and the scan goes on.

    Rows leave the scan for good when their grade has at most 1 left, or when
    neither the ticket nor what later picks can leave of the grade's cap (its
    room less the rest) fits the rest.
    """
    g, cap = policy.group_col, _decimal(policy.budget * policy.max_concentration_per_grade)
    score = F.col("expected_return") / (F.col("default_probability") + 0.01)
    rows = (cands.where(F.col("ticket") > 1).withColumn("balance_score", score)
            .withColumn("_a", F.coalesce(-F.col("balance_score"), F.lit(float("inf")))))
    rows = materialize(rows, "balanced-rows")
    left = F.lit(cap).cast(MONEY) - F.coalesce(
        F.element_at(F.from_json("used", "map<string,string>"), F.col("risk_grade")).cast(MONEY), _money(0))
    room = (F.col("rest") > 1) & (left > 1) & ((F.col("ticket") <= F.col("rest")) | (left - F.col("rest") <= F.col("rest")))

    def step(pdf):
        rest, used, at, amounts = pdf["rest"][0], {k: Decimal(v) for k, v in json.loads(pdf["used"][0]).items()}, [], []
        for i, (ticket, grade) in enumerate(zip(pdf["ticket"], pdf["risk_grade"])):
            amount = min(ticket, cap - used.get(grade, Decimal(0)))
            if 1 < amount <= rest:
                at.append(i), amounts.append(amount)
                rest -= amount
                used[grade] = used.get(grade, Decimal(0)) + amount
        return at, amounts, rest, json.dumps({k: str(v) for k, v in used.items()})

    memory = rows.select(g).distinct().select(g, _money(policy.budget).alias("rest"), F.lit("{}").alias("used"))
    return greedy_scan(rows, g, memory, room, step, batch, policy.salt_buckets, "balanced").drop("balance_score")


# ---------------------------------------------------------------- K7
def policy_select(preds: DataFrame, loans: DataFrame, budget: float = 5000.0, max_risk_tolerance: float = 0.15,
                  method: str = "lowest_risk", max_loans: int | None = None, group_col: str = "data_quarter",
                  batch: int = BATCH, salt_buckets: int = 64) -> DataFrame:
    """K7: keep p <= tolerance; rank (lowest_risk: p asc; highest_return:
    risk_score desc; otherwise id); take a loan when its funded amount fits
    the rest, skip it otherwise; stop after ``max_loans``.  The rest only
    falls, so a row above it leaves the scan for good."""
    rank = {"lowest_risk": F.col("default_probability").cast("double"),
            "highest_return": F.coalesce(-F.col("risk_score").cast("double"), F.lit(float("inf")))}.get(method, F.lit(0.0))
    elig = (preds.where(F.col("default_probability") <= max_risk_tolerance)
            .join(loans.select(F.col("id").alias("loan_id"), group_col, F.col("funded_amnt").cast(MONEY).alias("amount")), "loan_id")
            .where(F.col("amount").isNotNull()).withColumn("_a", rank))
    elig = materialize(elig, "policy-eligible")

    def step(pdf):
        rest, at = pdf["rest"][0], []
        for i, amount in enumerate(pdf["amount"]):
            if amount <= rest:
                at.append(i)
                rest -= amount
        return at, [pdf["amount"][i] for i in at], rest, ""

    memory = elig.select(group_col).distinct().select(group_col, _money(budget).alias("rest"), F.lit("").alias("used"))
    taken = greedy_scan(elig, group_col, memory, F.col("amount") <= F.col("rest"), step, batch, salt_buckets, "policy")
    if max_loans:
        order = {"lowest_risk": [F.col("default_probability")], "highest_return": [F.col("risk_score").desc()]}.get(method, [])
        n = F.row_number().over(Window.partitionBy(group_col).orderBy(*order, "loan_id"))
        taken = taken.withColumn("_n", n).where(F.col("_n") <= max_loans).drop("_n")
    return taken.drop("investment_amount")


# ---------------------------------------------------------------- K3 / K11
def apply_strategy(filtered: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """K3: dispatch; unknown strategy -> lowest risk."""
    if policy.strategy == "highest_expected_value":
        return select_highest_expected_value(filtered, policy)
    if policy.strategy == "balanced_portfolio":
        return select_balanced(filtered, policy)
    return select_lowest_risk(filtered, policy)


def enforce_constraints(selected: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """K8: scale pro rata when a quarter's total exceeds the budget."""
    g = policy.group_col
    tot = F.sum("investment_amount").over(Window.partitionBy(g))
    factor = F.when(tot > policy.budget, F.lit(policy.budget) / tot).otherwise(F.lit(1))
    return selected.withColumn("investment_amount", (F.col("investment_amount") * factor).cast(MONEY))


def select_investments(loans: DataFrame, scores: DataFrame | None = None,
                       policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """Candidates -> risk filter -> strategy -> constraints, per quarter."""
    c = candidates(loans, scores, policy)
    return enforce_constraints(apply_strategy(filter_candidates(c, policy), policy), policy)


# ---------------------------------------------------------------- K8 / K9 / K10
def constraint_report(selected: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """K8 checks per quarter: total vs budget, loan count vs the diversity
    target, largest grade share of the budget and of the invested total."""
    g = policy.group_col
    per_grade = selected.groupBy(g, "risk_grade").agg(F.sum("investment_amount").alias("amt"))
    tot = selected.groupBy(g).agg(F.sum("investment_amount").alias("total"), F.count(F.lit(1)).alias("loans"))
    top = per_grade.groupBy(g).agg(F.max("amt").alias("top_grade_amount"))
    return tot.join(top, g).select(
        g, F.col("total").cast("double").alias("total_investment"), F.col("loans").alias("loan_count"),
        (F.col("total") > policy.budget).alias("over_budget"),
        (F.col("loans") < policy.min_loan_diversity).alias("below_min_diversity"),
        (F.col("top_grade_amount") / F.lit(policy.budget)).cast("double").alias("max_grade_share_of_budget"),
        (F.col("top_grade_amount") / F.col("total")).cast("double").alias("max_grade_share_of_invested"),
        ((F.col("top_grade_amount") / F.lit(policy.budget)) > policy.max_concentration_per_grade)
        .alias("concentration_exceeded"),
    )


def share_by(selected: DataFrame, key: str, group_col: str = "data_quarter") -> DataFrame:
    """K9: share of the invested total by ``key`` (grade or term)."""
    part = selected.groupBy(group_col, key).agg(F.sum("investment_amount").alias("amt"))
    return part.select(group_col, key, (F.col("amt") / F.sum("amt").over(Window.partitionBy(group_col)))
                       .cast("double").alias("share"))


def portfolio_metrics(selected: DataFrame, groups: DataFrame | None = None, group_col: str = "data_quarter") -> DataFrame:
    """K9: totals, plain means, population spreads, Sharpe = mean/(std+1e-8),
    largest grade share; zeros for quarters with nothing selected."""
    g = group_col
    shares = share_by(selected, "risk_grade", g).groupBy(g).agg(F.max("share").alias("concentration_risk"))
    m = selected.groupBy(g).agg(
        F.sum("investment_amount").cast("double").alias("total_investment"),
        F.count(F.lit(1)).alias("loan_count"),
        F.avg("default_probability").alias("avg_risk_score"),
        F.avg("expected_return").alias("avg_expected_return"),
        F.stddev_pop("default_probability").alias("default_risk_std"),
        F.max("default_probability").alias("max_default_risk"),
        F.min("default_probability").alias("min_default_risk"),
        F.stddev_pop("expected_return").alias("return_std"),
    ).join(shares, g, "left")
    m = m.withColumn("sharpe_ratio", F.col("avg_expected_return") / (F.col("return_std") + 1e-8))
    if groups is not None:
        m = groups.select(g).distinct().join(m, g, "left")
    zero = {c: 0.0 for c in m.columns if c not in (g, "loan_count")}
    zero["loan_count"] = 0
    return m.na.fill(zero)


def decision_summary(metrics: DataFrame, policy: PortfolioPolicy = PortfolioPolicy()) -> DataFrame:
    """Summary per quarter plus the four compliance flags."""
    B = float(policy.budget)
    return metrics.select(
        policy.group_col,
        F.lit(policy.strategy).alias("selection_strategy"),
        F.lit(B).alias("budget_allocated"),
        F.col("total_investment").alias("budget_used"),
        (F.col("total_investment") / B).alias("budget_utilization"),
        F.col("loan_count").alias("loans_selected"),
        F.when(F.col("loan_count") > 0, F.col("total_investment") / F.col("loan_count")).otherwise(0.0)
         .alias("avg_investment_per_loan"),
        F.col("avg_risk_score").alias("avg_default_probability"),
        (F.col("avg_expected_return") * F.col("total_investment")).alias("estimated_annual_return"),
        (F.col("total_investment") <= B).alias("budget_constraint_ok"),
        (F.col("max_default_risk") <= policy.max_default_probability).alias("max_default_risk_ok"),
        (F.col("avg_expected_return") >= policy.min_expected_return).alias("min_expected_return_ok"),
        (F.col("concentration_risk") <= policy.max_concentration_per_grade).alias("grade_concentration_ok"),
    )
