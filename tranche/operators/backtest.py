"""Backtest of a selected portfolio against realised outcomes (B1-B8, D2,
D13, D18).

Outcomes join the selection on the loan id (J6; never by position).  The
random benchmark draws without replacement through an integer hash order
(repeatable and expressible in SQL); keys are pre-cut so only a little more
than the needed rows per draw reach the window, and the cut is widened and
re-run when any draw comes up short — the result is the exact n smallest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

P31 = 2147483647


def attach_outcomes(selected: DataFrame, outcomes: DataFrame, label: str = "label") -> DataFrame:
    """Selected loans with their realised label (inner join on id)."""
    return selected.join(outcomes.select(F.col("id").alias("loan_id"), F.col(label).alias("outcome")), "loan_id")


def loan_return(recovery: float = 0.30):
    """Per-loan return: rate * term / 12 when repaid, -(1 - recovery) on default."""
    return F.when(F.col("outcome") == 0, F.col("interest_rate") * F.col("term") / 12.0).otherwise(F.lit(-(1 - recovery)))


def realised(sel_out: DataFrame, group_col: str = "data_quarter", recovery: float = 0.30) -> DataFrame:
    """B1 + B2 per quarter: defaults, interest on repaid loans, losses on
    defaults, net, ROI, annualised ROI; return volatility, Sharpe and worst
    loan (only with more than one loan)."""
    inv = F.col("investment_amount").cast("double")
    ret = loan_return(recovery)
    good = F.col("outcome") == 0
    a = sel_out.groupBy(group_col).agg(
        F.sum(inv).alias("total_investment"), F.count(F.lit(1)).alias("loans_selected"),
        F.sum(F.col("outcome")).cast("long").alias("actual_defaults"),
        F.sum(F.when(good, inv * F.col("interest_rate") * F.col("term") / 12.0).otherwise(0.0)).alias("total_interest_income"),
        F.sum(F.when(~good, inv * (1 - recovery)).otherwise(0.0)).alias("total_losses"),
        F.avg(F.col("term").cast("double")).alias("_avg_term"),
        F.stddev_pop(ret).alias("_vol"), F.avg(ret).alias("_mret"), F.min(ret).alias("_worst"))
    net = F.col("total_interest_income") - F.col("total_losses")
    roi = F.when(F.col("total_investment") > 0, net / F.col("total_investment")).otherwise(0.0)
    many = F.col("loans_selected") > 1
    return a.select(group_col, "total_investment", "loans_selected", "actual_defaults",
                    (F.col("actual_defaults") / F.col("loans_selected")).alias("default_rate"),
                    "total_interest_income", "total_losses", net.alias("net_return"), roi.alias("roi_proxy"),
                    (roi * (12 / F.col("_avg_term"))).alias("annualized_return"),
                    F.when(many, F.col("_vol")).alias("return_volatility"),
                    F.when(many, F.col("_mret") / (F.col("_vol") + 1e-8)).alias("sharpe_ratio"),
                    F.when(many, F.col("_worst")).alias("maximum_drawdown"))


def payments_roi(sel_out: DataFrame, group_col: str = "data_quarter", recovery: float = 0.30) -> DataFrame:
    """(payments - principal) / principal; a repaid loan pays principal
    plus rate * term / 12, a defaulted one returns ``recovery`` of principal."""
    inv = F.col("investment_amount").cast("double")
    pay = F.when(F.col("outcome") == 0, inv * (1 + F.col("interest_rate") * F.col("term") / 12.0)).otherwise(inv * recovery)
    return sel_out.groupBy(group_col).agg(((F.sum(pay) - F.sum(inv)) / F.sum(inv)).alias("portfolio_roi"))


def max_drawdown(sel_out: DataFrame, order_col: str = "issue_d", group_col: str = "data_quarter",
                 recovery: float = 0.30) -> DataFrame:
    """Largest (peak - value) / peak of the value path 1 + cumulative
    money return / invested total, loans in ``order_col`` order (id breaks
    ties).  Windows run per quarter over the selected loans only."""
    inv = F.col("investment_amount").cast("double")
    w = Window.partitionBy(group_col).orderBy(order_col, "loan_id").rowsBetween(Window.unboundedPreceding, 0)
    tot = F.sum(inv).over(Window.partitionBy(group_col))
    v = sel_out.withColumn("_v", 1 + F.sum(inv * loan_return(recovery)).over(w) / tot)
    v = v.withColumn("_peak", F.greatest(F.max("_v").over(w), F.lit(1.0)))
    return v.groupBy(group_col).agg(F.max((F.col("_peak") - F.col("_v")) / F.col("_peak")).alias("max_drawdown"))


def market_benchmark(loans: DataFrame, group_col: str = "data_quarter", label: str = "label",
                     rate_col: str | None = "int_rate", recovery: float = 0.30) -> DataFrame:
    """All loans of the quarter: default rate, ROI proxy
    (1 - d) * mean rate - d * (1 - recovery) (.05 without a rate column)."""
    d = F.avg(F.col(label).cast("double"))
    aggs = [d.alias("market_default_rate"), F.count(F.lit(1)).alias("data_points")]
    if rate_col:
        aggs.append(F.avg(rate_col).alias("_r"))
    a = loans.groupBy(group_col).agg(*aggs)
    roi = ((1 - F.col("market_default_rate")) * F.col("_r") - F.col("market_default_rate") * (1 - recovery)
           if rate_col else F.lit(0.05))
    return a.select(group_col, "market_default_rate", roi.alias("market_roi_proxy"), "data_points")


def draw_key(id_col: str = "id", draw_col: str = "draw"):
    """Integer hash order of a loan in one draw (all products fit BIGINT)."""
    i = F.pmod(F.col(id_col), F.lit(P31))
    d1 = F.col(draw_col) + 1
    h = F.pmod(i * 1103515245 + d1 * 322239948, F.lit(P31))
    return F.pmod(F.pmod(h * h, F.lit(P31)) + F.pmod(d1 * 48271, F.lit(P31)) * i, F.lit(P31))


def random_benchmark(loans: DataFrame, sizes: DataFrame, draws: int = 100, group_col: str = "data_quarter",
                     label: str = "label", rate_col: str = "int_rate", recovery: float = 0.30,
                     slack_sigmas: float = 10.0) -> DataFrame:
    """``draws`` samples without replacement of the selected count per
    quarter (``sizes``: group_col, n); mean and population std of the
    default rate and ROI proxy across draws.

    Keys are ~uniform on [0, P): a draw keeps only keys below a cut that
    expects n + slack rows; the survivors (bounded by draws x (n + slack),
    independent of the table size) are written once to the checkpoint
    folder, checked, and ranked.  A draw with fewer than n survivors widens
    the cut and runs again, so the result is always the exact n smallest.
    """
    from ..session import ensure_checkpoint_dir, materialize
    spark = loans.sparkSession
    ensure_checkpoint_dir(spark)
    counts = loans.groupBy(group_col).agg(F.count(F.lit(1)).alias("_total"))
    sz = materialize(sizes.join(counts, group_col).withColumn("_take", F.least(F.col("n"), F.col("_total"))), "draw-sizes")
    widen = 1.0
    while True:
        expect = F.col("_take") * widen + slack_sigmas * F.sqrt(F.col("_take")) * widen + 32
        cut = F.least(F.lit(float(P31)), expect / F.col("_total") * P31)
        # each loan gets its key in every draw (a generator, no join), and
        # only keys under the cut leave the task
        keyed = materialize(loans.select("id", group_col, label, rate_col)
                            .join(F.broadcast(sz.select(group_col, "_take", "_total")), group_col)
                            .withColumn("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(draws - 1).cast("long"))))
                            .withColumn("_k", draw_key())
                            .where(F.col("_k") < cut), "draws")
        have = keyed.groupBy(group_col, "draw").agg(F.count(F.lit(1)).alias("c"), F.first("_take").alias("_take"))
        bad = (have.where(F.col("c") < F.col("_take")).count() > 0
               or have.groupBy(group_col).count().where(F.col("count") < draws).count() > 0)
        if not bad:
            break
        if widen > 1e6:     # the cut has long let every row through
            raise RuntimeError("a draw has fewer loans than it needs")
        widen *= 4
    w = Window.partitionBy(group_col, "draw").orderBy("_k", "id")
    picked = keyed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.col("_take"))
    per = picked.groupBy(group_col, "draw").agg(F.avg(F.col(label).cast("double")).alias("dr"),
                                                F.avg(rate_col).alias("r"))
    per = per.withColumn("roi", (1 - F.col("dr")) * F.col("r") - F.col("dr") * (1 - recovery))
    return per.groupBy(group_col).agg(F.avg("dr").alias("mean_default_rate"), F.stddev_pop("dr").alias("std_default_rate"),
                                      F.avg("roi").alias("mean_roi_proxy"), F.stddev_pop("roi").alias("std_roi_proxy"),
                                      F.count(F.lit(1)).alias("simulations_run"))


def result_row(real: DataFrame, market: DataFrame, budget: float = 5000.0, group_col: str = "data_quarter") -> DataFrame:
    """B7 (+P17): quarter result with utilisation, average loan, risk
    reduction (market - selected default rate) and ROI percent."""
    j = real.join(market, group_col)
    return j.select(F.col(group_col).alias("quarter"), F.lit(float(budget)).alias("total_budget"),
                    F.col("total_investment").alias("budget_utilized"), "loans_selected",
                    F.col("default_rate").alias("selected_default_rate"),
                    F.col("market_default_rate").alias("overall_default_rate"),
                    (F.col("market_default_rate") - F.col("default_rate")).alias("risk_reduction"),
                    F.col("net_return").alias("total_return"), (F.col("roi_proxy") * 100).alias("roi_percentage"),
                    (F.col("total_investment") / budget).alias("budget_utilization_rate"),
                    F.when(F.col("loans_selected") > 0, F.col("total_investment") / F.col("loans_selected"))
                    .otherwise(0.0).alias("average_loan_amount"))


def compare(real: DataFrame, market: DataFrame, rnd: DataFrame, group_col: str = "data_quarter") -> DataFrame:
    """Portfolio minus benchmarks."""
    j = real.join(market, group_col).join(rnd, group_col)
    return j.select(group_col,
                    (F.col("default_rate") - F.col("market_default_rate")).alias("default_rate_vs_market"),
                    (F.col("default_rate") - F.col("mean_default_rate")).alias("default_rate_vs_random"),
                    (F.col("roi_proxy") - F.col("market_roi_proxy")).alias("roi_vs_market"),
                    (F.col("roi_proxy") - F.col("mean_roi_proxy")).alias("roi_vs_random"))


def business_gates(real: DataFrame, market: DataFrame, group_col: str = "data_quarter", min_roi_gain: float = 0.02,
                   max_risk: float = 0.15, min_loans: int = 100) -> DataFrame:
    """ROI gain over the market >= .02, default rate <= .15, >= 100 loans."""
    j = real.join(market, group_col)
    gain = F.col("roi_proxy") - F.col("market_roi_proxy")
    return j.select(group_col, gain.alias("roi_gain"), (gain >= min_roi_gain).alias("roi_gain_ok"),
                    (F.col("default_rate") <= max_risk).alias("portfolio_risk_ok"),
                    (F.col("loans_selected") >= min_loans).alias("loan_count_ok"))
