"""Metrics of a scored table with a 0/1 ``label`` and a probability ``p``
(V1-V11, D4, D5, D9, D16, D17).

Every metric is a grouped aggregate (optionally per ``by`` columns, e.g.
quarter).  Bins use literal edges (the same floating values the source's
``linspace`` produces) so that a score sitting on an edge lands in the
same bin in every engine.  The exact ROC-AUC needs negatives ranked below
each score: scores are grouped first (ties collapse), then a running sum
runs per group, or — for one global curve — range-bucketed (K1) so no
single task holds all scores.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import EVAL_THRESHOLDS
from ..session import materialize
from .prefix import running_sum
from .quantiles import ACCURACY, exact_quantiles
from .rows import combine_rows, scalars

UNIFORM_EDGES = [float(x) for x in np.linspace(0, 1, 11)]


def _by(by):
    return list(by or [])


def _lit_array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _count_le(edges_col: Column, x: Column, strict: bool = False) -> Column:
    """Number of edges <= x (or < x when strict)."""
    return F.size(F.filter(edges_col, (lambda e: e < x) if strict else (lambda e: e <= x)))


# ------------------------------------------------------------------ V1 / D4
def roc_auc(df: DataFrame, label: str = "label", p: str = "p", by=None, buckets: int | None = None) -> DataFrame:
    """V1: ROC-AUC with ties counted half (Mann-Whitney)."""
    by = _by(by)
    g = df.groupBy(*by, p).agg(F.sum(F.col(label)).cast("long").alias("_pos"),
                               (F.count(F.lit(1)) - F.sum(F.col(label))).cast("long").alias("_neg"))
    cum = running_sum(g, ["_neg"], [p], by or None, buckets=buckets, skew_safe=True)
    below = F.col("_neg_cum") - F.col("_neg")
    part = cum.groupBy(*by).agg(
        F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0)).alias("_num"),
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"))
    return part.select(*by, F.try_divide(F.col("_num"), F.col("positives") * F.col("negatives")).alias("roc_auc"),
                       "positives", "negatives")


def auc_interval(auc: DataFrame, z: float = 1.96) -> DataFrame:
    """Hanley-McNeil standard error and a 95 % interval."""
    a, P, N = F.col("roc_auc"), F.col("positives"), F.col("negatives")
    q1 = a / (2 - a)
    q2 = 2 * a * a / (1 + a)
    se = F.sqrt(F.try_divide(a * (1 - a) + (P - 1) * (q1 - a * a) + (N - 1) * (q2 - a * a), P * N))
    return auc.withColumn("auc_se", se).withColumn("auc_lower", a - z * se).withColumn("auc_upper", a + z * se)


# ------------------------------------------------------------------ V2 - V5
def score_summary(df: DataFrame, label: str = "label", p: str = "p", by=None, eps: float = 1e-15) -> DataFrame:
    """V2 Brier, V3 log loss (clipped), V5 distribution and actual rate."""
    y, x = F.col(label).cast("double"), F.col(p).cast("double")
    pc = F.least(F.greatest(x, F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*_by(by)).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((x - y) ** 2).alias("brier_score"),
        (-F.avg(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("log_loss"),
        F.avg(x).alias("prediction_mean"), F.stddev_pop(x).alias("prediction_std"),
        F.min(x).alias("prediction_min"), F.max(x).alias("prediction_max"),
        F.avg(y).alias("actual_default_rate"))


def classification_counts(df: DataFrame, label: str = "label", p: str = "p", threshold: float = 0.5,
                          by=None) -> DataFrame:
    """V4: confusion counts of ``p > threshold`` and accuracy / precision /
    recall / F1 (0 where undefined)."""
    pred = F.col(p) > threshold
    y = F.col(label) == 1
    c = df.groupBy(*_by(by)).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return c.select(*_by(by), "tp", "fp", "fn", "tn", ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"))


# ------------------------------------------------------------------ V6 / D16
def threshold_table(df: DataFrame, label: str = "label", p: str = "p", thresholds=None, by=None) -> DataFrame:
    """V6: at each threshold (``p >= t``): precision, recall, F1 and the
    selected share; thresholds selecting nothing are left out.  One pass:
    conditional counts per threshold, unpivoted."""
    ts = list(thresholds or EVAL_THRESHOLDS)
    y = F.col(label) == 1
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(y).alias("_p")]
    for i, t in enumerate(ts):
        aggs += [F.count_if(F.col(p) >= t).alias(f"pp{i}"), F.count_if((F.col(p) >= t) & y).alias(f"tp{i}")]
    row = df.groupBy(*_by(by)).agg(*aggs)
    structs = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"pp{i}").alias("pp"), F.col(f"tp{i}").alias("tp"))
               for i, t in enumerate(ts)]
    long = row.select(*_by(by), "_n", "_p", F.explode(F.array(*structs)).alias("r")).select(*_by(by), "_n", "_p", "r.*")
    prec = F.col("tp") / F.col("pp")
    rec = F.try_divide(F.col("tp"), F.col("_p"))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return long.where(F.col("pp") > 0).select(*_by(by), "threshold", prec.alias("precision"), rec.alias("recall"),
                                              f1.alias("f1_score"), (F.col("pp") / F.col("_n")).alias("selected_fraction"))


def best_threshold(df: DataFrame, label: str = "label", p: str = "p", steps: int = 100) -> DataFrame:
    """Confusion matrix at the F1-best threshold of the grid 1/steps ..
    (steps-1)/steps.  Scores are grouped by grid cell (edges compared as
    literals), then suffix sums give counts at every threshold."""
    grid = [j / steps for j in range(1, steps)]
    cell = _count_le(_lit_array(grid), F.col(p))
    g = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).cast("long").alias("pos"))
    tot = g.agg(F.sum("n").alias("N"), F.sum("pos").alias("P"))
    # threshold j selects cells >= j: each cell (at most `steps` rows) counts
    # toward thresholds 1..cell
    th = df.sparkSession.range(1, steps).withColumnRenamed("id", "j")
    sel = (g.where(F.col("cell") >= 1).select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("cell").cast("long"))).alias("j"),
                                              "n", "pos")
           .groupBy("j").agg(F.sum("n").alias("pp"), F.sum("pos").alias("tp")))
    m = th.join(sel, "j", "left").na.fill(0, ["pp", "tp"]).withColumn("_one", F.lit(1)).join(
        tot.withColumn("_one", F.lit(1)), "_one").drop("_one")
    tp, pp, P, N = F.col("tp"), F.col("pp"), F.col("P"), F.col("N")
    prec = F.coalesce(F.try_divide(tp, pp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, P), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    m = m.select((F.col("j") / float(steps)).alias("threshold"), tp.alias("tp"), (pp - tp).alias("fp"),
                 (P - tp).alias("fn"), (N - P - pp + tp).alias("tn"), f1.alias("f1"))
    best = m.agg(F.max_by(F.struct(*m.columns), F.struct(F.col("f1"), (-F.col("threshold")).alias("t"))).alias("b"))
    return best.select("b.*")


# ------------------------------------------------------------------ V7 / V8 / D5 / D17
def uniform_bin(p: Column) -> Column:
    """Index 0..9 = number of inner edges strictly below p (p = 0 -> 0)."""
    return _count_le(_lit_array(UNIFORM_EDGES[1:-1]), p, strict=True)


def expected_calibration_error(df: DataFrame, label: str = "label", p: str = "p", by=None) -> DataFrame:
    """V7: bins (lo, hi] over ten uniform edges; p = 0 is in no bin."""
    by = _by(by)
    x = F.col(p)
    in_any = x > UNIFORM_EDGES[0]
    b = df.where(in_any).groupBy(*by, uniform_bin(x).alias("bin")).agg(
        F.count(F.lit(1)).alias("_cnt"), F.avg(F.col(label).cast("double")).alias("acc"), F.avg(x).alias("conf"))
    tot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    j = b.join(tot, by) if by else b.withColumn("_one", F.lit(1)).join(tot.withColumn("_one", F.lit(1)), "_one")
    return j.groupBy(*by).agg(F.sum(F.abs(F.col("conf") - F.col("acc")) * F.col("_cnt") / F.col("_total"))
                              .alias("expected_calibration_error"))


def reliability_curve(df: DataFrame, label: str = "label", p: str = "p", by=None) -> DataFrame:
    """V8: per non-empty uniform bin: fraction of positives, mean score, count."""
    return df.groupBy(*_by(by), uniform_bin(F.col(p)).alias("bin")).agg(
        F.avg(F.col(label).cast("double")).alias("fraction_positives"), F.avg(F.col(p)).alias("mean_predicted"),
        F.count(F.lit(1)).alias("count"))


def brier_decomposition(df: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Reliability, resolution, uncertainty over the V8 bins."""
    curve = reliability_curve(df, label, p)
    base = df.agg(F.avg(F.col(label).cast("double")).alias("o"), F.count(F.lit(1)).alias("N"))
    j = curve.withColumn("_one", F.lit(1)).join(base.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return j.groupBy("o", "N").agg(
        (F.sum(F.col("count") * (F.col("mean_predicted") - F.col("fraction_positives")) ** 2) / F.first("N")).alias("reliability"),
        (F.sum(F.col("count") * (F.col("fraction_positives") - F.col("o")) ** 2) / F.first("N")).alias("resolution"),
    ).select("reliability", "resolution", (F.col("o") * (1 - F.col("o"))).alias("uncertainty"))


def score_histogram(df: DataFrame, label: str = "label", p: str = "p", bins: int = 20) -> DataFrame:
    """Score distribution per true class, ``bins`` uniform bins [lo, hi)
    (1 at the top lands in the last bin)."""
    edges = [float(x) for x in np.linspace(0, 1, bins + 1)][1:-1]
    b = 1 + _count_le(_lit_array(edges), F.col(p))
    return df.groupBy(F.col(label).alias("label"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ V10
def chi2_sf_even(x: Column, df: int) -> Column:
    """Upper tail of chi-square with even degrees of freedom, closed form:
    exp(-x/2) * sum_{k < df/2} (x/2)^k / k!."""
    h = x / 2
    terms = [F.pow(h, F.lit(k)) / math.factorial(k) for k in range(df // 2)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.exp(-h) * total


def hosmer_lemeshow(df: DataFrame, label: str = "label", p: str = "p", bins: int = 10,
                    approx: bool = False) -> DataFrame:
    """11 quantile edges of p; bin = number of edges <= p; bins 1..10
    kept (the maximum itself falls past the last edge and is left out, as
    in the source); chi-square with bins-2 df; well calibrated if p > .05."""
    probs = [float(x) for x in np.linspace(0, 1, bins + 1)]
    df = materialize(df.select(label, p), "hosmer-input")
    if approx:
        edges = scalars(df.agg(F.percentile_approx(F.col(p), probs, 100 * ACCURACY).alias("_edges")))["_edges"] or []
    else:
        edges = [e for e in exact_quantiles(df, [p], probs, stored=True)[p] if e is not None]
    b = df.withColumn("_bin", _count_le(_lit_array(edges), F.col(p)))
    g = b.where((F.col("_bin") >= 1) & (F.col("_bin") <= bins)).groupBy("_bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("o1"), F.sum(F.col(p)).alias("e1"))
    e0 = F.col("n") - F.col("e1")
    o0 = F.col("n") - F.col("o1")
    term = (F.when(F.col("e1") > 0, (F.col("o1") - F.col("e1")) ** 2 / F.col("e1")).otherwise(0.0)
            + F.when(e0 > 0, (o0 - e0) ** 2 / e0).otherwise(0.0))
    stat = g.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("hosmer_lemeshow_statistic"))
    pv = chi2_sf_even(F.col("hosmer_lemeshow_statistic"), bins - 2)
    return stat.select("hosmer_lemeshow_statistic", pv.alias("hosmer_lemeshow_pvalue"),
                       (pv > 0.05).alias("well_calibrated"))


# ------------------------------------------------------------------ D9
def precision_at_k(df: DataFrame, k: int, label: str = "label", p: str = "p", id_col: str = "id") -> DataFrame:
    """Share of positives among the k highest scores (id breaks ties).
    The top-k is a TakeOrdered (per-partition top k, then merge)."""
    top = df.orderBy(F.col(p).desc(), F.col(id_col).asc()).limit(k)
    return top.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n"),
                   F.avg(F.col(label).cast("double")).alias("precision_at_k"))


# ------------------------------------------------------------------ V11
def summary_row(auc: DataFrame, summ: DataFrame, ece: DataFrame, hl: DataFrame, realised: DataFrame) -> DataFrame:
    """One row from the metric tables and the realised backtest."""
    r = realised.agg(F.avg("default_rate").alias("portfolio_default_rate"),
                     F.avg("roi_proxy").alias("portfolio_roi"), F.avg("sharpe_ratio").alias("sharpe_ratio"),
                     F.sum("total_investment").alias("total_investment"), F.sum("loans_selected").alias("loans_selected"))
    return combine_rows(auc.select(F.col("roc_auc").alias("model_auc")),
                        summ.select(F.col("brier_score").alias("model_brier_score")),
                        ece.select(F.col("expected_calibration_error").alias("calibration_error")),
                        r, hl.select("well_calibrated"))


# ------------------------------------------------------------------ D12
def stability_index(df: DataFrame, cols: list[str], base_filter: Column, group_col: str = "data_quarter",
                    bins: int = 10, eps: float = 1e-6, approx: bool = False) -> DataFrame:
    """Population stability index of each column per group against the
    base rows: decile edges of the base (exact), share per bin (missing values
    have a bin of their own), and sum((a - e) * ln(a / e)) over the bins the
    base has, with shares floored at ``eps``.  One grouped count over the rows;
    the rest works on that small table."""
    probs = [float(x) for x in np.linspace(0, 1, bins + 1)][1:-1]
    df = materialize(df.select(group_col, base_filter.alias("_base"), *[F.col(c).cast("double").alias(c) for c in cols]), "stability-input")
    base_rows = df.where("_base")
    if approx:
        edges = scalars(base_rows.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 100 * ACCURACY).alias(c) for c in cols]))
    else:
        edges = exact_quantiles(base_rows, cols, probs, stored=True)
    edges = {c: [e for e in edges[c] or [] if e is not None] for c in cols}
    structs = [F.struct(F.lit(c).alias("feature"),
                        F.when(F.col(c).isNull(), F.lit(-1)).otherwise(
                            _count_le(_lit_array(edges[c]), F.col(c).cast("double"), strict=True)).alias("bin"))
               for c in cols]
    counts = (df.select(group_col, "_base", F.explode(F.array(*structs)).alias("r"))
              .groupBy(group_col, "_base", "r.feature", "r.bin").agg(F.count(F.lit(1)).alias("n")))
    counts = materialize(counts, "stability")
    per_group = counts.groupBy(group_col, "feature", "bin").agg(F.sum("n").alias("_gn"))
    grp_tot = counts.groupBy(group_col, "feature").agg(F.sum("n").alias("_gtot"))
    base = counts.where("_base").groupBy("feature", "bin").agg(F.sum("n").alias("_bn"))
    base_tot = counts.where("_base").groupBy("feature").agg(F.sum("n").alias("_btot"))
    grid = (grp_tot.join(base.join(base_tot, "feature"), "feature")
            .join(per_group, [group_col, "feature", "bin"], "left").na.fill(0, ["_gn"]))
    a = F.greatest(F.col("_gn") / F.col("_gtot"), F.lit(eps))
    e = F.greatest(F.col("_bn") / F.col("_btot"), F.lit(eps))
    return grid.groupBy(group_col, "feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
