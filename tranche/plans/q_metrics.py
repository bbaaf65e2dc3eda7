"""Queries: scored-table metrics (V*, D4, D5, D9, D12, D16, D17, A14) and
the backtest (B*, D2, D13, D18, V11).

The scored table is the labelled loan view with its deterministic score
``pd`` as ``p``, so every metric has an exact SQL oracle without a model.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.fixed import EVAL_THRESHOLDS
from ..operators import backtest as bt
from ..operators import metrics as mt
from .inputs import labelled_loans
from .q_portfolio import CAND_SQL, _ranked, lowest_risk_selection
from ..session import materialize
from .registry import register, rounded
from .views import LABELLED_SQL, LOANS_SQL, OUTCOMES_SQL, with_views

VIEWS = (LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL,
         "scored AS (SELECT id, data_quarter, split, label, pd AS p, int_rate, loan_amnt, annual_inc, dti FROM labelled)")


def _edges_sql(values) -> str:
    return "[" + ", ".join(repr(float(v)) + "::DOUBLE" for v in values) + "]"


def scored(spark, sf):
    return labelled_loans(spark, sf).withColumnRenamed("pd", "p")


_AUC_CTE = """auc_g AS (
 SELECT {by}p, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg,
  SUM(COUNT(*) - SUM(label)) OVER ({part}ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum
 FROM scored GROUP BY {by}p)"""


@register("roc_auc", with_views("""
SELECT round(SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)), 6) AS roc_auc,
 CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives FROM auc_g""",
                                 *VIEWS, _AUC_CTE.format(by="", part="")))
def q_roc_auc(spark, sf):
    """V1: exact ROC-AUC over all loans (range-bucketed running sum)."""
    return rounded(mt.roc_auc(scored(spark, sf)))


@register("roc_auc_by_quarter", with_views("""
SELECT data_quarter, round(SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)), 6) AS roc_auc,
 CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives FROM auc_g GROUP BY data_quarter""",
                                            *VIEWS, _AUC_CTE.format(by="data_quarter, ", part="PARTITION BY data_quarter ")))
def q_roc_auc_by_quarter(spark, sf):
    """V1 per quarter (range-bucketed running sums inside each quarter)."""
    return rounded(mt.roc_auc(scored(spark, sf), by=["data_quarter"]))


@register("auc_interval", with_views("""
SELECT round(a, 6) AS roc_auc, P AS positives, N AS negatives, round(se, 6) AS auc_se,
 round(a - 1.96 * se, 6) AS auc_lower, round(a + 1.96 * se, 6) AS auc_upper FROM (
 SELECT *, sqrt((a * (1 - a) + (P - 1) * (a / (2 - a) - a * a) + (N - 1) * (2 * a * a / (1 + a) - a * a)) / (P * N)) AS se FROM (
  SELECT SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)) AS a,
   CAST(SUM(pos) AS BIGINT) AS P, CAST(SUM(neg) AS BIGINT) AS N FROM auc_g))""", *VIEWS, _AUC_CTE.format(by="", part="")))
def q_auc_interval(spark, sf):
    """Hanley-McNeil interval of the AUC."""
    return rounded(mt.auc_interval(mt.roc_auc(scored(spark, sf))))


_SUMMARY_SQL = """SELECT COUNT(*) AS n, AVG((p - label) * (p - label)) AS brier_score,
 -AVG(label * ln(LEAST(GREATEST(p, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - LEAST(GREATEST(p, 1e-15), 1 - 1e-15))) AS log_loss,
 AVG(p) AS prediction_mean, STDDEV_POP(p) AS prediction_std, MIN(p) AS prediction_min, MAX(p) AS prediction_max,
 AVG(label) AS actual_default_rate FROM scored"""


@register("brier", with_views(f"SELECT round(brier_score, 6) AS brier_score FROM ({_SUMMARY_SQL})", *VIEWS))
def q_brier(spark, sf):
    """V2: Brier score."""
    return rounded(mt.score_summary(scored(spark, sf)).select("brier_score"))


@register("log_loss", with_views(f"SELECT round(log_loss, 6) AS log_loss FROM ({_SUMMARY_SQL})", *VIEWS))
def q_log_loss(spark, sf):
    """V3: log loss with probabilities clipped to [1e-15, 1 - 1e-15]."""
    return rounded(mt.score_summary(scored(spark, sf)).select("log_loss"))


@register("score_distribution", with_views(f"""
SELECT n, round(prediction_mean, 6) AS prediction_mean, round(prediction_std, 6) AS prediction_std,
 round(prediction_min, 6) AS prediction_min, round(prediction_max, 6) AS prediction_max,
 round(actual_default_rate, 6) AS actual_default_rate FROM ({_SUMMARY_SQL})""", *VIEWS))
def q_score_distribution(spark, sf):
    """V5: score mean / population std / range and the actual rate."""
    return rounded(mt.score_summary(scored(spark, sf)).drop("brier_score", "log_loss"))


@register("classification_counts", with_views("""
SELECT tp, fp, fn, tn, round((tp + tn) * 1.0e0 / (tp + fp + fn + tn), 6) AS accuracy, round(prec, 6) AS precision,
 round(rec, 6) AS recall, round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END, 6) AS f1 FROM (
 SELECT *, CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) ELSE 0 END AS prec,
  CASE WHEN tp + fn > 0 THEN tp * 1.0e0 / (tp + fn) ELSE 0 END AS rec FROM (
  SELECT COUNT(*) FILTER (WHERE p > 0.5 AND label = 1) AS tp, COUNT(*) FILTER (WHERE p > 0.5 AND label = 0) AS fp,
   COUNT(*) FILTER (WHERE NOT p > 0.5 AND label = 1) AS fn, COUNT(*) FILTER (WHERE NOT p > 0.5 AND label = 0) AS tn
  FROM scored))""", *VIEWS))
def q_classification_counts(spark, sf):
    """V4: accuracy, precision, recall, F1 of p > 0.5."""
    return rounded(mt.classification_counts(scored(spark, sf)))


@register("threshold_table", with_views(f"""
SELECT t AS threshold, round(tp * 1.0e0 / pp, 6) AS precision, round(tp * 1.0e0 / P, 6) AS recall,
 round(CASE WHEN tp > 0 THEN 2 * (tp * 1.0e0 / pp) * (tp * 1.0e0 / P) / (tp * 1.0e0 / pp + tp * 1.0e0 / P) ELSE 0 END, 6) AS f1_score,
 round(pp * 1.0e0 / n, 6) AS selected_fraction FROM (
 SELECT t, COUNT(*) FILTER (WHERE p >= t) AS pp, COUNT(*) FILTER (WHERE p >= t AND label = 1) AS tp,
  (SELECT COUNT(*) FROM scored WHERE label = 1) AS P, (SELECT COUNT(*) FROM scored) AS n
 FROM scored, (SELECT UNNEST({_edges_sql(EVAL_THRESHOLDS)}) AS t) GROUP BY t) WHERE pp > 0""", *VIEWS))
def q_threshold_table(spark, sf):
    """V6: precision / recall / F1 / share selected at .10 .. .30."""
    return rounded(mt.threshold_table(scored(spark, sf)))


_UBIN = f"len(list_filter({_edges_sql(mt.UNIFORM_EDGES[1:-1])}, lambda e: e < p))"


@register("ece", with_views(f"""
SELECT round(SUM(abs(conf - acc) * cnt / tot), 6) AS expected_calibration_error FROM (
 SELECT {_UBIN} AS bin, COUNT(*) AS cnt, AVG(label) AS acc, AVG(p) AS conf FROM scored WHERE p > 0 GROUP BY 1),
 (SELECT COUNT(*) AS tot FROM scored)""", *VIEWS))
def q_ece(spark, sf):
    """V7: expected calibration error, ten (lo, hi] bins."""
    return rounded(mt.expected_calibration_error(scored(spark, sf)))


@register("reliability_curve", with_views(f"""
SELECT {_UBIN} AS bin, round(AVG(label), 6) AS fraction_positives, round(AVG(p), 6) AS mean_predicted,
 COUNT(*) AS count FROM scored GROUP BY 1""", *VIEWS))
def q_reliability_curve(spark, sf):
    """V8: reliability curve over ten uniform bins (empty bins absent)."""
    return rounded(mt.reliability_curve(scored(spark, sf)))


@register("brier_decomposition", with_views(f"""
SELECT round(SUM(cnt * (mp - fp) * (mp - fp)) / MAX(N), 6) AS reliability,
 round(SUM(cnt * (fp - o) * (fp - o)) / MAX(N), 6) AS resolution, round(MAX(o) * (1 - MAX(o)), 6) AS uncertainty FROM (
 SELECT {_UBIN} AS bin, AVG(label) AS fp, AVG(p) AS mp, COUNT(*) AS cnt FROM scored GROUP BY 1),
 (SELECT AVG(label) AS o, COUNT(*) AS N FROM scored)""", *VIEWS))
def q_brier_decomposition(spark, sf):
    """Brier reliability / resolution / uncertainty."""
    return rounded(mt.brier_decomposition(scored(spark, sf)))


_HL_PROBS = [float(x) for x in np.linspace(0, 1, 11)]


_HL_CTE = f"""
hl AS (SELECT stat, exp(-stat / 2) * (1 + stat / 2 + pow(stat / 2, 2) / 2 + pow(stat / 2, 3) / 6) AS pv FROM (
 SELECT COALESCE(SUM(CASE WHEN e1 > 0 THEN (o1 - e1) * (o1 - e1) / e1 ELSE 0 END
  + CASE WHEN n - e1 > 0 THEN ((n - o1) - (n - e1)) * ((n - o1) - (n - e1)) / (n - e1) ELSE 0 END), 0) AS stat FROM (
  SELECT bin, COUNT(*) AS n, SUM(label) AS o1, SUM(p) AS e1 FROM (
   SELECT *, len(list_filter(edges, lambda e: e <= p)) AS bin FROM scored,
    (SELECT quantile_cont(p, {_edges_sql(_HL_PROBS)}) AS edges FROM scored))
  WHERE bin BETWEEN 1 AND 10 GROUP BY bin)))"""


@register("hosmer_lemeshow", with_views("""
SELECT round(stat, 6) AS hosmer_lemeshow_statistic, round(pv, 6) AS hosmer_lemeshow_pvalue, pv > 0.05 AS well_calibrated
FROM hl""", *VIEWS, _HL_CTE))
def q_hosmer_lemeshow(spark, sf):
    """Hosmer-Lemeshow statistic, closed-form p-value (8 df)."""
    return rounded(mt.hosmer_lemeshow(scored(spark, sf)))


_GRID = [j / 100 for j in range(1, 100)]


@register("best_threshold", with_views(f"""
SELECT threshold, tp, fp, fn, tn, round(f1, 6) AS f1 FROM (
 SELECT j / 100.0e0 AS threshold, tp, pp - tp AS fp, P - tp AS fn, N - P - pp + tp AS tn,
  CASE WHEN tp > 0 THEN 2 * (tp * 1.0e0 / pp) * (tp * 1.0e0 / P) / (tp * 1.0e0 / pp + tp * 1.0e0 / P) ELSE 0 END AS f1 FROM (
  SELECT j, COUNT(*) FILTER (WHERE cell >= j) AS pp, COUNT(*) FILTER (WHERE cell >= j AND label = 1) AS tp,
   MAX(P) AS P, MAX(N) AS N FROM range(1, 100) r(j),
   (SELECT label, len(list_filter({_edges_sql(_GRID)}, lambda e: e <= p)) AS cell,
     SUM(label) OVER () AS P, COUNT(*) OVER () AS N FROM scored) GROUP BY j))
ORDER BY f1 DESC, threshold ASC LIMIT 1""", *VIEWS))
def q_best_threshold(spark, sf):
    """Confusion matrix at the F1-best threshold of a 0.01 grid."""
    return rounded(mt.best_threshold(scored(spark, sf)))


_H20 = [float(x) for x in np.linspace(0, 1, 21)][1:-1]


@register("score_histogram", with_views(f"""
SELECT label, 1 + len(list_filter({_edges_sql(_H20)}, lambda e: e <= p)) AS bin, COUNT(*) AS n FROM scored GROUP BY 1, 2""",
                                         *VIEWS))
def q_score_histogram(spark, sf):
    """Score distribution per true class, 20 bins."""
    return mt.score_histogram(scored(spark, sf))


@register("precision_at_k", with_views("""
SELECT 100 AS k, COUNT(*) AS n, round(AVG(label), 6) AS precision_at_k FROM (
 SELECT label FROM scored ORDER BY p DESC, id ASC LIMIT 100)""", *VIEWS))
def q_precision_at_k(spark, sf):
    """Positives among the 100 highest scores."""
    return rounded(mt.precision_at_k(scored(spark, sf), 100))


PSI_COLS = ["loan_amnt", "int_rate", "annual_inc", "dti"]
_DEC = [float(x) for x in np.linspace(0, 1, 11)][1:-1]


def _psi_sql() -> str:
    parts = []
    for c in PSI_COLS:
        parts.append(f"""SELECT '{c}' AS feature, data_quarter, split = 'train' AS base,
 CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter(e, lambda x: x < CAST({c} AS DOUBLE))) END AS bin FROM scored,
 (SELECT quantile_cont(CAST({c} AS DOUBLE), {_edges_sql(_DEC)}) AS e FROM scored WHERE split = 'train')""")
    body = " UNION ALL ".join(parts)
    return with_views(f"""
SELECT g.data_quarter, g.feature, round(SUM((GREATEST(COALESCE(pg.n, 0) * 1.0e0 / g.N, 1e-6) - GREATEST(b.bn * 1.0e0 / bt.BN, 1e-6))
  * ln(GREATEST(COALESCE(pg.n, 0) * 1.0e0 / g.N, 1e-6) / GREATEST(b.bn * 1.0e0 / bt.BN, 1e-6))), 6) AS psi
FROM (SELECT data_quarter, feature, COUNT(*) AS N FROM lng GROUP BY 1, 2) g
JOIN (SELECT feature, bin, COUNT(*) AS bn FROM lng WHERE base GROUP BY 1, 2) b ON g.feature = b.feature
JOIN (SELECT feature, COUNT(*) AS BN FROM lng WHERE base GROUP BY 1) bt ON g.feature = bt.feature
LEFT JOIN (SELECT data_quarter, feature, bin, COUNT(*) AS n FROM lng GROUP BY 1, 2, 3) pg
 ON pg.data_quarter = g.data_quarter AND pg.feature = g.feature AND pg.bin = b.bin
GROUP BY g.data_quarter, g.feature""", *VIEWS, f"lng AS ({body})")


@register("stability_index", _psi_sql())
def q_stability_index(spark, sf):
    """Population stability index per feature and quarter vs training."""
    s = scored(spark, sf)
    return rounded(mt.stability_index(s, PSI_COLS, F.col("split") == "train"))


@register("model_gate", with_views(f"""
SELECT rule, round(value, 6) AS value, threshold, passed FROM (
 SELECT 'min_auc' AS rule, a AS value, 0.65e0 AS threshold, a >= 0.65 AS passed FROM (
  SELECT SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)) AS a FROM auc_g)
 UNION ALL SELECT 'warn_auc', a, 0.70e0, a >= 0.70 FROM (
  SELECT SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)) AS a FROM auc_g)
 UNION ALL SELECT 'max_brier', AVG((p - label) * (p - label)), 0.20e0, AVG((p - label) * (p - label)) <= 0.20 FROM scored
 UNION ALL SELECT 'min_calibration_p', pv, 0.05e0, pv >= 0.05 FROM hl)""",
                                   *VIEWS, _AUC_CTE.format(by="", part=""), _HL_CTE))
def q_model_gate(spark, sf):
    """Performance gate rows (AUC >= .65, warn < .70, Brier <= .20,
    calibration p >= .05)."""
    from ..operators.audit import model_gate
    s = materialize(scored(spark, sf), "scored")
    return rounded(model_gate(mt.roc_auc(s), mt.score_summary(s), mt.hosmer_lemeshow(s)))


# ------------------------------------------------------------------ backtest
SEL_VIEWS = (LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL, CAND_SQL, *_ranked("default_probability, loan_id"),
             """so AS (SELECT s.*, CAST(s.investment_amount AS DOUBLE) AS inv, l.label AS outcome, l.issue_d
                 FROM sel s JOIN labelled l ON s.loan_id = l.id)""")

_REALISED = """SELECT data_quarter, SUM(inv) AS total_investment, COUNT(*) AS loans_selected,
 CAST(SUM(outcome) AS BIGINT) AS actual_defaults, SUM(outcome) * 1.0e0 / COUNT(*) AS default_rate,
 SUM(CASE WHEN outcome = 0 THEN inv * interest_rate * term / 12.0e0 ELSE 0 END) AS total_interest_income,
 SUM(CASE WHEN outcome = 1 THEN inv * 0.7e0 ELSE 0 END) AS total_losses,
 SUM(CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END) AS sret,
 STDDEV_POP(CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END) AS vol,
 AVG(CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END) AS mret,
 MIN(CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END) AS worst, AVG(term) AS avg_term
FROM so GROUP BY data_quarter"""
_REALISED_OUT = """data_quarter, round(total_investment, 6) AS total_investment, loans_selected, actual_defaults,
 round(default_rate, 6) AS default_rate, round(total_interest_income, 6) AS total_interest_income,
 round(total_losses, 6) AS total_losses, round(total_interest_income - total_losses, 6) AS net_return,
 round((total_interest_income - total_losses) / total_investment, 6) AS roi_proxy,
 round((total_interest_income - total_losses) / total_investment * (12 / avg_term), 6) AS annualized_return,
 round(CASE WHEN loans_selected > 1 THEN vol END, 6) AS return_volatility,
 round(CASE WHEN loans_selected > 1 THEN mret / (vol + 1e-8) END, 6) AS sharpe_ratio,
 round(CASE WHEN loans_selected > 1 THEN worst END, 6) AS maximum_drawdown"""


def selection_with_outcomes(spark, sf):
    sel = lowest_risk_selection(spark, sf)
    lab = labelled_loans(spark, sf).select("id", "label", "issue_d")
    return bt.attach_outcomes(sel, lab).join(lab.select(F.col("id").alias("loan_id"), "issue_d"), "loan_id")


def _realised(spark, sf):
    return bt.realised(selection_with_outcomes(spark, sf))


@register("backtest_realised", with_views(f"SELECT {_REALISED_OUT} FROM ({_REALISED})", *SEL_VIEWS))
def q_backtest_realised(spark, sf):
    """B1 + B2: realised defaults, income, losses, ROI, volatility, Sharpe per quarter."""
    return rounded(_realised(spark, sf))


@register("backtest_returns", with_views("""
SELECT data_quarter, loan_id, outcome, round(CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END, 6)
 AS loan_return FROM so""", *SEL_VIEWS))
def q_backtest_returns(spark, sf):
    """B2: per-loan realised return of the selected loans."""
    s = selection_with_outcomes(spark, sf)
    return rounded(s.select("data_quarter", "loan_id", "outcome", bt.loan_return().alias("loan_return")))


_MARKET = """SELECT data_quarter, AVG(label) AS market_default_rate, COUNT(*) AS data_points,
 (1 - AVG(label)) * AVG(int_rate) - AVG(label) * 0.7e0 AS market_roi_proxy FROM labelled GROUP BY data_quarter"""


def _market(spark, sf):
    return bt.market_benchmark(labelled_loans(spark, sf))


@register("benchmark_market", with_views(f"""
SELECT data_quarter, round(market_default_rate, 6) AS market_default_rate, round(market_roi_proxy, 6) AS market_roi_proxy,
 data_points FROM ({_MARKET})""", *SEL_VIEWS))
def q_benchmark_market(spark, sf):
    """Quarter-wide default rate and ROI proxy."""
    return rounded(_market(spark, sf))


_KEY = """(((((id % 2147483647) * 1103515245 + (draw + 1) * 322239948) % 2147483647)
  * (((id % 2147483647) * 1103515245 + (draw + 1) * 322239948) % 2147483647)) % 2147483647
  + ((draw + 1) * 48271 % 2147483647) * (id % 2147483647)) % 2147483647"""
_RANDOM = f"""SELECT data_quarter, AVG(dr) AS mean_default_rate, STDDEV_POP(dr) AS std_default_rate,
 AVG(roi) AS mean_roi_proxy, STDDEV_POP(roi) AS std_roi_proxy, COUNT(*) AS simulations_run FROM (
 SELECT data_quarter, draw, AVG(label) AS dr, (1 - AVG(label)) * AVG(int_rate) - AVG(label) * 0.7e0 AS roi FROM (
  SELECT *, row_number() OVER (PARTITION BY data_quarter, draw ORDER BY k, id) AS rn FROM (
   SELECT l.id, l.data_quarter, l.label, l.int_rate, d.draw, {_KEY} AS k, s.n FROM labelled l
   JOIN (SELECT data_quarter, COUNT(*) AS n FROM sel GROUP BY 1) s ON l.data_quarter = s.data_quarter,
   range(100) d(draw))) WHERE rn <= n GROUP BY data_quarter, draw) GROUP BY data_quarter"""


def _random(spark, sf):
    sizes = lowest_risk_selection(spark, sf).groupBy("data_quarter").agg(F.count(F.lit(1)).alias("n"))
    return bt.random_benchmark(labelled_loans(spark, sf), sizes)


@register("benchmark_random", with_views(f"""
SELECT data_quarter, round(mean_default_rate, 6) AS mean_default_rate, round(std_default_rate, 6) AS std_default_rate,
 round(mean_roi_proxy, 6) AS mean_roi_proxy, round(std_roi_proxy, 6) AS std_roi_proxy, simulations_run FROM ({_RANDOM})""",
                                         *SEL_VIEWS))
def q_benchmark_random(spark, sf):
    """100 hash-ordered draws without replacement of the portfolio size."""
    return rounded(_random(spark, sf))


@register("backtest_result_row", with_views(f"""
SELECT r.data_quarter AS quarter, 5000e0 AS total_budget, round(total_investment, 6) AS budget_utilized, loans_selected,
 round(default_rate, 6) AS selected_default_rate, round(market_default_rate, 6) AS overall_default_rate,
 round(market_default_rate - default_rate, 6) AS risk_reduction,
 round(total_interest_income - total_losses, 6) AS total_return,
 round((total_interest_income - total_losses) / total_investment * 100, 6) AS roi_percentage,
 round(total_investment / 5000e0, 6) AS budget_utilization_rate,
 round(total_investment / loans_selected, 6) AS average_loan_amount
FROM ({_REALISED}) r JOIN ({_MARKET}) m ON r.data_quarter = m.data_quarter""", *SEL_VIEWS))
def q_backtest_result_row(spark, sf):
    """B7 + P17: quarter result rows."""
    return rounded(bt.result_row(_realised(spark, sf), _market(spark, sf)))


@register("benchmark_compare", with_views(f"""
SELECT r.data_quarter, round(default_rate - market_default_rate, 6) AS default_rate_vs_market,
 round(default_rate - mean_default_rate, 6) AS default_rate_vs_random,
 round((total_interest_income - total_losses) / total_investment - market_roi_proxy, 6) AS roi_vs_market,
 round((total_interest_income - total_losses) / total_investment - mean_roi_proxy, 6) AS roi_vs_random
FROM ({_REALISED}) r JOIN ({_MARKET}) m ON r.data_quarter = m.data_quarter
JOIN ({_RANDOM}) x ON r.data_quarter = x.data_quarter""", *SEL_VIEWS))
def q_benchmark_compare(spark, sf):
    """Portfolio minus market and random benchmarks."""
    return rounded(bt.compare(_realised(spark, sf), _market(spark, sf), _random(spark, sf)))


@register("business_gates", with_views(f"""
SELECT r.data_quarter, round((total_interest_income - total_losses) / total_investment - market_roi_proxy, 6) AS roi_gain,
 (total_interest_income - total_losses) / total_investment - market_roi_proxy >= 0.02 AS roi_gain_ok,
 default_rate <= 0.15 AS portfolio_risk_ok, loans_selected >= 100 AS loan_count_ok
FROM ({_REALISED}) r JOIN ({_MARKET}) m ON r.data_quarter = m.data_quarter""", *SEL_VIEWS))
def q_business_gates(spark, sf):
    """Business gates per quarter."""
    return rounded(bt.business_gates(_realised(spark, sf), _market(spark, sf)))


@register("portfolio_roi", with_views("""
SELECT data_quarter, round((SUM(CASE WHEN outcome = 0 THEN inv * (1 + interest_rate * term / 12.0e0) ELSE inv * 0.3e0 END)
 - SUM(inv)) / SUM(inv), 6) AS portfolio_roi FROM so GROUP BY data_quarter""", *SEL_VIEWS))
def q_portfolio_roi(spark, sf):
    """Payments-based ROI of the selected loans."""
    return rounded(bt.payments_roi(selection_with_outcomes(spark, sf)))


@register("max_drawdown", with_views("""
SELECT data_quarter, round(MAX((peak - v) / peak), 6) AS max_drawdown FROM (
 SELECT *, GREATEST(MAX(v) OVER (PARTITION BY data_quarter ORDER BY issue_d, loan_id
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0e0) AS peak FROM (
  SELECT *, 1 + SUM(inv * CASE WHEN outcome = 0 THEN interest_rate * term / 12.0e0 ELSE -0.7e0 END)
   OVER (PARTITION BY data_quarter ORDER BY issue_d, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   / SUM(inv) OVER (PARTITION BY data_quarter) AS v FROM so)) GROUP BY data_quarter""", *SEL_VIEWS))
def q_max_drawdown(spark, sf):
    """Maximum drawdown of the portfolio value path by issue date."""
    return rounded(bt.max_drawdown(selection_with_outcomes(spark, sf)))


@register("summary_metrics", with_views(f"""
SELECT round(a, 6) AS model_auc, round(b, 6) AS model_brier_score, round(e, 6) AS calibration_error,
 round(dr, 6) AS portfolio_default_rate, round(roi, 6) AS portfolio_roi, round(sh, 6) AS sharpe_ratio,
 round(ti, 6) AS total_investment, ls AS loans_selected, pv > 0.05 AS well_calibrated FROM hl,
 (SELECT SUM(pos * ((neg_cum - neg) + neg / 2.0e0)) / (SUM(pos) * SUM(neg)) AS a FROM auc_g),
 (SELECT AVG((p - label) * (p - label)) AS b FROM scored),
 (SELECT SUM(abs(conf - acc) * cnt / tot) AS e FROM (
   SELECT {_UBIN} AS bin, COUNT(*) AS cnt, AVG(label) AS acc, AVG(p) AS conf FROM scored WHERE p > 0 GROUP BY 1),
   (SELECT COUNT(*) AS tot FROM scored)),
 (SELECT AVG(default_rate) AS dr, AVG((total_interest_income - total_losses) / total_investment) AS roi,
   AVG(CASE WHEN loans_selected > 1 THEN mret / (vol + 1e-8) END) AS sh, SUM(total_investment) AS ti,
   SUM(loans_selected) AS ls FROM ({_REALISED}))""",
                                       *SEL_VIEWS, VIEWS[-1], _AUC_CTE.format(by="", part=""), _HL_CTE))
def q_summary_metrics(spark, sf):
    """One summary row (AUC, Brier, ECE, realised rate / ROI / Sharpe,
    amount, count, calibration flag)."""
    s = materialize(scored(spark, sf), "scored")     # four metrics read it
    real = _realised(spark, sf)
    return rounded(mt.summary_row(mt.roc_auc(s), mt.score_summary(s), mt.expected_calibration_error(s),
                                  mt.hosmer_lemeshow(s), real))
