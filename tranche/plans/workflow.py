"""End-to-end run (section 3.1): labels -> quality gate -> features ->
model -> calibration -> per-quarter selection -> backtest -> report.

Tables that several steps read (labels, feature matrix, scores, metrics,
selections, realised portfolio) are written once to the shared checkpoint
folder; the others are lazy.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as au
from ..operators import backtest as bt
from ..operators import calibration as cal
from ..operators import metrics as mt
from ..operators import models as md
from ..operators import portfolio as pf
from ..operators import quality as qa
from ..session import ensure_checkpoint_dir, materialize
from .feature_plan import FeaturePlan
from .inputs import labelled_loans


class QualityGateError(RuntimeError):
    pass


@dataclass
class RunConfig:
    model: md.ModelConfig = field(default_factory=md.ModelConfig)
    features: FeaturePlan = field(default_factory=FeaturePlan)
    policy: pf.PortfolioPolicy = field(default_factory=pf.PortfolioPolicy)
    calibrate: str | None = "platt"   # 'platt' | 'isotonic' | None (M12)
    search: bool = False
    min_quality_score: float = 0.80
    gate: bool = True
    benchmarks: tuple[str, ...] = ("market", "random")  # B5 switches
    stop_at_model_gate: bool = False   # A14 raises instead of only reporting


def quality_gate(df: DataFrame, min_score: float, stored: bool = False) -> DataFrame:
    """Quality score per split, from one grouped pass per figure; raise
    when any split fails (one without rows does)."""
    splits = ["train", "validation", "backtest"]
    rows = [(r["split"], None if r["quality_score"] is None else float(r["quality_score"]),
             r["quality_score"] is not None and bool(r["quality_score"] >= min_score))
            for r in qa.quality_scores(df, "split", splits, stored=stored).collect()]
    rows.sort(key=lambda r: splits.index(r[0]))
    failed = [s for s, _, ok in rows if not ok]
    if failed:
        raise QualityGateError(f"quality gate failed for {failed}")
    return df.sparkSession.createDataFrame(rows, "split string, quality_score double, passed boolean")


class ModelGateError(RuntimeError):
    pass


def split_metrics(scored: DataFrame) -> DataFrame:
    """M6: AUC, summary, calibration error and Hosmer-Lemeshow of each split
    that ``scored`` has rows of, one row per split."""
    from ..operators.rows import combine_rows
    parts = []
    for split in sorted(r[0] for r in scored.select("split").distinct().collect()):     # three at most
        one = scored.where(F.col("split") == split)
        parts.append(combine_rows(mt.roc_auc(one), mt.score_summary(one), mt.expected_calibration_error(one), mt.hosmer_lemeshow(one))
                     .withColumn("split", F.lit(split)))
    return reduce(DataFrame.unionByName, parts)


def run(spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None) -> dict[str, DataFrame]:
    """The whole run's tables; what several steps read is stored once.  The
    model's gate judges the validation quarters; ``audit`` has a row per step."""
    cfg = cfg or RunConfig()
    ensure_checkpoint_dir(spark)
    out: dict[str, DataFrame] = {}
    log: list[dict] = []
    step = lambda name, action, source=None: au.timed(name, action, log, source)

    # labels feed the gate, the fit, the transform, the selection and the backtest
    lab = step("labels", lambda: materialize(labelled_loans(spark, sf_dir), "labelled"))
    if cfg.gate:
        out["quality_gate"] = step("quality_gate", lambda: quality_gate(lab.drop("label"), cfg.min_quality_score, stored=True), lab)
    learn = lab.where(F.col("split") == "train")
    fitted = step("features", lambda: cfg.features.fit(learn), learn)
    mat = step("matrix", lambda: materialize(fitted.assemble(fitted.transform(lab)).select("id", "data_quarter", "split", "label", "features"),
                                             "run-features"), lab)
    train = mat.where(F.col("split") == "train")
    model = step("model", lambda: md.grid_search(train, cfg.model)[0] if cfg.search else md.train(train, cfg.model), train)
    scored = md.score(model, mat)
    if cfg.calibrate:
        c = (cal.PlattCalibrator() if cfg.calibrate == "platt" else cal.IsotonicCalibrator())
        step("calibration", lambda: c.fit(scored.where(F.col("split") == "validation")), mat.where(F.col("split") == "validation"))
        scored = c.transform(scored).withColumn("p", F.col("p_cal"))
    scores = step("scores", lambda: materialize(scored.select("id", "data_quarter", "split", "label", "p"), "run-scores"), mat)
    metrics = step("metrics", lambda: materialize(split_metrics(scores), "run-metrics"), scores)
    out["split_metrics"] = metrics
    out["model_metrics"] = metrics.where(F.col("split") == "backtest").drop("split")
    val = metrics.where(F.col("split") == "validation")
    out["model_gate"] = step("model_gate", lambda: materialize(au.model_gate(val, val, val), "run-gate"), metrics)
    if cfg.stop_at_model_gate and out["model_gate"].where("NOT passed AND rule <> 'warn_auc'").count():
        raise ModelGateError("the model misses its limits on the validation quarters")

    chosen = {}
    for split in ("validation", "backtest"):
        own = lab.where(F.col("split") == split)
        pds = scores.where(F.col("split") == split).select("id", F.col("p").alias("pd"))
        chosen[split] = step(f"selection_{split}", lambda own=own, pds=pds: materialize(pf.select_investments(own, pds, cfg.policy), "run-selection"), own)
    sel, out["selection"], out["selection_validation"] = chosen["backtest"], chosen["backtest"], chosen["validation"]
    real = step("backtest", lambda: materialize(bt.realised(bt.attach_outcomes(sel, lab.select("id", "label"))), "run-realised"), sel)
    back_loans = lab.where(F.col("split") == "backtest")
    market = bt.market_benchmark(back_loans)
    out["backtest"] = bt.result_row(real, market, cfg.policy.budget)
    if "market" in cfg.benchmarks:
        out["benchmark_market"] = market
    if "random" in cfg.benchmarks:
        sizes = sel.groupBy(cfg.policy.group_col).agg(F.count(F.lit(1)).alias("n"))
        out["benchmark_random"] = step("benchmark_random", lambda: bt.random_benchmark(back_loans, sizes), back_loans)
        if "market" in cfg.benchmarks:
            out["benchmark_compare"] = bt.compare(real, market, out["benchmark_random"])
    out["feature_importance"] = md.feature_importance(model, fitted.feature_names) \
        if hasattr(model, "coefficients") or hasattr(model, "featureImportances") else None

    realised = real.agg(F.sum("total_investment").alias("total_investment"), F.sum("loans_selected").alias("loans_selected"),
                        F.avg("default_rate").alias("portfolio_default_rate"), F.avg("roi_proxy").alias("portfolio_roi"))
    facts = spark.createDataFrame([(len(fitted.names_before_selection), len(fitted.feature_names), len(fitted.states))],
                                  "features_built int, features_selected int, states_flagged int")
    sections = {
        "executive": realised.select("portfolio_roi", "portfolio_default_rate"),
        "data": lab.groupBy().pivot("split", ["train", "validation", "backtest"]).agg(F.count(F.lit(1)))
                   .select(*[F.col(s).alias(f"{s}_rows") for s in ("train", "validation", "backtest")]),
        "features": facts,
        "model": out["model_metrics"].drop("well_calibrated"),
        "investment": pf.portfolio_metrics(sel).agg(F.sum("total_investment").alias("invested"), F.sum("loan_count").alias("loans"),
                                                    F.avg("avg_risk_score").alias("avg_risk_score")),
        "backtest": realised if "benchmark_compare" not in out else joined_row(realised, out["benchmark_compare"]),
    }
    out["report"] = au.report_table(sections, {"roc_auc": ("min", 0.65), "brier_score": ("max", 0.20), "hosmer_lemeshow_pvalue": ("min", 0.05)})
    out["audit"] = spark.createDataFrame([(i, r["step"], r["seconds"], r["status"], r["error"], r["rows_in"], r["rows_out"]) for i, r in enumerate(log)],
                                         "position int, step string, seconds double, status string, error string, rows_in long, rows_out long")
    return out


def joined_row(realised: DataFrame, compared: DataFrame) -> DataFrame:
    """The realised figures and the mean gains over the benchmarks, one row."""
    gains = compared.agg(*(F.avg(c).alias(c) for c in ("default_rate_vs_market", "default_rate_vs_random", "roi_vs_market", "roi_vs_random")))
    return realised.withColumn("__one", F.lit(1)).join(gains.withColumn("__one", F.lit(1)), "__one").drop("__one")
