"""Plan shape checks: pruning reaches the scans, skew-prone windows are salted."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["risk_filter_reasons"](spark, SF))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans, p
    for s in scans:
        read = s.split("ReadSchema: struct<", 1)[1]
        assert "l_comment" not in read and "l_shipdate" not in read and "l_quantity" not in read


def test_budget_window_is_salted_before_quarter_window(spark):
    p = plan(E.queries()["portfolio_lowest_risk"](spark, SF))
    assert "_salt" in p
    # the risk filter runs below the first exchange (before any shuffle)
    first_exchange = p.index("Exchange hashpartitioning(data_quarter")
    assert "Filter CASE WHEN" in p[first_exchange:]


def test_global_auc_has_no_single_partition_row_window(spark):
    p = plan(E.queries()["roc_auc"](spark, SF))
    # the only window over all score groups is partitioned by bucket
    assert "windowspecdefinition(_bucket" in p


def test_end_to_end_compares_with_both_benchmarks(spark):
    from tranche.plans.catalog import load
    rows = load()[0]["end_to_end"](spark, "/root/testdata/sf0.001").collect()
    got = {r["metric"]: r["value"] for r in rows if r["section"] == "backtest"}
    assert {"portfolio_roi", "default_rate_vs_market", "default_rate_vs_random", "roi_vs_market", "roi_vs_random"} <= set(got)
    assert all(got[m] is not None for m in ("roi_vs_market", "roi_vs_random"))


def test_trees_are_trained_on_even_parts(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from tranche.operators import models as md
    rows = [(i, int(i % 3 == 0), Vectors.dense([i % 3, i % 7])) for i in range(900)]
    df = spark.createDataFrame(rows, ["id", "label", "features"]).coalesce(1)
    monkeypatch.setattr(md, "ROWS_PER_BUCKET", 20)
    parts = md.dealt(df, 900)
    cores = spark.sparkContext.defaultParallelism
    sizes = parts.rdd.glom().map(len).collect()
    assert parts.columns == ["features", "label"] and len(sizes) % cores == 0 and sum(sizes) == 900
    assert len(sizes) >= 900 / 20 and max(sizes) <= 40
    model = md.train(df, md.ModelConfig("random_forest", n_estimators=3, max_depth=3))
    assert md.score(model, df).where("(p > 0.5) != (label = 1)").count() == 0
