"""Quarter-file scan, config checks and the streaming scorer."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tranche.sources import files

SF = "/root/testdata/sf0.001"


def _write_quarters(spark, d):
    from tranche.sources.loans import loan_file_rows
    rows = loan_file_rows(spark, SF).where(F.col("data_quarter").isin("1995Q1", "1995Q2"))
    pdf = rows.toPandas()
    pdf = pdf.rename(columns={"term_raw": "term", "revol_util_raw": "revol_util", "earliest_cr_line_raw": "earliest_cr_line",
                              "issue_d_raw": "issue_d"})
    pdf["int_rate"] = (pdf["int_rate"] * 100).round(2).astype(str) + "%"
    for q, part in pdf.groupby("data_quarter"):
        part.drop(columns=["data_quarter"]).to_csv(os.path.join(d, f"{q}.csv"), index=False)
    return pdf


def test_load_quarters(spark):
    d = tempfile.mkdtemp(prefix="tranche-q-")
    pdf = _write_quarters(spark, d)
    df = files.load_quarters(spark, d, ["1995Q1", "1995Q2"])
    assert df.count() == len(pdf)
    got = {r["data_quarter"]: r["n"] for r in df.groupBy("data_quarter").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == pdf.groupby("data_quarter").size().to_dict()
    r = df.where(F.col("term") == 60).first()
    assert r["term"] == 60 and 0 <= r["revol_util"] <= 1 and r["issue_d"].year == 1995
    assert files.available_quarters(spark, d) == ["1995Q1", "1995Q2"]


def test_columns_are_matched_by_name_and_bad_rows_kept_apart(spark, tmp_path):
    (tmp_path / "2016Q1.csv").write_text("id,loan_amnt,annual_inc\n1,1000,50000\n9,7\n")
    (tmp_path / "2016Q2.csv").write_text("id,annual_inc,loan_amnt,purpose\n2,60000,2000,car\n8,1,2,x,y\n")
    (tmp_path / "2016Q3.csv").write_text("id,loan_amnt,annual_inc\n3,3000,\n")
    rows = {r["id"]: r for r in files.load_quarters(spark, f"file:{tmp_path}", ["2016Q1", "2016Q2", "2016Q3"]).collect()}
    assert {i: (r["loan_amnt"], r["annual_inc"], r["purpose"], r["data_quarter"]) for i, r in rows.items()} == {
        1: (1000.0, 50000.0, None, "2016Q1"), 2: (2000.0, 60000.0, "car", "2016Q2"), 3: (3000.0, None, None, "2016Q3")}
    bad = files.malformed_rows(spark, f"file:{tmp_path}", ["2016Q1", "2016Q2", "2016Q3"]).collect()
    assert sorted((r["data_quarter"], r["_corrupt_record"]) for r in bad) == [("2016Q1", "9,7"), ("2016Q2", "8,1,2,x,y")]
    assert files.available_quarters(spark, f"file:{tmp_path}") == ["2016Q1", "2016Q2", "2016Q3"]


def test_missing_dates_sort_last(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, None), (2, dt.date(2016, 2, 1)), (3, dt.date(2015, 1, 1))], "id long, issue_d date")
    assert [r["id"] for r in files.by_date(df).collect()] == [3, 2, 1]


def test_missing_quarters_reported_together(spark):
    d = tempfile.mkdtemp(prefix="tranche-q-")
    with pytest.raises(FileNotFoundError) as e:
        files.load_quarters(spark, d, ["2016Q1", "2016Q2"])
    assert "2016Q1" in str(e.value) and "2016Q2" in str(e.value)


def test_config_checks():
    base = {"data": {"train_quarters": ["a"], "validation_quarters": ["b"], "backtest_quarters": ["c"]},
            "features": {}, "model": {}, "investment": {"budget_per_quarter": 5000}, "evaluation": {}}
    assert files.PipelineConfig.from_dict(base).investment["budget_per_quarter"] == 5000
    with pytest.raises(ValueError):
        files.PipelineConfig.from_dict({k: v for k, v in base.items() if k != "model"})
    with pytest.raises(ValueError):
        files.PipelineConfig.from_dict({**base, "investment": {"budget_per_quarter": 0}})


def test_streaming_scoring(spark):
    from tranche.operators import models as md
    from tranche.plans.feature_plan import FeaturePlan
    from tranche.plans.inputs import labelled_loans
    from tranche.streaming.scoring import start_scoring
    lab = labelled_loans(spark, SF)
    train = lab.where(F.col("split") == "train")
    fitted = FeaturePlan(max_features=20, top_states=5).fit(train)
    model = md.train(fitted.assemble(fitted.transform(train)), md.ModelConfig("logistic", max_iter=50))
    src = tempfile.mkdtemp(prefix="tranche-src-")
    new = lab.where(F.col("split") == "backtest").drop("label", "split")
    new.write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    out, ck = tempfile.mkdtemp(prefix="tranche-out-"), tempfile.mkdtemp(prefix="tranche-ck-")
    q = start_scoring(spark, os.path.join(src, "batch1"), new.schema, fitted, model, out, ck)
    q.awaitTermination(300)
    res = spark.read.parquet(out)
    assert res.count() == new.count()
    assert res.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0


def test_quarter_counts_window(spark):
    import datetime as dt
    from tranche.streaming.scoring import quarter_counts
    rows = [(1, dt.date(2016, 1, 5), 0.1), (2, dt.date(2016, 2, 5), 0.3), (3, dt.date(2016, 7, 1), 0.2)]
    df = spark.createDataFrame(rows, "id long, issue_d date, p double")
    got = sorted((r["loans"], round(r["mean_p"], 6)) for r in quarter_counts(df).collect())
    assert got == [(1, 0.2), (2, 0.2)]


def test_materialize_and_release(spark):
    from tranche.session import materialize, release_materialized
    df = materialize(spark.range(10), "t")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 10
    assert release_materialized(spark) >= 1
    assert not os.path.exists(path.replace("file:", ""))


def test_a_run_releases_its_own_files_only(spark):
    from tranche.session import materialize, run_intermediates
    with run_intermediates() as one:
        a = materialize(spark.range(3), "a")
    with run_intermediates() as two:
        b = materialize(spark.range(4), "b")
    assert one.release(spark) == 1 and one.release(spark) == 0
    assert b.count() == 4
    assert not os.path.exists(a.inputFiles()[0].replace("file:", ""))
    assert two.release(spark) == 1


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tranche.session import ensure_checkpoint_dir, local_master
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)
    assert local_master("local") and local_master("local[8]") and not local_master("local-cluster[3,2,3000]") and not local_master("yarn")
