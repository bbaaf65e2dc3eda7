"""Feature plan, compliance and quality profiles on fixture frames."""

import pytest
from pyspark.sql import functions as F

from tranche.operators import compliance as cp
from tranche.operators import prep
from tranche.operators import quality as qa
from tranche.plans.feature_plan import FeaturePlan


def basic(spark):
    return spark.createDataFrame(
        [(1, 10000.0, 0.12, 36, 50000.0, 15.0, "A", "RENT", 0),
         (2, 15000.0, 0.15, 60, 75000.0, 20.0, "B", "OWN", 1),
         (3, 8000.0, 0.18, 36, None, 25.0, "C", "MORTGAGE", 0),
         (4, 12000.0, None, 36, 60000.0, 18.0, "A", "RENT", 1),
         (5, None, 0.10, 60, 90000.0, 12.0, "B", "OWN", 0)],
        "id long, loan_amnt double, int_rate double, term int, annual_inc double, dti double, grade string, "
        "home_ownership string, label int")


def test_dummies_and_median_fill(spark):
    df = basic(spark)
    fitted = FeaturePlan(max_features=0, scaling="none", top_states=0).fit(df)
    out = {r["id"]: r for r in fitted.transform(df).collect()}
    assert [out[i]["grade_A"] for i in range(1, 6)] == [1, 0, 0, 1, 0]
    assert out[5]["loan_amount"] == pytest.approx(11000.0)  # median of 8000, 10000, 12000, 15000
    assert out[4]["interest_rate"] == pytest.approx(0.135)


def test_fit_on_train_only(spark):
    df = basic(spark)
    a = FeaturePlan(max_features=0, top_states=0).fit(df.where("id <= 3"))
    b = FeaturePlan(max_features=0, top_states=0).fit(df.where("id <= 3").unionByName(df.where("id > 3").limit(0)))
    assert a.scaler.center == b.scaler.center
    # new rows never move the fitted values
    t = a.transform(df)
    assert t.count() == 5 and set(a.feature_names) <= set(t.columns)


def test_alignment_adds_zero(spark):
    df = basic(spark)
    fitted = FeaturePlan(max_features=0, scaling="none", top_states=0).fit(df)
    only_a = df.where(F.col("grade") == "A").drop("home_ownership")
    out = fitted.transform(only_a)
    assert out.columns[-len(fitted.feature_names):] == fitted.feature_names
    assert {r["home_OWN"] for r in out.collect()} == {0.0}


def test_leaking_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 0.1, 2.0, "2016-01-01", 0.0, 0.0, 3)],
                               "id long, loan_amnt double, int_rate double, total_pymnt double, last_pymnt_d string, "
                               "recoveries double, collection_recovery_fee double, pub_rec_bankruptcies int")
    assert cp.drop_leaking(df).columns == ["id", "loan_amnt", "int_rate"]
    assert "pub_rec_bankruptcies" in cp.drop_leaking(df, allow=("pub_rec_bankruptcies",)).columns
    assert cp.leaking_columns(["my_total_pymnt"], mode="anchored") == ["my_total_pymnt"]
    assert cp.leaking_columns(["xrecovery_amt"], mode="anchored") == []


def test_all_missing_column_imputes_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, x double")
    fit = prep.fit_imputer(df.select("x"), ["x"])
    assert fit.values["x"] == 0.0 and fit.all_missing == ["x"]


def test_empty_and_single_row(spark):
    df = basic(spark)
    fitted = FeaturePlan(max_features=0, top_states=0).fit(df)
    assert fitted.transform(df.limit(0)).count() == 0
    assert fitted.transform(df.limit(1)).count() == 1


def test_quality_profiles(spark):
    rows = [(1, 100.0, 0.1, "A"), (2, None, 0.2, "B"), (1, 100.0, 0.1, "A"), (3, None, None, "C"), (1, 100.0, 0.1, "A")]
    df = spark.createDataFrame(rows, "id long, amount double, rate double, grade string")
    d = qa.duplicate_profile(df).first()
    assert d["duplicate_rows"] == 2
    m = {r["column_name"]: r["missing_pct"] for r in qa.missing_profile(df).collect()}
    assert m["amount"] == pytest.approx(40.0) and m["rate"] == pytest.approx(20.0)
    s = qa.quality_score(df).first()
    assert 0.0 <= s["quality_score"] <= 1.0


def test_anova_constant_feature_ranks_last(spark):
    df = spark.createDataFrame([(i, float(i % 2), 1.0, float(i), i % 2) for i in range(20)],
                               "id long, a double, c double, b double, label int")
    scores = prep.anova_f(df, ["a", "c", "b"], "label")
    assert prep.select_k_best(scores, 2) == ["a", "b"]


def test_fitted_values_come_from_training_rows_only(spark):
    """Leak test: imputation and scaling parameters equal statistics of the
    training split alone, and transforming other rows does not move them."""
    import statistics

    from tranche.plans.inputs import labelled_loans
    lab = labelled_loans(spark, "/root/testdata/sf0.001")
    train = lab.where(F.col("split") == "train")
    fitted = FeaturePlan(max_features=0, top_states=0, scaling="standard").fit(train)
    inc_train = [r[0] for r in train.select("annual_inc").collect() if r[0] is not None]
    assert fitted.imputer.values["annual_income"] == pytest.approx(statistics.median(inc_train))
    before = dict(fitted.scaler.center)
    fitted.transform(lab.where(F.col("split") != "train")).count()
    assert fitted.scaler.center == before
    inc_all = [r[0] for r in lab.select("annual_inc").collect() if r[0] is not None]
    if statistics.median(inc_all) != statistics.median(inc_train):
        assert fitted.imputer.values["annual_income"] != pytest.approx(statistics.median(inc_all))


def test_rows_with_missing_features_are_dropped(spark):
    """with the drop strategy a row with any missing feature goes, in the
    fit and in the transform, and its label with it."""
    from tranche.plans.inputs import labelled_loans
    lab = labelled_loans(spark, "/root/testdata/sf0.001").where(F.col("split") == "train")
    plan = FeaturePlan(categories={"credit_history": False, "derived_features": False}, dummies=False, top_states=0, max_features=0,
                       missing_strategy="drop")
    fitted = plan.fit(lab)
    whole = fitted.raw_features(lab).na.drop(subset=fitted.names_before_selection)
    out = fitted.transform(lab)
    assert 0 < out.count() == whole.count()
    assert out.na.drop().count() == out.count()
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 3.0), (3, None, 4.0)], "id long, a double, b double")
    assert [r["id"] for r in prep.drop_missing(df, ["a", "b"]).collect()] == [2]


def test_blocks_can_be_switched_off_and_metadata_names_them(spark):
    """X8, X10."""
    from tranche.plans.inputs import labelled_loans
    lab = labelled_loans(spark, "/root/testdata/sf0.001").where(F.col("split") == "train")
    on = FeaturePlan(dummies=False, top_states=0, max_features=0).fit(lab)
    off = FeaturePlan(dummies=False, top_states=0, max_features=0, categories={"credit_history": False}).fit(lab)
    assert set(off.feature_names) < set(on.feature_names) and "fico_score" not in off.feature_names
    meta = off.metadata()
    assert meta["n_features"] == len(meta["feature_names"]) == len(off.feature_names)
    assert meta["scaling"] == "standard" and meta["categories"] == {} and meta["top_states"] == []


def test_too_many_categories_are_refused(spark, monkeypatch):
    from tranche.plans import feature_plan
    from tranche.plans.inputs import labelled_loans
    monkeypatch.setattr(feature_plan, "MAX_CATEGORIES", 3)
    with pytest.raises(ValueError):
        FeaturePlan().fit_categories(labelled_loans(spark, "/root/testdata/sf0.001"))


def test_unknown_scaling_falls_back_to_standard(spark):
    """E6."""
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert prep.fit_scaler(df, ["x"], "none").method == "none"
    odd = prep.fit_scaler(df, ["x"], "odd")
    assert odd.method == "standard" and odd.center["x"] == 2.0 and odd.scale["x"] == 1.0
