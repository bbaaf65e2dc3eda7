"""A fit on a written table does not write its input again."""

from pyspark.sql import functions as F

from tranche.plans import feature_plan as fp
from tranche.plans.inputs import labelled_loans
from tranche.session import materialize


def test_fit_reads_the_written_table(spark, monkeypatch):
    df = materialize(labelled_loans(spark, "/root/testdata/sf0.001"), "labelled").where(F.col("split") == "train")
    written = []
    monkeypatch.setattr(fp, "materialize", lambda d, name, *a: written.append(name) or materialize(d, name, *a))
    fits = [fp.FeaturePlan(max_features=20).fit(df, stored=stored) for stored in (True, False)]
    assert written == ["fit-features", "fit-input", "fit-features"]
    a, b = fits
    assert a.feature_names == b.feature_names and a.imputer.values == b.imputer.values and a.categories == b.categories
    assert all(abs(a.scaler.scale[c] - b.scaler.scale[c]) < 1e-9 * max(1, abs(b.scaler.scale[c])) for c in a.feature_names)
