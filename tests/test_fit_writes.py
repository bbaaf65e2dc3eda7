"""A feature plan's fit writes its rows and its features, nothing again."""

import pytest
from pyspark.sql import functions as F

from tranche.operators import quantiles as qt
from tranche.plans.feature_plan import FeaturePlan


@pytest.mark.parametrize("scaling", ["standard", "robust"])
def test_fit_reads_the_written_features(spark, monkeypatch, scaling):
    again = []
    materialize = qt.materialize
    monkeypatch.setattr(qt, "materialize", lambda df, name="stage", **k: again.append(name) or materialize(df, name, **k))
    loans = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") * 10.0 + 1).alias("loan_amnt"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") * 100.0).alias("annual_inc"))
    fitted = FeaturePlan(max_features=0, dummies=False, top_states=0, scaling=scaling).fit(loans)
    assert again == []
    own = sorted(100.0 * i for i in range(200) if i % 5)
    assert fitted.imputer.values["annual_income"] == (own[79] + own[80]) / 2
