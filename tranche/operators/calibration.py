"""Probability calibration on validation rows with the model frozen
(M9-M11, V9)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import is_well_calibrated
from ..session import materialize
from .isotonic import IsotonicModel
from .metrics import reliability_curve, uniform_bin


def _vec(df: DataFrame, col: str) -> DataFrame:
    return VectorAssembler(inputCols=[col], outputCol="_x").transform(df)


class PlattCalibrator:
    """M9: sigmoid on the raw margin, fitted without penalty on Platt's
    smoothed targets t+ = (N+ + 1)/(N+ + 2), t- = 1/(N- + 2).  A soft target
    is written as two weighted rows (label 1 with weight t, label 0 with
    weight 1 - t), which gives exactly the soft-target log loss."""

    def fit(self, val: DataFrame, margin: str = "margin", label: str = "label") -> "PlattCalibrator":
        c = val.agg(F.sum(label).alias("pos"), F.count(F.lit(1)).alias("n")).first()
        pos, neg = float(c["pos"] or 0), float(c["n"] - (c["pos"] or 0))
        t_pos, t_neg = (pos + 1) / (pos + 2), 1 / (neg + 2)
        t = F.when(F.col(label) == 1, t_pos).otherwise(t_neg)
        two = (val.select(margin, t.alias("_t"))
               .select(margin, F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("_t").alias("w")),
                                                 F.struct(F.lit(0.0).alias("y"), (1 - F.col("_t")).alias("w")))).alias("r"))
               .select(margin, "r.y", "r.w"))
        lr = LogisticRegression(featuresCol="_x", labelCol="y", weightCol="w", regParam=0.0, standardization=False,
                                maxIter=200, tol=1e-10)
        m = lr.fit(_vec(two, margin))
        self.a, self.b, self.margin = float(m.coefficients[0]), float(m.intercept), margin
        return self

    def transform(self, df: DataFrame, out: str = "p_cal") -> DataFrame:
        return df.withColumn(out, 1 / (1 + F.exp(-(F.lit(self.a) * F.col(self.margin) + F.lit(self.b)))))


class IsotonicCalibrator:
    """Isotonic regression of the label on the margin (out-of-range
    margins take the boundary value)."""

    def fit(self, val: DataFrame, margin: str = "margin", label: str = "label") -> "IsotonicCalibrator":
        self.margin = margin
        self.model = IsotonicModel.fit(val, margin, label)
        return self

    def transform(self, df: DataFrame, out: str = "p_cal") -> DataFrame:
        return df.withColumn(out, self.model.predict(self.margin))


def calibration_slope(df: DataFrame, p: str = "p", label: str = "label", eps: float = 1e-15) -> tuple[float, float]:
    """V9: logistic fit of the label on logit(p), L2 with C = 1
    (regParam = 1 / n, intercept unpenalised)."""
    pc = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    x = df.select(F.log(pc / (1 - pc)).alias("_logit"), F.col(label).cast("double").alias("_y"))
    n = x.count()
    m = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                           standardization=False, maxIter=200, tol=1e-10).fit(_vec(x, "_logit"))
    return float(m.coefficients[0]), float(m.intercept)


def calibration_report(df: DataFrame, raw: str = "p", cal: str = "p_cal", label: str = "label") -> DataFrame:
    """Brier and ECE before / after, improvements, slope / intercept of
    the calibrated scores (one row).  The three columns are written once; one
    grouped pass over (scores, bin) gives all sums."""
    df = materialize(df.select(F.col(label).cast("double").alias("y"), F.col(raw).cast("double").alias("raw"), F.col(cal).cast("double").alias("cal")),
                     "calibration-input")
    both = F.array(*[F.struct(F.lit(c).alias("scores"), F.col(c).alias("p")) for c in ("raw", "cal")])
    bins = (df.select("y", F.explode(both).alias("r")).select("y", "r.*").where(F.col("p").isNotNull())
            .groupBy("scores", F.when(F.col("p") > 0, uniform_bin(F.col("p"))).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.sum("p").alias("p"), F.sum((F.col("p") - F.col("y")) ** 2).alias("squares")))
    per = (bins.groupBy("scores").agg(
        (F.sum("squares") / F.sum("n")).alias("brier"),
        (F.sum(F.when(F.col("bin").isNotNull(), F.abs(F.col("p") - F.col("y")))) / F.sum("n")).alias("ece"))
        .groupBy().pivot("scores", ["raw", "cal"]).agg(F.first("brier").alias("brier"), F.first("ece").alias("ece")))
    slope, intercept = calibration_slope(df, "cal", "y")
    return per.select(
        F.col("raw_brier").alias("original_brier_score"), F.col("cal_brier").alias("calibrated_brier_score"),
        (F.col("raw_brier") - F.col("cal_brier")).alias("brier_score_improvement"),
        F.col("raw_ece").alias("original_ece"), F.col("cal_ece").alias("calibrated_ece"), (F.col("raw_ece") - F.col("cal_ece")).alias("ece_improvement"),
        F.lit(slope).alias("calibration_slope"), F.lit(intercept).alias("calibration_intercept"),
        is_well_calibrated(F.lit(slope), F.lit(intercept)).alias("is_well_calibrated"))


def calibration_curves(df: DataFrame, raw: str = "p", cal: str = "p_cal", label: str = "label") -> DataFrame:
    """Reliability curves of both score columns in long form."""
    return (reliability_curve(df, label, raw).withColumn("scores", F.lit("original"))
            .unionByName(reliability_curve(df, label, cal).withColumn("scores", F.lit("calibrated"))))
