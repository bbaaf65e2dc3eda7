"""Exact quantiles and modes equal numpy's, whatever the values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tranche.operators import metrics as mt
from tranche.operators import prep
from tranche.operators import quality as qa
from tranche.operators.quantiles import exact_quantiles, modes


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles_match_numpy(spark, accuracy):
    """Also with a sketch so coarse that most brackets have to be widened."""
    rnd = random.Random(0)
    rows = []
    for _ in range(3000):
        a = rnd.lognormvariate(0, 3)                  # very skewed
        b = float(rnd.choice([1.0, 1.0, 1.0, 2.5, rnd.random()]))  # heavy ties
        c = None if rnd.random() < 0.2 else rnd.gauss(0, 1)
        rows.append((a, b, c, None))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "d"], probs, accuracy)
    for j, col in enumerate("abc"):
        vals = np.array([r[j] for r in rows if r[j] is not None])
        assert got[col] == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12, abs=1e-12)
    assert got["d"] == [None] * len(probs)


def test_infinity_nan_and_wide_range(spark):
    inf = spark.createDataFrame([(float(i),) for i in range(1, 1001)] + [(math.inf,)], "x double")
    assert exact_quantiles(inf, ["x"], [0.5, 1.0])["x"] == [501.0, math.inf]
    wide = spark.createDataFrame([(10.0 ** -i,) for i in range(300)], "x double")
    assert exact_quantiles(wide, ["x"], [0.5])["x"] == [wide.agg(F.percentile("x", 0.5)).first()[0]]
    nan = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (math.nan,), (-math.inf,)], "x double")
    q = exact_quantiles(nan, ["x"], [0.0, 0.5, 0.75, 1.0])["x"]
    assert q[:3] == [-math.inf, 2.0, 3.0] and math.isnan(q[3])
    assert exact_quantiles(nan.limit(0), ["x"], [0.5])["x"] == [None]


def test_operators_equal_percentile(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.random(), 1 if rnd.random() < 0.3 else 0, None if i % 7 == 0 else rnd.gauss(5, 2), rnd.choice(["a", "b", None]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, p double, label int, x double, t string")
    q = df.agg(F.percentile("x", F.array(*[F.lit(v) for v in (.25, .5, .75)]))).first()[0]
    r = {r["column_name"]: r for r in qa.outlier_iqr(df, ["p", "x"]).collect()}["x"]
    assert r["lower_bound"] == pytest.approx(q[0] - 1.5 * (q[2] - q[0])) and r["upper_bound"] == pytest.approx(q[2] + 1.5 * (q[2] - q[0]))
    assert prep.fit_imputer(df.select("x"), ["x"]).values["x"] == pytest.approx(q[1])
    scaler = prep.fit_scaler(df.select("x"), ["x"], "robust")
    assert scaler.center["x"] == pytest.approx(q[1]) and scaler.scale["x"] == pytest.approx(q[2] - q[0])
    med = {r["bin"]: r["median"] for r in qa.binned_aggregate(df, "p", "x").collect()}
    for b, m in med.items():
        lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
        vals = [r[3] for r in rows if r[3] is not None and max(1, math.ceil((r[1] - lo) / ((hi - lo) / 10))) == b]
        assert m == pytest.approx(float(np.median(vals)))
    assert mt.hosmer_lemeshow(df).count() == 1


def test_modes(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", None), (2, "b", None), (2, "a", None), (3, None, None)], "i int, t string, e double")
    assert modes(df, ["i", "t", "e"]) == {"i": 1.0, "t": "a", "e": None}


def test_unstable_missing_values_have_a_bin(spark):
    df = spark.createDataFrame([("A", float(i)) for i in range(100)] + [("B", float(i)) for i in range(50)] + [("B", None)] * 50, "data_quarter string, x double")
    got = {r["data_quarter"]: r["psi"] for r in mt.stability_index(df, ["x"], F.col("data_quarter") == "A").collect()}
    assert abs(got["A"]) < 1e-9
    want = 0.0
    edges = np.quantile(np.arange(100.0), np.linspace(0, 1, 11)[1:-1])
    share = lambda v: np.bincount([(edges < x).sum() for x in v], minlength=10) / len(v)
    base, now = share(range(100)), share(range(50)) / 2
    for e, a in zip(np.maximum(base, 1e-6), np.maximum(now, 1e-6)):
        want += (a - e) * math.log(a / e)
    assert got["B"] == pytest.approx(want)


def test_tied_columns_end_in_the_first_round(spark, monkeypatch):
    """Flags and small integers need no second pass, whatever their rows; a
    later pass reads only the columns that are still open."""
    from tranche.operators import quantiles as qt
    df = spark.range(5000).select((F.col("id") % 2).alias("flag"), (F.col("id") % 7 - 3).alias("small"), F.sqrt("id").alias("wide"))
    read, counter = [], qt._counter
    monkeypatch.setattr(qt, "_counter", lambda depth, inside, known: read.append(sorted(inside) if inside else None) or counter(depth, inside, known))
    got = exact_quantiles(df, ["flag", "small", "wide"], [0.25, 0.5, 0.75], 100)
    assert read[0] is None and read[1:] and all(r == [2] for r in read[1:])
    n = np.arange(5000)
    for c, v in (("flag", n % 2), ("small", n % 7 - 3), ("wide", np.sqrt(n))):
        assert got[c] == pytest.approx(list(np.quantile(v, [0.25, 0.5, 0.75])), rel=1e-15)


def test_array_bits_equal_column_bits(spark):
    from tranche.operators.quantiles import bits_of, ordered_bits
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.0, -1.0, 0.1, -1e300, math.inf, -math.inf, math.nan]
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select(ordered_bits(F.col("v")).alias("b")).collect()
    assert [r["b"] for r in got] == bits_of(np.array(values)).tolist()
