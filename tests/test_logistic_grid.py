"""The shared-pass search against MLlib, one model at a time."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tranche.operators import logistic_grid as lg
from tranche.operators import models as md


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        x = [rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1), rng.random() * 3, float(rng.random() < 0.2)]
        x.append(x[0] + x[1])                      # a column that others add up to
        z = 1.5 * x[0] - x[2] + 0.7 * x[4] - 1
        rows.append((i, int(rng.random() < 1 / (1 + 2.718281828 ** -z)), *x))
    df = spark.createDataFrame(rows, "id long, label int, " + ", ".join(f"x{k} double" for k in range(6)))
    out = VectorAssembler(inputCols=[f"x{k}" for k in range(6)], outputCol="features").transform(df).select("id", "label", "features")
    path = md.materialize(out, "grid-test")
    return path


def _data(df, folds=5):
    return md.fold_column(df, folds).select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), "fold", F.lit(1.0).alias("w")).cache()


def test_models_meet_the_optimality_conditions(spark, frame):
    data = _data(frame)
    points = [lg.Point(C, penalty, f) for C in (0.01, 1.0, 100.0) for penalty in ("l1", "l2") for f in (None, 2)]
    models = lg.fit_points(data, points)
    rows = data.collect()
    x, y, fold = (np.array([r[c] for r in rows]) for c in ("x", "y", "fold"))
    for p, m in zip(points, models):
        own = fold != p.fold if p.fold is not None else np.ones(len(y), bool)
        b = m.coefficients.toArray()
        z = x[own] @ b + m.intercept
        assert m.objective == pytest.approx(np.logaddexp(0, z).sum() - (y[own] * z).sum() + lg._penalty(p, np.r_[m.intercept, b]), rel=1e-9)
        off = 1 / (1 + np.exp(-z)) - y[own]
        grad = x[own].T @ off
        assert abs(off.sum()) < 1e-3
        if p.penalty == "l2":
            assert grad + b / p.C == pytest.approx(0, abs=1e-3)
        else:
            assert (np.abs(grad[b == 0]) <= 1 / p.C + 1e-3).all() and grad[b != 0] == pytest.approx(-np.sign(b[b != 0]) / p.C, abs=1e-3)


def test_coefficients_equal_mllib(spark, frame):
    data = _data(frame)
    m = lg.fit_points(data, [lg.Point(1.0, "l2")])[0]
    ref = LogisticRegression(regParam=1 / 900, elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-10).fit(frame)
    assert m.coefficients.toArray() == pytest.approx(ref.coefficients.toArray(), abs=1e-3) and m.intercept == pytest.approx(ref.intercept, abs=1e-3)


def test_search_scores_and_refit(spark, frame, tmp_path):
    model, results = md.grid_search(frame, md.ModelConfig("logistic"))
    assert [json.loads(r["params"]) for r in results] == [{"C": C, "penalty": p} for C in md.C_VALUES for p in ("l1", "l2")]
    assert all(0.6 < r["cv_auc"] < 1 for r in results) and max(r["cv_auc"] for r in results) > 0.8
    scored = md.score(model, frame).select("p", "margin", "label").toPandas()
    assert scored["p"].to_numpy() == pytest.approx(1 / (1 + np.exp(-scored["margin"].to_numpy())))
    # one fold's score of one point, from the held-out rows alone
    data = _data(frame)
    points = [lg.Point(1.0, "l2", f) for f in range(5)]
    models = lg.fit_points(data, points)
    auc = []
    for f, m in enumerate(models):
        own = data.where(F.col("fold") == f).toPandas()
        z = np.array(own["x"].tolist()) @ m.coefficients.toArray()
        pos, neg = z[own["y"] == 1], z[own["y"] == 0]
        auc.append(((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg)))
    assert results[5]["cv_auc"] == pytest.approx(np.mean(auc), abs=1e-9)
    path = md.save_model(model, {"C": 1}, f"file:{tmp_path}/m", "v1")
    again = lg.GridLogisticModel.load(f"{path}/model")
    assert again.coefficients == model.coefficients and again.intercept == model.intercept


def test_weights_count_like_rows(spark, frame):
    data = _data(frame)
    twice = data.union(data)
    heavy = data.withColumn("w", F.lit(2.0))
    a, b = (lg.fit_points(d, [lg.Point(0.5, "l2")])[0] for d in (twice, heavy))
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-6)


def test_folds_differ_by_one_row(spark):
    df = spark.range(1003).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    n = {(r["label"], r["fold"]): r["count"] for r in md.fold_column(df).groupBy("label", "fold").count().collect()}
    for c, total in ((0, 668), (1, 335)):
        sizes = [n[c, f] for f in range(5)]
        assert sum(sizes) == total and max(sizes) - min(sizes) <= 1


def test_models_of_one_pass_share_their_curvature(spark, frame):
    data = _data(frame)
    points = [lg.Point(C, "l2", f) for C in (0.5, 1.0) for f in (0, 1, None)] + [lg.Point(9.0, "l1", 3)]
    rng = np.random.default_rng(1)
    here, far = rng.normal(size=7) / 4, rng.normal(size=7)
    betas = {k: here for k in range(6)} | {6: far}
    lead = lg._leaders(betas, {}, set())
    assert lead == {**dict.fromkeys(range(6), 0), 6: 6}
    assert lg._leaders(betas, {}, {4}) == {**dict.fromkeys(range(6), 0), 4: 4, 6: 6}
    shared, own = lg._pass(data, betas, points, lead), lg._pass(data, betas, points)
    for k in betas:
        for a, b in zip(shared[k], own[k]):
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)
    hess = {k: own[k][2] for k in betas}
    near = {k: b + (1e-3 if k == 1 else 0) for k, b in betas.items()}
    assert lg._leaders(near, hess, set())[1] == 0 and lg._leaders({**near, 1: here + 1}, hess, set())[1] == 1


def test_lasso_step_is_exact_with_columns_that_add_up():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 30))
    kind = rng.integers(0, 5, 2000)
    for k in range(5):
        x[:, k] = 2.2 * (kind == k)
    x[:, 8], x[:, 9], x[:, 10] = x[:, 7], -x[:, 7], x[:, 5] + x[:, 6]
    x = np.column_stack([np.ones(2000), x])
    h, grad = x.T @ x / 5, x.T @ rng.normal(size=2000) * 3
    for start in (np.zeros(31), rng.normal(size=31) * (rng.random(31) < 0.5)):
        for C in (100.0, 1.0, 0.01):
            step, promise = lg._direction(lg.Point(C, "l1"), start, grad, h)
            b, slope = (start + step)[1:], grad + h @ step
            assert promise <= 0 and abs(slope[0]) < 1e-6 and (np.abs(slope[1:])[b == 0] <= 1 / C + 1e-6).all()
            assert slope[1:][b != 0] == pytest.approx(-np.sign(b[b != 0]) / C, abs=1e-6)


def test_packed_rows_and_auc_by_ranges(spark, frame, monkeypatch):
    data = _data(frame)
    points = [lg.Point(1.0, "l1", 2), lg.Point(0.1, "l2", 0)]
    packed = md.materialize(lg.packed(data), "packed-test")
    a, b = (lg.fit_points(d, points) for d in (data, packed))
    for m, n in zip(a, b):
        assert m.coefficients.toArray() == pytest.approx(n.coefficients.toArray(), abs=1e-9)
    scores = lg.held_out_scores(packed, points, b).withColumn("p", F.round("p", 2))      # ties
    one = scores.union(scores.limit(5).select(F.lit(7), "fold", F.lit(1), "p"))          # a point without negatives
    want = {r["point"]: r["roc_auc"] for r in lg_auc(one)}
    for size in (10, 10**6):
        monkeypatch.setattr(lg, "ROWS_PER_RANGE", size)
        got = lg.held_out_auc(one, one.count())
        assert got.pop(7) is None and got == pytest.approx({k: v for k, v in want.items() if k != 7}, abs=1e-12)


def lg_auc(scores):
    from tranche.operators.metrics import roc_auc
    return roc_auc(scores, by=["point"]).collect()


def test_folds_follow_the_hash_order_and_move_rows_once(spark):
    df = md.materialize(spark.range(2000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 2).alias("label"), F.lit("wide").alias("x")), "folds-test")
    out = md.fold_column(df, parts=3, stored=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and out.rdd.getNumPartitions() == 3
    got = {r["id"]: (r["label"], r["fold"]) for r in out.collect()}
    order = df.select("id", "label", F.xxhash64("id", F.lit(42)).alias("at")).orderBy("at", "id").collect()
    turn = {}
    for r in order:
        turn[r["label"]] = turn.get(r["label"], -1) + 1
        assert got.pop(r["id"]) == (r["label"], turn[r["label"]] % 5)
    assert not got
