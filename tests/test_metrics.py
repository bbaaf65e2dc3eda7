"""Scored-table metrics against direct computations."""

import math
import random

import numpy as np
import pytest

from tranche.operators import metrics as mt


def frame(spark, seed=0, n=400, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        p = round(rnd.random(), 1 if ties else 6)
        y = 1 if rnd.random() < p * 0.8 + 0.05 else 0
        rows.append((i, y, p))
    return rows, spark.createDataFrame(rows, "id long, label int, p double")


def pair_auc(rows):
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.mark.parametrize("ties", [True, False])
def test_auc_equals_pair_counting(spark, ties):
    rows, df = frame(spark, 1, ties=ties)
    got = mt.roc_auc(df, buckets=4).first()["roc_auc"]
    assert got == pytest.approx(pair_auc(rows), abs=1e-12)


def test_auc_grouped_equals_pair_counting(spark):
    rows, df = frame(spark, 2)
    from pyspark.sql import functions as F
    g = df.withColumn("g", (F.col("id") % 3).cast("int"))
    got = {r["g"]: r["roc_auc"] for r in mt.roc_auc(g, by=["g"]).collect()}
    for k in range(3):
        assert got[k] == pytest.approx(pair_auc([r for r in rows if r[0] % 3 == k]), abs=1e-12)


def test_brier_logloss_distribution(spark):
    rows, df = frame(spark, 3)
    y = np.array([r[1] for r in rows], float)
    p = np.array([r[2] for r in rows], float)
    s = mt.score_summary(df).first()
    assert s["brier_score"] == pytest.approx(np.mean((p - y) ** 2))
    pc = np.clip(p, 1e-15, 1 - 1e-15)
    assert s["log_loss"] == pytest.approx(-np.mean(y * np.log(pc) + (1 - y) * np.log(1 - pc)))
    assert s["prediction_std"] == pytest.approx(np.std(p))


def test_ece_matches_loop(spark):
    rows, df = frame(spark, 4, ties=False)
    y = np.array([r[1] for r in rows], float)
    p = np.array([r[2] for r in rows], float)
    edges = np.linspace(0, 1, 11)
    ece = 0.0
    for lo, hi in zip(edges[:-1], edges[1:]):
        m = (p > lo) & (p <= hi)
        if m.mean() > 0:
            ece += abs(p[m].mean() - y[m].mean()) * m.mean()
    assert mt.expected_calibration_error(df).first()[0] == pytest.approx(ece)


def test_hosmer_lemeshow_loop(spark):
    rows, df = frame(spark, 5, ties=False)
    y = np.array([r[1] for r in rows], float)
    p = np.array([r[2] for r in rows], float)
    b = np.digitize(p, np.quantile(p, np.linspace(0, 1, 11)))
    stat = 0.0
    for k in range(1, 11):
        m = b == k
        if m.sum():
            o1, e1 = y[m].sum(), p[m].sum()
            o0, e0 = m.sum() - o1, m.sum() - e1
            stat += (o1 - e1) ** 2 / e1 + (o0 - e0) ** 2 / e0
    r = mt.hosmer_lemeshow(df).first()
    assert r["hosmer_lemeshow_statistic"] == pytest.approx(stat)
    h = stat / 2
    assert r["hosmer_lemeshow_pvalue"] == pytest.approx(math.exp(-h) * sum(h ** k / math.factorial(k) for k in range(4)))


def test_threshold_table(spark):
    rows, df = frame(spark, 6)
    t = {round(r["threshold"], 2): r for r in mt.threshold_table(df).collect()}
    y = np.array([r[1] for r in rows])
    p = np.array([r[2] for r in rows])
    for th in (0.1, 0.3):
        sel = p >= th
        assert t[th]["precision"] == pytest.approx((sel & (y == 1)).sum() / sel.sum())
        assert t[th]["selected_fraction"] == pytest.approx(sel.mean())


def test_best_threshold_is_best(spark):
    rows, df = frame(spark, 7, ties=False)
    best = mt.best_threshold(df).first()
    y = np.array([r[1] for r in rows])
    p = np.array([r[2] for r in rows])
    f1s = []
    for j in range(1, 100):
        sel = p >= j / 100
        tp = (sel & (y == 1)).sum()
        prec = tp / sel.sum() if sel.sum() else 0
        rec = tp / (y == 1).sum()
        f1s.append(2 * prec * rec / (prec + rec) if prec + rec else 0)
    assert best["f1"] == pytest.approx(max(f1s))
