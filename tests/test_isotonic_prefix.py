"""Isotonic regression in ranges and two-level running sums against plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tranche.operators import isotonic as iso
from tranche.operators import prefix
from tranche.operators.calibration import IsotonicCalibrator


def plain(points):
    """Violators pooled one after another: {score: value}."""
    blocks = []
    for x in sorted(points):
        t, n = points[x]
        blocks.append([t, n, [x]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            t, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {x: t / n for t, n, xs in blocks for x in xs}


def _rows(seed, n, kind):
    rng = random.Random(seed)
    x = [round(rng.random(), 2 if kind == "ties" else 9) for _ in range(n)]
    chance = {"rising": lambda v: v, "falling": lambda v: 1 - v, "flat": lambda v: 0.5, "ties": lambda v: v * v}[kind]
    return [(v, int(rng.random() < chance(v))) for v in x]


@pytest.mark.parametrize("kind", ["rising", "falling", "flat", "ties"])
@pytest.mark.parametrize("ranges", [1, 40])
def test_equal_to_plain_pooling(spark, kind, ranges):
    rows = _rows(len(kind), 1500, kind) + [(None, 1), (0.5, None), (float("nan"), 1)]
    df = spark.createDataFrame(rows, "p double, label int")
    points = {}
    for x, y in rows:
        if x is not None and x == x and y is not None:
            t, n = points.get(x, (0, 0))
            points[x] = (t + y, n + 1)
    want = plain(points)
    blocks = iso.isotonic_blocks(df, "p", "label", ranges=ranges).collect()
    got = {x: b["value"] for b in blocks for x in points if b["first"] <= x <= b["last"]}
    assert got == pytest.approx(want) and sum(b["n"] for b in blocks) == sum(n for _, n in points.values())
    values = [b["value"] for b in sorted(blocks, key=lambda b: b["first"])]
    assert all(a < b for a, b in zip(values, values[1:]))


def test_calibrator_interpolates_and_keeps_the_ends(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (1.0, 0), (2.0, 0), (4.0, 1)], "margin double, label int")
    c = IsotonicCalibrator().fit(df)
    got = c.transform(spark.createDataFrame([(v,) for v in (-9.0, 0.5, 1.5, 3.0, 9.0, None)], "margin double"))
    # scores 1 and 2 are one block of mean 1/3
    assert [r["p_cal"] for r in got.collect()] == pytest.approx([0.0, 1 / 6, 1 / 3, 2 / 3, 1.0, None])
    assert len(iso.IsotonicModel.fit(df.limit(0), "margin", "label").values) == 0


@pytest.mark.parametrize("parts", [[], ["g"]])
def test_running_sums_over_many_buckets(spark, parts, monkeypatch):
    monkeypatch.setattr(prefix, "LEVEL", 4)
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.random(), i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, x double, id int, v int")
    got = {r["id"]: r["v_cum"] for r in prefix.running_sum(df, ["v"], ["x", "id"], parts, buckets=37, skew_safe=True).collect()}
    total, want = {}, {}
    for g, x, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        key = g if parts else 0
        total[key] = total.get(key, 0) + v
        want[i] = total[key]
    assert got == want


def test_buckets_follow_the_row_count(spark, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_BUCKET", 50)
    df = spark.range(1000).withColumn("x", F.rand(3))
    sizes = [r["count"] for r in prefix.in_buckets(df, ["x"]).groupBy("_bucket").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 200 and sum(sizes) == 1000
    n = sorted((r["k"], r["number"]) for r in prefix.numbered(df.withColumn("k", F.col("id") % 3), ["k"], ["x"]).collect())
    assert n == [(k, i) for k in range(3) for i in range(len([v for v in range(1000) if v % 3 == k]))]


def test_pool_joins_equal_means():
    assert iso.pool(np.array([1.0, 1.0, 3.0]), np.array([1.0, 1.0, 1.0])).tolist() == [0, 2]
