import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle_check import digest, duck
from tranche.llm.catalog import ORACLE, QUERIES
from tranche.llm.exact_topk import top_products
from tranche.llm.kmeans_tree import cosines, nearest_neighbours

SF = "/root/testdata/sf0.01"


def test_exact_topk_equals_sql(spark):
    got = [tuple(r) for r in QUERIES["op10_exact_topk"](spark, SF).collect()]
    res = duck(SF).execute(ORACLE["op10_exact_topk"])
    cols = [d[0] for d in res.description]
    assert digest(cols, got)[0] == digest(cols, res.fetchall())[0]


def brute_products(rows, k):
    out = []
    ok = [(u, i, [math.floor(1024 * x) for x in v]) for u, (i, v) in enumerate(rows)
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for u, i, v in ok:
        if i % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j, t) for t, j, w in ok if t != u)[:k]
            out += [(i, r + 1, j, -p) for r, (p, j, _) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_exact_topk_lengths_ties_and_bad_rows(spark, spread):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 6)) * np.exp(spread * rng.normal(size=(700, 1)))
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(1000, rows[5][1]), (1001, rows[5][1]), (1100, [0.0] * 6), (1200, None), (None, [1.0] * 6), (1300, [1.0, None, 0, 0, 0, 0]),
             (1400, [float("nan")] * 6), (1500, [float("inf")] * 6), (1600, [-3.0] * 6), (1700, [])]
    rows = [(i, None if v is None else [None if a is None else float(a) for a in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "vec_id long, embedding array<double>, label string, score double")
    got = sorted(tuple(r) for r in top_products(df, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_products(rows, 10)


def test_many_blocks_in_many_partitions(spark, monkeypatch):
    from tranche.llm import exact_topk, kmeans_tree
    for module, name, value in ((exact_topk, "BLOCK", 32), (exact_topk, "QUERIES", 4), (exact_topk, "BLOCKS_PER_TASK", 2), (exact_topk, "SEEDS", 16),
                                (kmeans_tree, "LEAF_ROWS", 20), (kmeans_tree, "LEAF_QUERIES", 3)):
        monkeypatch.setattr(module, name, value)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = np.random.default_rng(3)
        x = rng.normal(size=(1500, 5)) * np.exp(rng.normal(size=(1500, 1)))
        rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
        got = sorted(tuple(r) for r in top_products(df, F.col("vec_id") % 100 == 0).collect())
        assert got == brute_products(rows, 10)
        near = nearest_neighbours(df, F.col("vec_id") % 50 == 0).collect()
        assert len(near) == 30 * 5
        hit = 0
        for q in range(0, 1500, 50):
            s = cosines(x, x[q])
            s[q] = -2
            hit += len(set(np.argsort(-s)[:5].tolist()) & {r.vec_id for r in near if r.query_id == q})
        assert hit >= 0.9 * 150
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])], schema)
    assert [tuple(r) for r in top_products(three, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 1024 * 1024), (0, 2, 2, 0)]
    got = [tuple(r) for r in nearest_neighbours(three, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2)] and abs(got[0][3] - math.sqrt(0.5)) < 1e-12
    for rows in ([], [(None, [1.0])], [(1, None)], [(0, [0.0])]):
        df = spark.createDataFrame(rows, schema)
        assert nearest_neighbours(df, F.col("vec_id") % 50 == 0).collect() == []
    assert top_products(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).collect() == []


def test_tree_recall_and_scores(spark):
    """Held against brute force on the whole table of sf0.1."""
    sf = "/root/testdata/sf0.1"
    t = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in t]), np.array([r[1] for r in t], float)
    rows = QUERIES["op7_kmeans_tree"](spark, sf).collect()
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == [i for i in ids.tolist() if i % 50 == 0]
    hit = total = 0
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        s = cosines(x, x[ids == q][0])
        others = ids != q
        order = np.lexsort((ids[others], -s[others]))[:5]
        truth = set(ids[others][order].tolist())
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            assert abs(r.score - s[ids == r.vec_id][0]) < 1e-12 and r.vec_id != q
        hit += len(truth & {r.vec_id for r in found})
        total += 5
    assert hit / total >= 0.9


def test_tree_repeated_ids_and_hot_leaf(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(50, [1.0, 2.0, 3.0, 4.0])] * 200
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = nearest_neighbours(df, F.col("vec_id") == 50).collect()
    assert len(got) == 201 * 5 and all(r.score > 1 - 1e-12 for r in got if r["rank"] == 1 and r.vec_id == 50)
