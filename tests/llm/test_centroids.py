import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tranche.llm.catalog import ORACLE, QUERIES
from tranche.llm.centroids import Centroids, cluster_vectors


def plain(rows, k, rounds, dims, scale):
    """Lloyd's rounds in Python integers over (id, vector) rows."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept)
    centroids = [q for _, _, q in named[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(q)[1] for _, q in kept]
        centroids = [[sum(col) // len(col) for col in zip(*m)] if (m := [q for (_, q), o in zip(kept, own) if o == n]) else c
                     for n, c in enumerate(centroids)]
    out = [(i, *nearest(q)[::-1]) for i, q in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for i, c, d in out]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(0, 2**31), st.sampled_from([1, 3, 100, 10**6]))
def test_search_finds_the_nearest_and_smaller_numbers_first(k, d, seed, size):
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-size, size + 1, (k, d)), rng.integers(-size, size + 1, (60, d))
    c[k // 2] = c[0]
    every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    who, distance = Centroids(c).nearest(x)
    assert (who == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_inequalities_spare_distances(monkeypatch):
    rng = np.random.default_rng(5)
    c = Centroids(rng.integers(-50, 50, (64, 16)) + np.arange(64)[:, None] * 40)
    measured = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda s, a, b: measured.append(len(a)) or einsum(s, a, b))
    c.nearest(c.points[rng.integers(0, 64, 500)] + rng.integers(-9, 9, (500, 16)))
    assert sum(measured[1:]) < 500 * 8


ODD = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [1.0, float("inf")]),
       (6, [None, 1.0]), (None, [2.0, 2.0]), (7, [0.0, 0.0]), (8, [-3.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, []), (11, [2.0, 2.0])]


def test_odd_rows_and_clashing_columns(spark):
    rows = [(i, v, "x", 7) for i, v in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, id int")
    for k in (1, 3, 50):
        got, points = cluster_vectors(df, k=k, dims=2)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(ODD, k, 3, 2, 64), key=str)
        assert len(points) == min(k, 6)
    empty, points = cluster_vectors(df.limit(0), dims=2)
    assert empty.collect() == [] and len(points) == 0 and empty.columns == got.columns
    with pytest.raises(Exception, match="range of a long"):
        cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dims=2)


def test_query_against_plain_rounds_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op12_centroids"](spark, sf).collect()))
    assert got == sorted(plain(rows, 16, 3, 64, 64))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    assert sorted(con.execute(ORACLE["op12_centroids"]).fetchall()) == got
