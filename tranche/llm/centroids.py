"""Centroid clustering of integer vectors with equal-average equal-variance search.

For a vector x and a centroid c of d components, with S the sum of the
components and D = sqrt(d * sum((component - mean) ** 2)),

    d * distance >= (Sx - Sc) ** 2                     (equal averages)
    d * distance >= (Sx - Sc) ** 2 + (Dx - Dc) ** 2    (and equal variances)

Centroids lie sorted by S.  Each vector starts between its two neighbours in
that order and goes outward, always to the nearer mean: once the first
inequality rules out a centroid, it rules out all that are left.  The second
one spares single centroids.  What neither rejects is measured in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: vectors searched at a time
BLOCK = 8192
#: integers up to this size keep every squared distance inside a long
LARGEST = 1 << 27
_FAR = np.iinfo(np.int64).max


class Centroids:
    """Integer centroids sorted by the sum of their components."""

    def __init__(self, points: np.ndarray):
        self.points = points
        order = np.argsort(points.sum(axis=1), kind="stable")
        self.number = order
        self.sorted = points[order]
        self.sums = self.sorted.sum(axis=1)
        self.spread = deviations(self.sorted)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row
        (ties: the smaller number), in exact integers."""
        n, d = x.shape
        k = len(self.points)
        best, who = np.full(n, _FAR), np.full(n, k)
        sums, spread = x.sum(axis=1), deviations(x)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        live = np.arange(n)
        while len(live):
            lo, hi, s = low[live], high[live], sums[live]
            below = np.where(lo >= 0, s - self.sums[lo], _FAR)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, _FAR)
            down = below <= above
            gap = np.where(down, below, above)
            squared = gap.astype(float) ** 2 * (1 - 1e-12)
            within = (gap < _FAR) & (squared <= d * best[live].astype(float))
            live, down, squared = live[within], down[within], squared[within]
            at = np.where(down, low[live], high[live])
            low[live] -= down
            high[live] += ~down
            apart = np.abs(spread[live] - self.spread[at])
            apart = np.maximum(apart - 1e-12 * (spread[live] + self.spread[at]), 0)
            close = squared + apart * apart * (1 - 1e-12) <= d * best[live].astype(float)
            rows, at = live[close], at[close]
            step = x[rows] - self.sorted[at]
            distance = np.einsum("ij,ij->i", step, step)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < who[rows]))
            best[rows[better]], who[rows[better]] = distance[better], number[better]
        return who, best


def deviations(x: np.ndarray) -> np.ndarray:
    """sqrt(d * sum((component - mean) ** 2)) of each row."""
    centred = x - x.mean(axis=1, keepdims=True)
    return np.sqrt(x.shape[1] * np.einsum("ij,ij->i", centred, centred))


def integers(batch: pa.RecordBatch, dims: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and floor(scale * component) of the vectors that are kept: exactly
    ``dims`` components, none of them null or non-finite."""
    ids, lists = batch.column(0), batch.column(1)
    whole = pc.equal(pc.fill_null(pc.list_value_length(lists), -1), dims)
    ids, lists = ids.filter(whole), lists.filter(whole)
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    finite = np.isfinite(x).all(axis=1)
    if not finite.all():
        ids, x = ids.filter(pa.array(finite)), x[finite]
    with np.errstate(over="ignore"):
        q = np.floor(x * scale)
    if len(q) and np.abs(q).max() > LARGEST:
        raise ArithmeticError(f"a component times {scale} exceeds {LARGEST}: squared distances may leave the range of a long")
    return ids, q.astype(np.int64)


def blocks(batches, dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            yield integers(batch.slice(lo, BLOCK), dims, scale)


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, seed: int) -> np.ndarray:
    """The k kept vectors with the smallest SHA-256 of ``seed:id`` (null ids
    last; equal ids by their components).  A top-k of at most k rows."""
    def run(batches):
        for ids, q in blocks(batches, dims, scale):
            yield pa.RecordBatch.from_arrays([ids, pa.array(list(q), pa.list_(pa.int64()))], ["id", "q"])

    kind = vectors.schema["id"].dataType.simpleString()
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = (vectors.mapInArrow(run, f"id {kind}, q array<long>")
            .orderBy(named.asc_nulls_last(), "q").limit(k).collect())
    return np.array([r.q for r in rows], np.int64).reshape(-1, dims)


def updated(vectors: DataFrame, centroids: Centroids, dims: int, scale: int) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; centroids
    without vectors stay.  A task sends k rows of sums, whatever it reads."""
    k = len(centroids.points)

    def run(batches):
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, q in blocks(batches, dims, scale):
            who, _ = centroids.nearest(q)
            order = np.argsort(who, kind="stable")
            present, start = np.unique(who[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(q[order], start, axis=0)
                count += np.bincount(who, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k), pa.int32()), pa.array(count), pa.array(list(total), pa.list_(pa.int64()))],
            ["cluster", "n", "total"])

    sums = (vectors.mapInArrow(run, "cluster int, n long, total array<long>")
            .select("cluster", "n", F.posexplode("total").alias("at", "total"))
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("n > 0").toArrow())
    points = centroids.points.copy()
    c, at, n, total = (sums[i].to_numpy() for i in range(4))
    points[c, at] = total // n
    return points


def assigned(vectors: DataFrame, centroids: Centroids, dims: int, scale: int) -> DataFrame:
    """id, cluster, distance of every kept vector; a narrow map."""
    def run(batches):
        for ids, q in blocks(batches, dims, scale):
            who, distance = centroids.nearest(q)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster_vectors(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
                    vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Clusters of the vectors of ``df``: a table of ``vec_id``, cluster,
    distance, cluster_inertia, inertia, centroid_sha256 with a row per kept
    vector, and the final centroids.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    null vectors are not.  A null id is kept and comes last among the first
    centroids.  Equal ids and equal vectors count as often as they occur.
    With fewer than ``k`` kept vectors all of them are centroids; without
    any, the result has no rows.  Other columns are not read.  A component
    whose integer exceeds 2 ** 27 raises, since distances would not fit.

    Each round reads the vectors once and sends k rows of sums a task; only
    the k centroids reach the driver.
    """
    vectors = df.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("vec"))
    points = first_centroids(vectors, k, dims, scale, seed)
    if len(points):
        for _ in range(rounds):
            points = updated(vectors, Centroids(points), dims, scale)
    # one row where there are none, so that the (empty) plan stays the same
    found = assigned(vectors, Centroids(points if len(points) else np.zeros((1, dims), np.int64)), dims, scale)
    inertia = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    rows = [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest())
            for c, p in enumerate(points)]
    per = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(per), "cluster").select(   # k rows
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out, points


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of embeddings: 16 clusters, three rounds."""
    return cluster_vectors(read(spark, sf_dir, "embeddings"))[0]


def _assign_sql(step: int) -> str:
    return f"""d{step} AS (
  SELECT v.uid, c.cluster, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.q, c.q)]) AS BIGINT) AS distance
  FROM v CROSS JOIN c{step} c
), a{step} AS (
  SELECT uid, cluster, distance FROM d{step}
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY distance, cluster) = 1
)"""


def _update_sql(step: int) -> str:
    return f"""m{step} AS (
  SELECT cluster, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
  FROM (SELECT a.cluster, unnest(v.q) AS x, generate_subscripts(v.q, 1) AS i FROM a{step} a JOIN v USING (uid))
  GROUP BY cluster, i
), c{step + 1} AS (
  SELECT c.cluster, CASE WHEN m.q IS NULL THEN c.q ELSE m.q END AS q
  FROM c{step} c LEFT JOIN (
    SELECT cluster, list((CASE WHEN total < 0 AND total % n <> 0 THEN total // n - 1 ELSE total // n END) ORDER BY i) AS q
    FROM m{step} GROUP BY cluster) m USING (cluster)
)"""


OP12_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, [CAST(floor(CAST(64 AS DOUBLE) * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), q) - 1 AS cluster, q FROM v
  QUALIFY cluster < 16
), {_assign_sql(0)}, {_update_sql(0)}, {_assign_sql(1)}, {_update_sql(1)}, {_assign_sql(2)}, {_update_sql(2)}, {_assign_sql(3)}
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a3 a JOIN v USING (uid) JOIN c3 c USING (cluster)
"""
