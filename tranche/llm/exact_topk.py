"""Exact top-k by inner product: norm-bucketed retrieval (operator 10).

Vectors are put in order of length and cut into blocks.  A block is looked at
by a block of queries at a time.  Each query knows a score its k-th best result
reaches at least; divided by its own length and the block's largest length it
becomes a cosine that a candidate must reach.  Above 1 the block is skipped.
A high cosine prunes by coordinates (each focus coordinate of the query limits
that coordinate of a candidate), a low one by length (only the vectors long
enough).  Products of the survivors are then taken exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, stored
from .vectors import matrix, usable

K = 10
SCALE = 1024
BLOCK = 2048             # vectors in a block
QUERIES = 512            # queries in a block
BLOCKS_PER_TASK = 8
SEEDS = 1024             # longest vectors, which give every query its first threshold
COORDINATE_FROM = 0.5    # local cosine from which coordinates prune
FOCUS = 3                # coordinates looked at
LIMIT = 2**63 - 1


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products: in double precision where every partial sum is
    exact, else in Python integers, held to the range of long."""
    if not len(rows):
        return np.empty(0, np.int64)
    bound = float(np.abs(rows).max()) * float(np.abs(q).max()) * rows.shape[1]
    if bound < 2**52:
        return np.rint(rows @ q).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in rows], object) @ np.array([int(x) for x in q], object)
    return np.array([min(max(int(x), -LIMIT - 1), LIMIT) for x in exact], np.int64)


def survivors(unit: np.ndarray, lengths: np.ndarray, q: np.ndarray, q_length: float, least: float) -> np.ndarray:
    """Positions (rows in order of falling length) that may score ``least``."""
    n = len(lengths)
    if least == -np.inf or not n:
        return np.arange(n)
    if q_length == 0 or lengths[0] == 0:
        return np.arange(n) if least <= 0 else np.arange(0)
    slack = 1e-9
    t = least / (q_length * lengths[0])
    if t > 1 + slack:
        return np.arange(0)
    if t < COORDINATE_FROM:                  # by length: prefix of the block
        return np.arange(n if least <= 0 else np.searchsorted(-lengths, -(least / q_length) * (1 - slack), side="right"))
    t = min(t, 1.0)
    u = q / q_length
    keep = None
    for f in np.argsort(-np.abs(u))[:FOCUS]:
        # cos >= t needs u_f p_f + sqrt((1 - u_f^2)(1 - p_f^2)) >= t
        half = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f])))
        low = u[f] * t - half if u[f] > -t else -1.0
        high = u[f] * t + half if u[f] < t else 1.0
        column = unit[:, f] if keep is None else unit[keep, f]
        inside = np.flatnonzero((column >= low - slack) & (column <= high + slack))
        keep = inside if keep is None else keep[inside]
    return keep


def _pack(rows: DataFrame, size: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each partition, in their order, as blocks of ``size``: one row
    per block with its members as arrays."""
    names = ["uid", "vec_id", "length", *extra]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        held, part, made = [], TaskContext.get().partitionId(), 0

        def block(t):
            n = t.num_rows
            arrays = [pa.array([part * (1 << 31) + made], pa.int64())]
            for c in names:
                arrays.append(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), t[c].combine_chunks()))
            flat = t["vec"].combine_chunks().flatten()
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
            return pa.RecordBatch.from_arrays(arrays, ["block", *names, "flat"])

        rest = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            while rest.num_rows >= size:
                yield block(rest.slice(0, size))
                rest, made = rest.slice(size), made + 1
        if rest is not None and rest.num_rows:
            yield block(rest)

    return rows.select("uid", "vec_id", "length", *extra, "vec").mapInArrow(
        run, "block long, " + ", ".join(f"{c} array<{kinds[c]}>" for c in names) + ", flat array<double>")


def top_products(df: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k highest integer
    products with every other row, ties to smaller ids (then input order).

    Components become floor(scale * x).  Rows that ``usable`` leaves out take
    no part; a repeated id is a row of its own, as query and as candidate.
    Fewer than k other rows: all of them.  Scores beyond long are held to its
    range.  No usable row: no rows.
    """
    whole = usable(df).withColumn("vec", F.transform("vec", lambda c: F.floor(c * scale).cast("double")))
    rows = stored(whole.withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, c: a + c * c)))
                  .withColumn("is_query", F.coalesce(is_query, F.lit(False))), "products")
    kind = rows.schema["vec_id"].dataType.simpleString()
    result = f"query_uid long, query_id {kind}, uid long, vec_id {kind}, score long"
    seeds = rows.orderBy(F.desc("length"), "uid").limit(SEEDS).select("uid", "vec_id", "vec").toArrow()   # bounded
    seed_uid = seeds["uid"].to_numpy()
    seed_rows = matrix(seeds["vec"].combine_chunks())

    def bounds(batches):
        for b in batches:
            least = []
            for uid, q in zip(b.column("uid").to_pylist(), matrix(b.column("vec"))):
                s = products(seed_rows, q)[seed_uid != uid]
                least.append(float(np.sort(s)[-k]) if len(s) >= k else -np.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.float64())], [*b.schema.names, "least"])

    queries = rows.where("is_query").select("uid", "vec_id", "length", "vec").mapInArrow(
        bounds, f"uid long, vec_id {kind}, length double, vec array<double>, least double")
    q_blocks = stored(_pack(queries, QUERIES, ("least",)), "query-blocks")
    v_blocks = stored(_pack(rows.drop("is_query").repartitionByRange(F.desc("length"), "uid").sortWithinPartitions(F.desc("length"), "uid"), BLOCK), "vector-blocks")

    # every pair of a query block and a slot of vector blocks is one group
    slots = max(1, -(-v_blocks.count() // BLOCKS_PER_TASK))
    numbers = [r["block"] for r in q_blocks.select("block").collect()]   # one number per 512 queries
    left = v_blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).withColumn(
        "q", F.explode(F.array([F.lit(b) for b in numbers]))) if numbers else v_blocks.where("false").withColumn("slot", F.lit(0)).withColumn("q", F.lit(0).cast("long"))
    right = q_blocks.withColumnRenamed("block", "q").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if vectors.num_rows and queries.num_rows:
            blocks = []
            for r in range(vectors.num_rows):
                uid, ids, lengths, flat = (vectors[c][r].values.to_numpy(zero_copy_only=False) for c in ("uid", "vec_id", "length", "flat"))
                raw = flat.reshape(len(uid), -1)
                blocks.append((uid, ids, lengths, raw, raw / np.maximum(lengths, 1e-300)[:, None]))
            blocks.sort(key=lambda b: -b[2][0])
            for r in range(queries.num_rows):
                q_uid, q_id, q_len, q_least, q_flat = (queries[c][r].values.to_numpy(zero_copy_only=False) for c in ("uid", "vec_id", "length", "least", "flat"))
                q_rows = q_flat.reshape(len(q_uid), -1)
                for j in range(len(q_uid)):
                    least, best = q_least[j], None
                    for uid, ids, lengths, raw, unit in blocks:
                        at = survivors(unit, lengths, q_rows[j], q_len[j], least)
                        at = at[uid[at] != q_uid[j]]
                        if not len(at):
                            continue
                        found = (products(raw[at], q_rows[j]), ids[at], uid[at])
                        best = found if best is None else tuple(np.concatenate(p) for p in zip(best, found))
                        keep = np.lexsort((best[2], best[1], -best[0]))[:k]
                        best = tuple(p[keep] for p in best)
                        if len(best[0]) == k:
                            least = max(least, float(best[0][-1]))
                    if best is not None:
                        for column, values in zip(out, (np.full(len(best[0]), q_uid[j]), np.full(len(best[0]), q_id[j]), best[2], best[1], best[0])):
                            column.append(values)
        names = ["query_uid", "query_id", "uid", "vec_id", "score"]
        types = [pa.int64(), vectors.schema.field("vec_id").type.value_type, pa.int64(), vectors.schema.field("vec_id").type.value_type, pa.int64()]
        return pa.table({n: pa.array(np.concatenate(c) if c else [], t) for n, c, t in zip(names, out, types)})

    found = left.groupBy("q", "slot").cogroup(right.groupBy("q", "slot")).applyInArrow(search, result)
    return best_of(found, k, "long")


def best_of(found: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best of the results that tasks found for each query."""
    rank = F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(kind).alias("score")))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: ids divisible by 100, against all rows of embeddings."""
    return top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(CAST(1024 AS DOUBLE) * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
