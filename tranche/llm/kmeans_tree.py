"""Approximate nearest neighbours: hierarchical k-means tree (operator 7).

The tree is fitted on a bounded sample and every vector is filed in a leaf.  A
query walks the tree best bin first: a priority queue holds the branches met,
the one whose centre is nearest is opened next, and leaves are visited until
their number reaches the widening that a calibration on sample queries, with
their exact neighbours among all vectors, found to give the asked recall.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stored
from .exact_topk import best_of
from .vectors import matrix, top, usable

K = 5
SAMPLE = 20_000          # vectors the tree is fitted on, the first in order of a hash
BRANCH = 8
LEAF_SAMPLE = 64         # a node with at most so many sample vectors is a leaf
CALIBRATION = 256        # sample queries for the widening
RECALL = 0.96            # asked of the sample queries
LEAF_ROWS = 8192         # vectors of a leaf in one group; larger leaves are split
LEAF_QUERIES = 2048


@dataclass
class Tree:
    centres: np.ndarray          # unit centre of each node
    children: list[np.ndarray]   # node numbers; empty for a leaf

    def file(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each row: at each level the child with the nearest centre."""
        at = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not len(kids) or not len(rows):
                at[rows] = node
                continue
            pick = np.argmax(unit[rows] @ self.centres[kids].T, axis=1)
            todo += [(int(k), rows[pick == j]) for j, k in enumerate(kids)]
        return at

    def walk(self, q: np.ndarray):
        """Leaves, best bin first."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heappop(heap)
            kids = self.children[node]
            if not len(kids):
                yield node
                continue
            for k, near in zip(kids.tolist(), (self.centres[kids] @ q).tolist()):
                heappush(heap, (-near, k))


def grow(unit: np.ndarray, seed: int = 1, rounds: int = 12) -> Tree:
    """Spherical k-means, node by node, until nodes are small or all alike."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, unit.shape[1])), [np.empty(0, np.int64)])
    todo = [(0, unit)]
    while todo:
        node, x = todo.pop()
        if len(x) <= LEAF_SAMPLE:
            continue
        c = x[rng.choice(len(x), BRANCH, replace=False)]
        for _ in range(rounds):
            pick = np.argmax(x @ c.T, axis=1)
            c = np.array([m / (np.linalg.norm(m) or 1) if len(y := x[pick == j]) and np.any(m := y.sum(0)) else c[j] for j in range(BRANCH)])
        pick = np.argmax(x @ c.T, axis=1)
        parts = [j for j in range(BRANCH) if np.any(pick == j)]
        if len(parts) < 2:
            continue
        first = len(tree.children)
        tree.centres = np.vstack([tree.centres, c[parts]])
        tree.children += [np.empty(0, np.int64) for _ in parts]
        tree.children[node] = np.arange(first, first + len(parts))
        todo += [(first + k, x[pick == j]) for k, j in enumerate(parts)]
    return tree


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that
    neither very large nor very small finite values overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Index:
    rows: DataFrame      # uid, vec_id, vec, leaf, is_query: every usable row
    tree: Tree
    sizes: dict[int, int]
    visits: int


def build(df: DataFrame, is_query, k: int = K, recall: float = RECALL) -> Index | None:
    """File every usable row and calibrate; None if there is no usable row.

    On the driver: the sample, the sample queries with their exact
    neighbours, and one size per leaf; each is bounded by a parameter.
    """
    rows = usable(df, zero=False).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    rows = stored(rows, "vectors")
    order = F.xxhash64("vec_id", "uid")
    sample = rows.orderBy(order, "uid").limit(SAMPLE).select("vec").toArrow()
    if not sample.num_rows:
        return None
    tree = grow(unit_rows(matrix(sample["vec"].combine_chunks())))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def place(batches):
        for b in batches:
            if b.num_rows:
                leaf = tree.file(unit_rows(matrix(b.column("vec"))))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], [*b.schema.names, "leaf"])

    filed = stored(rows.mapInArrow(place, f"uid long, vec_id {kind}, vec array<double>, is_query boolean, leaf int"), "filed")
    sizes = {r["leaf"]: r["count"] for r in filed.groupBy("leaf").count().collect()}
    return Index(filed, tree, sizes, calibrate(filed, tree, sizes, k, recall))


def calibrate(filed: DataFrame, tree: Tree, sizes: dict[int, int], k: int, recall: float) -> int:
    """Fewest leaves whose visit finds ``recall`` of the sample queries' exact
    neighbours, taken over all rows."""
    picked = filed.where("is_query").orderBy(F.xxhash64(F.lit(9), "uid"), "uid").limit(CALIBRATION).select("uid", "vec").toArrow()
    if not picked.num_rows:
        return 1
    q_uid, q = picked["uid"].to_numpy(), unit_rows(matrix(picked["vec"].combine_chunks()))

    def near(batches):
        for b in batches:
            if not b.num_rows:
                continue
            s = unit_rows(matrix(b.column("vec"))) @ q.T
            uid, leaf = b.column("uid").to_numpy(), b.column("leaf").to_numpy()
            out = []
            for j in range(len(q_uid)):
                at = np.flatnonzero(uid != q_uid[j])
                at = at[top(s[at, j], uid[at], k)]
                out.append((np.full(len(at), j), s[at, j], leaf[at], uid[at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_uid", "score", "leaf", "uid"])

    found = filed.mapInArrow(near, "query_uid long, score double, leaf int, uid long")
    best = found.groupBy("query_uid").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "uid", "leaf")), False), 1, k).alias("best"))
    need = []
    for r in best.collect():
        place = {leaf: i + 1 for i, leaf in enumerate(tree.walk(q[r["query_uid"]]))}
        need += [place[x["leaf"]] for x in r["best"]]
    return int(np.sort(need)[max(0, int(np.ceil(recall * len(need))) - 1)]) if need else 1


def search(index: Index, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score (cosine of the original vectors in double
    precision) of the k nearest found, ties to smaller ids."""
    tree, sizes, visits, rows = index.tree, index.sizes, index.visits, index.rows
    kind = rows.schema["vec_id"].dataType.simpleString()
    # groups of bounded size: a large leaf is split, its queries go to each part
    parts = {leaf: -(-n // LEAF_ROWS) for leaf, n in sizes.items()}

    def route(batches):
        for b in batches:
            at, leaf, part = [], [], []
            for i, q in enumerate(unit_rows(matrix(b.column("vec"))) if b.num_rows else []):
                seen = met = 0
                for x in tree.walk(q):
                    if x in sizes:
                        at += [i] * parts[x]
                        leaf += [x] * parts[x]
                        part += range(parts[x])
                        met += sizes[x]
                    seen += 1
                    if seen >= visits and met > k:
                        break
            idx = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").take(idx), b.column("vec_id").take(idx), b.column("vec").take(idx), pa.array(leaf, pa.int32()), pa.array(part, pa.int32())],
                ["uid", "vec_id", "vec", "leaf", "part"])

    routed = stored(rows.where("is_query").select("uid", "vec_id", "vec").mapInArrow(
        route, f"uid long, vec_id {kind}, vec array<double>, leaf int, part int"), "routed")
    # a (leaf, part) with many queries is split on their side as well
    shares = routed.groupBy("leaf", "part").count().select("leaf", "part", F.ceil(F.col("count") / LEAF_QUERIES).cast("int").alias("shares"))
    queries = routed.join(shares, ["leaf", "part"]).withColumn("share", F.pmod(F.xxhash64("uid"), F.col("shares")).cast("int")).drop("shares")
    spark = rows.sparkSession
    n_parts = spark.createDataFrame(list(parts.items()), "leaf int, parts int")    # one row per leaf of the fitted tree
    vectors = (rows.join(F.broadcast(n_parts), "leaf").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
               .join(shares, ["leaf", "part"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
               .select("uid", "vec_id", "vec", "leaf", "part", "share"))

    def nearest(c: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if c.num_rows and q.num_rows:
            x, ids, uid = matrix(c["vec"].combine_chunks()), c["vec_id"].to_numpy(), c["uid"].to_numpy()
            y, q_ids, q_uid = matrix(q["vec"].combine_chunks()), q["vec_id"].to_numpy(), q["uid"].to_numpy()
            approx = unit_rows(y) @ unit_rows(x).T
            for j in range(len(y)):
                at = np.flatnonzero(uid != q_uid[j])
                at = at[top(approx[j, at], ids[at], 4 * k)]
                score = cosines(x[at], y[j])
                pick = np.lexsort((uid[at], ids[at], -score))[:k]
                for column, values in zip(out, (np.full(len(pick), q_uid[j]), np.full(len(pick), q_ids[j]), uid[at][pick], ids[at][pick], score[pick])):
                    column.append(values)
        names = ["query_uid", "query_id", "uid", "vec_id", "score"]
        types = [pa.int64(), c.schema.field("vec_id").type, pa.int64(), c.schema.field("vec_id").type, pa.float64()]
        return pa.table({n: pa.array(np.concatenate(v) if v else [], t) for n, v, t in zip(names, out, types)})

    keys = ("leaf", "part", "share")
    found = vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        nearest, f"query_uid long, query_id {kind}, uid long, vec_id {kind}, score double")
    return best_of(found, k, "double")


def cosines(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines in double precision; scaled rows where squares would overflow
    or vanish."""
    def plain(rows, q):
        return rows @ q / (np.sqrt((rows * rows).sum(1)) * np.sqrt(q @ q))
    with np.errstate(all="ignore"):
        big = max(np.abs(rows).max(initial=0), np.abs(q).max(initial=0))
        small = min(np.abs(rows).max(axis=1).min(initial=1), np.abs(q).max(initial=1))
        return plain(rows, q) if big < 1e100 and small > 1e-100 else unit_rows(rows) @ unit_rows(q[None])[0]


def nearest_neighbours(df: DataFrame, is_query, k: int = K, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k nearest other rows
    found, by cosine.

    Null ids and null, empty, zero or non-finite vectors take no part; a
    repeated id is a row of its own.  With fewer than k other rows all are
    returned: a walk goes on until it has met more than k rows.  No usable
    row, or no query: no rows.
    """
    index = build(df, is_query, k, recall)
    if index is None:
        kind = df.schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    return search(index, k)


def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: ids divisible by 50, against all rows of embeddings."""
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
