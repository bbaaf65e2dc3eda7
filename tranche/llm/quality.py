"""Quality classifier: a factorisation machine (operator 9).

Inputs of a score are hashed words of the whole text, structure statistics of
the text and the ``n_chars`` metadata, each statistic as one of ten quantile
bins.  The pairwise interactions are low-rank and are scored in linear time
with the sum-of-squares identity.  The machine is fitted on the driver on a
bounded sample of labelled rows; scoring is a narrow map over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, utf8
from .features import STATISTICS, text_features

BUCKETS = 1 << 14
BINS = 10
RANK = 8
MAX_TRAIN = 12_000       # labelled rows used to fit, the first in order of a hash of doc_id
VISITS = 120_000         # rows visited in fitting, over at least MIN_EPOCHS passes
MIN_EPOCHS = 8
BATCH = 128
THRESHOLD = 0.3
FOLDS = 5
#: text bytes turned into features at a time; temporaries are 30 times as large
WIDE_SLICE = 512 << 10


@dataclass
class FactorisationMachine:
    edges: np.ndarray     # inner bin edges of each statistic, then of n_chars
    bias: float
    linear: np.ndarray    # one weight per input
    factors: np.ndarray   # RANK factors per input

    @property
    def inputs(self) -> int:
        return BUCKETS + len(self.edges) * (BINS + 1)


def one_hot(edges: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Input number of each statistic's bin; a missing value has bin ``BINS``."""
    out = np.empty(stats.shape, np.int64)
    for j, e in enumerate(edges):
        b = np.searchsorted(e, stats[:, j], side="right")
        out[:, j] = BUCKETS + j * (BINS + 1) + np.where(np.isnan(stats[:, j]), BINS, b)
    return out


def assemble(edges, stats, owner, bucket, weight):
    """Inputs of all rows laid end to end: owner row, input number, value."""
    n, m = stats.shape
    o = np.concatenate([owner, np.repeat(np.arange(n), m)])
    i = np.concatenate([bucket, one_hot(edges, stats).ravel()])
    x = np.concatenate([weight, np.full(n * m, 1 / np.sqrt(m))])
    order = np.argsort(o, kind="stable")
    return o[order], i[order], x[order]


def raw_scores(fm: FactorisationMachine, n: int, o, i, x):
    """bias + linear part + half of (square of sums - sum of squares), and the
    sums, which the gradient needs.  Every row has at least one input."""
    at = np.searchsorted(o, np.arange(n))
    vx = fm.factors[i] * x[:, None]
    sums = np.add.reduceat(vx, at, axis=0)
    squares = np.add.reduceat((vx * vx).sum(1), at)
    return fm.bias + np.add.reduceat(fm.linear[i] * x, at) + 0.5 * ((sums * sums).sum(1) - squares), sums


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(stats: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 1) -> FactorisationMachine:
    """Adagrad on the logistic loss with a small squared penalty.  ``lists``
    holds each row's (buckets, weights).  Without two classes the score is the
    labels' mean (0.5 without labels)."""
    m = stats.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    edges = np.array([np.quantile(c, np.arange(1, BINS) / BINS) if len(c := stats[~np.isnan(stats[:, j]), j]) else np.zeros(BINS - 1) for j in range(m)])
    rng = np.random.default_rng(seed)
    size = BUCKETS + m * (BINS + 1)
    fm = FactorisationMachine(edges, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    if len(y) == 0 or y.min() == y.max():
        fm.factors[:] = 0
        return fm
    g_lin, g_fac, g_bias = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    epochs = max(MIN_EPOCHS, -(-VISITS // len(y)))
    for epoch in range(epochs):
        rate = 0.15 / (1 + 3 * epoch / epochs)
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo:lo + BATCH]
            k = len(rows)
            counts = [len(lists[r][0]) for r in rows]
            o, i, x = assemble(edges, stats[rows], np.repeat(np.arange(k), counts),
                               np.concatenate([lists[r][0] for r in rows]), np.concatenate([lists[r][1] for r in rows]))
            z, sums = raw_scores(fm, k, o, i, x)
            d = (sigmoid(z) - y[rows]) / k
            used, back = np.unique(i, return_inverse=True)
            dx = d[o] * x
            grad = np.bincount(back, dx, len(used)) + 1e-5 * fm.linear[used]
            g_lin[used] += grad * grad
            per = dx[:, None] * (sums[o] - fm.factors[i] * x[:, None])
            fac = np.column_stack([np.bincount(back, per[:, f], len(used)) for f in range(RANK)]) + 1e-5 * fm.factors[used]
            g_fac[used] += fac * fac
            fm.linear[used] -= rate * grad / np.sqrt(g_lin[used])
            fm.factors[used] -= rate * fac / np.sqrt(g_fac[used])
            g_bias += d.sum() ** 2
            fm.bias -= rate * d.sum() / np.sqrt(g_bias)
    return fm


def held_out(doc_id="doc_id"):
    """Rows never learnt from: CRC-32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _metadata(docs: DataFrame):
    """n_chars as a number; missing where the column is, or is not numeric."""
    if "n_chars" not in docs.columns:
        return F.lit(None).cast("double")
    return F.expr("try_cast(n_chars AS DOUBLE)")


def _statistics(batch: pa.RecordBatch, text: str, chars: str):
    data, offs = utf8(batch.column(text))
    stats, o, b, w = text_features(data, offs, BUCKETS)
    n = batch.column(chars).to_numpy(zero_copy_only=False).astype(float)
    return np.column_stack([stats, np.log1p(np.maximum(n, 0))]), o, b, w


def sample_features(docs: DataFrame, labelled: DataFrame, max_train: int):
    """Statistics, (buckets, weights) and labels of at most ``max_train``
    labelled rows; ``labelled`` has doc_id (unique, not null) and label.

    The sample is the first ids in the order of a hash.  Its ids are bounded
    by ``max_train`` and broadcast; only their rows are turned into features,
    and again at most ``max_train`` rows come to the driver."""
    order = F.xxhash64("doc_id")
    sample = labelled.orderBy(order, "doc_id").limit(max_train)

    def extract(batches):
        for b in slices(batches, limit=WIDE_SLICE):
            stats, o, k, w = _statistics(b, "text", "chars")
            cut = pa.array(np.searchsorted(o, np.arange(len(stats) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array(list(stats), pa.list_(pa.float64())),
                 pa.ListArray.from_arrays(cut, pa.array(k.astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(w.astype(np.float32)))],
                ["doc_id", "label", "stats", "buckets", "weights"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"), _metadata(docs).alias("chars"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", F.col("label").cast("int").alias("label"), "text", "chars")
            .mapInArrow(extract, f"doc_id {kind}, label int, stats array<double>, buckets array<int>, weights array<float>")
            .orderBy(order, "doc_id", F.xxhash64("stats")).limit(max_train).toArrow())
    if not rows.num_rows:
        return np.empty((0, len(STATISTICS) + 1)), [], np.empty(0, np.int64)
    stats, buckets, weights = (rows[c].combine_chunks() for c in ("stats", "buckets", "weights"))
    offs = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy())])
    k, w = buckets.flatten().to_numpy().astype(np.int64), weights.flatten().to_numpy().astype(float)
    return (stats.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1),
            [(k[x:z], w[x:z]) for x, z in zip(offs[:-1], offs[1:])], rows["label"].to_numpy())


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> FactorisationMachine:
    """Fit on at most ``max_train`` labelled rows that are not held out.  Null
    ids and labels are not used; an id labelled twice takes its larger label."""
    labelled = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
                .groupBy("doc_id").agg(F.max("quality").alias("label")))
    stats, lists, y = sample_features(docs, labelled, max_train)
    return fit(stats, lists, (y > 0).astype(float))


def text_column(docs: DataFrame, temp: str) -> tuple[DataFrame, str]:
    """``docs`` and the name of its text as a string: the column itself where
    it is one, so that a task never holds the texts twice."""
    if docs.schema["text"].dataType.simpleString() == "string":
        return docs, "text"
    return docs.withColumn(temp, F.col("text").cast("string")), temp


def with_scores(docs: DataFrame, fm: FactorisationMachine, out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 appended; a narrow map."""
    names, schema = docs.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{out}` double"
    x, text = text_column(docs, f"__text_{out}")
    chars = f"__chars_{out}"

    def run(batches):
        for b in slices(batches, text, WIDE_SLICE):
            stats, o, k, w = _statistics(b, text, chars)
            z, _ = raw_scores(fm, len(stats), *assemble(fm.edges, stats, o, k, w))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(sigmoid(z))], [*names, out])

    return x.withColumn(chars, _metadata(docs)).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) per row.

    Null and empty texts have zero statistics and get that score.  Repeated
    ids are scored row by row; a null id is not held out.  Labels, lang,
    source and doc_id are no inputs.  An empty table gives no rows.
    """
    fm = train(docs, labels)
    slim = docs.select("doc_id", "text", _metadata(docs).alias("n_chars"))
    return with_scores(slim, fm, "score").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learnt from the labels outside the held-out fold."""
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
