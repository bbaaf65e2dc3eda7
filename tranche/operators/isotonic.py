"""Distributed isotonic regression by pooling adjacent violators.

Rows of equal scores are one weighted point.  Points are dealt to ranges of
the score, and each range pools its own violators into blocks.  A block whose
mean lies above no later range's lowest block and below no earlier range's
highest one can never be pooled again; it leaves.  The others, near the
borders as a rule, meet in the next round, where ``FAN`` neighbouring ranges
are one.  Pooling blocks gives what pooling their points would (in whatever
order violators are pooled, the solution is the same), so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import materialize
from .prefix import in_buckets

#: ranges that meet in a later round
FAN = 32
_BLOCK = "_range int, first double, last double, total double, n double"


def pool(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Start of each block after pooling adjacent violators of total / n."""
    start, sums, weights = [], [], []
    for i, (t, w) in enumerate(zip(total.tolist(), n.tolist())):
        at = i
        # a mean that does not exceed the block before joins it
        while start and sums[-1] * w >= t * weights[-1]:
            t, w, at = t + sums.pop(), w + weights.pop(), start.pop()
        start.append(at)
        sums.append(t)
        weights.append(w)
    return np.array(start, np.int64)


def _pooled(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("first", kind="stable")
    start = pool(rows["total"].to_numpy(), rows["n"].to_numpy())
    if not len(start):
        return rows[["_range", "first", "last", "total", "n"]]
    end = np.append(start[1:], len(rows)) - 1
    return pd.DataFrame({"_range": rows["_range"].to_numpy()[start], "first": rows["first"].to_numpy()[start], "last": rows["last"].to_numpy()[end],
                         "total": np.add.reduceat(rows["total"].to_numpy(), start), "n": np.add.reduceat(rows["n"].to_numpy(), start)})


def _open(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``_in_play``: a block of another range may pool with it.
    The bounds are a running maximum and minimum over one row per range."""
    mean = F.col("total") / F.col("n")
    per = blocks.groupBy("_range").agg(F.max(mean).alias("_high"), F.min(mean).alias("_low"))
    w = Window.orderBy("_range")
    bounds = per.select("_range", F.max("_high").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                        F.min("_low").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    clash = F.coalesce(F.col("_before") >= mean, F.lit(False)) | F.coalesce(F.col("_after") <= mean, F.lit(False))
    return blocks.join(bounds, "_range").withColumn("_in_play", clash).drop("_before", "_after")


def isotonic_blocks(df: DataFrame, score: str, label: str, weight: str | None = None, ranges: int | None = None) -> DataFrame:
    """first, last, value, n of each block of the increasing least-squares fit
    of ``label`` on ``score`` (missing scores and labels take no part)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    points = (df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
              .groupBy(F.col(score).cast("double").alias("first"))
              .agg(F.sum(F.col(label).cast("double") * w).alias("total"), F.sum(w).alias("n")).where("n > 0"))
    dealt = in_buckets(points.withColumn("last", F.col("first")), ["first"], ranges).withColumnRenamed("_bucket", "_range")
    blocks = materialize(dealt.select("_range", "first", "last", "total", "n").groupBy("_range").applyInPandas(_pooled, _BLOCK), "isotonic-ranges")
    done: list[DataFrame] = []
    while True:
        marked = materialize(_open(blocks), "isotonic-blocks")
        done.append(marked.where(~F.col("_in_play")))
        rest = marked.where("_in_play").drop("_in_play")
        if not rest.limit(1).count():
            break
        # neighbours of a block that left are never pooled across it: its mean
        # lies between theirs, so a gap in the sequence changes nothing
        wider = rest.withColumn("_range", F.floor(F.col("_range") / FAN).cast("int"))
        blocks = materialize(wider.groupBy("_range").applyInPandas(_pooled, _BLOCK), "isotonic-ranges")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("first", "last", (F.col("total") / F.col("n")).alias("value"), "n")


class IsotonicModel:
    """Steps of a fit; between two blocks the value runs linearly, beyond the
    ends it stays."""

    def __init__(self, boundaries: np.ndarray, values: np.ndarray):
        self.boundaries, self.values = boundaries, values

    @classmethod
    def fit(cls, df: DataFrame, score: str, label: str, weight: str | None = None, ranges: int | None = None) -> "IsotonicModel":
        # the model itself: two numbers per block
        rows = isotonic_blocks(df, score, label, weight, ranges).toPandas().sort_values("first")
        ends = np.stack([rows["first"].to_numpy(), rows["last"].to_numpy()], axis=1)
        keep = np.stack([np.ones(len(rows), bool), ends[:, 0] != ends[:, 1]], axis=1)
        return cls(ends[keep], np.repeat(rows["value"].to_numpy(), 2).reshape(-1, 2)[keep])

    def predict(self, score) -> "F.Column":
        x, y = self.boundaries, self.values

        @pandas_udf("double")
        def interpolated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                v = np.interp(s.astype(float), x, y) if len(x) else np.full(len(s), np.nan)
                yield pd.Series(v).where(s.notna().to_numpy(), None)

        return interpolated(F.col(score).cast("double"))
