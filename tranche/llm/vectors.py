"""Vector tables: which rows take part, and Arrow access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", zero: bool = True) -> DataFrame:
    """uid, vec_id, vec (array<double>) of the rows that take part.

    Null ids, null or empty vectors and vectors with null or non-finite
    components do not; nor do zero vectors where ``zero`` is False.  Vectors
    of another length than the most frequent one (the longer, if tied) cannot
    be compared with the others and are left out too.
    """
    v = F.col(embedding).cast("array<double>")
    x = df.select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).alias("vec_id"), v.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    if not zero:
        x = x.where(F.exists("vec", lambda c: c != 0))
    dims = x.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return x.where(F.size("vec") == dims[0]["n"]) if dims else x


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    n = len(col)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]
