"""Helpers for one-row results (scalar aggregates)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Put one-row DataFrames side by side (equi-join on a constant key;
    every input has exactly one row, so the result has one row)."""
    keyed = [f.withColumn("_one", F.lit(1)) for f in frames]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")


def scalars(frame: DataFrame) -> dict:
    """The single row of a one-row aggregate as Python values (bounded)."""
    return frame.first().asDict()
