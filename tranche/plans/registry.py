"""Registry of named queries: Spark callable + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (engines sum in different orders)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])
