"""Gapless numbers within a key that no task has to hold whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_GROUP = 100_000


def rank_within(df: DataFrame, key: str, order: str, out: str = "rank", rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """0-based numbers of the rows of each non-null ``key``.

    Rows are salted by a hash of ``order`` (unique), numbered inside
    (key, salt), and shifted by the number of rows in the key's earlier salts;
    the salts grow with the table.  ``df`` is read three times: pass a stored
    table.
    """
    salts = max(1, -(-df.count() // rows_per_group))
    x = df.withColumn("__salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int"))
    shift = x.groupBy(key, "__salt").count().select(
        key, "__salt", (F.sum("count").over(Window.partitionBy(key).orderBy("__salt")) - F.col("count")).alias("__shift"))
    numbered = x.withColumn("__n", F.row_number().over(Window.partitionBy(key, "__salt").orderBy(order)) - 1)
    return (numbered.join(shift, [key, "__salt"])
            .select(*df.columns, (F.col("__n") + F.col("__shift")).cast("long").alias(out)))
