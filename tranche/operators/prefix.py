"""Running sums and gapless numbers that scale (K1).

A plain window over a group puts the whole group in one task.  That is fine
for bounded groups (a selected portfolio, a table of bucket totals) and is
what ``running_sum(..., partition_by=..., skew_safe=False)`` does.

For unbounded groups (one global order, such as the ROC curve over all scores,
or groups that may hold a third of the rows) the rows are dealt by ranges of
(group, order) into buckets whose number follows the row count, so that a
bucket holds about ``ROWS_PER_BUCKET`` rows of any table.  A running sum inside
each bucket is shifted by the group's total over its earlier buckets; these
offsets are themselves a running sum over bucket totals in two levels
(``LEVEL`` buckets make one section), so no task has rows that grow with the
square root of the table even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROWS_PER_BUCKET = 100_000
LEVEL = 1024


def running_sum(df: DataFrame, value_cols: list[str], order_cols: list, partition_by: list[str] | None = None,
                suffix: str = "_cum", buckets: int | None = None, skew_safe: bool | None = None) -> DataFrame:
    """Add inclusive running sums ``<v><suffix>`` of ``value_cols``.

    ``skew_safe`` defaults to True without ``partition_by`` and False with it.
    ``buckets`` is the least number of ranges (default: by the row count).
    """
    parts = list(partition_by or [])
    if skew_safe is None:
        skew_safe = not parts
    if not skew_safe:
        w = Window.partitionBy(*parts).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(v).over(w).alias(v + suffix) for v in value_cols])

    dealt = in_buckets(df, [*parts, *order_cols], buckets)
    totals = dealt.groupBy(*parts, "_bucket").agg(*[F.sum(v).alias("_t_" + v) for v in value_cols])
    offsets = before_buckets(totals, value_cols, parts)
    w = Window.partitionBy(*parts, "_bucket").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.select("*", *[F.sum(v).over(w).alias("_in_" + v) for v in value_cols])
    out = inside.join(offsets, [F.col("_bucket") == F.col("_o_bucket"), *[F.col(c).eqNullSafe(F.col("_o_" + c)) for c in parts]])
    return out.select(*df.columns, *[(F.col("_o_" + v) + F.col("_in_" + v)).alias(v + suffix) for v in value_cols])


def in_buckets(df: DataFrame, order: list, buckets: int | None = None) -> DataFrame:
    """``df`` written once with ``_bucket``, its range of ``order``."""
    # the ranges are sampled from the written input, and totals and sums must
    # see the same ranges
    df = materialize(df, "prefix-input")
    n = max(buckets or 1, -(-df.count() // ROWS_PER_BUCKET))
    return materialize(df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id()), "prefix-buckets")


def before_buckets(totals: DataFrame, value_cols: list[str], parts: list[str]) -> DataFrame:
    """Each bucket's totals over its group's earlier buckets: sections of
    ``LEVEL`` buckets first, then the buckets of a section."""
    section = F.floor(F.col("_bucket") / LEVEL).alias("_section")
    per = totals.groupBy(*parts, section).agg(*[F.sum("_t_" + v).alias("_s_" + v) for v in value_cols])
    earlier = Window.partitionBy(*parts).orderBy("_section").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(c).alias("_p_" + c) for c in parts], F.col("_section").alias("_p_section"),
                     *[F.coalesce(F.sum("_s_" + v).over(earlier), F.lit(0)).alias("_b_" + v) for v in value_cols])
    within = Window.partitionBy(*parts, "_section").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    local = totals.select("*", section).select(
        *[F.col(c).alias("_o_" + c) for c in parts], F.col("_bucket").alias("_o_bucket"), "_section",
        *[F.coalesce(F.sum("_t_" + v).over(within), F.lit(0)).alias("_l_" + v) for v in value_cols])
    both = local.join(per, [F.col("_section") == F.col("_p_section"), *[F.col("_o_" + c).eqNullSafe(F.col("_p_" + c)) for c in parts]])
    return both.select(*["_o_" + c for c in parts], "_o_bucket", *[(F.col("_b_" + v) + F.col("_l_" + v)).alias("_o_" + v) for v in value_cols])


def numbered(df: DataFrame, key: list[str], order: list, out: str = "number") -> DataFrame:
    """Gapless numbers from 0 of the rows of each ``key`` in ``order`` (which
    should tell all rows of a key apart), without a task that holds a key."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return (running_sum(one, ["_one"], order, key, buckets=None, skew_safe=True)
            .withColumn(out, F.col("_one_cum") - 1).drop("_one", "_one_cum"))
