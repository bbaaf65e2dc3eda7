"""Skip-greedy scans over ranked rows, group by group (K6, K7).

A scan takes or skips one row after another, and a skipped row can be
followed by one that fits, so no running sum expresses it.  A round filters
out rows that can no longer fit, hands the first ``batch`` of the rest of each
group to the scan's step, and stores what was taken with the position reached;
the next round goes on from there, until every group's rows are used up.  The
step (Python) gets at most ``batch`` rows of a group, however large the group
is; the window before it orders at most ``salt_buckets`` times as many.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BATCH = 20_000


def greedy_scan(rows: DataFrame, group: str, memory: DataFrame, room: Column, step: Callable, batch: int = BATCH,
                salt_buckets: int = 64, name: str = "scan") -> DataFrame:
    """``rows`` (with rank ``_a``, ties by ``loan_id``) that the scan takes,
    with ``investment_amount``.

    ``memory`` has a row per group: ``rest`` and ``used`` (text).  ``room`` is
    true for rows that may still fit.  ``step(pdf)`` gets rows in order, with
    their group's memory, and returns (positions taken, amounts, rest, used).
    """
    columns = rows.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"{kinds}, investment_amount decimal(18,4), rest decimal(18,4), used string, _more boolean"

    def run(pdf):
        pdf = pdf.sort_values(["_a", "loan_id"], ignore_index=True)
        at, amounts, rest, used = step(pdf)
        out = pdf.loc[[*at, len(pdf) - 1], columns]     # the last row carries the memory
        out["investment_amount"] = [*amounts, None]
        out["rest"] = [None] * len(at) + [rest]
        out["used"] = [None] * len(at) + [used]
        out["_more"] = [None] * len(at) + [len(pdf) >= batch]
        return out

    salt = F.pmod(F.xxhash64("loan_id"), F.lit(salt_buckets))
    state = memory.select(group, "rest", "used", F.lit(None).cast("double").alias("_pa"),
                          F.lit(None).cast(rows.schema["loan_id"].dataType).alias("_pid"))
    taken = None
    while True:
        later = F.col("_pa").isNull() | (F.col("_a") > F.col("_pa")) | ((F.col("_a") == F.col("_pa")) & (F.col("loan_id") > F.col("_pid")))
        head = (rows.join(state, group).where(later & room).withColumn("_salt", salt)
                .withColumn("_n", F.row_number().over(Window.partitionBy(group, "_salt").orderBy("_a", "loan_id")))
                .where(F.col("_n") <= batch)
                .withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy("_a", "loan_id")))
                .where(F.col("_n") <= batch))
        out = materialize(head.select(*columns, "rest", "used").groupBy(group).applyInPandas(run, schema), name)
        got = out.where("_more IS NULL").select(*columns, "investment_amount")
        taken = got if taken is None else taken.unionByName(got)
        state = out.where("_more").select(group, "rest", "used", F.col("_a").alias("_pa"), F.col("loan_id").alias("_pid"))
        if state.isEmpty():
            return taken.drop("_a")
