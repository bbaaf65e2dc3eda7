"""Streaming scoring with a frozen feature plan and model.

The reference is batch only; its row-wise steps (cleaning, features with
fitted literals, model scoring, risk tiers, expected return) are pure
per-row expressions, so the same fitted objects score a stream of new loan
files without any state.  Per-quarter running counts use a watermark on the
issue date so state is dropped once a quarter is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.returns import expected_return
from ..functions.rows import risk_tier


def scored_stream(stream: DataFrame, fitted_plan, model, rate_col: str = "int_rate") -> DataFrame:
    """Row-wise scoring of a streaming DataFrame of loan rows."""
    from pyspark.ml.functions import vector_to_array
    x = fitted_plan.assemble(fitted_plan.transform(stream, keep_extra=(rate_col, "issue_d")))
    out = model.transform(x).withColumn("p", vector_to_array("probability")[1])
    return out.select("id", "issue_d", "p", risk_tier("p").alias("risk_tier"),
                      expected_return(F.coalesce(F.col(rate_col), F.lit(0.0)), F.col("p")).alias("expected_return"))


def quarter_counts(scored: DataFrame, watermark: str = "120 days") -> DataFrame:
    """Running per-quarter count and mean score.  The event time is the
    quarter start of the issue date; a one-day window on it holds exactly
    one calendar quarter, and the watermark drops a quarter's state once
    later quarters have arrived."""
    q = F.date_trunc("quarter", F.col("issue_d").cast("timestamp"))
    return (scored.withColumn("_q", q).withWatermark("_q", watermark)
            .groupBy(F.window("_q", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("loans"), F.avg("p").alias("mean_p"))
            .select(F.col("w.start").alias("quarter_start"), "loans", "mean_p"))


def start_scoring(spark: SparkSession, source_dir: str, schema: StructType, fitted_plan, model, sink_dir: str,
                  checkpoint_dir: str, trigger_once: bool = True):
    """Read new parquet loan files from ``source_dir``, score them and
    append to ``sink_dir``; the checkpoint makes the sink exactly-once."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (scored_stream(stream, fitted_plan, model).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir).outputMode("append"))
    q = q.trigger(availableNow=True) if trigger_once else q
    return q.start()
