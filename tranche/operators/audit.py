"""Audit, lineage, gates and the report table.

Instead of process logs, a run leaves tables: data characteristics per step
(one aggregate per table, order-insensitive content hash), a lineage row per
transformation appended to a table, rule rows for gates and alerts, and a
long report table the renderer of choice can draw from.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.fixed import MODEL_GATE


# ------------------------------------------------------------------ A14 / D11
def model_gate(auc: DataFrame, summary: DataFrame, hl: DataFrame | None = None, gate: dict | None = None) -> DataFrame:
    """AUC >= .65 (error), AUC >= .70 (warning), Brier <= .20, and with
    a Hosmer-Lemeshow table, calibration p >= .05."""
    g = dict(MODEL_GATE, **(gate or {}))
    a = auc.select(F.col("roc_auc").alias("v"))
    b = summary.select(F.col("brier_score").alias("v"))
    rows = [
        a.select(F.lit("min_auc").alias("rule"), F.col("v").alias("value"), F.lit(g["min_auc"]).alias("threshold"),
                 (F.col("v") >= g["min_auc"]).alias("passed")),
        a.select(F.lit("warn_auc"), F.col("v"), F.lit(g["warn_auc"]), F.col("v") >= g["warn_auc"]),
        b.select(F.lit("max_brier"), F.col("v"), F.lit(g["max_brier"]), F.col("v") <= g["max_brier"]),
    ]
    if hl is not None:
        rows.append(hl.select(F.lit("min_calibration_p"), F.col("hosmer_lemeshow_pvalue"), F.lit(g["min_calibration_p"]),
                              F.col("hosmer_lemeshow_pvalue") >= g["min_calibration_p"]))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def alerts(metrics_long: DataFrame, rules: dict[str, tuple[str, float]]) -> DataFrame:
    """Metrics (metric, value) against rules {metric: ('min'|'max', limit)};
    one row per triggered alert."""
    spark = metrics_long.sparkSession
    r = spark.createDataFrame([(k, d, float(v)) for k, (d, v) in rules.items()], "metric string, direction string, limit double")
    j = metrics_long.join(F.broadcast(r), "metric")
    hit = ((F.col("direction") == "min") & (F.col("value") < F.col("limit"))) | \
          ((F.col("direction") == "max") & (F.col("value") > F.col("limit")))
    return j.where(hit).select("metric", "value", "direction", "limit")


# ------------------------------------------------------------------ A15 / S7
def characteristics(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, missing cells, approximate distinct count of the
    first column, and an order-insensitive content hash (sum of xxhash64 of
    each row), in one aggregate."""
    cols = df.columns
    miss = [F.count_if(F.col(c).isNull()) for c in cols]
    total_miss = miss[0]
    for m in miss[1:]:
        total_miss = total_miss + m
    h = F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), total_miss.alias("missing_cells"),
                  F.approx_count_distinct(cols[0]).alias("distinct_first"),
                  F.pmod(h, F.lit(2 ** 61 - 1)).cast("long").alias("content_hash")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(cols)).alias("columns"), "missing_cells", "distinct_first",
        "content_hash")


def column_profile(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """A15 per column: dataset, column_name, data_type, rows, missing and a
    mergeable sketch of its distinct values, in one aggregate (one per value
    of ``by``).  Stored with the lineage, profiles of parts or of later runs
    are put together by ``merge_profiles`` without reading data again."""
    cols = [f for f in df.schema.fields if f.name != by]
    keys = [by] if by else []
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[x for i, f in enumerate(cols) for x in (
        F.count_if(F.col(f.name).isNull()).alias(f"m{i}"), F.hll_sketch_agg(F.col(f.name).cast("string"), 12).alias(f"s{i}"))])
    each = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"m{i}").alias("missing"),
                     F.col(f"s{i}").alias("sketch")) for i, f in enumerate(cols)]
    return one.select(F.lit(name).alias("dataset"), *keys, "rows", F.explode(F.array(*each)).alias("c")).select("dataset", *keys, "rows", "c.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """dataset, column_name, data_type, rows, missing, distinct_estimate and
    the united sketch of all parts of a dataset (an estimate is within a few
    per cent of the exact count, and exact while values are few)."""
    return (profiles.groupBy("dataset", "column_name", "data_type")
            .agg(F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.hll_union_agg("sketch").alias("sketch"))
            .withColumn("distinct_estimate", F.hll_sketch_estimate("sketch")))


def lineage_row(spark: SparkSession, operation: str, before: DataFrame, after: DataFrame,
                metadata: dict | None = None) -> DataFrame:
    """S7 record: characteristics before / after and the deltas."""
    b = characteristics(before, "input").select(*[F.col(c).alias("in_" + c) for c in ("rows", "columns", "content_hash")])
    a = characteristics(after, "output").select(*[F.col(c).alias("out_" + c) for c in ("rows", "columns", "content_hash")])
    from .rows import combine_rows
    return combine_rows(b, a).select(
        F.lit(operation).alias("operation"), F.current_timestamp().alias("ts"), "*",
        (F.col("out_rows") - F.col("in_rows")).alias("row_delta"),
        (F.col("out_columns") - F.col("in_columns")).alias("column_delta"),
        F.lit(json.dumps(metadata or {}, sort_keys=True)).alias("metadata"))


def append_lineage(record: DataFrame, path: str) -> None:
    """Append to the lineage table (parquet, shared storage)."""
    record.write.mode("append").parquet(path)


# ------------------------------------------------------------------ A16
def timed(step: str, action: Callable[[], object], log: list | None = None, source: DataFrame | None = None) -> object:
    """Run one action (a job), recording step, seconds, status, and the
    rows of ``source`` and of the table it returns.  Both are written tables,
    whose rows are counted from the files' footers: no second pass."""
    t0 = time.time()
    status, err, done = "success", None, None
    try:
        done = action()
        return done
    except Exception as e:  # noqa: BLE001
        status, err = "error", f"{type(e).__name__}: {e}"
        raise
    finally:
        if log is not None:
            seconds = round(time.time() - t0, 3)
            log.append({"step": step, "seconds": seconds, "status": status, "error": err,
                        "rows_in": None if source is None else source.count(),
                        "rows_out": done.count() if isinstance(done, DataFrame) else None})


# ------------------------------------------------------------------ S8 / S9
REPORT_SCHEMA = "section string, metric string, value double, status string"


def report_table(sections: dict[str, DataFrame], thresholds: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """One long table (section, metric, value, status) from one-row
    metric DataFrames; status 'pass' / 'fail' where a threshold is given."""
    parts = []
    for sec, df in sections.items():
        num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
        if not num:
            continue
        structs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in num]
        parts.append(df.select(F.lit(sec).alias("section"), F.explode(F.array(*structs)).alias("r"))
                     .select("section", "r.metric", "r.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.lit(None).cast("string")
    for m, (d, lim) in (thresholds or {}).items():
        ok = (F.col("value") >= lim) if d == "min" else (F.col("value") <= lim)
        status = F.when(F.col("metric") == m, F.when(ok, "pass").otherwise("fail")).otherwise(status)
    return out.withColumn("status", status)


# ------------------------------------------------------------------ G1
def batch_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                batch_size: int = 10000) -> DataFrame:
    """Apply a user function to Arrow batches of at most
    ``batch_size`` rows, in parallel over partitions (``mapInPandas``)."""
    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), batch_size):
                yield fn(pdf.iloc[at:at + batch_size].reset_index(drop=True))

    return df.mapInPandas(run, schema)


# ------------------------------------------------------------------ D19
def data_summary(df: DataFrame, label: str, dropped: dict[str, str]) -> DataFrame:
    """Rows, columns, prevalence and the dropped columns with reasons."""
    spark = df.sparkSession
    s = df.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.avg(F.col(label).cast("double")).alias("prevalence"))
    base = s.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("item"), F.col("rows").alias("value"), F.lit(None).cast("string").alias("detail")),
        F.struct(F.lit("columns").alias("item"), F.lit(float(len(df.columns))).alias("value"),
                 F.lit(None).cast("string").alias("detail")),
        F.struct(F.lit("prevalence").alias("item"), F.col("prevalence").alias("value"),
                 F.lit(None).cast("string").alias("detail")))).alias("r")).select("r.*")
    if dropped:
        d = spark.createDataFrame([(f"dropped:{k}", None, v) for k, v in dropped.items()],
                                  "item string, value double, detail string")
        base = base.unionByName(d)
    return base
