"""Listing-time compliance: columns that leak the outcome.

Column selection is metadata only (``df.drop``) and costs no job.  The
name check runs as a small DataFrame of names with ``rlike`` so the same
rules can be audited as a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import PROHIBITED_FIELDS, PROHIBITED_PATTERNS

MODES = ("search", "anchored", "anchored_ci")


def _matches(name: str, pattern: str, mode: str) -> bool:
    if mode == "search":
        return re.search(pattern, name) is not None
    if mode == "anchored":
        return re.match(pattern, name) is not None
    return re.match(pattern, name, re.IGNORECASE) is not None


def leaking_columns(columns: list[str], mode: str = "search", patterns=None, fields=None,
                    allow: tuple[str, ...] = ()) -> list[str]:
    """Names to drop.  ``mode``: 'search' (pattern anywhere: the feature
    step), 'anchored' (match at the start: the file loader),
    'anchored_ci' (start, ignore case: the validator).  ``allow`` keeps
    legitimate names a broad pattern would catch (e.g. ``pub_rec_*``)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    patterns = PROHIBITED_PATTERNS if patterns is None else patterns
    fields = set(PROHIBITED_FIELDS if fields is None else fields)
    out = []
    for c in columns:
        if c in allow:
            continue
        if c in fields or any(_matches(c, p, mode) for p in patterns):
            out.append(c)
    return out


def drop_leaking(df: DataFrame, mode: str = "search", allow: tuple[str, ...] = ()) -> DataFrame:
    """Drop every leaking column (no data is touched)."""
    return df.drop(*leaking_columns(df.columns, mode, allow=allow))


def feature_compliance(spark: SparkSession, names: list[str], patterns=None, fields=None) -> DataFrame:
    """Per feature name: prohibited or not, and which rule matched
    (exact field list, then anchored case-insensitive patterns in order)."""
    patterns = PROHIBITED_PATTERNS if patterns is None else patterns
    fields = PROHIBITED_FIELDS if fields is None else fields
    df = spark.createDataFrame([(n,) for n in names], "feature_name string")
    rule = F.when(F.col("feature_name").isin(list(fields)), F.lit("field"))
    for p in patterns:
        rule = rule.when(F.col("feature_name").rlike("(?i)^(" + p + ")"), F.lit(p))
    return df.select("feature_name", rule.alias("matched_rule")).withColumn(
        "is_prohibited", F.col("matched_rule").isNotNull())


def compliance_summary(checked: DataFrame) -> DataFrame:
    """A11 summary: total, violations, compliance rate."""
    return checked.agg(F.count(F.lit(1)).alias("total_features"),
                       F.count_if("is_prohibited").alias("prohibited_features")).withColumn(
        "compliance_rate", (F.col("total_features") - F.col("prohibited_features")) / F.col("total_features"))


def provenance(registry: DataFrame, checked: DataFrame) -> DataFrame:
    """Feature registry rows joined to their compliance result."""
    return registry.join(checked, "feature_name", "left")
