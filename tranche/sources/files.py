"""Quarterly loan files, configuration, and sinks.

A quarter file is read as text columns named by its header (nothing is
inferred, no pass over the data to guess types) and then typed with the
tolerant cleaners; a bad cell becomes NULL instead of failing the file or
silently re-reading it untyped, and a row with too few or too many fields is
kept apart.  The quarter label comes from the file name.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as cl
from .records import field_names, first_record, records

#: Numeric columns of a quarterly loan file; the others are text, percents, dates or terms.
NUMERIC = ["id", "member_id", "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment", "annual_inc", "dti",
           "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "total_acc", "fico_range_low",
           "fico_range_high"]


CORRUPT = "_corrupt_record"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` (local, HDFS, object store) and its Path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def quarter_paths(spark: SparkSession, directory: str, quarters: list[str]) -> list[str]:
    """S3: every missing quarter is reported at once."""
    paths = [f"{directory.rstrip('/')}/{q}.csv" for q in quarters]
    missing = [q for q, p in zip(quarters, paths) if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing quarter files: {', '.join(missing)} in {directory}")
    return paths


def type_loan_file(raw: DataFrame) -> DataFrame:
    """S2 typing: numbers, term, percents, month-year dates, employment."""
    out = []
    for c in raw.columns:
        if c in NUMERIC:
            out.append(cl.to_double(c).alias(c) if c not in ("id", "member_id") else
                       F.col(c).try_cast("long").alias(c))
        elif c == "term":
            out.append(cl.term_months(c).alias(c))
        elif c in ("int_rate", "revol_util"):
            out.append(cl.percent_to_fraction(c).alias(c))
        elif c in ("issue_d", "earliest_cr_line"):
            out.append(cl.month_year_date(c).alias(c))
        else:
            out.append(F.col(c))
    if "emp_length" in raw.columns:
        out.append(cl.emp_length_years("emp_length").alias("emp_length_years"))
    return raw.select(*out)


def scan_quarters(spark: SparkSession, directory: str, quarters: list[str]) -> DataFrame:
    """The files' rows as text, columns by header name, with ``data_quarter``
    from the file name and the whole record in ``_corrupt_record`` where a row
    does not have its header's number of fields.

    Files with the same header are one scan, parsed with that header as the
    schema; scans are united by name, and a column that a file lacks is
    missing there.  Quoted fields may hold line breaks, commas and doubled
    quotes (``records`` cuts the files).
    """
    by_header: dict[str, list[str]] = {}
    for path in quarter_paths(spark, directory, quarters):
        header = first_record(spark, path)
        if header is not None:
            by_header.setdefault(header, []).append(path)
    scans = []
    for header, paths in by_header.items():
        names = [c.replace("`", "``") for c in field_names(header)]
        schema = ", ".join(f"`{c}` string" for c in (*names, CORRUPT))
        parse = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true"}
        scans.append(records(spark, paths)
                     .select(F.from_csv("record", schema, parse).alias("r"),
                             F.regexp_extract("file", r"([0-9]{4}Q[1-4])\.csv$", 1).alias("data_quarter"))
                     .select("r.*", "data_quarter"))
    if not scans:
        raise ValueError(f"no header in any quarter file of {directory}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def load_quarters(spark: SparkSession, directory: str, quarters: list[str]) -> DataFrame:
    """The well-formed rows of the quarter files, typed, tagged with
    ``data_quarter`` (no global sort: order at output)."""
    raw = scan_quarters(spark, directory, quarters)
    return type_loan_file(raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT))


def malformed_rows(spark: SparkSession, directory: str, quarters: list[str]) -> DataFrame:
    """data_quarter and line of the rows that ``load_quarters`` leaves out."""
    raw = scan_quarters(spark, directory, quarters)
    return raw.where(F.col(CORRUPT).isNotNull()).select("data_quarter", CORRUPT)


def available_quarters(spark: SparkSession, directory: str) -> list[str]:
    """S4 on files: quarter labels of the files present (a directory
    listing, no data read)."""
    fs, p = _file_system(spark, directory)
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(m.group(1) for n in names if (m := re.match(r"^([0-9]{4}Q[1-4])\.csv$", n)))


def by_date(df: DataFrame, date_col: str = "issue_d", tie: str = "id") -> DataFrame:
    """Rows by date, missing dates last, ties by id."""
    return df.orderBy(F.col(date_col).asc_nulls_last(), F.col(tie).asc_nulls_last())


@dataclass
class PipelineConfig:
    """The run's settings; required sections and basic checks."""
    data: dict = field(default_factory=dict)
    features: dict = field(default_factory=dict)
    model: dict = field(default_factory=dict)
    investment: dict = field(default_factory=dict)
    evaluation: dict = field(default_factory=dict)

    REQUIRED = ("data", "features", "model", "investment", "evaluation")

    @classmethod
    def from_dict(cls, d: dict) -> "PipelineConfig":
        missing = [k for k in cls.REQUIRED if k not in d]
        if missing:
            raise ValueError(f"missing config sections: {missing}")
        cfg = cls(**{k: dict(d[k]) for k in cls.REQUIRED})
        for split in ("train_quarters", "validation_quarters", "backtest_quarters"):
            if not cfg.data.get(split):
                raise ValueError(f"data.{split} is empty")
        if float(cfg.investment.get("budget_per_quarter", 5000.0)) <= 0:
            raise ValueError("investment.budget_per_quarter must be positive")
        return cfg

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> "PipelineConfig":
        """JSON or YAML from any file system that Spark reads."""
        text = spark.read.text(path, wholetext=True).first()[0]
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml  # optional
            except ImportError as e:  # pragma: no cover
                raise ImportError("YAML config needs PyYAML; use JSON") from e
            return cls.from_dict(yaml.safe_load(text))
        return cls.from_dict(json.loads(text))


def write_partitioned(df: DataFrame, path: str, partition_col: str = "data_quarter", mode: str = "overwrite") -> None:
    """Predictions / processed rows as parquet partitioned by quarter
    (later reads prune partitions)."""
    df.write.mode(mode).partitionBy(partition_col).parquet(path)
