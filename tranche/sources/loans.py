"""The loan table the library works on, derived from the supplied tables.

There are no loan files in the test data, so a loan view is derived from
orders / customer / nation / lineitem: one row per order, with the columns a
quarterly loan file has (raw text forms included, so the cleaning steps have
real work).  ``pd`` is a deterministic score column so the metric operators
have an exact oracle without a fitted model.

Scale: lineitem is aggregated per order first (partial aggregation before the
shuffle), then joined to orders on the order key (sort-merge at scale, both
sides hash-partitioned on the key); customer joins on its key; nation is a
25-row dimension that Spark broadcasts under its size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_compiled, ensure_utc
from .tables import table

#: Split of the 27 quarters in the supplied tables (1995Q1 .. 2001Q3).
DEFAULT_SPLITS = {
    "train": [f"{y}Q{q}" for y in range(1995, 2000) for q in range(1, 5)],
    "validation": [f"2000Q{q}" for q in range(1, 5)],
    "backtest": [f"2001Q{q}" for q in range(1, 4)],
}


def quarter_of(date_col) -> "F.Column":
    """'YYYYQn' label of a date."""
    return F.concat(F.year(date_col).cast("string"), F.lit("Q"),
                    F.quarter(date_col).cast("string"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates (partial aggregation happens map-side)."""
    li = table(spark, sf_dir, "lineitem")
    is_r = F.col("l_returnflag") == "R"
    return li.groupBy("l_orderkey").agg(
        F.max("l_discount").alias("max_disc"),
        F.max("l_tax").alias("max_tax"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max("l_extendedprice").alias("max_price"),
        F.sum(F.when(is_r, 1).otherwise(0)).cast("long").alias("n_ret"),
        F.sum(F.when(is_r & (F.col("l_linestatus") == "F"), 1).otherwise(0)).cast("long").alias("n_rf"),
    )


def loan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order, typed, with raw text columns for the cleaners."""
    ensure_utc(spark)
    ensure_compiled(spark)
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = order_lines(spark, sf_dir)

    key = F.col("o_orderkey")
    is60 = (key % 4) == 0
    prio = F.substring("o_orderpriority", 1, 1)
    letter = F.translate(prio, "12345", "ABCDE")
    emp_k = key % 12
    n_rf = F.coalesce(F.col("n_rf"), F.lit(0))
    issue = F.to_date("o_orderdate")

    joined = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(lines, lines.l_orderkey == key, "left"))
    return joined.select(
        key.alias("id"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.when(key % 10 == 0, F.col("o_totalprice") * 0.9).otherwise(F.col("o_totalprice")).alias("funded_amnt"),
        F.when(is60, F.lit(" 60 months")).otherwise(F.lit(" 36 months")).alias("term_raw"),
        F.when(is60, F.lit(60)).otherwise(F.lit(36)).alias("term"),
        (F.lit(0.05) + F.col("max_disc") + F.col("max_tax")).alias("int_rate"),
        (F.col("o_totalprice") / F.when(is60, F.lit(60)).otherwise(F.lit(36))).alias("installment"),
        letter.alias("grade"),
        F.concat(letter, (key % 5 + 1).cast("string")).alias("sub_grade"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") * 12).alias("annual_inc"),
        F.when(F.col("c_custkey") % 3 == 0, "RENT").when(F.col("c_custkey") % 3 == 1, "OWN")
         .otherwise("MORTGAGE").alias("home_ownership"),
        F.when(F.col("o_orderstatus") == "F", "Verified").when(F.col("o_orderstatus") == "O", "Source Verified")
         .otherwise("Not Verified").alias("verification_status"),
        F.when(emp_k == 0, "< 1 year").when(emp_k == 1, "1 year").when(emp_k == 10, "10+ years")
         .when(emp_k == 11, F.lit(None).cast("string"))
         .otherwise(F.concat(emp_k.cast("string"), F.lit(" years"))).alias("emp_length"),
        F.lower("c_mktsegment").alias("purpose"),
        F.col("n_name").alias("addr_state"),
        issue.alias("issue_d"),
        F.date_sub(issue, (F.col("c_custkey") % 6000).cast("int")).alias("earliest_cr_line"),
        (key % 41).cast("double").alias("dti"),
        F.coalesce(F.col("n_ret"), F.lit(0)).cast("long").alias("delinq_2yrs"),
        (key % 4).cast("int").alias("inq_last_6mths"),
        F.col("n_lines").alias("open_acc"),
        (F.col("n_lines") + F.col("c_custkey") % 20).alias("total_acc"),
        (key % 3).cast("int").alias("pub_rec"),
        F.col("max_price").alias("revol_bal"),
        F.concat((key % 101).cast("string"), F.lit("%")).alias("revol_util_raw"),
        F.when(n_rf >= 2, "Charged Off").when(F.col("o_orderstatus") == "F", "Fully Paid")
         .otherwise("Current").alias("loan_status"),
        F.when(n_rf >= 2, 1).otherwise(0).alias("is_default"),
        ((5 * (prio.cast("int") - 1) + key % 5 + 1) / F.lit(40.0)).alias("pd"),
        quarter_of(F.col("o_orderdate")).alias("data_quarter"),
    )


def loan_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan view in the raw text form of a quarterly file: dates as
    month-year text ('Jan-85'), term and utilisation as text."""
    lv = loan_table(spark, sf_dir)
    return lv.select(
        "id", "loan_amnt", "funded_amnt", "term_raw", "int_rate", "installment", "grade",
        "sub_grade", "emp_length", "home_ownership", "annual_inc", "verification_status",
        "loan_status", "purpose", "addr_state", "dti", "delinq_2yrs",
        F.date_format("earliest_cr_line", "MMM-yy").alias("earliest_cr_line_raw"),
        "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util_raw", "total_acc",
        F.date_format("issue_d", "MMM-yy").alias("issue_d_raw"),
        "data_quarter",
    )


def outcome_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later outcome observations: one row per (loan, observation).

    Derived from lineitem: each line is a status observation of its order on
    its ship date, so loan ids repeat and the last observation must win.
    """
    ensure_utc(spark)
    li = table(spark, sf_dir, "lineitem")
    r = F.col("l_returnflag") == "R"
    f = F.col("l_linestatus") == "F"
    return li.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").cast("int").alias("obs_seq"),
        F.when(r & f, "Charged Off").when(r, "Late (31-120 days)").when(f, "Fully Paid")
         .otherwise("Current").alias("loan_status"),
        F.to_date("l_shipdate").alias("outcome_date"),
        quarter_of(F.col("l_shipdate")).alias("outcome_quarter"),
    )


def split_of(quarter_col, splits: dict | None = None) -> "F.Column":
    """Split name for a quarter label (NULL when in no split)."""
    splits = splits or DEFAULT_SPLITS
    expr = None
    for name, qs in splits.items():
        cond = quarter_col.isin(list(qs))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_split(df: DataFrame, splits: dict | None = None, quarter_col: str = "data_quarter") -> DataFrame:
    return df.withColumn("split", split_of(F.col(quarter_col), splits))


def list_quarters(df: DataFrame, quarter_col: str = "data_quarter") -> DataFrame:
    """Available quarters (S4): distinct partition values, sorted."""
    return df.select(quarter_col).distinct().orderBy(quarter_col)


def loans_with_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan view plus post-origination columns a full loan file carries
    (payments, recoveries, last payment date).  These leak the outcome and
    exist to exercise the listing-time compliance step."""
    li = table(spark, sf_dir, "lineitem")
    is_r = F.col("l_returnflag") == "R"
    pay = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_pymnt"),
        F.max(F.to_date("l_shipdate")).alias("last_pymnt_d"),
        F.sum(F.when(is_r, F.col("l_extendedprice") * 0.1).otherwise(0.0)).alias("recoveries"),
        F.sum(F.when(is_r, F.col("l_extendedprice") * 0.01).otherwise(0.0)).alias("collection_recovery_fee"),
    )
    lv = loan_table(spark, sf_dir)
    return lv.join(pay, "id", "left").select(
        *lv.columns, "total_pymnt", "last_pymnt_d", "recoveries", "collection_recovery_fee",
        F.col("pub_rec").alias("pub_rec_bankruptcies"),
        F.when(F.col("loan_status") == "Fully Paid", F.lit(0.0)).otherwise(F.col("loan_amnt")).alias("out_prncp"))
