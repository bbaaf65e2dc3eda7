"""Queries on the cleaner's outputs (D8) and the split by row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaner as cn
from ..sources.loans import loan_file_rows, loan_table
from .registry import ORACLE, register, rounded
from .views import EMP_YEARS_SQL, LOANS_SQL, with_views

OUTLIERS = ["loan_amnt", "annual_inc", "dti", "revol_bal", "open_acc", "total_acc", "delinq_2yrs"]
MISSING = {"annual_inc": "median", "emp_length_years": "mean", "revol_util": "drop"}

_TYPED_SQL = f"""
typed AS (
 SELECT id, loan_amnt, annual_inc, dti, revol_bal, open_acc, total_acc, delinq_2yrs, data_quarter,
  TRY_CAST(regexp_extract(term_raw, '(\\d+)', 1) AS INTEGER) AS term,
  TRY_CAST(rtrim(revol_util_raw, '%') AS DOUBLE) / 100 AS revol_util,
  CAST(try_strptime(strftime(earliest_cr_line, '%b-%y'), '%b-%y') AS DATE) AS earliest_cr_line,
  CAST(try_strptime(strftime(issue_d, '%b-%y'), '%b-%y') AS DATE) AS issue_d,
  {EMP_YEARS_SQL} AS emp_length_years, emp_length
 FROM loans
)"""
_BOUNDS_SQL = "bounds AS (SELECT " + ", ".join(
    f"q_{c}[1] - 1.5e0 * (q_{c}[2] - q_{c}[1]) AS lo_{c}, q_{c}[2] + 1.5e0 * (q_{c}[2] - q_{c}[1]) AS hi_{c}" for c in OUTLIERS) \
    + " FROM (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) AS q_{c}" for c in OUTLIERS) + " FROM typed))"
_OUT = {c: f"COALESCE({c} < lo_{c} OR {c} > hi_{c}, FALSE)" for c in OUTLIERS}


def _rows(spark, sf):
    return loan_file_rows(spark, sf).select("id", "loan_amnt", "annual_inc", "dti", "revol_bal", "open_acc", "total_acc", "delinq_2yrs", "data_quarter",
                                            "term_raw", "revol_util_raw", "earliest_cr_line_raw", "issue_d_raw", "emp_length")


@register("cleaned_rows", with_views(f"""
SELECT id, round(loan_amnt, 6) AS loan_amnt, round(COALESCE(annual_inc, (SELECT quantile_cont(annual_inc, 0.5) FROM typed)), 6) AS annual_inc,
 round(dti, 6) AS dti, round(revol_bal, 6) AS revol_bal, open_acc, total_acc, delinq_2yrs, data_quarter, term, round(revol_util, 6) AS revol_util,
 earliest_cr_line, issue_d, emp_length, round(COALESCE(emp_length_years, (SELECT AVG(emp_length_years) FROM typed)), 6) AS emp_length_years,
 array_to_string(list_filter([{', '.join(f"CASE WHEN {hit} THEN '{c}' END" for c, hit in _OUT.items())}], lambda x: x IS NOT NULL), ',') AS outlier_columns
FROM typed, bounds WHERE revol_util IS NOT NULL""", LOANS_SQL, _TYPED_SQL, _BOUNDS_SQL))
def q_cleaned_rows(spark, sf):
    """Every column of the cleaned rows, filled, with outlier flags."""
    rows = cn.clean_data(_rows(spark, sf), OUTLIERS, MISSING).rows
    return rounded(rows.withColumn("outlier_columns", F.array_join("outlier_columns", ",")))


def _n(section: str, column: str | None, cond: str) -> str:
    return f"SELECT '{section}' AS section, {'CAST(NULL AS VARCHAR)' if column is None else repr(column)} AS column_name, " \
           f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS n FROM typed, bounds"


_ALL = ["id", "loan_amnt", "annual_inc", "dti", "revol_bal", "open_acc", "total_acc", "delinq_2yrs", "data_quarter", "term", "revol_util",
        "earliest_cr_line", "issue_d", "emp_length", "emp_length_years"]


@register("cleaning_report", with_views("\nUNION ALL ".join(
    [_n("rows_in", None, "TRUE"), _n("rows_out", None, "revol_util IS NOT NULL"), _n("rows_dropped", None, "revol_util IS NULL")]
    + [_n("unparsed", c, f"{c} IS NULL") for c in ("term", "revol_util", "earliest_cr_line", "issue_d")]
    + [_n("unparsed", "emp_length_years", "emp_length IS NOT NULL AND emp_length_years IS NULL")]
    + [_n("missing", c, f"{c} IS NULL") for c in _ALL]
    + [_n("filled", c, f"{c} IS NULL AND revol_util IS NOT NULL") for c in ("annual_inc", "emp_length_years")]
    + [_n("outliers", c, hit) for c, hit in _OUT.items()]), LOANS_SQL, _TYPED_SQL, _BOUNDS_SQL))
def q_cleaning_report(spark, sf):
    """What the cleaner read, missed, filled, dropped and flagged."""
    return cn.clean_data(_rows(spark, sf), OUTLIERS, MISSING).report


#: state codes, and the purposes that a loan file would have for four of the five segments
PURPOSES = {"automobile": "car", "household": "house", "machinery": "major_purchase", "furniture": "home_improvement"}
_CODED_SQL = "coded AS (SELECT * REPLACE (substr(addr_state, 1, 2) AS addr_state, CASE " \
    + " ".join(f"WHEN purpose = '{k}' THEN '{v}'" for k, v in PURPOSES.items()) + " ELSE purpose END AS purpose) FROM loans)"
_RULES_SQL = "checked AS (" + ORACLE["row_constraints"].removeprefix("WITH " + LOANS_SQL.strip()).replace("FROM loans", "FROM coded") + ")"


def _coded(spark, sf):
    purpose = F.col("purpose")
    for name, code in PURPOSES.items():
        purpose = F.when(F.col("purpose") == name, code).otherwise(purpose)
    return loan_table(spark, sf).withColumns({"addr_state": F.substring("addr_state", 1, 2), "purpose": purpose})


@register("rows_valid", with_views("""
SELECT coded.* REPLACE (round(loan_amnt, 6) AS loan_amnt, round(funded_amnt, 6) AS funded_amnt, round(int_rate, 6) AS int_rate,
 round(installment, 6) AS installment, round(annual_inc, 6) AS annual_inc, round(dti, 6) AS dti, round(revol_bal, 6) AS revol_bal, round(pd, 6) AS pd)
FROM coded JOIN checked ON coded.id = checked.id WHERE violations = ''""", LOANS_SQL, _CODED_SQL, _RULES_SQL))
def q_rows_valid(spark, sf):
    """The rows that keep every rule, all columns."""
    return rounded(cn.validate_rows(_coded(spark, sf)).valid)


@register("rows_quarantined", with_views("""
SELECT coded.id, data_quarter, purpose, violations FROM coded JOIN checked ON coded.id = checked.id WHERE violations <> ''""",
                                         LOANS_SQL, _CODED_SQL, _RULES_SQL))
def q_rows_quarantined(spark, sf):
    """The rows that break a rule, with the rules."""
    bad = cn.validate_rows(_coded(spark, sf)).quarantined
    return bad.select("id", "data_quarter", "purpose", F.array_join("violations", ",").alias("violations"))


@register("row_rule_report", with_views("""
SELECT rule, CAST(COUNT(*) AS BIGINT) AS rows FROM (
 SELECT CASE WHEN violations = '' THEN 'valid' ELSE 'quarantined' END AS rule FROM checked
 UNION ALL SELECT unnest(string_split(violations, ',')) FROM checked WHERE violations <> '') GROUP BY rule""", LOANS_SQL, _CODED_SQL, _RULES_SQL))
def q_row_rule_report(spark, sf):
    """Rows per verdict and per broken rule."""
    return cn.validate_rows(_coded(spark, sf)).report
