"""Queries: cleaning, row rules, quality profiles, compliance, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as cl
from ..functions import rows as rw
from ..operators import compliance as cp
from ..operators import quality as qa
from ..operators import targets as tg
from ..sources.loans import (list_quarters, loan_file_rows, loan_table, loans_with_payments,
                             outcome_table, with_split)
from .registry import register, rounded
from .views import LOANS_SQL, OUTCOMES_SQL, PAYMENTS_SQL, SPLIT_CASE, with_views

# Column lists of the loan view, for generating the oracle SQL.
LOAN_COLS = ("id loan_amnt funded_amnt term_raw term int_rate installment grade sub_grade annual_inc "
             "home_ownership verification_status emp_length purpose addr_state issue_d earliest_cr_line dti "
             "delinq_2yrs inq_last_6mths open_acc total_acc pub_rec revol_bal revol_util_raw loan_status "
             "is_default pd data_quarter").split()
NUMERIC_COLS = ("id loan_amnt funded_amnt term int_rate installment annual_inc dti delinq_2yrs inq_last_6mths "
                "open_acc total_acc pub_rec revol_bal is_default pd").split()
STRING_COLS = ("term_raw grade sub_grade home_ownership verification_status emp_length purpose addr_state "
               "revol_util_raw loan_status data_quarter").split()
CAT_COLS = ["grade", "sub_grade", "term", "home_ownership", "verification_status", "purpose"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ cleaning
@register("clean_numeric", with_views("""
SELECT id, TRY_CAST(CAST(loan_amnt AS VARCHAR) AS DOUBLE) AS loan_amnt_num,
 TRY_CAST(term_raw AS DOUBLE) AS term_raw_num, TRY_CAST(revol_util_raw AS DOUBLE) AS revol_util_num,
 TRY_CAST(CAST(delinq_2yrs AS VARCHAR) AS DOUBLE) AS delinq_num FROM loans"""))
def q_clean_numeric(spark, sf):
    """Tolerant numeric parse of text columns (bad text -> NULL)."""
    lv = loan_table(spark, sf)
    return lv.select("id", cl.to_double(F.col("loan_amnt").cast("string")).alias("loan_amnt_num"),
                     cl.to_double("term_raw").alias("term_raw_num"),
                     cl.to_double("revol_util_raw").alias("revol_util_num"),
                     cl.to_double(F.col("delinq_2yrs").cast("string")).alias("delinq_num"))


@register("clean_term", with_views("""
SELECT id, term_raw, TRY_CAST(regexp_extract(term_raw, '(\\d+)', 1) AS INTEGER) AS term_months FROM loans"""))
def q_clean_term(spark, sf):
    """P2: ' 36 months' -> 36."""
    return loan_file_rows(spark, sf).select("id", "term_raw", cl.term_months("term_raw").alias("term_months"))


@register("clean_percent", with_views("""
SELECT id, revol_util_raw, TRY_CAST(rtrim(revol_util_raw, '%') AS DOUBLE) / 100 AS revol_util FROM loans"""))
def q_clean_percent(spark, sf):
    """P3: '45%' -> 0.45."""
    return loan_file_rows(spark, sf).select("id", "revol_util_raw",
                                            cl.percent_to_fraction("revol_util_raw").alias("revol_util"))


@register("clean_dates", with_views("""
SELECT id, strftime(earliest_cr_line, '%b-%y') AS earliest_cr_line_raw, strftime(issue_d, '%b-%y') AS issue_d_raw,
 CAST(try_strptime(strftime(earliest_cr_line, '%b-%y'), '%b-%y') AS DATE) AS earliest_cr_line_parsed,
 CAST(try_strptime(strftime(issue_d, '%b-%y'), '%b-%y') AS DATE) AS issue_d_parsed FROM loans"""))
def q_clean_dates(spark, sf):
    """Month-year text -> first of month, two-digit years >= 69 in 19xx."""
    f = loan_file_rows(spark, sf)
    return f.select("id", "earliest_cr_line_raw", "issue_d_raw",
                    cl.month_year_date("earliest_cr_line_raw").alias("earliest_cr_line_parsed"),
                    cl.month_year_date("issue_d_raw").alias("issue_d_parsed"))


@register("clean_emp_length", with_views("""
SELECT id, emp_length,
 CASE WHEN regexp_matches(trim(emp_length), '^<\\s*1\\s*(years?)?$') THEN 0.5e0
      ELSE TRY_CAST(CASE WHEN trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) = '10+'
                         THEN '10' ELSE trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) END AS DOUBLE)
 END AS emp_length_years,
 TRY_CAST(CASE WHEN trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) = '10+'
               THEN '10' ELSE trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) END AS DOUBLE)
   AS emp_length_years_legacy,
 CASE emp_length WHEN '< 1 year' THEN 0.5e0 WHEN '1 year' THEN 1e0 WHEN '2 years' THEN 2e0 WHEN '3 years' THEN 3e0
   WHEN '4 years' THEN 4e0 WHEN '5 years' THEN 5e0 WHEN '6 years' THEN 6e0 WHEN '7 years' THEN 7e0
   WHEN '8 years' THEN 8e0 WHEN '9 years' THEN 9e0 WHEN '10+ years' THEN 12e0 END AS emp_length_enum_years
FROM loans"""))
def q_clean_emp_length(spark, sf):
    """P5 + P14: employment length text -> years (default, legacy, enum)."""
    f = loan_file_rows(spark, sf)
    return f.select("id", "emp_length", cl.emp_length_years("emp_length").alias("emp_length_years"),
                    cl.emp_length_years("emp_length", legacy=True).alias("emp_length_years_legacy"),
                    cl.emp_length_enum_years("emp_length").alias("emp_length_enum_years"))


@register("clean_loans", with_views("""
SELECT COUNT(*) AS n, COUNT(term) AS term_ok, round(SUM(revol_util), 6) AS revol_util_sum,
 MIN(earliest_cr_line) AS min_ecl, MAX(earliest_cr_line) AS max_ecl, MIN(issue_d) AS min_issue,
 round(SUM(emp_length_years), 6) AS emp_years_sum FROM (
 SELECT TRY_CAST(regexp_extract(term_raw, '(\\d+)', 1) AS INTEGER) AS term,
  TRY_CAST(rtrim(revol_util_raw, '%') AS DOUBLE) / 100 AS revol_util,
  CAST(try_strptime(strftime(earliest_cr_line, '%b-%y'), '%b-%y') AS DATE) AS earliest_cr_line,
  CAST(try_strptime(strftime(issue_d, '%b-%y'), '%b-%y') AS DATE) AS issue_d,
  CASE WHEN regexp_matches(trim(emp_length), '^<\\s*1\\s*(years?)?$') THEN 0.5e0
   ELSE TRY_CAST(CASE WHEN trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) = '10+'
        THEN '10' ELSE trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g')) END AS DOUBLE)
  END AS emp_length_years FROM loans)"""))
def q_clean_loans(spark, sf):
    """Whole-file standardisation in one select, summarised."""
    c = cl.clean_loans(loan_file_rows(spark, sf))
    return c.agg(F.count(F.lit(1)).alias("n"), F.count("term").alias("term_ok"),
                 F.round(F.sum("revol_util"), 6).alias("revol_util_sum"),
                 F.min("earliest_cr_line").alias("min_ecl"), F.max("earliest_cr_line").alias("max_ecl"),
                 F.min("issue_d").alias("min_issue"), F.round(F.sum("emp_length_years"), 6).alias("emp_years_sum"))


# ------------------------------------------------------------------ row rules
@register("row_constraints", with_views("""
SELECT id, array_to_string(list_filter([
  CASE WHEN NOT COALESCE(funded_amnt > 0, FALSE) THEN 'funded_amnt_not_positive' END,
  CASE WHEN NOT COALESCE(installment > 0, FALSE) THEN 'installment_not_positive' END,
  CASE WHEN int_rate IS NULL THEN 'int_rate_missing' END,
  CASE WHEN COALESCE(int_rate < 0 OR int_rate > 1, FALSE) THEN 'int_rate_out_of_range' END,
  CASE WHEN COALESCE(term NOT IN (36, 60) OR term IS NULL, FALSE) THEN 'term_invalid' END,
  CASE WHEN sub_grade IS NULL OR NOT regexp_full_match(sub_grade, '[A-G][1-5]') THEN 'sub_grade_invalid' END,
  CASE WHEN home_ownership IS NULL OR home_ownership NOT IN ('RENT','OWN','MORTGAGE','OTHER') THEN 'home_ownership_invalid' END,
  CASE WHEN verification_status IS NULL OR verification_status NOT IN ('Verified','Source Verified','Not Verified')
       THEN 'verification_status_invalid' END,
  CASE WHEN purpose IS NULL OR purpose NOT IN ('debt_consolidation','credit_card','home_improvement','major_purchase',
       'medical','small_business','car','vacation','wedding','house','moving','educational','renewable_energy','other')
       THEN 'purpose_invalid' END,
  CASE WHEN COALESCE(length(addr_state) <> 2, FALSE) THEN 'addr_state_length' END,
  CASE WHEN COALESCE(annual_inc < 0, FALSE) THEN 'annual_inc_negative' END,
  CASE WHEN COALESCE(dti < 0, FALSE) THEN 'dti_negative' END,
  CASE WHEN COALESCE(delinq_2yrs < 0, FALSE) THEN 'delinq_2yrs_negative' END,
  CASE WHEN COALESCE(inq_last_6mths < 0, FALSE) THEN 'inq_last_6mths_negative' END,
  CASE WHEN COALESCE(open_acc < 0, FALSE) THEN 'open_acc_negative' END,
  CASE WHEN COALESCE(pub_rec < 0, FALSE) THEN 'pub_rec_negative' END,
  CASE WHEN COALESCE(revol_bal < 0, FALSE) THEN 'revol_bal_negative' END,
  CASE WHEN COALESCE(total_acc < 0, FALSE) THEN 'total_acc_negative' END
 ], lambda x: x IS NOT NULL), ',') AS violations FROM loans"""))
def q_row_constraints(spark, sf):
    """Violated row rules per loan ('' = valid)."""
    lv = loan_table(spark, sf)
    return lv.select("id", F.array_join(rw.constraint_violations(set(lv.columns)), ",").alias("violations"))


@register("risk_tier", with_views("""
SELECT id, pd, CASE WHEN pd < 0.05e0 THEN 'LOW' WHEN pd < 0.15e0 THEN 'MEDIUM' WHEN pd < 0.30e0 THEN 'HIGH'
 ELSE 'VERY_HIGH' END AS risk_tier, (CASE WHEN loan_status IN ('Charged Off','Default','Late (31-120 days)') THEN 1 ELSE 0 END) AS status_default,
 position(substr(sub_grade,1,1) IN 'ABCDEFG') * 5 - 5 + TRY_CAST(substr(sub_grade,2,1) AS INTEGER) AS sub_grade_rank
FROM loans"""))
def q_risk_tier(spark, sf):
    """P11 + P12 + P13: sub-grade rank, risk tier of pd, default flag of status."""
    lv = loan_table(spark, sf)
    return lv.select("id", "pd", rw.risk_tier("pd").alias("risk_tier"),
                     rw.is_default_status("loan_status").alias("status_default"),
                     rw.sub_grade_rank("sub_grade").alias("sub_grade_rank"))


@register("row_properties", with_views("""
SELECT id, round(datediff('day', earliest_cr_line, issue_d) / 365.25, 6) AS credit_age_years,
 round(CASE WHEN annual_inc > 0 THEN funded_amnt / annual_inc END, 6) AS loan_to_income,
 round(CASE WHEN funded_amnt > 0 THEN loan_amnt / funded_amnt END, 6) AS loan_to_funded_ratio,
 round(loan_amnt - funded_amnt, 6) AS funding_gap,
 round(CASE WHEN loan_amnt > 0 THEN (total_pymnt - loan_amnt) / loan_amnt END, 6) AS outcome_roi,
 round(CASE WHEN loan_amnt > 0 THEN ((CASE WHEN is_default = 1 THEN installment * term * 0.3e0 ELSE installment * term END) - loan_amnt) / loan_amnt END, 6) AS roi_proxy
FROM wide""", LOANS_SQL, PAYMENTS_SQL))
def q_row_properties(spark, sf):
    """Credit age, loan-to-income, funding ratio / gap,
    outcome ROI on principal, instalment ROI proxy."""
    from ..functions.returns import instalment_roi
    w = loans_with_payments(spark, sf)
    out = w.select("id", rw.credit_age_years().alias("credit_age_years"),
                   rw.loan_to_income("funded_amnt", "annual_inc").alias("loan_to_income"),
                   *[c for c in rw.extra_features(set(w.columns))],
                   rw.outcome_roi("total_pymnt", "loan_amnt").alias("outcome_roi"),
                   instalment_roi("installment", "term", "loan_amnt", "is_default").alias("roi_proxy"))
    return rounded(out.drop("pub_rec_bankruptcies"))


# ------------------------------------------------------------------ profiles
def _missing_sql():
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, "
             f"(COUNT(*) - COUNT({c})) * 100.0e0 / COUNT(*) AS missing_pct FROM loans" for c in LOAN_COLS]
    return with_views(f"SELECT column_name, missing_count, round(missing_pct, 6) AS missing_pct, "
                      f"missing_pct > 50 AS high_missing FROM ({_union(parts)})")


@register("missing_profile", _missing_sql())
def q_missing_profile(spark, sf):
    """A1: missing count and percent per column of the loan table."""
    return rounded(qa.missing_profile(loan_table(spark, sf)))


@register("duplicate_profile", with_views(f"""
SELECT total_rows, total_rows - distinct_rows AS duplicate_rows,
 round((total_rows - distinct_rows) * 100.0e0 / total_rows, 6) AS duplicate_rate_percent,
 (total_rows - distinct_rows) * 100.0e0 / total_rows > 1 AS exceeds_threshold
FROM (SELECT COUNT(*) AS total_rows FROM loans),
 (SELECT COUNT(*) AS distinct_rows FROM (SELECT DISTINCT {', '.join(CAT_COLS)} FROM loans))"""))
def q_duplicate_profile(spark, sf):
    """A2: duplicate rows over the categorical columns of the loan table."""
    return rounded(qa.duplicate_profile(loan_table(spark, sf).select(*CAT_COLS)))


def _iqr_sql(rate_base: str):
    parts = []
    for c in NUMERIC_COLS:
        parts.append(f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) < lo OR CAST({c} AS DOUBLE) > hi) AS outlier_count,
 MAX(nn) AS total_values, MAX(lo) AS lower_bound, MAX(hi) AS upper_bound, MAX(n) AS rows_ FROM loans,
 (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi, nn, n FROM
   (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) AS q, COUNT({c}) AS nn, COUNT(*) AS n FROM loans))""")
    rate = "outlier_count * 100.0e0 / rows_" if rate_base == "rows" else "outlier_count * 1.0e0 / total_values"
    return with_views(f"""SELECT column_name, outlier_count, total_values, round(lower_bound, 6) AS lower_bound,
 round(upper_bound, 6) AS upper_bound, round({rate}, 6) AS outlier_rate FROM ({_union(parts)}) WHERE total_values >= 10""")


@register("outlier_iqr", _iqr_sql("rows"))
def q_outlier_iqr(spark, sf):
    """A3: IQR outliers per numeric column, rate over all rows (percent)."""
    return rounded(qa.outlier_iqr(loan_table(spark, sf)))


@register("outlier_iqr_values", _iqr_sql("values"))
def q_outlier_iqr_values(spark, sf):
    """A8 (IQR form): rate over non-missing values (fraction)."""
    return rounded(qa.outlier_iqr(loan_table(spark, sf), rate_base="values"))


def _z_sql():
    parts = [f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE abs((CAST({c} AS DOUBLE) - m) / s) > 3) AS outlier_count,
 MAX(nn) AS total_values FROM loans, (SELECT AVG(CAST({c} AS DOUBLE)) AS m, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS s,
 COUNT({c}) AS nn FROM loans)""" for c in NUMERIC_COLS]
    return with_views(f"""SELECT column_name, outlier_count, total_values,
 round(outlier_count * 1.0e0 / total_values, 6) AS outlier_rate FROM ({_union(parts)}) WHERE total_values > 0""")


@register("outlier_zscore", _z_sql())
def q_outlier_zscore(spark, sf):
    """|z| > 3 with the sample standard deviation."""
    return rounded(qa.outlier_zscore(loan_table(spark, sf)))


def _type_sql():
    pot = [f"SELECT '{c}' AS name, COUNT(*) FILTER (WHERE regexp_matches({c}, '^[\\d.,%-]+$')) AS k, COUNT(*) AS n "
           f"FROM loans" for c in STRING_COLS]
    return with_views(f"""
SELECT CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END AS name,
  'dtype' AS kind, COUNT(*) AS n FROM (DESCRIBE SELECT * FROM loans) GROUP BY 1
UNION ALL
SELECT name, 'potential_numeric' AS kind, k AS n FROM ({_union(pot)}) WHERE k > n * 0.8e0""")


@register("type_profile", _type_sql())
def q_type_profile(spark, sf):
    """A4: columns per type; text columns that look numeric in > 80 % of rows."""
    return qa.type_profile(loan_table(spark, sf))


def _score_sql():
    miss = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in LOAN_COLS)
    outs = []
    for c in NUMERIC_COLS:
        outs.append(f"""SELECT COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) < lo OR CAST({c} AS DOUBLE) > hi) AS o FROM loans,
 (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi FROM
   (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) AS q, COUNT({c}) AS nn FROM loans) WHERE nn >= 10)""")
    nc = len(LOAN_COLS)
    return with_views(f"""
SELECT total_rows, {nc} AS total_columns, total_missing_cells, duplicate_rows, total_outliers,
 round(total_missing_cells * 100.0e0 / (total_rows * {nc}), 6) AS missing_percentage_overall,
 round(total_outliers * 100.0e0 / (total_rows * {nc}), 6) AS overall_outlier_rate_percent,
 round(score, 6) AS quality_score, score >= 0.8 AS passed_validation FROM (
 SELECT *, LEAST(1.0e0, GREATEST(0.0e0,
   0.3e0 * GREATEST(0.0e0, 1 - (total_missing_cells * 1.0e0 / (total_rows * {nc})) / 0.5e0)
 + 0.2e0 * GREATEST(0.0e0, 1 - (duplicate_rows * 1.0e0 / total_rows) / 0.01e0)
 + 0.2e0 * GREATEST(0.0e0, 1 - (total_outliers * 1.0e0 / (total_rows * {nc})) / 0.05e0)
 + 0.3e0 * (1 - (total_missing_cells * 1.0e0 / (total_rows * {nc})) / 2))) AS score FROM (
  SELECT COUNT(*) AS total_rows, {miss} AS total_missing_cells FROM loans),
  (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM loans)) AS duplicate_rows FROM loans),
  (SELECT CAST(SUM(o) AS BIGINT) AS total_outliers FROM ({_union(outs)}))
)""")


@register("quality_score", _score_sql())
def q_quality_score(spark, sf):
    """A5: weighted quality score of the loan table and the pass flag."""
    return rounded(qa.quality_score(loan_table(spark, sf)))


def _rules_sql():
    nc = len(LOAN_COLS)
    miss = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in LOAN_COLS)
    bad = " || ".join(f"CASE WHEN (COUNT(*) - COUNT({c})) * 2 > COUNT(*) THEN ',{c}' ELSE '' END" for c in sorted(LOAN_COLS))
    return with_views(f"""
SELECT 'data_quality_loans' AS validation_type, total_rows, {nc} AS total_columns, total_rows * {nc} AS total_cells,
 missing_cells, round(mr, 6) AS missing_rate, duplicate_rows, round(dr, 6) AS duplicate_rate,
 round((1 - mr) * (1 - dr), 6) AS quality_score, errs = '' AS is_valid, errs AS errors,
 CASE WHEN mr <= 0.5 AND mr > 0.1 THEN 'high_missing_rate' ELSE '' END AS warnings FROM (
 SELECT *, array_to_string(list_filter([
   CASE WHEN total_rows = 0 THEN 'empty' END, CASE WHEN mr > 0.5 THEN 'missing_rate' END,
   CASE WHEN dr > 0.01 THEN 'duplicate_rate' END,
   CASE WHEN bad <> '' THEN 'columns_missing:' || substr(bad, 2) END,
   CASE WHEN (1 - mr) * (1 - dr) < 0.8 THEN 'quality_score' END], lambda x: x IS NOT NULL), '; ') AS errs FROM (
  SELECT *, missing_cells * 1.0e0 / (total_rows * {nc}) AS mr, duplicate_rows * 1.0e0 / total_rows AS dr FROM (
   SELECT COUNT(*) AS total_rows, {miss} AS missing_cells, {bad} AS bad FROM loans),
   (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM loans)) AS duplicate_rows FROM loans)))""")


@register("quality_rules", _rules_sql())
def q_quality_rules(spark, sf):
    """Validator metrics and rule results for the loan table."""
    return rounded(qa.quality_rules(loan_table(spark, sf), "loans"))


@register("temporal_split", with_views(f"""
SELECT MAX(CASE WHEN s='train' THEN mn END) AS train_date_min, MAX(CASE WHEN s='train' THEN mx END) AS train_date_max,
 MAX(CASE WHEN s='validation' THEN mn END) AS validation_date_min, MAX(CASE WHEN s='validation' THEN mx END) AS validation_date_max,
 MAX(CASE WHEN s='backtest' THEN mn END) AS backtest_date_min, MAX(CASE WHEN s='backtest' THEN mx END) AS backtest_date_max,
 datediff('day', MAX(CASE WHEN s='train' THEN mx END), MAX(CASE WHEN s='validation' THEN mn END)) AS train_validation_gap_days,
 datediff('day', MAX(CASE WHEN s='validation' THEN mx END), MAX(CASE WHEN s='backtest' THEN mn END)) AS validation_backtest_gap_days,
 MAX(CASE WHEN s='train' THEN mx END) < MAX(CASE WHEN s='validation' THEN mn END)
  AND MAX(CASE WHEN s='validation' THEN mx END) < MAX(CASE WHEN s='backtest' THEN mn END) AS is_valid,
 '' AS errors
FROM (SELECT {SPLIT_CASE} AS s, MIN(issue_d) AS mn, MAX(issue_d) AS mx FROM loans GROUP BY 1)"""))
def q_temporal_split(spark, sf):
    """Date ranges per split and the ordering check."""
    return qa.temporal_split_check(with_split(loan_table(spark, sf)))


@register("date_consistency", with_views("""
SELECT MIN(issue_d) AS date_range_min, MAX(issue_d) AS date_range_max,
 datediff('day', MIN(issue_d), MAX(issue_d)) AS date_span_days, COUNT(*) - COUNT(issue_d) AS null_dates,
 round((COUNT(*) - COUNT(issue_d)) * 1.0e0 / COUNT(*), 6) AS null_date_rate,
 NOT (MAX(issue_d) > current_date) AS is_valid,
 CASE WHEN MAX(issue_d) > current_date THEN 'future_dates' ELSE '' END AS errors,
 array_to_string(list_filter([CASE WHEN COUNT(*) - COUNT(issue_d) > 0 THEN 'null_dates' END,
   CASE WHEN year(MIN(issue_d)) < 2007 THEN 'before_min_year' END], lambda x: x IS NOT NULL), '; ') AS warnings
FROM loans"""))
def q_date_consistency(spark, sf):
    """A10: issue-date range, nulls, early and future dates."""
    return rounded(qa.date_consistency(loan_table(spark, sf)))


@register("quarter_range_check", with_views("""
SELECT outcome_quarter AS data_quarter, COUNT(*) AS rows,
 COUNT(*) FILTER (WHERE NOT COALESCE(outcome_date >= make_date(CAST(substr(outcome_quarter,1,4) AS INTEGER),
   (CAST(substr(outcome_quarter,6,1) AS INTEGER) - 1) * 3 + 1, 1)
  AND outcome_date < make_date(CAST(substr(outcome_quarter,1,4) AS INTEGER), (CAST(substr(outcome_quarter,6,1) AS INTEGER) - 1) * 3 + 1, 1)
   + INTERVAL 3 MONTH, FALSE)) AS invalid_rows
FROM (SELECT outcome_quarter, CASE WHEN obs_seq = 1 THEN outcome_date - 100 ELSE outcome_date END AS outcome_date
      FROM outcomes) GROUP BY 1""", OUTCOMES_SQL))
def q_quarter_range(spark, sf):
    """rows dated outside their quarter (first observations are shifted
    back 100 days so that the check has rows to catch)."""
    o = outcome_table(spark, sf)
    o = o.withColumn("outcome_date", F.when(F.col("obs_seq") == 1, F.date_sub("outcome_date", 100))
                     .otherwise(F.col("outcome_date")))
    return qa.quarter_range_check(o, "outcome_date", "outcome_quarter").withColumnRenamed(
        "outcome_quarter", "data_quarter")


@register("list_quarters", with_views("SELECT DISTINCT data_quarter FROM loans"))
def q_list_quarters(spark, sf):
    """Available quarters."""
    return list_quarters(loan_table(spark, sf))


# ------------------------------------------------------------------ compliance
_LEAK = " OR ".join([f"regexp_matches(c, '{p}')" for p in
                     [".*pymnt.*", ".*rec_.*", "chargeoff.*", "settlement.*", "collection.*", "recovery.*"]])
_FIELDS = ("'loan_status','last_pymnt_d','last_pymnt_amnt','next_pymnt_d','total_rec_prncp','total_rec_int',"
           "'recoveries','collection_recovery_fee','out_prncp','out_prncp_inv'")


@register("drop_leaking", with_views(f"""
SELECT COLUMNS(lambda c: NOT ({_LEAK} OR c IN ({_FIELDS}))) FROM wide""", LOANS_SQL, PAYMENTS_SQL))
def q_drop_leaking(spark, sf):
    """Drop columns that leak the outcome (search semantics)."""
    return cp.drop_leaking(loans_with_payments(spark, sf), mode="search")


@register("feature_compliance", with_views(f"""
SELECT column_name AS feature_name,
 CASE WHEN column_name IN ({_FIELDS}) THEN 'field'
  WHEN regexp_matches(column_name, '(?i)^(.*pymnt.*)') THEN '.*pymnt.*'
  WHEN regexp_matches(column_name, '(?i)^(.*rec_.*)') THEN '.*rec_.*'
  WHEN regexp_matches(column_name, '(?i)^(chargeoff.*)') THEN 'chargeoff.*'
  WHEN regexp_matches(column_name, '(?i)^(settlement.*)') THEN 'settlement.*'
  WHEN regexp_matches(column_name, '(?i)^(collection.*)') THEN 'collection.*'
  WHEN regexp_matches(column_name, '(?i)^(recovery.*)') THEN 'recovery.*' END AS matched_rule,
 matched_rule IS NOT NULL AS is_prohibited
FROM (DESCRIBE SELECT * FROM wide)""", LOANS_SQL, PAYMENTS_SQL))
def q_feature_compliance(spark, sf):
    """Every column name of the full loan file checked against the
    listing-time rules."""
    return cp.feature_compliance(spark, loans_with_payments(spark, sf).columns)


# ------------------------------------------------------------------ targets
_LAST_SQL = """
last AS (
 SELECT id, CASE WHEN loan_status IN ('Charged Off','Default','Does not meet the credit policy. Status:Charged Off')
  THEN 1 ELSE 0 END AS outcome_flag, outcome_date AS last_outcome_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY outcome_date DESC, obs_seq DESC) AS rn FROM outcomes {where})
 WHERE rn = 1)"""


@register("target_matching", with_views("""
SELECT loans.id, data_quarter, last_outcome_date, outcome_flag IS NULL AS censored,
 COALESCE(outcome_flag, 0) AS label FROM loans LEFT JOIN last ON loans.id = last.id""",
                                          LOANS_SQL, OUTCOMES_SQL, _LAST_SQL.format(where="")))
def q_target_matching(spark, sf):
    """Label from the last later outcome per loan; no outcome -> 0, censored."""
    lv = loan_table(spark, sf).select("id", "data_quarter", "issue_d")
    return tg.match_outcomes(lv, outcome_table(spark, sf)).select(
        "id", "data_quarter", "last_outcome_date", "censored", "label")


@register("target_window", with_views("""
SELECT loans.id, data_quarter, last_outcome_date, outcome_flag IS NULL AS censored,
 COALESCE(outcome_flag, 0) AS label FROM loans LEFT JOIN last ON loans.id = last.id""",
                                        LOANS_SQL, OUTCOMES_SQL, _LAST_SQL.format(
        where="o WHERE outcome_date >= (SELECT issue_d FROM loans WHERE loans.id = o.id) + INTERVAL 1 MONTH")))
def q_target_window(spark, sf):
    """Only observations at least one month after issue count."""
    lv = loan_table(spark, sf).select("id", "data_quarter", "issue_d")
    return tg.match_outcomes(lv, outcome_table(spark, sf), window_months=1).select(
        "id", "data_quarter", "last_outcome_date", "censored", "label")


@register("target_split_windows", with_views(f"""
SELECT loans.id, data_quarter, last_outcome_date, outcome_flag IS NULL AS censored,
 COALESCE(outcome_flag, 0) AS label FROM loans LEFT JOIN last ON loans.id = last.id""",
                                               LOANS_SQL, OUTCOMES_SQL, _LAST_SQL.format(
        where=f"""o WHERE outcome_date >= (SELECT issue_d + to_months(CASE {SPLIT_CASE.replace('data_quarter', 'l.data_quarter')}
          WHEN 'train' THEN 3 WHEN 'validation' THEN 2 ELSE 1 END) FROM loans l WHERE l.id = o.id)""")))
def q_target_split_windows(spark, sf):
    """J2 + J3: observation window per split (3 / 2 / 1 months)."""
    lv = with_split(loan_table(spark, sf).select("id", "data_quarter", "issue_d"))
    return tg.match_outcomes_by_split(lv, outcome_table(spark, sf), {"train": 3, "validation": 2, "backtest": 1}) \
        .select("id", "data_quarter", "last_outcome_date", "censored", "label")


OUTCOME_QUARTERS = {"train": [f"{y}Q{q}" for y in (1999, 2000) for q in range(1, 5)], "validation": ["2000Q3", "2000Q4", "2001Q1"],
                    "backtest": ["2001Q2", "2001Q3", "2001Q4"]}
_QUARTERS_SQL = " ".join(f"WHEN '{s}' THEN o.outcome_quarter IN ({', '.join(map(repr, qs))})" for s, qs in OUTCOME_QUARTERS.items())


@register("target_outcome_quarters", with_views(f"""
SELECT loans.id, data_quarter, last_outcome_date, outcome_flag IS NULL AS censored,
 COALESCE(outcome_flag, 0) AS label FROM loans LEFT JOIN last ON loans.id = last.id""",
                                                  LOANS_SQL, OUTCOMES_SQL, _LAST_SQL.format(
        where=f"""o WHERE (SELECT outcome_date >= issue_d + to_months(CASE {SPLIT_CASE.replace('data_quarter', 'l.data_quarter')}
          WHEN 'train' THEN 12 WHEN 'validation' THEN 6 ELSE 3 END) AND CASE {SPLIT_CASE.replace('data_quarter', 'l.data_quarter')} {_QUARTERS_SQL} END
          FROM loans l WHERE l.id = o.id)""")))
def q_target_outcome_quarters(spark, sf):
    """Each split's labels from its own outcome quarters, 12 / 6 / 3 months
    after issue."""
    lv = with_split(loan_table(spark, sf).select("id", "data_quarter", "issue_d"))
    return tg.match_outcomes_by_split(lv, outcome_table(spark, sf), {"train": 12, "validation": 6, "backtest": 3}, outcome_quarters=OUTCOME_QUARTERS) \
        .select("id", "data_quarter", "last_outcome_date", "censored", "label")


@register("target_distribution", with_views("""
SELECT data_quarter, label, COUNT(*) AS n, round(COUNT(*) * 1.0e0 / SUM(COUNT(*)) OVER (PARTITION BY data_quarter), 6) AS share
FROM (SELECT data_quarter, COALESCE(outcome_flag, 0) AS label FROM loans LEFT JOIN last ON loans.id = last.id)
GROUP BY data_quarter, label""", LOANS_SQL, OUTCOMES_SQL, _LAST_SQL.format(where="")))
def q_target_distribution(spark, sf):
    """Label counts and prevalence per quarter."""
    lv = loan_table(spark, sf).select("id", "data_quarter", "issue_d")
    m = tg.match_outcomes(lv, outcome_table(spark, sf))
    return rounded(qa.target_distribution(m, "label", ["data_quarter"]))


@register("synthetic_risk", with_views("""
SELECT id, CASE WHEN int_rate IS NOT NULL THEN round(LEAST(0.60e0, GREATEST(0.001e0, COALESCE(CASE sub_grade
  WHEN 'A1' THEN 0.005 WHEN 'A2' THEN 0.008 WHEN 'A3' THEN 0.012 WHEN 'A4' THEN 0.015 WHEN 'A5' THEN 0.020
  WHEN 'B1' THEN 0.025 WHEN 'B2' THEN 0.030 WHEN 'B3' THEN 0.035 WHEN 'B4' THEN 0.045 WHEN 'B5' THEN 0.055
  WHEN 'C1' THEN 0.065 WHEN 'C2' THEN 0.075 WHEN 'C3' THEN 0.085 WHEN 'C4' THEN 0.095 WHEN 'C5' THEN 0.105
  WHEN 'D1' THEN 0.120 WHEN 'D2' THEN 0.135 WHEN 'D3' THEN 0.150 WHEN 'D4' THEN 0.170 WHEN 'D5' THEN 0.190
  WHEN 'E1' THEN 0.210 WHEN 'E2' THEN 0.230 WHEN 'E3' THEN 0.250 WHEN 'E4' THEN 0.270 WHEN 'E5' THEN 0.290
  WHEN 'F1' THEN 0.320 WHEN 'F2' THEN 0.350 WHEN 'F3' THEN 0.380 WHEN 'F4' THEN 0.410 WHEN 'F5' THEN 0.440
  WHEN 'G1' THEN 0.470 WHEN 'G2' THEN 0.500 WHEN 'G3' THEN 0.530 WHEN 'G4' THEN 0.560 WHEN 'G5' THEN 0.600 END, 0.15)
  + (int_rate - mn) / (mx - mn) * 0.1e0)), 6) END AS synthetic_probability
FROM loans, (SELECT MIN(int_rate) AS mn, MAX(int_rate) AS mx FROM loans)"""))
def q_synthetic_risk(spark, sf):
    """Synthetic default probability (the draw itself is seeded, see
    ``synthetic_label``)."""
    return rounded(tg.synthetic_probability(loan_table(spark, sf)).select("id", "synthetic_probability"))


@register("binned_aggregate", with_views("""
SELECT bin, COUNT(*) AS count, round(AVG(value), 6) AS mean, round(STDDEV_SAMP(value), 6) AS std,
 round(MIN(value), 6) AS min, round(MAX(value), 6) AS max, round(MEDIAN(value), 6) AS median, round(SUM(value), 6) AS sum
FROM (SELECT value, GREATEST(1, CAST(ceil((value - lo) / ((hi - lo) / 10)) AS INTEGER)) AS bin FROM events,
      (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events) WHERE value IS NOT NULL) GROUP BY bin""", ""))
def q_binned_aggregate(spark, sf):
    """Ten equal-width bins of event value with per-bin statistics."""
    from ..sources.tables import table
    ev = table(spark, sf, "events")
    return rounded(qa.binned_aggregate(ev, "value", "value", 10))


CORR_COLS = ["loan_amnt", "int_rate", "annual_inc", "dti", "revol_bal", "pd", "is_default"]


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM loans")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM loans")
    return with_views(f"SELECT col_a, col_b, round(corr, 6) AS corr FROM ({_union(parts)})")


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    """Pearson correlation of loan columns, every ordered pair."""
    return rounded(qa.correlation_matrix(loan_table(spark, sf), CORR_COLS))
