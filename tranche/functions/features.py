"""Feature expression blocks (X1-X5).  Each block returns a list of named
Columns; a feature table is one ``select`` of all blocks (no joins, no
per-block copies), so it is whole-stage generated.

Missing values follow the source behaviour: a numeric feature of a missing
input is missing; a 0/1 flag of a missing input is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import JOB_TITLE_PATTERNS, LETTER_RISK, LETTER_RISK_UNKNOWN, LOAN_TITLE_PATTERNS
from .rows import sub_grade_rank

# Whitespace as Python's str.split() sees it (ASCII and Unicode spaces).
WHITESPACE = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
              r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")


def flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_lower(c: Column, lo: float) -> Column:
    """Like pandas clip(lower=): missing stays missing."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(c.cast("double"), F.lit(lo)))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(c.cast("double"), F.lit(lo)), F.lit(hi)))


def log1p(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.log1p(c.cast("double")))


def _has(cols, *names):
    return all(n in cols for n in names)


def loan_block(cols: set[str]) -> list[Column]:
    """X1 (without dummies): amounts, funding ratio, rate buckets, term,
    instalment burden, sub-grade rank."""
    out = []
    if _has(cols, "loan_amnt"):
        out += [F.col("loan_amnt").cast("double").alias("loan_amount"), log1p(F.col("loan_amnt")).alias("loan_amount_log")]
    if _has(cols, "funded_amnt"):
        out.append(F.col("funded_amnt").cast("double").alias("funded_amount"))
        if _has(cols, "loan_amnt"):
            out.append((F.col("funded_amnt") / clip_lower(F.col("loan_amnt"), 1)).alias("funding_ratio"))
    if _has(cols, "int_rate"):
        r = F.col("int_rate")
        out += [r.cast("double").alias("interest_rate"), flag(r < 0.10).alias("int_rate_low"),
                flag((r >= 0.10) & (r < 0.15)).alias("int_rate_medium"), flag(r >= 0.15).alias("int_rate_high")]
    if _has(cols, "term"):
        t = F.col("term")
        out += [t.cast("double").alias("term"), flag(t == 36).alias("term_36"), flag(t == 60).alias("term_60")]
    if _has(cols, "installment"):
        out.append(F.col("installment").cast("double").alias("installment"))
        if _has(cols, "annual_inc"):
            out.append((F.col("installment") * 12 / clip_lower(F.col("annual_inc"), 1)).alias("installment_to_income"))
    if _has(cols, "sub_grade"):
        out.append(sub_grade_rank("sub_grade").cast("double").alias("sub_grade_numeric"))
    return out


def borrower_block(cols: set[str]) -> list[Column]:
    """X2 (without dummies and state flags)."""
    out = []
    if _has(cols, "annual_inc"):
        i = F.col("annual_inc")
        out += [i.cast("double").alias("annual_income"), log1p(i).alias("annual_income_log"),
                flag(i < 40000).alias("income_low"), flag((i >= 40000) & (i < 80000)).alias("income_medium"),
                flag(i >= 80000).alias("income_high")]
    if _has(cols, "emp_length_years"):
        e = F.col("emp_length_years")
        out += [e.cast("double").alias("emp_length_years"), e.isNull().cast("int").alias("emp_length_missing"),
                flag(e >= 5).alias("emp_stable"), flag(e < 1).alias("emp_new")]
    if _has(cols, "dti"):
        d = F.col("dti")
        out += [d.cast("double").alias("dti"), flag(d > 20).alias("dti_high"), flag(d > 30).alias("dti_very_high")]
    return out


def credit_block(cols: set[str], legacy_units: bool = False) -> list[Column]:
    """X3.  ``revol_util`` is a fraction; the utilisation flags compare with
    .75 / .90 (``legacy_units=True`` compares with 75 / 90 as the source
    did, which never fires on fractions)."""
    out = []
    if _has(cols, "earliest_cr_line", "issue_d"):
        m = F.datediff("issue_d", "earliest_cr_line") / 30.44
        out += [m.alias("credit_history_months"), (m / 12).alias("credit_history_years"),
                flag(m < 36).alias("credit_history_short"), flag(m > 120).alias("credit_history_long")]
    if _has(cols, "delinq_2yrs"):
        d = F.col("delinq_2yrs")
        out += [d.cast("double").alias("delinq_2yrs"), flag(d > 0).alias("has_delinq"), flag(d > 1).alias("delinq_multiple")]
    if _has(cols, "inq_last_6mths"):
        q = F.col("inq_last_6mths")
        out += [q.cast("double").alias("inq_last_6mths"), flag(q > 0).alias("has_recent_inq"), flag(q > 2).alias("inq_high")]
    if _has(cols, "open_acc"):
        out.append(F.col("open_acc").cast("double").alias("open_acc"))
    if _has(cols, "total_acc"):
        out.append(F.col("total_acc").cast("double").alias("total_acc"))
        if _has(cols, "open_acc"):
            out.append((F.col("open_acc") / clip_lower(F.col("total_acc"), 1)).alias("acc_utilization"))
    if _has(cols, "pub_rec"):
        out += [F.col("pub_rec").cast("double").alias("pub_rec"), flag(F.col("pub_rec") > 0).alias("has_pub_rec")]
    if _has(cols, "revol_bal"):
        out += [F.col("revol_bal").cast("double").alias("revol_bal"), log1p(F.col("revol_bal")).alias("revol_bal_log")]
    if _has(cols, "revol_util"):
        u = F.col("revol_util")
        hi, mx = (75, 90) if legacy_units else (0.75, 0.90)
        out += [u.cast("double").alias("revol_util"), flag(u > hi).alias("revol_util_high"),
                flag(u > mx).alias("revol_util_maxed")]
    return out


def derived_block(cols: set[str], legacy_units: bool = False) -> list[Column]:
    """Ratios to income, credit maturity score, combined risk score."""
    out = []
    inc = clip_lower(F.col("annual_inc"), 1) if "annual_inc" in cols else None
    if _has(cols, "loan_amnt", "annual_inc"):
        lti = F.col("loan_amnt") / inc
        out += [lti.alias("loan_to_income"), flag(lti < 0.2).alias("loan_to_income_low"),
                flag(lti > 0.5).alias("loan_to_income_high")]
    if _has(cols, "revol_bal", "annual_inc"):
        out.append((F.col("revol_bal") / inc).alias("revol_bal_to_income"))
    if _has(cols, "installment", "revol_bal", "annual_inc"):
        out.append(((F.col("installment") + F.col("revol_bal") * 0.03) * 12 / inc).alias("total_debt_to_income"))
    parts = []
    if _has(cols, "earliest_cr_line", "issue_d"):
        parts.append(clip(F.datediff("issue_d", "earliest_cr_line") / 365.25 / 10, 0, 1))
    if _has(cols, "total_acc"):
        parts.append(clip(F.col("total_acc") / 50, 0, 1))
    if _has(cols, "delinq_2yrs"):
        parts.append(1 - clip(F.col("delinq_2yrs") / 5, 0, 1))
    if parts:
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        out.append((total / len(parts)).alias("credit_maturity_score"))
    if _has(cols, "sub_grade", "revol_util"):
        m = F.create_map(*[x for k, v in LETTER_RISK.items() for x in (F.lit(k), F.lit(v))])
        g = F.coalesce(F.element_at(m, F.substring("sub_grade", 1, 1)), F.lit(LETTER_RISK_UNKNOWN))
        u = F.col("revol_util") / 100 if legacy_units else F.col("revol_util")
        out.append(((g + clip(u, 0, 1)) / 2).alias("combined_risk_score"))
    return out


def word_count(text: Column) -> Column:
    """Whitespace-separated words (Python ``str.split()`` semantics)."""
    parts = F.split(text, WHITESPACE)
    return F.size(F.filter(parts, lambda x: x != ""))


def text_block(emp_title: Column | None = None, title: Column | None = None) -> list[Column]:
    """Keyword flags, title length and word count on lower-cased text."""
    out = []
    if emp_title is not None:
        t = F.lower(F.coalesce(emp_title, F.lit("")))
        out += [t.rlike(p).cast("int").alias(name) for name, p in JOB_TITLE_PATTERNS.items()]
        out.append(F.length(t).alias("emp_title_length"))
    if title is not None:
        t = F.lower(F.coalesce(title, F.lit("")))
        out += [t.rlike(p).cast("int").alias(name) for name, p in LOAN_TITLE_PATTERNS.items()]
        out.append(word_count(t).alias("title_word_count"))
    return out


def digits_flag(text: Column) -> Column:
    """The title contains a digit."""
    return flag(text.rlike("[0-9]"))


def base_features(cols: set[str], categories: dict[str, bool] | None = None, legacy_units: bool = False) -> list[Column]:
    """The enabled blocks, in the source's block order."""
    cat = {"loan_characteristics": True, "borrower_attributes": True, "credit_history": True,
           "derived_features": True}
    cat.update(categories or {})
    out = []
    if cat["loan_characteristics"]:
        out += loan_block(cols)
    if cat["borrower_attributes"]:
        out += borrower_block(cols)
    if cat["credit_history"]:
        out += credit_block(cols, legacy_units)
    if cat["derived_features"]:
        out += derived_block(cols, legacy_units)
    return out
