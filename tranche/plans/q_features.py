"""Queries: feature blocks, fitted categories, alignment, prep estimators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import prep
from ..sources.tables import table
from .feature_plan import FeaturePlan
from .inputs import labelled_loans
from .registry import register, rounded
from .views import LABELLED_SQL, LOANS_SQL, OUTCOMES_SQL, with_views

VIEWS = (LOANS_SQL, OUTCOMES_SQL, LABELLED_SQL)


def _clip_lower(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE GREATEST(CAST({x} AS DOUBLE), 1e0) END)"


def _clip(x: str, lo: str = "0e0", hi: str = "1e0") -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE LEAST(GREATEST(CAST({x} AS DOUBLE), {lo}), {hi}) END)"


def _flag(c: str) -> str:
    return f"CAST(COALESCE({c}, FALSE) AS INTEGER)"


def _ln1p(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE ln(1 + CAST({x} AS DOUBLE)) END)"


_SUBRANK = "CAST(position(substr(sub_grade,1,1) IN 'ABCDEFG') * 5 - 5 + TRY_CAST(substr(sub_grade,2,1) AS INTEGER) AS DOUBLE)"
_MONTHS = "(datediff('day', earliest_cr_line, issue_d) / 30.44e0)"
_AGE10 = "datediff('day', earliest_cr_line, issue_d) / 365.25e0 / 10"

LOAN_SQL = [
    ("loan_amount", "CAST(loan_amnt AS DOUBLE)"), ("loan_amount_log", _ln1p("loan_amnt")),
    ("funded_amount", "CAST(funded_amnt AS DOUBLE)"), ("funding_ratio", f"funded_amnt / {_clip_lower('loan_amnt')}"),
    ("interest_rate", "int_rate"), ("int_rate_low", _flag("int_rate < 0.10")),
    ("int_rate_medium", _flag("int_rate >= 0.10 AND int_rate < 0.15")), ("int_rate_high", _flag("int_rate >= 0.15")),
    ("term", "CAST(term AS DOUBLE)"), ("term_36", _flag("term = 36")), ("term_60", _flag("term = 60")),
    ("installment", "installment"), ("installment_to_income", f"installment * 12 / {_clip_lower('annual_inc')}"),
    ("sub_grade_numeric", f"CASE WHEN regexp_full_match(sub_grade, '[A-G][1-5]') THEN {_SUBRANK} END"),
]
BORROWER_SQL = [
    ("annual_income", "annual_inc"), ("annual_income_log", _ln1p("annual_inc")),
    ("income_low", _flag("annual_inc < 40000")), ("income_medium", _flag("annual_inc >= 40000 AND annual_inc < 80000")),
    ("income_high", _flag("annual_inc >= 80000")), ("emp_length_years", "emp_length_years"),
    ("emp_length_missing", "CAST(emp_length_years IS NULL AS INTEGER)"), ("emp_stable", _flag("emp_length_years >= 5")),
    ("emp_new", _flag("emp_length_years < 1")), ("dti", "dti"), ("dti_high", _flag("dti > 20")),
    ("dti_very_high", _flag("dti > 30")),
]
CREDIT_SQL = [
    ("credit_history_months", _MONTHS), ("credit_history_years", f"{_MONTHS} / 12"),
    ("credit_history_short", _flag(f"{_MONTHS} < 36")), ("credit_history_long", _flag(f"{_MONTHS} > 120")),
    ("delinq_2yrs", "CAST(delinq_2yrs AS DOUBLE)"), ("has_delinq", _flag("delinq_2yrs > 0")),
    ("delinq_multiple", _flag("delinq_2yrs > 1")), ("inq_last_6mths", "CAST(inq_last_6mths AS DOUBLE)"),
    ("has_recent_inq", _flag("inq_last_6mths > 0")), ("inq_high", _flag("inq_last_6mths > 2")),
    ("open_acc", "CAST(open_acc AS DOUBLE)"), ("total_acc", "CAST(total_acc AS DOUBLE)"),
    ("acc_utilization", f"open_acc / {_clip_lower('total_acc')}"), ("pub_rec", "CAST(pub_rec AS DOUBLE)"),
    ("has_pub_rec", _flag("pub_rec > 0")), ("revol_bal", "revol_bal"), ("revol_bal_log", _ln1p("revol_bal")),
    ("revol_util", "revol_util"), ("revol_util_high", _flag("revol_util > 0.75")),
    ("revol_util_maxed", _flag("revol_util > 0.90")),
]
_LTI = f"(loan_amnt / {_clip_lower('annual_inc')})"
DERIVED_SQL = [
    ("loan_to_income", _LTI), ("loan_to_income_low", _flag(f"{_LTI} < 0.2")),
    ("loan_to_income_high", _flag(f"{_LTI} > 0.5")),
    ("revol_bal_to_income", f"revol_bal / {_clip_lower('annual_inc')}"),
    ("total_debt_to_income", f"(installment + revol_bal * 0.03) * 12 / {_clip_lower('annual_inc')}"),
    ("credit_maturity_score", f"({_clip(_AGE10)} + "
                              f"{_clip('total_acc / 50')} + (1 - {_clip('delinq_2yrs / 5')})) / 3"),
    ("combined_risk_score", "(COALESCE(CASE substr(sub_grade,1,1) WHEN 'A' THEN 0.1e0 WHEN 'B' THEN 0.2e0 WHEN 'C' THEN 0.3e0 "
                            "WHEN 'D' THEN 0.4e0 WHEN 'E' THEN 0.5e0 WHEN 'F' THEN 0.6e0 WHEN 'G' THEN 0.7e0 END, 0.35e0) + "
                            f"{_clip('revol_util')}) / 2"),
]


def _block_sql(block) -> str:
    cols = ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" if not e.startswith("CAST(COALESCE") and "AS INTEGER)" not in e[-12:]
                     else f"{e} AS {n}" for n, e in block)
    return with_views(f"SELECT id, {cols} FROM labelled", *VIEWS)


def _block_query(spark, sf, fn):
    df = labelled_loans(spark, sf)
    return rounded(df.select("id", *fn(set(df.columns))))


@register("features_loan", _block_sql(LOAN_SQL))
def q_features_loan(spark, sf):
    """Loan-characteristic features."""
    return _block_query(spark, sf, fx.loan_block)


@register("features_borrower", _block_sql(BORROWER_SQL))
def q_features_borrower(spark, sf):
    """Borrower features."""
    return _block_query(spark, sf, fx.borrower_block)


@register("features_credit", _block_sql(CREDIT_SQL))
def q_features_credit(spark, sf):
    """Credit-history features (fractional utilisation)."""
    return _block_query(spark, sf, fx.credit_block)


@register("features_derived", _block_sql(DERIVED_SQL))
def q_features_derived(spark, sf):
    """Derived ratios and scores."""
    return _block_query(spark, sf, fx.derived_block)


_WS = fx.WHITESPACE
_TEXT_SQL = ", ".join(
    [f"CAST(regexp_matches(t, '{p}') AS INTEGER) AS {n}" for n, p in
     [("job_manager", "manager|mgr"), ("job_teacher", "teacher|education"), ("job_nurse", "nurse|rn"),
      ("job_driver", "driver|truck"), ("job_engineer", "engineer|tech"), ("job_sales", "sales|retail")]]
    + ["length(t) AS emp_title_length"]
    + [f"CAST(regexp_matches(t, '{p}') AS INTEGER) AS {n}" for n, p in
       [("title_debt", "debt|consolidat"), ("title_credit", "credit card"), ("title_home", "home|house"),
        ("title_car", "car|auto"), ("title_business", "business|startup")]]
    + [f"CAST(len(list_filter(regexp_split_to_array(t, '{_WS}'), lambda x: x <> '')) AS INTEGER) AS title_word_count",
       "CAST(COALESCE(regexp_matches(t, '[0-9]'), FALSE) AS INTEGER) AS has_digits"])


@register("features_text", f"SELECT doc_id, {_TEXT_SQL} FROM (SELECT doc_id, lower(COALESCE(text, '')) AS t FROM documents)")
def q_features_text(spark, sf):
    """X5 + D20 on whole document texts (used as job title and loan title)."""
    d = table(spark, sf, "documents")
    t = F.col("text")
    return d.select("doc_id", *fx.text_block(t, t), fx.digits_flag(F.lower(F.coalesce(t, F.lit("")))).alias("has_digits"))


# ------------------------------------------------------------------ fitted categories
def _fit(spark, sf, **kw):
    df = labelled_loans(spark, sf)
    plan = FeaturePlan(**kw)
    return df, plan.fit(df.where(F.col("split") == "train"))


@register("one_hot", with_views("""
SELECT l.id, c.prefix || '_' || c.v AS feature, CAST(COALESCE(CASE c.src WHEN 'grade' THEN l.grade = c.v
  WHEN 'purpose' THEN l.purpose = c.v WHEN 'home_ownership' THEN l.home_ownership = c.v
  ELSE l.verification_status = c.v END, FALSE) AS INTEGER) AS value
FROM labelled l, (
 SELECT DISTINCT 'grade' AS src, 'grade' AS prefix, grade AS v FROM labelled WHERE split = 'train' AND grade IS NOT NULL
 UNION ALL SELECT DISTINCT 'purpose', 'purpose', purpose FROM labelled WHERE split = 'train' AND purpose IS NOT NULL
 UNION ALL SELECT DISTINCT 'home_ownership', 'home', home_ownership FROM labelled WHERE split = 'train' AND home_ownership IS NOT NULL
 UNION ALL SELECT DISTINCT 'verification_status', 'verified', verification_status FROM labelled
   WHERE split = 'train' AND verification_status IS NOT NULL) c""", *VIEWS))
def q_one_hot(spark, sf):
    """Dummies over the values seen in training, applied to every row
    (long form: one row per loan and dummy)."""
    df = labelled_loans(spark, sf)
    fitted = FeaturePlan(top_states=0).fit_categories(df.where(F.col("split") == "train"))
    d = df.select("id", *fitted.dummy_exprs())
    names = [c for c in d.columns if c != "id"]
    return d.select("id", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value"))
                                               for n in names])).alias("r")).select("id", "r.feature", "r.value")


@register("topk_state", with_views("""
SELECT addr_state, COUNT(*) AS n FROM labelled WHERE split = 'train' AND addr_state IS NOT NULL
GROUP BY addr_state ORDER BY n DESC, addr_state LIMIT 10""", *VIEWS))
def q_topk_state(spark, sf):
    """The ten most frequent states of the training rows."""
    df = labelled_loans(spark, sf).where(F.col("split") == "train").where(F.col("addr_state").isNotNull())
    return df.groupBy("addr_state").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "addr_state").limit(10)


@register("align_columns", with_views("""
SELECT b.id, 'state_' || t.addr_state AS feature,
 CASE WHEN t.addr_state IN (SELECT addr_state FROM btop) THEN CAST(b.addr_state = t.addr_state AS INTEGER) * 1.0e0 ELSE 0.0e0 END AS value
FROM (SELECT * FROM labelled WHERE split = 'backtest') b, ttop t""", *VIEWS,
    """ttop AS (SELECT addr_state FROM labelled WHERE split = 'train' AND addr_state IS NOT NULL
     GROUP BY addr_state ORDER BY COUNT(*) DESC, addr_state LIMIT 10)""",
    """btop AS (SELECT addr_state FROM labelled WHERE split = 'backtest' AND addr_state IS NOT NULL
     GROUP BY addr_state ORDER BY COUNT(*) DESC, addr_state LIMIT 10)"""))
def q_align_columns(spark, sf):
    """Backtest state flags built with the backtest's own top states,
    aligned to the training names (missing -> 0.0, extras dropped)."""
    df = labelled_loans(spark, sf)
    train_states = FeaturePlan().fit_categories(df.where(F.col("split") == "train")).states
    bt = df.where(F.col("split") == "backtest")
    own = FeaturePlan().fit_categories(bt)
    flags = bt.select("id", *[F.coalesce(F.col("addr_state") == s, F.lit(False)).cast("double").alias(f"state_{s}")
                              for s in own.states])
    names = [f"state_{s}" for s in train_states]
    al = prep.align_columns(flags, names, keep=["id"])
    return al.select("id", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("value"))
                                               for n in names])).alias("r")).select("id", "r.feature", "r.value")


# ------------------------------------------------------------------ imputation
IMPUTE_COLS = ["int_rate", "annual_inc", "emp_length_years", "revol_bal", "open_acc"]


def _impute_sql(agg: str) -> str:
    parts = [f"SELECT '{c}' AS column_name, round(CAST({agg.format(c=c)} AS DOUBLE), 6) AS fill_value FROM labelled "
             f"WHERE split = 'train'" for c in IMPUTE_COLS]
    return with_views("\nUNION ALL\n".join(parts), *VIEWS)


def _impute_query(spark, sf, strategy):
    df = labelled_loans(spark, sf)
    fit = prep.fit_imputer(df.where(F.col("split") == "train").select(*IMPUTE_COLS), IMPUTE_COLS, strategy)
    return rounded(fit.table(spark).select("column_name", "fill_value"))


@register("impute_median", _impute_sql("median({c})"))
def q_impute_median(spark, sf):
    """Exact training medians of columns with missing values."""
    return _impute_query(spark, sf, "median")


@register("impute_mean", _impute_sql("avg({c})"))
def q_impute_mean(spark, sf):
    """Training means."""
    return _impute_query(spark, sf, "mean")


def _mode_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, round(CAST((SELECT {c} FROM labelled WHERE split = 'train' AND {c} IS NOT NULL "
             f"GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS DOUBLE), 6) AS fill_value" for c in IMPUTE_COLS]
    return with_views("\nUNION ALL\n".join(parts), *VIEWS)


@register("impute_mode", _mode_sql())
def q_impute_mode(spark, sf):
    """Most frequent training value (smallest among ties)."""
    return _impute_query(spark, sf, "most_frequent")


@register("impute_apply", with_views("""
SELECT id, round(COALESCE(int_rate, m_rate), 6) AS int_rate, round(COALESCE(annual_inc, m_inc), 6) AS annual_inc,
 round(COALESCE(emp_length_years, m_emp), 6) AS emp_length_years
FROM labelled, (SELECT median(int_rate) AS m_rate, median(annual_inc) AS m_inc, median(emp_length_years) AS m_emp
 FROM labelled WHERE split = 'train')""", *VIEWS))
def q_impute_apply(spark, sf):
    """E1 fit on training rows, applied to every row."""
    df = labelled_loans(spark, sf)
    cols = ["int_rate", "annual_inc", "emp_length_years"]
    fit = prep.fit_imputer(df.where(F.col("split") == "train").select(*cols), cols, "median")
    return rounded(fit.transform(df.select("id", *cols)))


# ------------------------------------------------------------------ selection / scaling
SELECT_SQL = LOAN_SQL + BORROWER_SQL + CREDIT_SQL + DERIVED_SQL


def _fk_sql(k: int) -> str:
    feats = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in SELECT_SQL)
    med = ", ".join(f"median({n}) AS m_{n}" for n, _ in SELECT_SQL)
    parts = []
    for i, (n, _) in enumerate(SELECT_SQL):
        parts.append(f"""SELECT '{n}' AS feature, {i} AS position, ssbn / (k - 1) / ((sstot - ssbn) / (nn - k)) AS f FROM (
 SELECT SUM(q) - SUM(s) * SUM(s) / SUM(c) AS sstot, SUM(s * s / c) - SUM(s) * SUM(s) / SUM(c) AS ssbn,
  SUM(c) AS nn, COUNT(*) AS k FROM (
  SELECT label, COUNT(*) AS c, SUM(x) AS s, SUM(x * x) AS q FROM (
   SELECT label, COALESCE({n}, m_{n}) AS x FROM feats, meds) GROUP BY label))""")
    body = "\nUNION ALL\n".join(parts)
    return with_views(f"""
SELECT feature, position, round(f, 6) AS f_score,
 row_number() OVER (ORDER BY COALESCE(CASE WHEN isnan(f) THEN NULL ELSE f END, '-inf'::DOUBLE) DESC, position DESC) <= {k} AS selected
FROM ({body})""", *VIEWS, f"feats AS (SELECT label, {feats} FROM labelled WHERE split = 'train')",
                      f"meds AS (SELECT {med} FROM feats)")


@register("select_k_best", _fk_sql(20))
def q_select_k_best(spark, sf):
    """ANOVA F of every engineered feature on the training rows (median
    imputed) and whether it is among the 20 best."""
    df = labelled_loans(spark, sf)
    plan = FeaturePlan(max_features=0, dummies=False, top_states=0, scaling="none")
    fitted = plan.fit(df.where(F.col("split") == "train"))
    train = fitted.transform(df.where(F.col("split") == "train"), scale=False)
    names = fitted.feature_names
    scores = prep.anova_f(train, names, "label")
    chosen = set(prep.select_k_best(scores, 20))
    return rounded(scores).withColumn("selected", F.col("feature").isin(list(chosen)))


def _scale_sql(method: str) -> str:
    parts = []
    for n, _ in SELECT_SQL:
        x = f"COALESCE({n}, m_{n})"
        if method == "standard":
            c, s = f"AVG({x})", f"STDDEV_POP({x})"
        elif method == "minmax":
            c, s = f"MIN({x})", f"MAX({x}) - MIN({x})"
        else:
            c, s = f"quantile_cont({x}, 0.5)", f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"
        parts.append(f"SELECT '{n}' AS feature, {c} AS center, {s} AS spread FROM feats, meds")
    feats = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in SELECT_SQL)
    med = ", ".join(f"median({n}) AS m_{n}" for n, _ in SELECT_SQL)
    return with_views(f"""
SELECT feature, round(center, 6) AS center, round(CASE WHEN spread = 0 OR spread IS NULL THEN 1e0 ELSE spread END, 6) AS scale
FROM ({' UNION ALL '.join(parts)})""", *VIEWS, f"feats AS (SELECT label, {feats} FROM labelled WHERE split = 'train')",
                      f"meds AS (SELECT {med} FROM feats)")


def _scale_query(spark, sf, method):
    df = labelled_loans(spark, sf)
    plan = FeaturePlan(max_features=0, dummies=False, top_states=0, scaling=method)
    fitted = plan.fit(df.where(F.col("split") == "train"))
    return rounded(fitted.scaler.table(spark))


@register("scale_standard", _scale_sql("standard"))
def q_scale_standard(spark, sf):
    """Training mean and population deviation per feature."""
    return _scale_query(spark, sf, "standard")


@register("scale_minmax", _scale_sql("minmax"))
def q_scale_minmax(spark, sf):
    """Training minimum and range per feature."""
    return _scale_query(spark, sf, "minmax")


@register("scale_robust", _scale_sql("robust"))
def q_scale_robust(spark, sf):
    """E5: training median and inter-quartile range per feature."""
    return _scale_query(spark, sf, "robust")


@register("feature_matrix")
def q_feature_matrix(spark, sf):
    """X1-X8 + E1-E3 + P8-P10 end to end: fit on training rows, transform all
    rows (rows-only check)."""
    df, fitted = _fit(spark, sf)
    return fitted.transform(df)
