"""Row-level rules and derived properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import (APPLICATION_TYPES, HOME_OWNERSHIP, LOAN_PURPOSES, OUTCOME_DEFAULT_STATUSES,
                    RISK_TIER_EDGES, RISK_TIER_TOP, ROW_MODEL_DEFAULT_STATUSES, SUB_GRADES,
                    VERIFICATION_STATUSES)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sub_grade_rank(c) -> Column:
    """P11: 'A1'..'G5' -> 1..35, anything else NULL (arithmetic on the two
    characters; equal to the 35-entry literal table)."""
    c = _col(c)
    letter = F.instr(F.lit("ABCDEFG"), F.substring(c, 1, 1))
    digit = F.substring(c, 2, 1).try_cast("int")
    ok = c.isin(SUB_GRADES)
    return F.when(ok, (letter - 1) * 5 + digit)


def risk_tier(p) -> Column:
    """LOW < .05 <= MEDIUM < .15 <= HIGH < .30 <= VERY_HIGH."""
    p = _col(p)
    expr = None
    for edge, name in RISK_TIER_EDGES:
        expr = F.when(p < edge, name) if expr is None else expr.when(p < edge, name)
    return expr.otherwise(RISK_TIER_TOP)


def is_default_status(status, statuses=None) -> Column:
    """Status in the default set (row-model set by default)."""
    return _col(status).isin(list(statuses or ROW_MODEL_DEFAULT_STATUSES)).cast("int")


def outcome_default_flag(status) -> Column:
    return is_default_status(status, OUTCOME_DEFAULT_STATUSES)


def _rule(cond: Column, message: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(message))


#: amounts and counts that a loan row may lack but that are never negative
NON_NEGATIVE = ("annual_inc", "dti", "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "total_acc",
                "mths_since_last_delinq", "mths_since_last_record", "annual_inc_joint", "dti_joint", "acc_now_delinq", "tot_coll_amt",
                "tot_cur_bal", "collections_12_mths_ex_med", "mths_since_last_major_derog", "open_acc_6m", "open_act_il", "open_il_12m",
                "open_il_24m", "mths_since_rcnt_il", "total_bal_il", "il_util")


def constraint_violations(df_cols: set[str], rate_is_fraction: bool = True) -> Column:
    """Array of violated rule names (empty = valid row).

    Rules of the typed loan row: amounts > 0, rate in [0, 100 %], term in
    {36, 60}, FICO 300-850 with high >= low, zip length 5, state length 2,
    non-negative counts and balances, enum membership, joint-field
    consistency; id, issue date, zip and state are not missing.  Rules on
    absent columns are skipped.
    """
    rules = []
    has = df_cols.__contains__
    rate_max = 1.0 if rate_is_fraction else 100.0
    if has("funded_amnt"):
        rules.append(_rule(~F.coalesce(F.col("funded_amnt") > 0, F.lit(False)), "funded_amnt_not_positive"))
    if has("installment"):
        rules.append(_rule(~F.coalesce(F.col("installment") > 0, F.lit(False)), "installment_not_positive"))
    if has("int_rate"):
        rules.append(_rule(F.col("int_rate").isNull(), "int_rate_missing"))
        rules.append(_rule((F.col("int_rate") < 0) | (F.col("int_rate") > rate_max), "int_rate_out_of_range"))
    if has("term"):
        rules.append(_rule(~F.col("term").isin(36, 60) | F.col("term").isNull(), "term_invalid"))
    if has("sub_grade"):
        rules.append(_rule(~F.col("sub_grade").isin(SUB_GRADES) | F.col("sub_grade").isNull(), "sub_grade_invalid"))
    if has("home_ownership"):
        rules.append(_rule(~F.col("home_ownership").isin(HOME_OWNERSHIP) | F.col("home_ownership").isNull(),
                           "home_ownership_invalid"))
    if has("verification_status"):
        rules.append(_rule(~F.col("verification_status").isin(VERIFICATION_STATUSES)
                           | F.col("verification_status").isNull(), "verification_status_invalid"))
    if has("purpose"):
        rules.append(_rule(~F.col("purpose").isin(LOAN_PURPOSES) | F.col("purpose").isNull(), "purpose_invalid"))
    if has("zip_code"):
        rules.append(_rule(F.length("zip_code") != 5, "zip_code_length"))
    if has("addr_state"):
        rules.append(_rule(F.length("addr_state") != 2, "addr_state_length"))
    for c in ("id", "issue_d", "zip_code", "addr_state"):
        if has(c):
            rules.append(_rule(F.col(c).isNull(), f"{c}_missing"))
    for c in NON_NEGATIVE:
        if has(c):
            rules.append(_rule(F.col(c) < 0, f"{c}_negative"))
    if has("revol_util"):
        rules.append(_rule((F.col("revol_util") < 0) | (F.col("revol_util") > rate_max), "revol_util_out_of_range"))
    if has("fico_range_low") and has("fico_range_high"):
        for c in ("fico_range_low", "fico_range_high"):
            rules.append(_rule((F.col(c) < 300) | (F.col(c) > 850), f"{c}_out_of_range"))
        rules.append(_rule(F.col("fico_range_high") < F.col("fico_range_low"), "fico_high_below_low"))
    if has("application_type"):
        app = F.col("application_type")
        rules.append(_rule(~app.isin(APPLICATION_TYPES), "application_type_invalid"))
        if has("annual_inc_joint"):
            rules.append(_rule((app == "Joint App") & ~(F.coalesce(F.col("annual_inc_joint"), F.lit(0)) != 0),
                               "joint_without_joint_income"))
            joint_any = F.coalesce(F.col("annual_inc_joint"), F.lit(0)) != 0
            if has("dti_joint"):
                joint_any = joint_any | (F.coalesce(F.col("dti_joint"), F.lit(0)) != 0)
            if has("verification_status_joint"):
                rules.append(_rule(~F.col("verification_status_joint").isin(VERIFICATION_STATUSES), "verification_status_joint_invalid"))
                joint_any = joint_any | (F.coalesce(F.col("verification_status_joint"), F.lit("")) != "")
            rules.append(_rule((app == "Individual") & joint_any, "individual_with_joint_fields"))
    return F.filter(F.array(*rules), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")


def credit_age_years(issue="issue_d", earliest="earliest_cr_line") -> Column:
    """Days between earliest credit line and issue / 365.25."""
    return F.datediff(_col(issue), _col(earliest)) / 365.25


def fico_midpoint(low="fico_range_low", high="fico_range_high") -> Column:
    return (_col(low) + _col(high)) / 2.0


def loan_to_income(amount="funded_amnt", income="annual_inc", joint_income=None,
                   app_type=None) -> Column:
    """Amount / income, joint income for joint applications."""
    inc = _col(income)
    if joint_income is not None and app_type is not None:
        inc = F.when(_col(app_type) == "Joint App", _col(joint_income)).otherwise(inc)
    return F.when(inc > 0, _col(amount) / inc)


def utilisation(used, total) -> Column:
    """Budget utilisation used / total (0 when total is 0)."""
    return F.when(_col(total) > 0, _col(used) / _col(total)).otherwise(F.lit(0.0))


def average_loan(used, count) -> Column:
    """Average investment per loan, 0 for an empty portfolio."""
    return F.when(_col(count) > 0, _col(used) / _col(count)).otherwise(F.lit(0.0))


def is_well_calibrated(slope, intercept) -> Column:
    """P18."""
    return (F.abs(_col(slope) - 1) < 0.2) & (F.abs(_col(intercept)) < 0.1)


def outcome_roi(total_payments, principal) -> Column:
    """(payments - principal) / principal (principal, not the loan id: Q14)."""
    return F.when(_col(principal) > 0, (_col(total_payments) - _col(principal)) / _col(principal))


def extra_features(cols: set[str]) -> list[Column]:
    """FICO average and width, funding ratio and gap, joint flags."""
    out = []
    if {"fico_range_low", "fico_range_high"} <= cols:
        out += [fico_midpoint().alias("fico_avg"),
                (F.col("fico_range_high") - F.col("fico_range_low")).alias("fico_range_width")]
    if {"loan_amnt", "funded_amnt"} <= cols:
        out += [F.when(F.col("funded_amnt") > 0, F.col("loan_amnt") / F.col("funded_amnt")).alias("loan_to_funded_ratio"),
                (F.col("loan_amnt") - F.col("funded_amnt")).alias("funding_gap")]
    if "annual_inc_joint" in cols:
        out.append(F.coalesce(F.col("annual_inc_joint") > 0, F.lit(False)).cast("int").alias("has_joint_income"))
    if "dti_joint" in cols:
        out.append(F.col("dti_joint"))
    return out
