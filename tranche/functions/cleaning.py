"""Tolerant parsing of raw loan-file text.

All are Column -> Column and never raise: ANSI mode is on in Spark 4, so a
plain cast would fail the job on one bad cell; ``try_cast`` turns bad text
into NULL, and NaN is normalised to NULL (NULL is the only missing value).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(c) -> Column:
    """Text or number -> double, bad -> NULL."""
    return nan_to_null(_col(c).cast("string").try_cast("double"))


def term_months(c) -> Column:
    """P2: ' 36 months' -> 36 (first run of digits), none -> NULL."""
    return F.regexp_extract(_col(c).cast("string"), r"(\d+)", 1).try_cast("int")


def percent_to_fraction(c) -> Column:
    """P3: '12.5%' -> 0.125 (trailing percent signs stripped)."""
    txt = F.trim(F.regexp_replace(_col(c).cast("string"), "%+$", ""))
    return nan_to_null(txt.try_cast("double")) / 100.0


def month_year_date(c, pivot_year: int = 69) -> Column:
    """P4: 'Jan-85' -> 1985-01-01; ISO 'yyyy-MM-dd' also accepted (Q17).

    Spark's two-digit year maps to 2000-2099; the file convention maps
    two-digit years >= ``pivot_year`` to 19xx, so such dates move back 100y.
    """
    txt = F.trim(_col(c).cast("string"))
    my = F.to_date(F.try_to_timestamp(txt, F.lit("MMM-yy")))
    fixed = F.when(F.year(my) >= 2000 + pivot_year, F.add_months(my, -1200)).otherwise(my)
    iso = F.to_date(F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")))
    return F.coalesce(fixed, iso)


def emp_length_years(c, legacy: bool = False) -> Column:
    """P5: employment text -> years.

    Default: '< 1 year' -> 0.5, '10+ years' -> 10, 'n years' -> n, else NULL.
    ``legacy=True`` reproduces the file loader exactly: the '<' is removed
    before the under-one-year rule can match, so '< 1 year' becomes 1.0.
    """
    txt = _col(c).cast("string")
    stripped = F.trim(F.regexp_replace(F.regexp_replace(txt, "years?", ""), "[<>]", ""))
    stripped = F.when(stripped == "10+", F.lit("10")).otherwise(stripped)
    parsed = nan_to_null(stripped.try_cast("double"))
    if legacy:
        return parsed
    under_one = F.trim(txt).rlike(r"^<\s*1\s*(years?)?$")
    return F.when(under_one, F.lit(0.5)).otherwise(parsed)


def emp_length_enum_years(c) -> Column:
    """Enum text -> years with the enum table (10+ -> 12)."""
    from .fixed import EMP_LENGTH_YEARS
    m = F.create_map(*[x for k, v in EMP_LENGTH_YEARS.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, _col(c))


def clean_loans(df, legacy_emp_length: bool = False):
    """Standardise the raw text columns of a loan file in one select.

    Present raw columns are parsed; absent ones are skipped, other columns
    pass through unchanged.
    """
    cols = set(df.columns)
    out = []
    for name in df.columns:
        if name == "term_raw":
            out.append(term_months(name).alias("term"))
        elif name == "revol_util_raw":
            out.append(percent_to_fraction(name).alias("revol_util"))
        elif name == "int_rate_raw":
            out.append(percent_to_fraction(name).alias("int_rate"))
        elif name in ("earliest_cr_line_raw", "issue_d_raw"):
            out.append(month_year_date(name).alias(name[:-4]))
        elif name == "term" and "term_raw" in cols:
            continue
        else:
            out.append(F.col(name))
    if "emp_length" in cols:
        out.append(emp_length_years("emp_length", legacy_emp_length).alias("emp_length_years"))
    return df.select(*out)
