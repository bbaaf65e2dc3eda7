"""The loan cleaner with its report (D8) and the split by row rules.

Both write their rows once: the cleaner's flags and fills are expressions over
the written typed rows, and valid and quarantined rows are two partitions of
one written table, so nothing is computed twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_loans
from ..functions.rows import constraint_violations
from ..session import materialize
from .compliance import leaking_columns
from .prep import fit_imputer
from .quality import _missing, numeric_columns, outlier_bounds
from .quantiles import exact_quantiles

#: raw text columns and what the typing step turns them into
PARSED = {"term_raw": "term", "revol_util_raw": "revol_util", "int_rate_raw": "int_rate", "earliest_cr_line_raw": "earliest_cr_line",
          "issue_d_raw": "issue_d", "emp_length": "emp_length_years"}


@dataclass
class Cleaned:
    """``rows``: typed columns, filled where asked, and ``outlier_columns``;
    ``report``: (section, column_name, n)."""
    rows: DataFrame
    report: DataFrame


def clean_data(df: DataFrame, outlier_cols: list[str] | None = None, missing: dict[str, str] | str = "keep",
               legacy_emp_length: bool = False) -> Cleaned:
    """Type the raw text columns, flag outliers, apply a missing strategy,
    and count all of it.

    Outliers lie outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] of their column (exact
    quartiles of the typed rows, before filling).  ``missing`` is one strategy
    or one per column: "keep", "drop" (rows that miss any such column go),
    "median", "mean" or "mode".  An unknown strategy raises.  The report has
    rows in, out and dropped, and per column the texts that could not be read
    (unparsed), missing, filled and outlying cells, and columns that break the
    listing-time rule (leaking)."""
    raw = [c for c in PARSED if c in df.columns]
    marked = clean_loans(df.withColumns({f"_text_{c}": F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in raw}), legacy_emp_length)
    typed = materialize(marked, "typed-rows")
    columns = [c for c in typed.columns if not c.startswith("_text_")]
    how = {c: missing for c in columns if missing != "keep"} if isinstance(missing, str) else {c: m for c, m in missing.items() if m != "keep"}
    unknown = {m for m in how.values()} - {"drop", "median", "mean", "mode"} | {c for c in how if c not in columns}
    if unknown:
        raise ValueError(f"unknown missing strategy or column: {sorted(unknown)}")

    flagged = outlier_cols if outlier_cols is not None else numeric_columns(typed)
    bounds = {c: outlier_bounds(q) for c, q in exact_quantiles(typed, flagged, [0.25, 0.75], stored=True).items()}
    outside = {c: _outlying(c, bounds[c]) for c in flagged}
    out = typed.withColumn("outlier_columns", F.filter(F.array(*[F.when(hit, F.lit(c)) for c, hit in outside.items()]), lambda c: c.isNotNull())
                           if outside else F.array().cast("array<string>"))
    drop = [c for c, m in how.items() if m == "drop"]
    gone = F.lit(False)
    for c in drop:
        gone = gone | _missing(typed, c)
    fills = {}
    for strategy in ("median", "mean", "mode"):
        own = [c for c, m in how.items() if m == strategy]
        if own:
            fills |= fit_imputer(typed.select(*own), own, strategy, stored=True).values
    rows = out.where(~gone).select(*[_filled(typed, c, fills[c]).alias(c) if c in fills else F.col(c) for c in columns], "outlier_columns")

    counts = [("rows_in", None, F.lit(True)), ("rows_out", None, ~gone), ("rows_dropped", None, gone)]
    counts += [("unparsed", PARSED[c], F.col(f"_text_{c}") & _missing(typed, PARSED[c])) for c in raw]
    counts += [("missing", c, _missing(typed, c)) for c in columns]
    counts += [("filled", c, _missing(typed, c) & ~gone) for c in fills]
    counts += [("outliers", c, hit) for c, hit in outside.items()]
    counts += [("leaking", c, F.lit(True)) for c in leaking_columns(columns)]
    one = typed.agg(*[F.count_if(cond).alias(f"n{i}") for i, (_, _, cond) in enumerate(counts)])
    report = one.select(F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(c).cast("string").alias("column_name"), F.col(f"n{i}").alias("n"))
                                            for i, (s, c, _) in enumerate(counts)])).alias("r")).select("r.*")
    return Cleaned(rows, report)


def _outlying(c: str, bounds: tuple[float | None, float | None]) -> Column:
    lo, hi = bounds
    if lo is None:
        return F.lit(False)
    return F.coalesce((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(False))


def _filled(df: DataFrame, c: str, value) -> Column:
    return F.when(_missing(df, c), F.lit(value)).otherwise(F.col(c))


@dataclass
class Validated:
    """``valid`` and ``quarantined`` rows (with ``violations``) and ``report``:
    (rule, rows) with the verdicts' totals."""
    valid: DataFrame
    quarantined: DataFrame
    report: DataFrame


def validate_rows(df: DataFrame, rate_is_fraction: bool = True) -> Validated:
    """Rows that keep every rule and rows that break some, from one pass:
    the rows are written in two partitions, by verdict.  The report counts
    rows per verdict and per broken rule (a row may break several)."""
    checked = df.withColumn("violations", constraint_violations(set(df.columns), rate_is_fraction))
    checked = checked.withColumn("verdict", F.when(F.size("violations") == 0, "valid").otherwise("quarantined"))
    both = materialize(checked, "validated-rows", partition_by="verdict")
    report = (both.select(F.explode(F.concat(F.array(F.col("verdict")), "violations")).alias("rule"))
              .groupBy("rule").agg(F.count(F.lit(1)).alias("rows")))
    return Validated(both.where("verdict = 'valid'").drop("violations", "verdict"),
                     both.where("verdict = 'quarantined'").drop("verdict"), report)
