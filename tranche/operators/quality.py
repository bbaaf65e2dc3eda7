"""Data-quality profiles, scores and checks.

Each profile is one wide aggregate over the table (a single scan with
partial aggregation per task), unpivoted to a long table when it is per
column.  Quantiles are exact (``quantiles.py``); ``approx=True`` asks for
``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from ..functions.fixed import QUALITY_DEFAULTS
from ..session import materialize
from .quantiles import ACCURACY, exact_quantiles
from .rows import combine_rows, scalars


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    cond = F.col(c).isNull()
    if isinstance(t, (DoubleType, FloatType)):
        cond = cond | F.isnan(c)
    return cond


# ------------------------------------------------------------------ A1
def missing_profile(df: DataFrame, max_missing_rate: float = QUALITY_DEFAULTS["max_missing_rate"]) -> DataFrame:
    """A1: per column missing count and percent of rows; flag > max rate."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(_missing(df, c)).alias(f"missing_count__{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"missing_count__{i}").alias("missing_count"),
                        F.col("_n").alias("_n")) for i, c in enumerate(cols)]
    long = row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return long.select(
        "column_name", "missing_count",
        (F.col("missing_count") * 100.0 / F.col("_n")).alias("missing_pct"),
        (F.col("missing_count") * 100.0 / F.col("_n") > max_missing_rate * 100).alias("high_missing"))


def missing_totals(df: DataFrame, by: str | None = None) -> DataFrame:
    """A1 totals: missing cells, overall percent, columns with any missing
    (per value of ``by``, which is then no cell)."""
    cols = [c for c in df.columns if c != by]
    per = [F.count_if(_missing(df, c)) for c in cols]
    keys = [by] if by else []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[p.alias(f"m{i}") for i, p in enumerate(per)]).select(
        *keys, F.col("n").alias("total_rows"), F.lit(len(cols)).alias("total_columns"),
        reduce(lambda a, b: a + b, [F.col(f"m{i}") for i in range(len(cols))]).alias("total_missing_cells"),
        reduce(lambda a, b: a + b, [(F.col(f"m{i}") > 0).cast("int") for i in range(len(cols))])
        .alias("columns_with_missing"))


# ------------------------------------------------------------------ A2
def row_hash(df: DataFrame) -> list[Column]:
    """128 bits of a whole row, as two longs; equal rows have equal ones.
    (Missing values leave a hash as it is, so where they stand is hashed too.)"""
    cols = [F.col(c) for c in df.columns]
    return [F.xxhash64(*cols), F.xxhash64(F.array(*[c.isNull() for c in cols]), *reversed(cols), F.lit(1))]


def repeated_rows(df: DataFrame, by: str | None = None, hashes: Callable[[DataFrame], list[Column]] = row_hash) -> DataFrame:
    """Rows that equal an earlier row on all columns (NULL equals NULL), per
    value of ``by``: duplicate_rows, one row per value that has any.

    Two hashes of 64 bits are grouped instead of the rows; only rows whose
    hashes repeat are compared in full, so that equal hashes of different rows
    are no duplicates.  Their keys are written: Spark broadcasts them if small.
    """
    keys = [by] if by else []
    marks = [h.alias(f"_h{i}") for i, h in enumerate(hashes(df))]
    named = [f"_h{i}" for i in range(len(marks))]
    more = materialize(df.select(*keys, *marks).groupBy(*keys, *named).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated-hashes")
    rows = more.groupBy(*keys).agg(F.sum("_n").alias("_rows"))
    again = df.select("*", *marks).join(more.select(*keys, *named), [*keys, *named], "left_semi").select(*df.columns)
    different = again.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_different"))
    if by:
        return rows.join(different, by).select(by, (F.col("_rows") - F.col("_different")).alias("duplicate_rows"))
    return combine_rows(rows, different).select(F.coalesce(F.col("_rows") - F.col("_different"), F.lit(0)).alias("duplicate_rows"))


def duplicate_profile(df: DataFrame, max_duplicate_rate: float = QUALITY_DEFAULTS["max_duplicate_rate"],
                      hashes: Callable[[DataFrame], list[Column]] = row_hash) -> DataFrame:
    """A2: rows equal to an earlier row on all columns (NULL equals NULL)."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return combine_rows(total, repeated_rows(df, hashes=hashes)).select(
        "total_rows", "duplicate_rows",
        F.try_divide(F.col("duplicate_rows") * 100.0, F.col("total_rows")).alias("duplicate_rate_percent"),
    ).withColumn("exceeds_threshold", F.col("duplicate_rate_percent") > max_duplicate_rate * 100)


# ------------------------------------------------------------------ A3 / A8
def _double(c) -> Column:
    return F.col(c).cast("double")


def outlier_bounds(quartiles: list[float | None]) -> tuple[float | None, float | None]:
    """[Q1 - 1.5 IQR, Q3 + 1.5 IQR]; open where there are no values."""
    q1, q3 = (quartiles or [None, None])[:2]
    return (None, None) if q1 is None or q3 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))


def _outside(v: Column, bounds: tuple[float | None, float | None]) -> Column:
    lo, hi = (F.lit(b).cast("double") for b in bounds)
    return (v < lo) | (v > hi)


def outlier_iqr(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
                min_values: int = 10, rate_base: str = "rows", stored: bool = False) -> DataFrame:
    """A3 (rate_base='rows': rate over all rows) / A8 IQR (rate_base='values':
    over non-missing values): Q1/Q3 linear, outside [Q1-1.5 IQR, Q3+1.5 IQR]
    strictly; columns with fewer than ``min_values`` values are skipped.  The
    numeric columns are written once (unless ``df`` is a ``stored`` table)."""
    cols = cols or numeric_columns(df)
    if not stored:
        df = materialize(df.select(*[_double(c).alias(c) for c in cols]), "outlier-input")
    if approx:
        got = scalars(df.agg(*[F.percentile_approx(_double(c), [0.25, 0.75], 100 * ACCURACY).alias(f"q{i}") for i, c in enumerate(cols)]))
        quartiles = {c: got[f"q{i}"] for i, c in enumerate(cols)}
    else:
        quartiles = exact_quantiles(df, cols, [0.25, 0.75], stored=True)
    bounds = {c: outlier_bounds(quartiles[c]) for c in cols}
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)],
                     *[F.count_if(_outside(_double(c), bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)])
    lit = lambda v: F.lit(v).cast("double")
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"o{i}").alias("outlier_count"), F.col(f"n{i}").alias("total_values"),
                        lit(bounds[c][0]).alias("lower_bound"), lit(bounds[c][1]).alias("upper_bound"), F.col("_rows"))
               for i, c in enumerate(cols)]
    out = counted.select(F.explode(F.array(*structs)).alias("r")).select("r.*").where(F.col("total_values") >= min_values)
    base = F.col("_rows") if rate_base == "rows" else F.col("total_values")
    scale = 100.0 if rate_base == "rows" else 1.0
    return out.select("column_name", "outlier_count", "total_values", "lower_bound", "upper_bound",
                      (F.col("outlier_count") * scale / base).alias("outlier_rate"))


def outlier_totals(df: DataFrame, cols: list[str], by: str, values: list, min_values: int = 10) -> DataFrame:
    """A3 per group: outliers over all columns (``by``, total_outliers), with
    each group's own quartiles, found for all groups at once.  ``df`` is a
    written table; ``values`` are the groups."""
    parts = [((v, c), F.when(F.col(by) == F.lit(v), _double(c))) for v in values for c in cols]
    quartiles = exact_quantiles(df, parts, [0.25, 0.75], stored=True)
    marked = [F.struct(F.count(part).alias("n"), F.count_if(_outside(part, outlier_bounds(quartiles[name]))).alias("o")).alias(f"s{i}")
              for i, (name, part) in enumerate(parts)]
    row = df.agg(*marked).first()       # a count per group and column
    total = {v: 0 for v in values}
    for i, ((v, _), _) in enumerate(parts):
        total[v] += row[f"s{i}"]["o"] if row[f"s{i}"]["n"] >= min_values else 0
    return df.sparkSession.createDataFrame(list(total.items()), f"{by} {df.schema[by].dataType.simpleString()}, total_outliers long")


def outlier_zscore(df: DataFrame, cols: list[str] | None = None, z: float = 3.0) -> DataFrame:
    """A8 z-score: |x - mean| / sample std > z; rate over non-missing values."""
    cols = cols or numeric_columns(df)
    st = scalars(df.agg(*[F.struct(F.avg(F.col(c).cast("double")).alias("m"),
                                   F.stddev_samp(F.col(c).cast("double")).alias("s"),
                                   F.count(c).alias("nn")).alias(f"s{i}") for i, c in enumerate(cols)]))
    lit = lambda v: F.lit(v).cast("double")
    counted = df.agg(*[F.count_if(F.abs(F.try_divide(F.col(c).cast("double") - lit(st[f"s{i}"]["m"]),
                                                     lit(st[f"s{i}"]["s"]))) > z).alias(f"o{i}")
                       for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"o{i}").alias("outlier_count"),
                        F.lit(st[f"s{i}"]["nn"]).cast("long").alias("total_values")) for i, c in enumerate(cols)]
    out = counted.select(F.explode(F.array(*structs)).alias("r")).select("r.*").where(F.col("total_values") > 0)
    return out.withColumn("outlier_rate", F.col("outlier_count") / F.col("total_values"))


# ------------------------------------------------------------------ A4
NUMERIC_TEXT = r"^[\d.,%-]+$"


def type_profile(df: DataFrame, share: float = 0.8) -> DataFrame:
    """A4: column count per type, and text columns where more than ``share``
    of all rows look numeric."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    strs = string_columns(df)
    spark = df.sparkSession
    types = spark.createDataFrame([(k, "dtype", v) for k, v in counts.items()],
                                  "name string, kind string, n long")
    if not strs:
        return types
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.coalesce(F.col(c).rlike(NUMERIC_TEXT), F.lit(False))).alias(f"k{i}")
                   for i, c in enumerate(strs)])
    structs = [F.struct(F.lit(c).alias("name"), F.col(f"k{i}").alias("k"), F.col("_n").alias("_n"))
               for i, c in enumerate(strs)]
    pot = (row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
           .where(F.col("k") > F.col("_n") * share)
           .select("name", F.lit("potential_numeric").alias("kind"), F.col("k").alias("n")))
    return types.unionByName(pot)


# ------------------------------------------------------------------ A5
def _score(totals: DataFrame, max_missing_rate: float, max_duplicate_rate: float, max_outlier_rate: float, min_quality_score: float,
           keys: tuple[str, ...] = ()) -> DataFrame:
    """The weighted score from total_rows, total_columns, total_missing_cells,
    duplicate_rows and total_outliers."""
    cells = F.col("total_rows") * F.col("total_columns")
    miss = F.try_divide(F.col("total_missing_cells"), cells)
    dup = F.try_divide(F.col("duplicate_rows") * 100.0, F.col("total_rows")) / 100.0
    out = F.try_divide(F.col("total_outliers"), cells)
    score = (0.3 * F.greatest(F.lit(0.0), 1 - miss / max_missing_rate)
             + 0.2 * F.greatest(F.lit(0.0), 1 - dup / max_duplicate_rate)
             + 0.2 * F.greatest(F.lit(0.0), 1 - out / max_outlier_rate)
             + 0.3 * (1 - miss / 2))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
    return totals.select(*keys, "total_rows", "total_columns", "total_missing_cells", "duplicate_rows", "total_outliers",
                         (miss * 100).alias("missing_percentage_overall"), (out * 100).alias("overall_outlier_rate_percent"),
                         score.alias("quality_score")).withColumn("passed_validation", F.col("quality_score") >= min_quality_score)


def quality_score(df: DataFrame, outlier_cols: list[str] | None = None, approx: bool = False,
                  max_missing_rate: float = QUALITY_DEFAULTS["max_missing_rate"],
                  max_duplicate_rate: float = QUALITY_DEFAULTS["max_duplicate_rate"],
                  max_outlier_rate: float = QUALITY_DEFAULTS["max_outlier_rate"],
                  min_quality_score: float = QUALITY_DEFAULTS["min_quality_score"]) -> DataFrame:
    """A5: .3 max(0, 1 - miss/maxmiss) + .2 max(0, 1 - dup/maxdup)
    + .2 max(0, 1 - out/maxout) + .3 (1 - miss/2), clamped to [0, 1];
    rates as fractions of cells (missing, outliers) and rows (duplicates).
    The rows are computed and written once; every figure reads that table."""
    df = materialize(df, "quality-input")
    found = outlier_iqr(df, outlier_cols, approx, stored=True).agg(F.coalesce(F.sum("outlier_count"), F.lit(0)).alias("total_outliers"))
    return _score(combine_rows(missing_totals(df), repeated_rows(df), found), max_missing_rate, max_duplicate_rate, max_outlier_rate, min_quality_score)


def quality_scores(df: DataFrame, by: str, values: list, max_missing_rate: float = QUALITY_DEFAULTS["max_missing_rate"],
                   max_duplicate_rate: float = QUALITY_DEFAULTS["max_duplicate_rate"],
                   max_outlier_rate: float = QUALITY_DEFAULTS["max_outlier_rate"],
                   min_quality_score: float = QUALITY_DEFAULTS["min_quality_score"], stored: bool = False) -> DataFrame:
    """A5 of every group in ``values`` of ``by`` (a row each, 0 rows: missing
    score), each figure from one grouped pass for all groups."""
    df = df if stored else materialize(df, "quality-input")
    kind = df.schema[by].dataType.simpleString()
    groups = df.sparkSession.createDataFrame([(v,) for v in values], f"{by} {kind}")
    own = df.where(F.col(by).isin(list(values)))
    cols = [c for c in numeric_columns(df) if c != by]
    totals = (groups.join(missing_totals(own, by), by, "left").join(repeated_rows(own, by), by, "left")
              .join(outlier_totals(own, cols, by, list(values)), by, "left").na.fill(0, ["total_rows", "duplicate_rows", "total_outliers"]))
    return _score(totals, max_missing_rate, max_duplicate_rate, max_outlier_rate, min_quality_score, (by,))


# ------------------------------------------------------------------ A7
def quality_rules(df: DataFrame, name: str = "dataset",
                  max_missing_rate: float = QUALITY_DEFAULTS["max_missing_rate"],
                  max_duplicate_rate: float = QUALITY_DEFAULTS["max_duplicate_rate"],
                  min_quality_score: float = QUALITY_DEFAULTS["min_quality_score"]) -> DataFrame:
    """score = (1 - missing rate)(1 - duplicate rate) and rule results
    (errors / warnings as '; '-joined text, empty when none)."""
    cols = df.columns
    df = materialize(df, "rules-input")
    mp = missing_profile(df, max_missing_rate)
    bad = mp.where(F.col("missing_pct") > max_missing_rate * 100).agg(F.sort_array(F.collect_list("column_name")).alias("bad_cols"))
    mt = missing_totals(df)
    j = combine_rows(mt, repeated_rows(df), bad)
    cells = F.col("total_rows") * len(cols)
    miss = F.when(cells > 0, F.col("total_missing_cells") / cells).otherwise(0.0)
    dup = F.when(F.col("total_rows") > 0, F.col("duplicate_rows") / F.col("total_rows")).otherwise(0.0)
    score = (1 - miss) * (1 - dup)
    errors = F.filter(F.array(
        F.when(F.col("total_rows") == 0, F.lit("empty")),
        F.when(miss > max_missing_rate, F.lit("missing_rate")),
        F.when(dup > max_duplicate_rate, F.lit("duplicate_rate")),
        F.when(F.size("bad_cols") > 0, F.concat(F.lit("columns_missing:"), F.array_join("bad_cols", ","))),
        F.when(score < min_quality_score, F.lit("quality_score")),
    ), lambda x: x.isNotNull())
    warnings = F.filter(F.array(F.when((miss <= max_missing_rate) & (miss > 0.1), F.lit("high_missing_rate"))),
                        lambda x: x.isNotNull())
    return j.select(
        F.lit(f"data_quality_{name}").alias("validation_type"),
        "total_rows", "total_columns", cells.alias("total_cells"), F.col("total_missing_cells").alias("missing_cells"),
        miss.alias("missing_rate"), "duplicate_rows", dup.alias("duplicate_rate"), score.alias("quality_score"),
        (F.size(errors) == 0).alias("is_valid"), F.array_join(errors, "; ").alias("errors"),
        F.array_join(warnings, "; ").alias("warnings"))


# ------------------------------------------------------------------ A9 / A10 / F1
def temporal_split_check(df: DataFrame, date_col: str = "issue_d", split_col: str = "split",
                         order: tuple[str, ...] = ("train", "validation", "backtest")) -> DataFrame:
    """Min / max date per split (one grouped aggregate), gap days between
    consecutive splits, error when a split's max is not before the next min."""
    mm = (df.where(F.col(split_col).isin(list(order)))
          .groupBy(split_col).agg(F.min(date_col).alias("mn"), F.max(date_col).alias("mx")))
    wide = mm.agg(*[F.max(F.when(F.col(split_col) == s, F.col(k))).alias(f"{s}_{k}")
                    for s in order for k in ("mn", "mx")])
    cols, errs = [], []
    for s in order:
        cols += [F.col(f"{s}_mn").alias(f"{s}_date_min"), F.col(f"{s}_mx").alias(f"{s}_date_max")]
    for a, b in zip(order, order[1:]):
        cols.append(F.datediff(F.col(f"{b}_mn"), F.col(f"{a}_mx")).alias(f"{a}_{b}_gap_days"))
        errs.append(F.when(F.col(f"{a}_mx") >= F.col(f"{b}_mn"), F.lit(f"{a}_overlaps_{b}")))
    e = F.filter(F.array(*errs), lambda x: x.isNotNull())
    return wide.select(*cols, (F.size(e) == 0).alias("is_valid"), F.array_join(e, "; ").alias("errors"))


def date_consistency(df: DataFrame, date_col: str = "issue_d", min_year: int = 2007,
                     as_of: Column | None = None) -> DataFrame:
    """A10: null dates, earliest before ``min_year`` (warning), dates after
    ``as_of`` (error, default today), span in days."""
    as_of = as_of if as_of is not None else F.current_date()
    a = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(date_col).isNull()).alias("null_dates"),
               F.min(date_col).alias("date_range_min"), F.max(date_col).alias("date_range_max"))
    warn = F.filter(F.array(F.when(F.col("null_dates") > 0, F.lit("null_dates")),
                            F.when(F.year("date_range_min") < min_year, F.lit("before_min_year"))),
                    lambda x: x.isNotNull())
    err = F.filter(F.array(F.when(F.col("date_range_max") > as_of, F.lit("future_dates"))), lambda x: x.isNotNull())
    return a.select("date_range_min", "date_range_max",
                    F.datediff("date_range_max", "date_range_min").alias("date_span_days"), "null_dates",
                    (F.col("null_dates") / F.col("n")).alias("null_date_rate"),
                    (F.size(err) == 0).alias("is_valid"), F.array_join(err, "; ").alias("errors"),
                    F.array_join(warn, "; ").alias("warnings"))


def quarter_range_check(df: DataFrame, date_col: str = "issue_d", quarter_col: str = "data_quarter") -> DataFrame:
    """rows whose date is outside [quarter start, next quarter start);
    missing dates count as outside."""
    y = F.substring(quarter_col, 1, 4).cast("int")
    q = F.substring(quarter_col, 6, 1).cast("int")
    start = F.make_date(y, (q - 1) * 3 + 1, F.lit(1))
    end = F.add_months(start, 3)
    inside = F.coalesce((F.col(date_col) >= start) & (F.col(date_col) < end), F.lit(False))
    return df.groupBy(quarter_col).agg(F.count(F.lit(1)).alias("rows"),
                                       F.count_if(~inside).alias("invalid_rows"))


# ------------------------------------------------------------------ A17 / A18 / A19 / D6
def target_distribution(df: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Class counts and prevalence (optionally per group)."""
    keys = (by or []) + [label]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(w))


def binned_aggregate(df: DataFrame, col: str, value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins of ``col`` over [min, max] (the minimum lands in
    bin 1, the maximum in the last), with count / mean / std / min / max /
    median of ``value`` per bin."""
    df = materialize(df.select(*dict.fromkeys([col, value])), "binned-input")
    mm = scalars(df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")))
    lo, hi = F.lit(mm["_lo"]).cast("double"), F.lit(mm["_hi"]).cast("double")
    width = (hi - lo) / bins
    # right-closed bins (a, b]; the minimum joins the first bin
    b = F.coalesce(F.ceil(F.try_divide(F.col(col) - lo, width)).cast("int"), F.lit(1))
    binned = df.where(F.col(col).isNotNull()).withColumn("bin", F.greatest(F.lit(1), b))
    # the median of each bin, as the exact quantile of that bin's values
    med = exact_quantiles(binned, [(k, F.when(F.col("bin") == k, F.col(value))) for k in range(1, bins + 1)], [0.5])
    table = F.create_map(*[x for k, v in med.items() for x in (F.lit(k), F.lit(v[0]).cast("double"))])
    return (binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.avg(value).alias("mean"),
                                      F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                                      F.max(value).alias("max"), F.sum(value).alias("sum"))
            .withColumn("median", F.element_at(table, F.col("bin"))))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, one scan."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"c{i}").alias("corr")))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def availability_rules(df: DataFrame, label: str = "label", min_prevalence: float = 0.01,
                       min_availability: float = 0.80) -> DataFrame:
    """Prevalence >= 1 % and every column present in > 80 % of rows."""
    cols = [c for c in df.columns if c != label]
    a = df.agg(F.avg(F.col(label).cast("double")).alias("prevalence"),
               F.least(*[F.avg((~_missing(df, c)).cast("double")) for c in cols]).alias("min_availability"))
    return a.select("prevalence", "min_availability",
                    (F.col("prevalence") >= min_prevalence).alias("prevalence_ok"),
                    (F.col("min_availability") > min_availability).alias("availability_ok"))


def metric_variance_rule(metric_by_quarter: DataFrame, metric: str, max_variance: float = 0.05) -> DataFrame:
    """Variance of a metric across quarters below ``max_variance``."""
    return metric_by_quarter.agg(F.var_pop(metric).alias("variance")).withColumn(
        "stable", F.col("variance") < max_variance)
