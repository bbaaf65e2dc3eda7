"""Preprocessing estimators: fit on training rows only (one aggregate job
each), apply as literal column expressions (E1-E6, F4).

MLlib differs from the source on three points, so these are own
expressions: ``Imputer`` medians are approximate, ``StandardScaler`` uses
the sample deviation, ``MinMaxScaler`` maps a constant to the mid-point.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .quantiles import ACCURACY, exact_quantiles, modes


# ------------------------------------------------------------------ E1 / F4
@dataclass
class FittedImputer:
    strategy: str
    values: dict[str, object] = field(default_factory=dict)
    all_missing: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.coalesce(F.col(c), F.lit(self.values[c])).alias(c) if c in self.values else F.col(c)
                           for c in df.columns])

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(k, float(v) if isinstance(v, (int, float)) else None,
                                       v if isinstance(v, str) else None) for k, v in self.values.items()],
                                     "column_name string, fill_value double, fill_text string")


def fit_imputer(df: DataFrame, cols: list[str] | None = None, strategy: str = "median",
                approx: bool = False, stored: bool = False) -> FittedImputer:
    """Median / mean / mode ('most_frequent') per numeric column, mode
    for text columns; a column with no values at all is filled with 0.0
    (text: '') and reported.  Exact median by default; ``stored``: ``df`` is
    a written table."""
    cols = cols or df.columns
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
    by_mode = cols if strategy in ("mode", "most_frequent") else [c for c in cols if c not in numeric]
    row = modes(df, by_mode) if by_mode else {}
    rest = [c for c in cols if c not in row]
    if rest and strategy == "mean":
        got = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(rest)]).first()
        row |= {c: got[f"v{i}"] for i, c in enumerate(rest)}
    elif rest and approx:
        got = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100 * ACCURACY).alias(f"v{i}") for i, c in enumerate(rest)]).first()
        row |= {c: got[f"v{i}"] for i, c in enumerate(rest)}
    elif rest:
        row |= {c: v[0] for c, v in exact_quantiles(df, rest, [0.5], stored=stored).items()}
    values, empty = {}, []
    for c in cols:
        v = row[c]
        if v is None:
            empty.append(c)
            v = 0.0 if isinstance(df.schema[c].dataType, NumericType) else ""
        if isinstance(df.schema[c].dataType, NumericType):
            v = float(v)
        values[c] = v
    return FittedImputer(strategy, values, empty)


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """drop rows with any missing feature; the label stays in the row."""
    return df.na.drop(subset=cols)


# ------------------------------------------------------------------ E2
def anova_f(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """E2 scores: one-way ANOVA F of each feature across label classes.

    One grouped aggregate gives count / sum / sum of squares per class (one
    row per class: a bounded table); F follows from those sums.  A constant
    feature has 0/0 and gets a missing F (ranked lowest)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                *[F.sum(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
                                *[F.sum(F.col(c).cast("double") * F.col(c).cast("double")).alias(f"q{i}")
                                  for i, c in enumerate(cols)]).collect()
    k = len(per)
    N = float(sum(r["n"] for r in per))
    rows = []
    for i, c in enumerate(cols):
        S = sum(float(r[f"s{i}"] or 0.0) for r in per)
        Q = sum(float(r[f"q{i}"] or 0.0) for r in per)
        B = sum(float(r[f"s{i}"] or 0.0) ** 2 / r["n"] for r in per)
        sq_all = S * S / N if N else 0.0
        ssbn, sstot = B - sq_all, Q - sq_all
        sswn = sstot - ssbn
        num = ssbn / (k - 1) if k > 1 else None
        den = sswn / (N - k) if N > k else None
        if num is None or den is None:
            f = None
        elif den == 0.0:
            f = float("inf") if num > 0 else None  # perfect separation / constant feature
        else:
            f = num / den
        rows.append((c, i, f))
    return df.sparkSession.createDataFrame(rows, "feature string, position int, f_score double")


def select_k_best(scores: DataFrame, k: int) -> list[str]:
    """Top ``k`` by F (missing F ranks lowest; among equal F the later
    column wins, as a stable ascending sort taking the last k does), kept
    in original column order."""
    ranked = scores.select("feature", "position", F.coalesce(F.when(~F.isnan("f_score"), F.col("f_score")),
                                                             F.lit(float("-inf"))).alias("f"))
    top = ranked.orderBy(F.col("f").desc(), F.col("position").desc()).limit(k).collect()
    return [r["feature"] for r in sorted(top, key=lambda r: r["position"])]


# ------------------------------------------------------------------ E3-E6
@dataclass
class FittedScaler:
    method: str
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def expr(self, c: str) -> Column:
        if self.method == "none" or c not in self.center:
            return F.col(c)
        return ((F.col(c) - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(c)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.expr(c).alias(c) for c in df.columns])

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(self.center[c]), float(self.scale[c])) for c in self.center],
                                     "feature string, center double, scale double")


def fit_scaler(df: DataFrame, cols: list[str], method: str = "standard", approx: bool = False,
               stored: bool = False) -> FittedScaler:
    """E3 standard: (x - mean) / population std; E4 minmax: (x - min) /
    (max - min); E5 robust: (x - median) / (q75 - q25); zero spread -> 1;
    E6: 'none' leaves values, anything unknown falls back to standard.
    ``stored``: ``df`` is a written table (or a projection of one)."""
    if method == "none":
        return FittedScaler("none")
    if method not in ("standard", "minmax", "robust"):
        method = "standard"
    exact = exact_quantiles(df, cols, [0.25, 0.5, 0.75], stored=stored) if method == "robust" and not approx else {}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if method == "standard":
            aggs += [F.avg(x).alias(f"c{i}"), F.stddev_pop(x).alias(f"s{i}")]
        elif method == "minmax":
            aggs += [F.min(x).alias(f"c{i}"), (F.max(x) - F.min(x)).alias(f"s{i}")]
        else:
            aggs += [F.percentile_approx(x, [0.25, 0.5, 0.75], 100 * ACCURACY).alias(f"q{i}")] if approx else []
    row = df.agg(*aggs).first() if aggs else {f"q{i}": exact[c] for i, c in enumerate(cols)}
    center, scale = {}, {}
    for i, c in enumerate(cols):
        if method == "robust":
            q = row[f"q{i}"]
            q = [0.0, 0.0, 0.0] if not q or q[0] is None else q
            center[c], s = float(q[1]), float(q[2] - q[0])
        else:
            center[c], s = float(row[f"c{i}"] or 0.0), float(row[f"s{i}"] or 0.0)
        scale[c] = s if s != 0 else 1.0
    return FittedScaler(method, center, scale)


def align_columns(df: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly the training feature names in training order; a missing
    one is added as 0.0, extras are dropped (always selected by name)."""
    have = set(df.columns)
    return df.select(*(keep or []), *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in names])
