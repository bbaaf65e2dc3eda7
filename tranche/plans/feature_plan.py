"""FeaturePlan: fit on training rows, transform anything.

``fit`` runs a handful of aggregate jobs over the training rows only
(category lists, top states, impute values, ANOVA scores, scale
parameters) and freezes them as literals; ``transform`` is then one lazy
projection over any DataFrame with the loan columns, with no aggregation,
so validation / backtest / streaming rows never influence the fit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import base_features, text_block
from ..operators.compliance import drop_leaking
from ..session import ensure_checkpoint_dir, ensure_compiled, materialize
from ..operators.prep import FittedImputer, FittedScaler, anova_f, fit_imputer, fit_scaler, select_k_best

DUMMY_SOURCES = {"grade": "grade", "purpose": "purpose", "home_ownership": "home",
                 "verification_status": "verified"}


MAX_CATEGORIES = 2000    # distinct values that become flags, over all category columns


@dataclass
class FeaturePlan:
    categories: dict[str, bool] = field(default_factory=dict)
    dummies: bool = True
    top_states: int = 10
    text_features: bool = False
    missing_strategy: str = "median"
    max_features: int = 50
    scaling: str = "standard"
    legacy_units: bool = False
    approx_quantiles: bool = False
    id_cols: tuple[str, ...] = ("id",)
    label: str = "label"

    def fit_categories(self, train: DataFrame) -> "FittedFeaturePlan":
        """X6 / X7 only: category values and top states seen in training
        (one aggregate + one top-k; bounded by the categories' cardinality)."""
        train = drop_leaking(train)
        cols = set(train.columns)
        cats: dict[str, list[str]] = {}
        present = [c for c in DUMMY_SOURCES if c in cols] if self.dummies else []
        if present:
            values = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in present])
            seen = (train.select(F.explode(values).alias("s")).where("s.v IS NOT NULL").select("s.*").distinct()
                    .limit(MAX_CATEGORIES + 1).collect())
            if len(seen) > MAX_CATEGORIES:
                raise ValueError(f"over {MAX_CATEGORIES} category values in {present}: too many for flags")
            cats = {c: sorted(r["v"] for r in seen if r["c"] == c) for c in present}
        states: list[str] = []
        if self.top_states and "addr_state" in cols:
            states = [r["addr_state"] for r in
                      train.where(F.col("addr_state").isNotNull()).groupBy("addr_state").count()
                      .orderBy(F.col("count").desc(), F.col("addr_state").asc()).limit(self.top_states).collect()]
        return FittedFeaturePlan(self, cats, states)

    def fit(self, train: DataFrame, stored: bool = False) -> "FittedFeaturePlan":
        """``stored``: ``train`` is a written table (or rows of one)."""
        # every fit aggregate reads the training rows: write them once to the
        # shared checkpoint folder (short plans, no recompute, survives loss)
        ensure_checkpoint_dir(train.sparkSession)
        ensure_compiled(train.sparkSession)
        train = drop_leaking(train) if stored else materialize(drop_leaking(train), "fit-input")
        fitted = self.fit_categories(train)
        # the feature expressions are evaluated once; all later fits read columns
        raw = materialize(fitted.raw_features(train), "fit-features")
        names = [c for c in raw.columns if c not in fitted.keep_cols(train)]
        if self.missing_strategy == "drop":
            imputer = FittedImputer("drop")
        else:
            imputer = fit_imputer(raw.select(*names), names, self.missing_strategy, self.approx_quantiles, stored=True)
        fitted.names_before_selection = names
        fitted.imputer = imputer
        imputed = imputer.transform(raw) if imputer.values else raw.na.drop(subset=names)
        selected = names
        if self.max_features and len(names) > self.max_features and self.label in imputed.columns:
            fitted.scores = anova_f(imputed, names, self.label)
            selected = select_k_best(fitted.scores, self.max_features)
        fitted.feature_names = selected
        fitted.scaler = fit_scaler(imputed.select(*selected), selected, self.scaling, self.approx_quantiles, stored=True)
        return fitted


@dataclass
class FittedFeaturePlan:
    plan: FeaturePlan
    categories: dict[str, list[str]]
    states: list[str]
    names_before_selection: list[str] = field(default_factory=list)
    feature_names: list[str] = field(default_factory=list)
    imputer: FittedImputer | None = None
    scaler: FittedScaler | None = None
    scores: DataFrame | None = None

    def keep_cols(self, df: DataFrame) -> list[str]:
        return [c for c in (*self.plan.id_cols, self.plan.label, "data_quarter", "split") if c in df.columns]

    def dummy_exprs(self, cols: set[str] | None = None) -> list[Column]:
        """X6 / X7 flags for the fitted values; a source column the rows do
        not have yields no flags (alignment then fills 0.0)."""
        out = []
        for src, values in self.categories.items():
            if cols is not None and src not in cols:
                continue
            prefix = DUMMY_SOURCES[src]
            out += [F.coalesce(F.col(src) == v, F.lit(False)).cast("int").alias(f"{prefix}_{v}") for v in values]
        if cols is None or "addr_state" in cols:
            out += [F.coalesce(F.col("addr_state") == s, F.lit(False)).cast("int").alias(f"state_{s}")
                    for s in self.states]
        return out

    def raw_features(self, df: DataFrame) -> DataFrame:
        """All engineered features (before impute / select / scale)."""
        df = drop_leaking(df)
        return df.select(*[F.col(c) for c in self.keep_cols(df)], *self.feature_exprs(df).values())

    def feature_exprs(self, df: DataFrame) -> dict[str, Column]:
        cols = set(df.columns)
        exprs = base_features(cols, self.plan.categories, self.plan.legacy_units) + self.dummy_exprs(cols)
        if self.plan.text_features:
            exprs += text_block(F.col("emp_title") if "emp_title" in cols else None,
                                F.col("title") if "title" in cols else None)
        names = df.select(*exprs).columns
        return dict(zip(names, exprs))

    def transform(self, df: DataFrame, scale: bool = True, keep_extra: tuple[str, ...] = ()) -> DataFrame:
        """P10: the fitted steps on new rows as one projection: each output
        column is scale(impute(feature expression)); P8 alignment turns a
        training feature the rows cannot produce into 0.0."""
        df = drop_leaking(df)
        keep = self.keep_cols(df) + [c for c in keep_extra if c in df.columns and c not in self.keep_cols(df)]
        raw = self.feature_exprs(df)
        if self.imputer is None or not self.imputer.values:
            inner = df.select(*keep, *[raw.get(c, F.lit(0.0)).alias(c) for c in self.names_before_selection]) \
                .na.drop(subset=self.names_before_selection)
            raw = {c: F.col(c) for c in self.names_before_selection}
            df = inner
        outs = []
        for c in self.feature_names:
            e = raw[c] if c in raw else F.lit(0.0)
            if self.imputer is not None and c in self.imputer.values:
                e = F.coalesce(e, F.lit(self.imputer.values[c]))
            if scale and self.scaler is not None and c in self.scaler.center:
                e = (e - F.lit(self.scaler.center[c])) / F.lit(self.scaler.scale[c])
            outs.append(e.alias(c))
        return df.select(*keep, *outs)

    def assemble(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Features as one MLlib vector column."""
        return VectorAssembler(inputCols=self.feature_names, outputCol=output, handleInvalid="keep").transform(df)

    def metadata(self) -> dict:
        """X10."""
        return {"n_features": len(self.feature_names), "feature_names": list(self.feature_names),
                "categories": self.categories, "top_states": self.states,
                "imputed_all_missing": self.imputer.all_missing if self.imputer else [],
                "scaling": self.scaler.method if self.scaler else "none"}
