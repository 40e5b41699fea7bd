"""Label-free preparation fitted on training rows only.

Every fit is one long-form aggregate over the training rows whose result has
one row per feature (a bounded collect); every apply is one projection, so a
fitted preparation costs a single narrow pass over any table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import long_form
from strata.operators.quantile import exact_percentiles


def _per_feature(df: DataFrame, name: str) -> dict:
    return {r["feature"]: r[name] for r in df.collect()}


def _is_constant() -> F.Column:
    """Sample variance exactly zero, tested exactly: at least two non-missing
    values and min == max.  (Spark's merged ``var_samp`` of a constant column
    can come out as ~1e-30 depending on partition layout, so ``var == 0`` is
    not a reliable test; an all-missing or single-value column has an
    undefined variance and is not constant here.)"""
    return (F.count("value") >= 2) & (F.min("value") == F.max("value"))


def zero_variance_features(train: DataFrame, features: list[str]) -> DataFrame:
    """F1 fit: (feature) with zero sample variance on the training rows (an
    all-missing column is left to the null filter)."""
    v = long_form(train, [], features).groupBy("feature").agg(_is_constant().alias("const"))
    return v.filter(F.col("const")).select("feature")


def drop_zero_variance(train: DataFrame, test: DataFrame, features: list[str]):
    dropped = sorted(r["feature"] for r in zero_variance_features(train, features).collect())
    return train.drop(*dropped), test.drop(*dropped), dropped


def high_null_features(train: DataFrame, features: list[str], null_thresh: float = 0.90) -> DataFrame:
    lf = long_form(train, [], features)
    ns = lf.groupBy("feature").agg((F.lit(1.0) - F.count("value") / F.count(F.lit(1))).alias("ns"))
    return ns.filter(F.col("ns") > null_thresh).select("feature")


def medians(train: DataFrame, features: list[str]) -> DataFrame:
    return exact_percentiles(long_form(train, [], features), ["feature"], "value", [0.5],
                             out="median").drop("p")


def drop_high_null_and_impute(train: DataFrame, test: DataFrame, features: list[str],
                              null_thresh: float = 0.90):
    """drop features missing in more than ``null_thresh`` of training
    rows, then fill the rest with training medians (both tables)."""
    high = sorted(r["feature"] for r in high_null_features(train, features, null_thresh).collect())
    rest = [f for f in features if f not in high]
    med = _per_feature(medians(train, rest), "median")
    fill = {f: float(v) for f, v in med.items() if v is not None}
    train, test = train.drop(*high), test.drop(*high)
    return train.na.fill(fill), test.na.fill(fill), high, fill


def population_variance(train: DataFrame, features: list[str]) -> DataFrame:
    return long_form(train, [], features).groupBy("feature").agg(F.var_pop("value").alias("variance"))


def variance_filter(train: DataFrame, test: DataFrame, features: list[str], threshold: float = 0.01):
    """keep features whose population variance on training rows is
    strictly above ``threshold`` (input order kept)."""
    var = _per_feature(population_variance(train, features), "variance")
    keep = [f for f in features if var.get(f) is not None and var[f] > threshold]
    keys = [c for c in train.columns if c not in features]
    return train.select(*keys, *keep), test.select(*[c for c in test.columns if c not in features], *keep), keep


def scaler_stats(train: DataFrame, features: list[str]) -> DataFrame:
    """F4 fit: mean and population std (0 -> 1) per feature."""
    st = long_form(train, [], features).groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.when(F.min("value") == F.max("value"), F.lit(0.0)).otherwise(F.stddev_pop("value")).alias("sd"))
    return st.select("feature", "mean",
                     F.when(F.col("sd").isNull() | (F.col("sd") == 0), F.lit(1.0)).otherwise(F.col("sd"))
                     .alias("scale"))


def standardize_cols(features: list[str], means: dict, scales: dict) -> list:
    return [((F.col(f).cast("double") - F.lit(means[f])) / F.lit(scales[f])).alias(f) for f in features]


def standardize(train: DataFrame, others: list[DataFrame], features: list[str]):
    st = scaler_stats(train, features).collect()
    means = {r["feature"]: r["mean"] for r in st}
    scales = {r["feature"]: r["scale"] for r in st}

    def apply(df):
        keys = [c for c in df.columns if c not in features]
        return df.select(*keys, *standardize_cols(features, means, scales))
    return apply(train), [apply(o) for o in others], means, scales


@dataclass
class FittedPrep:
    """the fitted label-free preparation, applied as one projection."""
    features_in: list[str]
    zero_var: list[str] = field(default_factory=list)
    high_null: list[str] = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    kept: list[str] = field(default_factory=list)
    means: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)
    selected: list[str] | None = None

    @property
    def output_features(self) -> list[str]:
        return list(self.selected) if self.selected else list(self.kept)

    def transform(self, df: DataFrame, scale: bool = True) -> DataFrame:
        keys = [c for c in df.columns if c not in self.features_in]
        exprs = []
        for f in self.output_features:
            c = F.coalesce(F.col(f).cast("double"), F.lit(self.medians[f])) if f in self.medians \
                else F.col(f).cast("double")
            if scale and f in self.means:
                c = (c - F.lit(self.means[f])) / F.lit(self.scales[f])
            exprs.append(c.alias(f))
        return df.select(*keys, *exprs)

    def summary(self) -> dict:
        """Column counts after each stage."""
        n0 = len(self.features_in)
        n1 = n0 - len(self.zero_var)
        n2 = n1 - len(self.high_null)
        return {"n_candidates": n0, "after_zero_variance": n1, "after_high_null": n2,
                "after_variance_filter": len(self.kept),
                "selected": len(self.selected) if self.selected else None}

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "FittedPrep":
        return FittedPrep(**json.loads(s))


def fit_prep(train: DataFrame, features: list[str], null_thresh: float = 0.90,
             var_thresh: float = 0.01, scale: bool = True) -> FittedPrep:
    """F1 -> F2 -> F3 (-> F4) fitted on ``train`` in three passes:

    1. one long-form aggregate gives each feature's sample variance (F1) and
       null share (F2's filter; a feature's share does not depend on which
       other features were dropped);
    2. exact medians of the surviving features;
    3. one aggregate over the imputed values gives the population variance
       (F3) and, from the same sums, the scaler's mean and population std (F4).
    """
    lf = long_form(train, [], features)
    st = {r["feature"]: r for r in lf.groupBy("feature").agg(
        _is_constant().alias("const"),
        (F.lit(1.0) - F.count("value") / F.count(F.lit(1))).alias("ns")).collect()}
    zero = sorted(f for f in features if st[f]["const"])
    f1 = [f for f in features if f not in zero]
    high = sorted(f for f in f1 if st[f]["ns"] > null_thresh)
    f2 = [f for f in f1 if f not in high]
    med = {f: float(v) for f, v in _per_feature(medians(train, f2), "median").items() if v is not None}
    filled = train.select(*[F.coalesce(F.col(f).cast("double"), F.lit(med[f])).alias(f) if f in med
                            else F.col(f).cast("double").alias(f) for f in f2])
    mom = {r["feature"]: r for r in long_form(filled, [], f2).groupBy("feature").agg(
        F.var_pop("value").alias("variance"), F.avg("value").alias("mean"),
        F.when(F.min("value") == F.max("value"), F.lit(0.0)).otherwise(F.stddev_pop("value")).alias("sd")
    ).collect()}
    kept = [f for f in f2 if mom[f]["variance"] is not None and mom[f]["variance"] > var_thresh]
    prep = FittedPrep(features_in=list(features), zero_var=zero, high_null=high, medians=med, kept=kept)
    if scale and kept:
        prep.means = {f: mom[f]["mean"] for f in kept}
        prep.scales = {f: (mom[f]["sd"] if mom[f]["sd"] else 1.0) for f in kept}
    return prep


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """balanced class weights n / (2 * n_c), one row per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))  # one row per class
    n = F.sum("n_c").over(Window.partitionBy())
    return c.select(label, "n_c", (n / (F.lit(2.0) * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach the F9 weight as a column (per-class table is two rows: broadcast)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")


def with_positive_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """weight n_neg / n_pos on positives, 1 on negatives (boosting)."""
    n_neg, n_pos = df.agg(F.count(F.when(F.col(label) == 0, 1)),
                          F.count(F.when(F.col(label) == 1, 1))).first()  # two scalars
    r = (n_neg / n_pos) if n_pos else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(r))).otherwise(F.lit(1.0)))
