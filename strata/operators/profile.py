"""Profile queries over entity tables.

Per-column statistics run in long form (``unpivot`` -> ``groupBy(feature)``):
the aggregate stays narrow and inside codegen however many columns the table
has, and partial aggregation keeps the shuffle at one row per feature per map
task.  Quantiles use the exact bracketed algorithm in ``quantile.py``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import combine_rows, long_form, nan_to_null, null_band, safe_div
from strata.operators.quantile import exact_percentiles, exact_percentiles_wide
from strata.session import ship_package


def table_profile(raw: DataFrame, entity: list[str]) -> DataFrame:
    """Rows, columns, distinct entities."""
    return raw.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.lit(len(raw.columns)).cast("long").alias("n_cols"),
                   F.count_distinct(*[F.col(k) for k in entity]).alias("n_entities"))


def class_balance(ent: DataFrame, label: str = "label") -> DataFrame:
    """Count and share per class (window over the per-class rows only)."""
    c = ent.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def columns_by_suffix(columns: list[str], suffix: str) -> dict[str, str]:
    """The columns that end with ``suffix``, in order, each with its name without it."""
    return {c: c[:len(c) - len(suffix)] for c in columns if c.endswith(suffix) and c != suffix}


def null_shares(ent: DataFrame, features: list[str]) -> DataFrame:
    """(feature, null_share) for every feature: 1 - non-null / rows."""
    lf = long_form(ent, [], features)
    return lf.groupBy("feature").agg(
        (F.lit(1.0) - F.count("value") / F.count(F.lit(1))).alias("null_share"))


def null_profile(ent: DataFrame, features: list[str], top: int = 50) -> DataFrame:
    """Features with missing values, most-missing first, first ``top``."""
    return (null_shares(ent, features).filter(F.col("null_share") > 0)
            .orderBy(F.col("null_share").desc(), F.col("feature")).limit(top))


def null_bands(ent: DataFrame, features: list[str]) -> DataFrame:
    """Null share banded (>90 %, >50 %, rest)."""
    return null_shares(ent, features).withColumn("band", null_band("null_share"))


def null_overall(ent: DataFrame, features: list[str]) -> DataFrame:
    """Mean of the per-column null shares and the total of missing cells."""
    lf = long_form(ent, [], features)
    per = lf.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("nn"))
    return per.agg(F.avg(F.lit(1.0) - F.col("nn") / F.col("n")).alias("mean_null_share"),
                   F.sum(F.col("n") - F.col("nn")).alias("missing_cells"))


def split_rates(split_df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """A10: rows and positive rate per split."""
    return split_df.groupBy(split).agg(F.count(F.lit(1)).alias("n"),
                                       F.avg(F.col(label).cast("double")).alias("pos_rate"))


def histogram_by_class(ent: DataFrame, features: list[str], label: str = "label",
                       bins: int = 40) -> DataFrame:
    """Equal-width histogram per (feature, class) over that class's own
    min..max (a constant column gets the range v-0.5..v+0.5), with density
    = n / (N * width)."""
    lf = long_form(ent, [label], features).filter(F.col("value").isNotNull())
    rng = lf.groupBy("feature", label).agg(F.min("value").alias("lo0"), F.max("value").alias("hi0"),
                                           F.count(F.lit(1)).alias("n_fc"))
    rng = rng.select("feature", label, "n_fc",
                     F.when(F.col("hi0") > F.col("lo0"), F.col("lo0")).otherwise(F.col("lo0") - 0.5).alias("lo"),
                     F.when(F.col("hi0") > F.col("lo0"), F.col("hi0")).otherwise(F.col("hi0") + 0.5).alias("hi"))
    # one row per (feature, class): bounded -> broadcast
    j = lf.join(F.broadcast(rng), ["feature", label])
    b = F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1)).cast("int")
    n = j.groupBy("feature", label, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # every bin of every range, so that an empty one is a row with 0
    grid = rng.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    h = grid.join(n, ["feature", label, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    width = (F.col("hi") - F.col("lo")) / bins
    return h.select("feature", label, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.col("n").cast("long").alias("n"),
                    (F.col("n") / (F.col("n_fc") * width)).alias("density"))


def boxplot_by_class(ent: DataFrame, features: list[str], label: str = "label",
                     whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last datum within ``whis`` IQR of the
    box but never inside it, outliers."""
    lf = long_form(ent, [label], features).filter(F.col("value").isNotNull())
    qs = exact_percentiles_wide(lf, ["feature", label], "value", {"q1": 0.25, "med": 0.5, "q3": 0.75})
    j = lf.join(F.broadcast(qs), ["feature", label])
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - whis * iqr, F.col("q3") + whis * iqr
    v = F.col("value")
    return j.groupBy("feature", label, "q1", "med", "q3").agg(
        F.least("q1", F.min(F.when(v >= lo_f, v))).alias("whisker_lo"),
        F.greatest("q3", F.max(F.when(v <= hi_f, v))).alias("whisker_hi"),
        F.count(F.when((v < lo_f) | (v > hi_f), 1)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def _grams(features: list[str], shift: dict[str, float]):
    """For every pair of features the sums over the rows that have both, added
    up over a partition's batches: k^2 rows leave a task."""
    centre = np.array([shift[f] for f in features])

    def run(batches):
        sums = None
        for pdf in batches:
            x = pdf[features].to_numpy(np.float64, na_value=np.nan) - centre
            have = ~np.isnan(x)
            x, m = np.where(have, x, 0.0), have.astype(np.float64)
            part = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        i, j = np.tril_indices(len(features), -1)
        n, sx, sxx, sxy = sums
        yield pd.DataFrame({"i": i, "j": j, "n": n[i, j], "sa": sx[i, j], "sb": sx[j, i], "saa": sxx[i, j],
                            "sbb": sxx[j, i], "sab": sxy[i, j]})

    return run


def corr_lower(ent: DataFrame, features: list[str]) -> DataFrame:
    """Pearson matrix (pairwise-complete) as the strict lower triangle in
    long form.  One scan with a Gram matrix per batch (the columns shifted by
    their means, so that large offsets do not cancel), whatever the number of
    columns; NULL for a constant column or fewer than two pairs."""
    if len(features) < 2:
        return ent.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    ship_package(ent.sparkSession)
    x = ent.select(*[nan_to_null(F.col(f).cast("double")).alias(f) for f in features])
    ends = x.agg(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.min(f).alias(f"a_{f}") for f in features],
                 *[F.max(f).alias(f"b_{f}") for f in features]).first()     # three numbers for each feature
    shift = {f: ends[f"m_{f}"] or 0.0 for f in features}
    flat = [i for i, f in enumerate(features) if ends[f"a_{f}"] == ends[f"b_{f}"]]
    sums = (x.mapInPandas(_grams(list(features), shift),
                          "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]))
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    # a column that is constant among a pair's rows leaves only rounding behind
    some = (F.col("n") > 1) & (va > 1e-12 * F.col("saa")) & (vb > 1e-12 * F.col("sbb"))
    if flat:
        some = some & ~F.col("i").isin(flat) & ~F.col("j").isin(flat)
    names = F.array(*[F.lit(f) for f in features])
    return sums.select(F.element_at(names, F.col("i") + 1).alias("feature_a"),
                       F.element_at(names, F.col("j") + 1).alias("feature_b"),
                       F.when(some, cov / F.sqrt(va * vb)).alias("corr"))


def crosstab(ent: DataFrame, static: str, label: str = "label", classes=(0, 1)) -> DataFrame:
    """Static x label counts, zero-filled."""
    p = ent.groupBy(static).pivot(label, list(classes)).agg(F.count(F.lit(1))).na.fill(0)
    return p.select(static, *[F.col(str(c)).cast("long").alias(f"n_{c}") for c in classes])


def col_variance(ent: DataFrame, features: list[str], population: bool = False) -> DataFrame:
    """Sample (or population) variance per column."""
    fn = F.var_pop if population else F.var_samp
    return long_form(ent, [], features).groupBy("feature").agg(fn("value").alias("variance"))


def col_median(ent: DataFrame, features: list[str]) -> DataFrame:
    """Exact median per column."""
    lf = long_form(ent, [], features)
    return exact_percentiles(lf, ["feature"], "value", [0.5], out="median").drop("p")


def class_ratio(ent: DataFrame, label: str = "label") -> DataFrame:
    """n_neg / n_pos (0 when there is no positive)."""
    c = ent.agg(F.count(F.when(F.col(label) == 0, 1)).alias("n_neg"),
                F.count(F.when(F.col(label) == 1, 1)).alias("n_pos"))
    return c.select("n_neg", "n_pos", safe_div("n_neg", "n_pos").alias("ratio"))


def class_separation(ent: DataFrame, features: list[str], label: str = "label", places: int = 6) -> DataFrame:
    """(feature, weight): mean of the positives less mean of the negatives, in standard deviations of all rows; the
    weight of a feature on its own, without a model.  0 for a constant feature and where a class has no value."""
    v = F.col("value")
    gap = F.avg(F.when(F.col(label) == 1, v)) - F.avg(F.when(F.col(label) == 0, v))
    weight = F.when(F.min(v) < F.max(v), gap / F.stddev_samp(v))
    return long_form(ent, [label], features).groupBy("feature").agg(
        F.round(F.coalesce(weight, F.lit(0.0)), places).alias("weight"))


def cohort_stats(ent: DataFrame, features: list[str], places: int | None = 4) -> DataFrame:
    """Per-feature mean, std (1.0 when 0), q01, q25, q75, q99; rounded
    to ``places`` as published."""
    lf = long_form(ent, [], features)
    # std of an exactly constant column is 0 by definition (min == max): the
    # merged stddev can carry float noise, so the test is on min/max
    mom = lf.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.when(F.min("value") == F.max("value"), F.lit(0.0)).otherwise(F.stddev_samp("value")).alias("std"))
    qs = exact_percentiles_wide(lf, ["feature"], "value",
                                {"q01": 0.01, "q25": 0.25, "q75": 0.75, "q99": 0.99})
    out = mom.join(qs, "feature", "left").select(
        "feature", "mean", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("std"),
        "q01", "q25", "q75", "q99")
    if places is not None:
        out = out.select("feature", *[F.round(c, places).alias(c)
                                      for c in ("mean", "std", "q01", "q25", "q75", "q99")])
    return out


def dataset_summary(raw: DataFrame, ent: DataFrame, entity: list[str], features: list[str],
                    label: str = "label") -> DataFrame:
    """Rows, entities, features, positive share, mean null share."""
    a = raw.agg(F.count(F.lit(1)).alias("n_rows"))
    b = ent.agg(F.count(F.lit(1)).alias("n_entities"), F.avg(F.col(label).cast("double")).alias("pos_share"))
    c = null_overall(ent, features).select("mean_null_share")
    return combine_rows(a, b, c, F.lit(len(features)).cast("long").alias("n_features"))
