"""Seeded, exact-quota sampling.

Every draw is a rank inside the stratum by ``md5(seed:key)``: deterministic,
independent of partitioning and of task retries, and reproducible outside
Spark (any engine with md5 gives the same membership).  Quotas follow the
largest-remainder rule: the test share is ``ceil(n * share)``, class quotas of
the training side are ``floor(n_c / n * n_train)`` plus one for the classes
with the largest remainders (ties to the smaller class value).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

SEED = 42


def draw_key(keys: list[str], seed: int = SEED) -> Column:
    """Hex md5 of ``seed:key1:key2...`` — the seeded shuffle order."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def _class_counts(df: DataFrame, label: str) -> list[tuple]:
    # one row per class: a bounded collect
    return _known_classes((r[0], r[1]) for r in df.groupBy(label).count().collect())


def _known_classes(counts) -> list[tuple]:
    counts = list(counts)
    if any(c is None for c, _ in counts):
        raise ValueError("a row without a class (NULL label) has no stratum; drop or label it first")
    return sorted(counts)


def largest_remainder(counts: list[tuple], n_draw: int) -> dict:
    """Apportion ``n_draw`` rows over classes proportionally to their counts."""
    n = sum(c for _, c in counts)
    cont = [(k, c / n * n_draw) for k, c in counts]
    floors = {k: math.floor(v) for k, v in cont}
    need = n_draw - sum(floors.values())
    rem = sorted(((v - math.floor(v), k) for k, v in cont), key=lambda t: (-t[0], t[1]))
    for _, k in rem[:max(0, need)]:
        floors[k] += 1
    return floors


PREFIX = 5      # leading hex digits of a draw: 16^5 counts for each class


def quota_cuts(df: DataFrame, keys: list[str], label: str, quotas, seed: int) -> dict:
    """For each class the largest draw that its quota takes (keys are unique, so
    a row is taken if its draw is not larger).  ``quotas`` maps the sorted
    (class, count) list to a quota by class.

    Two narrow passes over (class, draw): counts by class and leading digits,
    from which the digits at the quota follow, then the exact draw among the rows
    with those digits.  No row but those is sorted, and only the counts are written;
    at most 16^5 counts a class are summed up in one task, and one row a class is collected."""
    draws = df.select(F.col(label).alias("c"), draw_key(keys, seed).alias("h"))
    counts = cut_lineage(draws.groupBy("c", F.substring("h", 1, PREFIX).alias("d")).agg(F.count(F.lit(1)).alias("n")))
    totals = _known_classes((r["c"], r["n"]) for r in counts.groupBy("c").agg(F.sum("n").alias("n")).collect())
    quota = quotas(totals)
    cuts = {c: "" if quota.get(c, 0) <= 0 else "g" for c, n in totals}       # "g" is above every hex digit
    open_classes = [c for c, n in totals if 0 < quota.get(c, 0) < n]
    if not open_classes:
        return cuts
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("d"))
    due = F.coalesce(*[F.when(F.col("c") == F.lit(c), F.lit(int(quota[c]))) for c in open_classes])
    at = (counts.withColumn("upto", upto).withColumn("due", due)
          .where((F.col("upto") >= F.col("due")) & (F.col("upto") - F.col("n") < F.col("due")))
          .select("c", "d", (F.col("due") - F.col("upto") + F.col("n")).alias("nth")).collect())
    here = F.coalesce(*[F.when((F.col("c") == F.lit(r["c"])) & F.col("h").startswith(r["d"]), F.lit(int(r["nth"])))
                        for r in at])
    rank = F.row_number().over(Window.partitionBy("c").orderBy("h"))
    found = draws.withColumn("nth", here).where("nth is not null").withColumn("r", rank).where("r = nth").collect()
    return cuts | {r["c"]: r["h"] for r in found}


def taken(keys: list[str], label: str, cuts: dict, seed: int) -> Column:
    """Whether a row is within its class's quota."""
    h = draw_key(keys, seed)
    cut = F.coalesce(*[F.when(F.col(label) == F.lit(c), F.lit(v)) for c, v in cuts.items()], F.lit(""))
    return h <= cut


def split_quotas(counts: list[tuple], share: float | int) -> tuple[dict, int, int]:
    n = sum(c for _, c in counts)
    n_test = int(share) if isinstance(share, int) else math.ceil(share * n)
    n_train = n - n_test
    return largest_remainder(counts, n_train), n_train, n_test


def stratified_split(df: DataFrame, keys: list[str], label: str, share: float | int = 0.2,
                     seed: int = SEED, names: tuple[str, str] = ("train", "test"),
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` = names[0] / names[1] with exact per-class quotas.
    ``share`` is a fraction (ceil) or an absolute test size."""
    cuts = quota_cuts(df, keys, label, lambda counts: split_quotas(counts, share)[0], seed)
    return df.withColumn(split_col, F.when(taken(keys, label, cuts, seed), F.lit(names[0])).otherwise(F.lit(names[1])))


def stratified_sample_n(df: DataFrame, keys: list[str], label: str, n: int,
                        seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows, class shares kept (the held-out side of a split
    with an absolute size)."""
    s = stratified_split(df, keys, label, share=int(n), seed=seed, names=("rest", "sample"))
    return s.filter(F.col("split") == "sample").drop("split")


def stratified_folds(df: DataFrame, keys: list[str], label: str, k: int = 5,
                     seed: int = SEED, fold_col: str = "fold") -> DataFrame:
    """K stratified folds.  Rows are ordered by (class, seeded draw) and
    dealt round-robin, so per-class fold sizes differ by at most one.

    A row's place is the count of its class's draws with smaller leading digits, at most 16^5 counts a class, plus its
    rank among the draws with the same digits: one exchange by those digits, no sort of all rows.  ``df`` is
    read twice.  A NULL class is an error."""
    h = draw_key(keys, seed)
    digits = F.substring("_h", 1, PREFIX).alias("_d")
    counts = cut_lineage(df.select(F.col(label), h.alias("_h")).groupBy(label, digits).agg(F.count(F.lit(1)).alias("_n")))
    totals = _known_classes((r[0], r[1]) for r in counts.groupBy(label).agg(F.sum("_n")).collect())
    firsts, run = [], 0
    for c, n in totals:
        firsts.append(F.when(F.col(label) == F.lit(c), F.lit(run).cast("long")))
        run += n
    if not totals:
        return df.withColumn(fold_col, F.lit(0))
    upto = F.sum("_n").over(Window.partitionBy(label).orderBy("_d"))
    before = counts.select(label, "_d", (upto - F.col("_n") + F.coalesce(*firsts)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(label, "_d").orderBy("_h", *keys))
    placed = df.withColumn("_h", h).withColumn("_d", digits).join(before, [label, "_d"])
    return placed.select(*df.columns, ((F.col("_before") + own - 1) % k).cast("int").alias(fold_col))


def class_capped_sample(df: DataFrame, keys: list[str], label: str, n_samples: int,
                        seed: int = SEED) -> DataFrame:
    """Up to n_samples // 2 rows per class without replacement, returned
    in seeded shuffled order (``_order``)."""
    cap = max(1, n_samples // 2)
    cuts = quota_cuts(df, keys, label, lambda counts: {c: cap for c, _ in counts}, seed)
    return df.filter(taken(keys, label, cuts, seed)).withColumn("_order", draw_key(keys, seed + 1))


def _normal(seed: int, name: str, idx: Column) -> Column:
    def uniform(salt: int) -> Column:
        h = F.xxhash64(F.lit(seed), F.lit(name), F.lit(salt), idx)
        return (h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") + 0.5) / float(1 << 53)
    return F.sqrt(-2.0 * F.log(uniform(0))) * F.cos(2.0 * math.pi * uniform(1))


def gaussian_rows(spark, stats: DataFrame, n: int, widen: float = 2.5,
                  seed: int = SEED) -> DataFrame:
    """``n`` synthetic rows, feature f ~ N(mean_f, (widen * sd_f)^2).

    ``stats`` has one row per feature (feature, mean, std) — bounded by the
    number of features — so it is collected and inlined as literals.  Draws
    are Box-Muller on two uniforms hashed from (seed, feature, row id): the
    same rows at any partitioning and after any retry."""
    rows = sorted((r["feature"], r["mean"], r["std"]) for r in stats.collect())
    base = spark.range(n).withColumnRenamed("id", "row_id")
    return base.select("row_id", *[
        (F.lit(m) + _normal(seed, f, F.col("row_id")) * F.lit(widen * (sd or 0.0))).alias(f)
        for f, m, sd in rows])
