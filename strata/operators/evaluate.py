"""Evaluation (E1-E14, K3, K4) on a scored table (label 0/1, probability).

Rule: positive iff ``p >= threshold`` (MLlib's ``prediction`` column is never
used).  0/0 in precision / recall / F1 is 0.  Threshold sweeps on a fixed grid
collapse the rows to per-bucket counts in one pass and cumulate over at most
len(grid)+1 rows; ROC-AUC and ROC points cumulate over distinct scores with
the distributed running sum (no single-task window over all scores).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import combine_rows, safe_div
from strata.operators.rank import running_sums

# The calibration grid 0.05..0.50 step 0.05 and the sweep grid
# 0.00..1.00 step 0.01 (rounded literals, compared exactly).
CALIBRATION_GRID = [round(i / 100, 2) for i in range(5, 55, 5)]
SWEEP_STEP = 0.01


def sweep_grid(step: float = SWEEP_STEP) -> list[float]:
    n = int(round(1.0 / step))
    return [round(i * step, 4) for i in range(n + 1)]


def _alarm(prob: str, t) -> Column:
    return F.col(prob) >= (t if isinstance(t, Column) else F.lit(float(t)))


def confusion(scored: DataFrame, threshold: float, label: str = "label", prob: str = "p") -> DataFrame:
    """TP, FN, FP, TN at ``threshold`` in one pass."""
    y, a = F.col(label) == 1, _alarm(prob, threshold)
    return scored.agg(
        F.count(F.when(y & a, 1)).alias("tp"), F.count(F.when(y & ~a, 1)).alias("fn"),
        F.count(F.when(~y & a, 1)).alias("fp"), F.count(F.when(~y & ~a, 1)).alias("tn"))


def prf_cols(tp="tp", fn="fn", fp="fp") -> list[Column]:
    """Precision, recall, F1 from counts (0/0 -> 0)."""
    tp_, fn_, fp_ = F.col(tp), F.col(fn), F.col(fp)
    return [safe_div(tp_, tp_ + fp_).alias("precision"), safe_div(tp_, tp_ + fn_).alias("recall"),
            safe_div(2 * tp_, 2 * tp_ + fp_ + fn_).alias("f1")]


def prf(scored: DataFrame, threshold: float, label: str = "label", prob: str = "p") -> DataFrame:
    return confusion(scored, threshold, label, prob).select(*prf_cols())


def _score_counts(scored: DataFrame, label: str, prob: str, groups: list[str]) -> DataFrame:
    return scored.groupBy(*groups, prob).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        (F.count(F.lit(1)) - F.sum(F.col(label).cast("long"))).alias("neg"))


def roc_auc(scored: DataFrame, label: str = "label", prob: str = "p",
            groups: list[str] | None = None) -> DataFrame:
    """Tie-aware ROC-AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P N)."""
    groups = list(groups or [])
    sc = _score_counts(scored, label, prob, groups)
    cu = running_sums(sc, [prob], ["neg"], groups=groups)
    below = F.col("neg_cum") - F.col("neg")
    return cu.groupBy(*groups).agg(
        safe_div(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                 F.sum("pos").cast("double") * F.sum("neg").cast("double"), None).alias("roc_auc"))


def roc_points(scored: DataFrame, label: str = "label", prob: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) at the start (0, 0), where nothing is
    flagged (threshold infinity), and at every distinct score."""
    sc = _score_counts(scored, label, prob, [])
    n_pos, n_neg = sc.agg(F.sum("pos"), F.sum("neg")).first()  # two scalars
    cu = running_sums(sc, [prob], ["pos", "neg"], descending=True)
    pts = cu.select(F.col(prob).cast("double").alias("threshold"), safe_div("neg_cum", F.lit(n_neg or 0)).alias("fpr"),
                    safe_div("pos_cum", F.lit(n_pos or 0)).alias("tpr"))
    start = scored.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                                F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def grid_bucket(value: Column, grid: list[float]) -> Column:
    """Number of (sorted) grid values <= value, as a balanced binary search of
    CASE expressions: ~log2(len(grid)) literal comparisons per row, all inside
    whole-stage codegen (no per-row array, no lambda)."""
    g = sorted(float(t) for t in grid)

    def bs(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(g[mid]), bs(mid + 1, hi)).otherwise(bs(lo, mid))
    return F.when(value.isNull(), F.lit(0)).otherwise(bs(0, len(g)))


def grid_counts(scored: DataFrame, grid: list[float], label: str = "label", prob: str = "p",
                groups: list[str] | None = None) -> DataFrame:
    """TP / FP at every grid threshold (p >= t, literal grid values).

    One pass buckets each row (b = number of grid values <= p) and counts per
    bucket; a bucket b counts towards thresholds 1..b.  The bucket table has
    at most len(grid)+1 rows per group, so fanning each bucket row out over
    the grid (index 0 carries the class totals) is tiny and needs no join.
    Output: (groups..., i, threshold, tp, fp, n_pos, n_neg)."""
    from pyspark.sql import Window
    groups = list(groups or [])
    grid = sorted(float(t) for t in grid)
    n = len(grid)
    y = F.col(label).cast("long")
    bc = scored.groupBy(*groups, grid_bucket(F.col(prob), grid).alias("b")).agg(
        F.sum(y).alias("pos"), (F.count(F.lit(1)) - F.sum(y)).alias("neg"))
    fan = bc.select(*groups, "b", "pos", "neg", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("i"))
    hit = F.col("i") <= F.col("b")
    cum = fan.groupBy(*groups, "i").agg(F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
                                        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"))
    w = Window.partitionBy(*groups)
    garr = F.array(*[F.lit(t) for t in grid])
    out = cum.select(*groups, "i", "tp", "fp",
                     F.max(F.when(F.col("i") == 0, F.col("tp"))).over(w).alias("n_pos"),
                     F.max(F.when(F.col("i") == 0, F.col("fp"))).over(w).alias("n_neg"))
    return out.filter(F.col("i") >= 1).select(
        *groups, F.col("i").cast("int").alias("i"), F.element_at(garr, F.col("i").cast("int")).alias("threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def threshold_table(scored: DataFrame, grid: list[float], label="label", prob="p",
                    groups: list[str] | None = None) -> DataFrame:
    gc = grid_counts(scored, grid, label, prob, groups)
    return gc.select(*(groups or []), "threshold", "tp", "fp",
                     (F.col("n_pos") - F.col("tp")).alias("fn"), (F.col("n_neg") - F.col("fp")).alias("tn"),
                     "n_pos", "n_neg")


def choose_threshold(scored: DataFrame, grid: list[float] | None = None, label="label",
                     prob="p") -> DataFrame:
    """(threshold, precision, recall, f1) on the calibration grid."""
    t = threshold_table(scored, grid or CALIBRATION_GRID, label, prob)
    return t.select("threshold", *prf_cols())


def best_threshold(choices: DataFrame) -> DataFrame:
    """K3: arg-max F1, first (lowest) threshold wins ties."""
    return choices.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def threshold_sweep(scored: DataFrame, step: float = SWEEP_STEP, label="label", prob="p") -> DataFrame:
    """TP / FP at every step of 0..1 plus the class totals (long form)."""
    return grid_counts(scored, sweep_grid(step), label, prob).select(
        "threshold", "tp", "fp", "n_pos", "n_neg")


def sweep_artifact(sweep: DataFrame, step: float = SWEEP_STEP) -> DataFrame:
    """E7 nested form: one row struct<step, n_pos, n_neg, tp array, fp array>
    (arrays of grid length, ordered by threshold)."""
    s = sweep.agg(F.sort_array(F.collect_list(F.struct("threshold", "tp", "fp"))).alias("rows"),
                  F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))
    return s.select(F.lit(step).alias("step"), "n_pos", "n_neg",
                    F.transform("rows", lambda r: r["tp"]).alias("tp"),
                    F.transform("rows", lambda r: r["fp"]).alias("fp"))


def metric_bundle(scored: DataFrame, threshold: float, label="label", prob="p",
                  nested: bool = False) -> DataFrame:
    """E8 (+E10): threshold, f1, roc_auc, precision, recall, accuracy and the
    confusion counts in one row (``nested`` puts them in a struct)."""
    c = confusion(scored, threshold, label, prob)
    a = roc_auc(scored, label, prob)
    row = combine_rows(c, a)
    acc = safe_div(F.col("tp") + F.col("tn"), F.greatest(F.lit(1), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
    cols = [F.lit(float(threshold)).alias("threshold"), *prf_cols(), "roc_auc", acc.alias("accuracy")]
    if nested:
        return row.select(*cols, F.struct("tp", "fn", "fp", "tn").alias("confusion"))
    return row.select(*cols, "tp", "fn", "fp", "tn")


def model_comparison(scores_long: DataFrame, thresholds: dict, label="label", prob="p",
                     model: str = "model", places: int | None = 4) -> DataFrame:
    """Per model: F1, ROC-AUC, precision, recall at the model's threshold,
    rounded to ``places``."""
    tcol = None
    for m, t in thresholds.items():
        tcol = (F.when(F.col(model) == m, F.lit(float(t))) if tcol is None
                else tcol.when(F.col(model) == m, F.lit(float(t))))
    s = scores_long.withColumn("_t", tcol)
    y, a = F.col(label) == 1, F.col(prob) >= F.col("_t")
    c = s.groupBy(model).agg(
        F.count(F.when(y & a, 1)).alias("tp"), F.count(F.when(y & ~a, 1)).alias("fn"),
        F.count(F.when(~y & a, 1)).alias("fp"))
    auc = roc_auc(scores_long, label, prob, groups=[model])
    out = c.join(auc, model).select(model, *prf_cols(), "roc_auc")
    if places is None:
        return out
    return out.select(model, *[F.round(x, places).alias(x) for x in ("f1", "roc_auc", "precision", "recall")])


def winner(comparison: DataFrame, priority: dict, model: str = "model") -> DataFrame:
    """K4: best F1; on a tie the model with the smaller priority wins."""
    pr = None
    for m, k in priority.items():
        pr = F.when(F.col(model) == m, F.lit(k)) if pr is None else pr.when(F.col(model) == m, F.lit(k))
    return comparison.orderBy(F.col("f1").desc(), pr.asc()).limit(1)


def class_report(scored: DataFrame, threshold: float, label="label", prob="p") -> DataFrame:
    """E5: per-class precision / recall / F1 / support, accuracy, macro and
    support-weighted means (rows '0', '1', 'accuracy', 'macro avg',
    'weighted avg')."""
    c = confusion(scored, threshold, label, prob)
    tp, fn, fp, tn = (F.col(x) for x in ("tp", "fn", "fp", "tn"))
    p1, r1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    p0, r0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp)
    f1_1, f1_0 = safe_div(2 * tp, 2 * tp + fp + fn), safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0, n = tp + fn, tn + fp, tp + fn + fp + tn
    rows = F.array(
        F.struct(F.lit("0").alias("row"), p0.alias("precision"), r0.alias("recall"), f1_0.alias("f1"),
                 s0.alias("support")),
        F.struct(F.lit("1").alias("row"), p1.alias("precision"), r1.alias("recall"), f1_1.alias("f1"),
                 s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), safe_div(tp + tn, n).alias("f1"),
                 n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f1_0 + f1_1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), safe_div(p0 * s0 + p1 * s1, n).alias("precision"),
                 safe_div(r0 * s0 + r1 * s1, n).alias("recall"), safe_div(f1_0 * s0 + f1_1 * s1, n).alias("f1"),
                 n.alias("support")))
    return c.select(F.explode(rows).alias("r")).select("r.*")


def caught(scored: DataFrame, threshold: float, label="label", prob="p") -> DataFrame:
    """Positives caught at ``threshold`` out of all positives."""
    y = F.col(label) == 1
    c = scored.agg(F.count(F.when(y & _alarm(prob, threshold), 1)).alias("caught"),
                   F.count(F.when(y, 1)).alias("n_pos"))
    return c.select("caught", "n_pos", safe_div("caught", "n_pos").alias("caught_share"))


def score_parity(a: DataFrame, b: DataFrame, key: str | list[str], threshold: float,
                 prob_a: str = "p", prob_b: str = "p") -> DataFrame:
    """Rows scored both ways, max |p_a - p_b| and label flips at
    ``threshold`` among them, and the rows that only one side has or scored."""
    keys = [key] if isinstance(key, str) else list(key)
    k = a.select(*keys, F.col(prob_a).alias("_pa")).join(
        b.select(*keys, F.col(prob_b).alias("_pb")), keys, "full")
    both = F.col("_pa").isNotNull() & F.col("_pb").isNotNull()
    flip = (F.col("_pa") >= threshold) != (F.col("_pb") >= threshold)
    return k.agg(F.count(F.when(both, 1)).alias("n"),
                 F.max(F.abs(F.col("_pa") - F.col("_pb"))).alias("max_abs_delta"),
                 F.count(F.when(flip, 1)).alias("n_flips"), F.count(F.when(~both, 1)).alias("n_unmatched"))


class ParityError(AssertionError):
    """Two scorings of the same rows differ."""


def require_parity(a: DataFrame, b: DataFrame, key: str | list[str], threshold: float, tolerance: float = 1e-9,
                   prob_a: str = "p", prob_b: str = "p") -> None:
    """The export gate: raises if a row is lost, flips or moves by more than ``tolerance``."""
    r = score_parity(a, b, key, threshold, prob_a, prob_b).first()
    if r["n_unmatched"] or r["n_flips"] or (r["max_abs_delta"] or 0.0) > tolerance:
        raise ParityError(f"scores differ: {r.asDict()}")


def sweep_delta(sweep: DataFrame, base_threshold: float, step: float = SWEEP_STEP) -> DataFrame:
    """Counts at every sweep step and the change against the base
    (tuned) threshold: caught delta = fn_base - fn, false-alarm delta =
    fp - fp_base; precision is NULL when nothing is flagged."""
    last = int(round(1.0 / step))
    base_i = min(max(int(round(base_threshold / step)), 0), last)
    s = sweep.withColumn("_i", F.round(F.col("threshold") / step).cast("int"))
    base = s.filter(F.col("_i") == base_i).select("tp", "fp").first()  # one grid row
    j = s.withColumn("tp_b", F.lit(base["tp"])).withColumn("fp_b", F.lit(base["fp"]))
    fn, fn_b = F.col("n_pos") - F.col("tp"), F.col("n_pos") - F.col("tp_b")
    return j.select(
        "threshold", "tp", "fp", fn.alias("fn"), (F.col("n_neg") - F.col("fp")).alias("tn"),
        (fn_b - fn).alias("d_caught"), (F.col("fp") - F.col("fp_b")).alias("d_false_alarms"),
        safe_div(F.col("tp"), F.col("n_pos"), None).alias("recall"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp"), None).alias("precision"))


def outcome_class(scored: DataFrame, threshold: float, label="label", prob="p") -> DataFrame:
    """Per row: alarm flag and correct/wrong x alarm/silent outcome."""
    a, y = _alarm(prob, threshold), F.col(label) == 1
    out = (F.when(a & y, "correct alarm").when(~a & ~y, "correct silence")
           .when(a & ~y, "false alarm").otherwise("miss"))
    return scored.select("*", a.alias("alarm"), out.alias("outcome"))
