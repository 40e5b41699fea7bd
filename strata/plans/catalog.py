"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each next to its DuckDB oracle (when the operator
is SQL-expressible).  Doubles are rounded to 6 places on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import round_doubles
from strata.operators import aggregate as agg
from strata.plans import oracle as O
from strata.plans import views as V
from strata.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


ORD, DAY = V.ORD_SPEC, V.DAY_SPEC
_ORD_ENT_SQL = O.entity_select(ORD, "v_ord_raw")


# --- A1-A5 entity aggregation --------------------------------------------
@register("entity_table", O.with_(O.V_ORD_RAW) + _ORD_ENT_SQL)
def q_entity_table(spark, sf):
    return round_doubles(agg.entity_table(V.v_ord_raw(spark, sf), ORD))


@register("entity_table_sparse", O.with_(O.V_DAY_RAW) + O.entity_select(DAY, "v_day_raw"))
def q_entity_table_sparse(spark, sf):
    return round_doubles(agg.entity_table(V.v_day_raw(spark, sf), DAY))


@register("entity_agg", O.with_(O.V_ORD_RAW) + "SELECT l_orderkey, " + ", ".join(
    f"{O.r(f'{O._AGG_SQL[a]}({m})')} AS {m}_{a}" for m in ORD.measures for a in ORD.aggs)
    + " FROM v_ord_raw GROUP BY l_orderkey")
def q_entity_agg(spark, sf):
    return round_doubles(agg.entity_agg(V.v_ord_raw(spark, sf), ORD))


@register("entity_range", O.with_(O.V_ORD_RAW) + "SELECT l_orderkey, " + ", ".join(
    f"{O.r(f'max({m}) - min({m})')} AS {m}_range" for m in ORD.measures)
    + " FROM v_ord_raw GROUP BY l_orderkey")
def q_entity_range(spark, sf):
    return round_doubles(agg.entity_range(V.v_ord_raw(spark, sf), ORD))


@register("entity_statics", O.with_(O.V_DAY_RAW)
          + "SELECT user_id, day, min({'o': hr, 'v': click}) FILTER (WHERE click IS NOT NULL).v AS click"
          " FROM v_day_raw GROUP BY user_id, day")
def q_entity_statics(spark, sf):
    # first non-missing value in sequence order, on a sparse column
    from strata.spec import CohortSpec
    spec = CohortSpec(entity=("user_id", "day"), seq="hr", measures=(), statics=("click",))
    return round_doubles(agg.entity_statics(V.v_day_raw(spark, sf), spec))


@register("entity_length", O.with_(O.V_ORD_RAW)
          + "SELECT l_orderkey, max(l_linenumber) AS l_linenumber_max FROM v_ord_raw GROUP BY 1")
def q_entity_length(spark, sf):
    return agg.entity_length(V.v_ord_raw(spark, sf), ORD)


@register("entity_label", O.with_(O.V_ORD_RAW)
          + "SELECT l_orderkey, max(is_pos) AS label FROM v_ord_raw GROUP BY 1")
def q_entity_label(spark, sf):
    return agg.entity_label(V.v_ord_raw(spark, sf), ORD)


@register("scan_raw", O.with_(O.V_ORD_RAW)
          + "SELECT l_orderkey, l_linenumber, " + ", ".join(O.r(m) + f" AS {m}" for m in ORD.measures)
          + f", {O.r('o_totalprice')} AS o_totalprice, o_priority, is_pos FROM v_ord_raw")
def q_scan_raw(spark, sf):
    return round_doubles(V.v_ord_raw(spark, sf))


@register("static_join", O.with_(O.V_ORD_RAW)
          + "SELECT e.l_orderkey, e.n_lines, c.c_nationkey FROM (SELECT l_orderkey, count(*) AS n_lines"
          " FROM v_ord_raw GROUP BY 1) e LEFT JOIN orders o ON e.l_orderkey = o.o_orderkey"
          " LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
def q_static_join(spark, sf):
    from strata.sources.tables import table
    ent = V.v_ord_raw(spark, sf).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    dim = (table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
           .join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                     "c_nationkey"), "o_custkey", "left")
           .select("l_orderkey", "c_nationkey"))
    return agg.static_join(ent, dim, "l_orderkey")


@register("xy_join", O.with_(O.V_ORD_RAW, O.ORD_ENT)
          + "SELECT l_orderkey, " + O.r("l_quantity_mean") + " AS l_quantity_mean, label FROM ord_ent")
def q_xy_join(spark, sf):
    ent = cut_lineage(V.v_ord_entities(spark, sf).select("l_orderkey", "l_quantity_mean", "label"))    # one table for both
    x = ent.select("l_orderkey", "l_quantity_mean")
    y = ent.select("l_orderkey", "label")
    return round_doubles(agg.xy_join(x, y, "l_orderkey"))


# --- X1-X5 sampling ------------------------------------------------------------
from strata.operators import sampling as S  # noqa: E402


def _ord_labels(spark, sf):
    return agg.entity_label(V.v_ord_raw(spark, sf), ORD)


def ord_split(spark, sf):
    """Entity labels of V-ORD with the seeded 80/20 train/test split."""
    return S.stratified_split(cut_lineage(_ord_labels(spark, sf)), ["l_orderkey"], "label", 0.2)


@register("stratified_split", O.with_(O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT)
          + "SELECT l_orderkey, label, split FROM ord_split")
def q_stratified_split(spark, sf):
    return ord_split(spark, sf)


@register("validation_split", O.with_(
    O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT,
    "ord_train AS (SELECT l_orderkey, label FROM ord_split WHERE split = 'train')",
    O.split_sql("ord_val", "ord_train", ["l_orderkey"], "label", 0.2, 43, ("tr2", "val")))
    + "SELECT l_orderkey, label, split FROM ord_val")
def q_validation_split(spark, sf):
    tr = ord_split(spark, sf).filter(F.col("split") == "train").drop("split")
    return S.stratified_split(tr, ["l_orderkey"], "label", 0.2, seed=43, names=("tr2", "val"))


@register("stratified_sample_n", O.with_(
    O.V_ORD_RAW, O.ORD_LAB,
    O.split_sql("smp", "ord_lab", ["l_orderkey"], "label", 2000, 42, ("rest", "sample")),
    "smp_rows AS (SELECT l_orderkey, label FROM smp WHERE split = 'sample')",
    O.split_sql("smp2", "smp_rows", ["l_orderkey"], "label", 0.2, 42, ("train", "test")))
    + "SELECT l_orderkey, label, split FROM smp2")
def q_stratified_sample_n(spark, sf):
    smp = S.stratified_sample_n(_ord_labels(spark, sf), ["l_orderkey"], "label", 2000)
    return S.stratified_split(smp, ["l_orderkey"], "label", 0.2)


@register("stratified_folds", O.with_(
    O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT,
    "ord_train AS (SELECT l_orderkey, label FROM ord_split WHERE split = 'train')",
    O.folds_sql("fo", "ord_train", ["l_orderkey"], "label", 5, 44))
    + "SELECT l_orderkey, label, fold FROM fo")
def q_stratified_folds(spark, sf):
    tr = ord_split(spark, sf).filter(F.col("split") == "train").drop("split")
    return S.stratified_folds(tr, ["l_orderkey"], "label", 5, seed=44)


@register("class_capped_sample", O.with_(
    O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT,
    "ord_test AS (SELECT l_orderkey, label FROM ord_split WHERE split = 'test')",
    "cap_rk AS (SELECT l_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY "
    + O.draw_sql(["l_orderkey"], 7) + ", l_orderkey) AS rn FROM ord_test)")
    + "SELECT l_orderkey, label FROM cap_rk WHERE rn <= 40")
def q_class_capped_sample(spark, sf):
    te = ord_split(spark, sf).filter(F.col("split") == "test").drop("split")
    return S.class_capped_sample(te, ["l_orderkey"], "label", 80, seed=7).select("l_orderkey", "label")


# --- A6-A19, P9, R6 profiles -----------------------------------------------------
from strata.operators import profile as P  # noqa: E402

ORD_F, DAY_F = O.ORD_FEATURES, O.DAY_FEATURES
_ORD = O.with_(O.V_ORD_RAW, O.ORD_ENT)
_DAY = O.with_(O.V_DAY_RAW, O.DAY_ENT)
_DAYL = O.with_(O.V_DAY_RAW, O.DAY_ENT, O.DAY_LONG)
_ORDL = O.with_(O.V_ORD_RAW, O.ORD_ENT, O.ORD_LONG)


@register("table_profile", O.with_(O.V_ORD_RAW)
          + "SELECT count(*) AS n_rows, CAST(9 AS BIGINT) AS n_cols, count(DISTINCT l_orderkey) AS n_entities"
          " FROM v_ord_raw")
def q_table_profile(spark, sf):
    return P.table_profile(V.v_ord_raw(spark, sf), ["l_orderkey"])


@register("class_balance", _ORD + "SELECT label, count(*) AS n, "
          + O.r("count(*) / sum(count(*)) OVER ()") + " AS share FROM ord_ent GROUP BY label")
def q_class_balance(spark, sf):
    return round_doubles(P.class_balance(V.v_ord_entities(spark, sf)))


_NULL_SHARE = "1.0 - CAST(count(value) AS DOUBLE) / count(*)"


@register("null_profile", _DAYL + f"SELECT feature, {O.r('ns')} AS null_share FROM (SELECT feature, "
          f"{_NULL_SHARE} AS ns FROM day_long GROUP BY feature) WHERE ns > 0 ORDER BY ns DESC, feature LIMIT 50")
def q_null_profile(spark, sf):
    return round_doubles(P.null_profile(V.v_day_entities(spark, sf), DAY_F))


@register("null_bands", _DAYL + f"SELECT feature, {O.r('ns')} AS null_share, CASE WHEN ns > 0.9 THEN '>90%'"
          " WHEN ns > 0.5 THEN '>50%' ELSE '<=50%' END AS band FROM (SELECT feature, "
          f"{_NULL_SHARE} AS ns FROM day_long GROUP BY feature)")
def q_null_bands(spark, sf):
    return round_doubles(P.null_bands(V.v_day_entities(spark, sf), DAY_F))


@register("null_overall", _DAYL + f"SELECT {O.r('avg(ns)')} AS mean_null_share, CAST(sum(nmiss) AS BIGINT)"
          f" AS missing_cells FROM (SELECT feature, {_NULL_SHARE} AS ns, count(*) - count(value) AS nmiss"
          " FROM day_long GROUP BY feature)")
def q_null_overall(spark, sf):
    return round_doubles(P.null_overall(V.v_day_entities(spark, sf), DAY_F))


@register("split_rates", O.with_(O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT)
          + f"SELECT split, count(*) AS n, {O.r('avg(label)')} AS pos_rate FROM ord_split GROUP BY split")
def q_split_rates(spark, sf):
    return round_doubles(P.split_rates(ord_split(spark, sf)))


_HF = O.ORD_MEAN_FEATURES


@register("histogram_by_class", O.with_(
    O.V_ORD_RAW, O.ORD_ENT, f"hl AS ({O.long_sql('ord_ent', ['label'], _HF)})",
    "hv AS (SELECT * FROM hl WHERE value IS NOT NULL)",
    "hr0 AS (SELECT feature, label, min(value) AS lo0, max(value) AS hi0, count(*) AS n_fc FROM hv GROUP BY 1, 2)",
    "hr AS (SELECT feature, label, n_fc, CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo,"
    " CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi FROM hr0)",
    "hb AS (SELECT v.feature, v.label, CAST(least(floor((v.value - r.lo) * 40 / (r.hi - r.lo)), 39) AS INTEGER)"
    " AS bin FROM hv v JOIN hr r ON v.feature = r.feature AND v.label = r.label)",
    "hc AS (SELECT feature, label, bin, count(*) AS n FROM hb GROUP BY 1, 2, 3)",
    "hg AS (SELECT hr.*, CAST(g.bin AS INTEGER) AS bin FROM hr, range(40) g(bin))",
    "ha AS (SELECT g.*, coalesce(c.n, 0) AS n FROM hg g LEFT JOIN hc c ON g.feature = c.feature AND g.label = c.label"
    " AND g.bin = c.bin)")
    + "SELECT feature, label, bin, " + O.r("lo + bin * ((hi - lo) / 40)") + " AS bin_lo, "
    + O.r("lo + (bin + 1) * ((hi - lo) / 40)") + " AS bin_hi, CAST(n AS BIGINT) AS n, "
    + O.r("n / (n_fc * ((hi - lo) / 40))") + " AS density FROM ha")
def q_histogram_by_class(spark, sf):
    return round_doubles(P.histogram_by_class(V.v_ord_entities(spark, sf), _HF))


@register("boxplot_by_class", O.with_(
    O.V_ORD_RAW, O.ORD_ENT, f"bl AS ({O.long_sql('ord_ent', ['label'], _HF)})",
    "bv AS (SELECT * FROM bl WHERE value IS NOT NULL)",
    "bq AS (SELECT feature, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,"
    " quantile_cont(value, 0.75) AS q3 FROM bv GROUP BY 1, 2)")
    + "SELECT v.feature, v.label, " + ", ".join(O.r(f"q.{c}") + f" AS {c}" for c in ("q1", "med", "q3"))
    + ", " + O.r("least(q.q1, min(CASE WHEN v.value >= q.q1 - 1.5 * (q.q3 - q.q1) THEN v.value END))")
    + " AS whisker_lo, "
    + O.r("greatest(q.q3, max(CASE WHEN v.value <= q.q3 + 1.5 * (q.q3 - q.q1) THEN v.value END))") + " AS whisker_hi, "
    "count(CASE WHEN v.value < q.q1 - 1.5 * (q.q3 - q.q1) OR v.value > q.q3 + 1.5 * (q.q3 - q.q1) THEN 1 END)"
    " AS n_outliers, count(*) AS n FROM bv v JOIN bq q ON v.feature = q.feature AND v.label = q.label"
    " GROUP BY v.feature, v.label, q.q1, q.med, q.q3")
def q_boxplot_by_class(spark, sf):
    return round_doubles(P.boxplot_by_class(V.v_ord_entities(spark, sf), _HF))


def _corr_sql(features, src="day_ent"):
    parts = []
    for i, a in enumerate(features):
        for b in features[:i]:
            e = (f"covar_pop({a}, {b}) / nullif(stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
                 f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0)")
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {O.r(e)} AS corr FROM {src}")
    return " UNION ALL ".join(parts)


@register("corr_lower", _DAY + _corr_sql(O.DAY_MEAN_FEATURES))
def q_corr_lower(spark, sf):
    return round_doubles(P.corr_lower(V.v_day_entities(spark, sf), O.DAY_MEAN_FEATURES))


@register("crosstab", _ORD + "SELECT o_priority, count(*) FILTER (WHERE label = 0) AS n_0,"
          " count(*) FILTER (WHERE label = 1) AS n_1 FROM ord_ent GROUP BY o_priority")
def q_crosstab(spark, sf):
    return P.crosstab(V.v_ord_entities(spark, sf), "o_priority")


@register("col_variance", _DAYL + f"SELECT feature, {O.r('var_samp(value)')} AS variance FROM day_long"
          " GROUP BY feature")
def q_col_variance(spark, sf):
    return round_doubles(P.col_variance(V.v_day_entities(spark, sf), DAY_F))


@register("col_median", _DAYL + f"SELECT feature, {O.r('quantile_cont(value, 0.5)')} AS median FROM day_long"
          " WHERE value IS NOT NULL GROUP BY feature")
def q_col_median(spark, sf):
    return round_doubles(P.col_median(V.v_day_entities(spark, sf), DAY_F))


@register("class_ratio", _ORD + "SELECT count(*) FILTER (WHERE label = 0) AS n_neg, count(*) FILTER"
          " (WHERE label = 1) AS n_pos, " + O.r("coalesce(CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)"
                                                 " / nullif(count(*) FILTER (WHERE label = 1), 0), 0)")
          + " AS ratio FROM ord_ent")
def q_class_ratio(spark, sf):
    return round_doubles(P.class_ratio(V.v_ord_entities(spark, sf)))


def ord_train_entities(spark, sf):
    """V-ORD entity table with the split column (the same as ord_split's: it
    depends on key and label only).  The entities are written once in the shared
    checkpoint folder: the split and the profiles below make several passes over
    them and must not aggregate the raw tables anew for each."""
    return S.stratified_split(cut_lineage(V.v_ord_entities(spark, sf)), ["l_orderkey"], "label", 0.2)


_ORD_SPLIT_ENT = O.with_(O.V_ORD_RAW, O.ORD_ENT, O.ORD_LAB, O.ORD_SPLIT,
                         "ord_se AS (SELECT e.*, s.split FROM ord_ent e JOIN ord_split s USING (l_orderkey))",
                         "ord_tr AS (SELECT * FROM ord_se WHERE split = 'train')",
                         f"tr_long AS ({O.long_sql('ord_tr', [], ORD_F)})")


@register("cohort_stats", _ORD_SPLIT_ENT
          + "SELECT feature, round(avg(value), 4) AS mean, round(CASE WHEN stddev_samp(value) = 0 THEN 1.0"
          " ELSE stddev_samp(value) END, 4) AS std, "
          + ", ".join(f"round(quantile_cont(value, {p}), 4) AS {n}" for n, p in
                      (("q01", 0.01), ("q25", 0.25), ("q75", 0.75), ("q99", 0.99)))
          + " FROM tr_long GROUP BY feature")
def q_cohort_stats(spark, sf):
    tr = ord_train_entities(spark, sf).filter(F.col("split") == "train")
    return round_doubles(P.cohort_stats(tr, ORD_F))


@register("dataset_summary", _DAYL + "SELECT (SELECT count(*) FROM v_day_raw) AS n_rows, (SELECT count(*)"
          " FROM day_ent) AS n_entities, (SELECT " + O.r("avg(label)") + " FROM day_ent) AS pos_share, (SELECT "
          + O.r("avg(ns)") + f" FROM (SELECT {_NULL_SHARE} AS ns FROM day_long GROUP BY feature)) AS"
          f" mean_null_share, CAST({len(DAY_F)} AS BIGINT) AS n_features")
def q_dataset_summary(spark, sf):
    raw = V.v_day_raw(spark, sf)
    from strata.operators.aggregate import entity_table
    ent = entity_table(raw, DAY)
    return round_doubles(P.dataset_summary(raw, ent, list(DAY.entity), DAY_F))


# --- E1-E14, K3, K4 evaluation on V-SCORE -------------------------------------
from strata.operators import evaluate as EV  # noqa: E402

T_FOREST, T_BOOSTED = 0.3, 0.4
_VS = O.with_(O.V_ORD_RAW, O.V_SCORE)


def _dv(x):
    return f"CAST({x} AS DOUBLE)"


def _conf_sql(t, src="v_score", prob="p"):
    return (f"SELECT count(*) FILTER (WHERE label = 1 AND {prob} >= {t}) AS tp, count(*) FILTER (WHERE label = 1"
            f" AND {prob} < {t}) AS fn, count(*) FILTER (WHERE label = 0 AND {prob} >= {t}) AS fp, count(*) FILTER"
            f" (WHERE label = 0 AND {prob} < {t}) AS tn FROM {src}")


def _prf_sql(tp="tp", fn="fn", fp="fp"):
    return (f"{O.r(f'coalesce({_dv(tp)} / nullif({tp} + {fp}, 0), 0)')} AS precision, "
            f"{O.r(f'coalesce({_dv(tp)} / nullif({tp} + {fn}, 0), 0)')} AS recall, "
            f"{O.r(f'coalesce({_dv(f'2 * {tp}')} / nullif(2 * {tp} + {fp} + {fn}, 0), 0)')} AS f1")


_AUC_CTE = ("sc AS (SELECT p, sum(label) AS pos, count(*) - sum(label) AS neg FROM v_score GROUP BY p)",
            "cu AS (SELECT p, pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING"
            " AND 1 PRECEDING), 0) AS nb FROM sc)",
            "auc AS (SELECT sum(pos * (nb + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc FROM cu)")


def _grid_sql(grid):
    return "grid AS (SELECT unnest([" + ", ".join(f"{t!r}::DOUBLE" for t in grid) + "]) AS threshold)"


_GRID_CNT = ("gc AS (SELECT g.threshold, count(*) FILTER (WHERE s.label = 1 AND s.p >= g.threshold) AS tp,"
             " count(*) FILTER (WHERE s.label = 0 AND s.p >= g.threshold) AS fp, count(*) FILTER (WHERE s.label"
             " = 1) AS n_pos, count(*) FILTER (WHERE s.label = 0) AS n_neg FROM grid g CROSS JOIN v_score s"
             " GROUP BY g.threshold)")


@register("confusion", _VS + _conf_sql(T_FOREST))
def q_confusion(spark, sf):
    return EV.confusion(V.v_score(spark, sf), T_FOREST)


@register("prf", O.with_(O.V_ORD_RAW, O.V_SCORE, f"c AS ({_conf_sql(T_FOREST)})") + f"SELECT {_prf_sql()} FROM c")
def q_prf(spark, sf):
    return round_doubles(EV.prf(V.v_score(spark, sf), T_FOREST))


@register("roc_auc", O.with_(O.V_ORD_RAW, O.V_SCORE, *_AUC_CTE) + f"SELECT {O.r('roc_auc')} AS roc_auc FROM auc")
def q_roc_auc(spark, sf):
    return round_doubles(EV.roc_auc(V.v_score(spark, sf)))


@register("roc_points", O.with_(O.V_ORD_RAW, O.V_SCORE, _AUC_CTE[0])
          + "SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
          + "SELECT p AS threshold, " + O.r("sum(neg) OVER (ORDER BY p DESC) / (SELECT sum(neg) FROM sc)")
          + " AS fpr, " + O.r("sum(pos) OVER (ORDER BY p DESC) / (SELECT sum(pos) FROM sc)") + " AS tpr FROM sc")
def q_roc_points(spark, sf):
    return round_doubles(EV.roc_points(V.v_score(spark, sf)))


def _class_report_sql():
    def d(a, b):
        return f"coalesce({_dv(a)} / nullif({b}, 0), 0)"
    p1, r1, p0, r0 = d("tp", "tp + fp"), d("tp", "tp + fn"), d("tn", "tn + fn"), d("tn", "tn + fp")
    f1, f0 = d("2 * tp", "2 * tp + fp + fn"), d("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fn + fp + tn)"
    rows = [
        f"SELECT '0' AS row, {O.r(p0)} AS precision, {O.r(r0)} AS recall, {O.r(f0)} AS f1, tn + fp AS support FROM c",
        f"SELECT '1', {O.r(p1)}, {O.r(r1)}, {O.r(f1)}, tp + fn FROM c",
        f"SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {O.r(d('tp + tn', n))}, {n} FROM c",
        f"SELECT 'macro avg', {O.r(f'({p0} + {p1}) / 2')}, {O.r(f'({r0} + {r1}) / 2')}, {O.r(f'({f0} + {f1}) / 2')},"
        f" {n} FROM c",
        f"SELECT 'weighted avg', {O.r(d(f'{p0} * (tn + fp) + {p1} * (tp + fn)', n))},"
        f" {O.r(d(f'{r0} * (tn + fp) + {r1} * (tp + fn)', n))}, {O.r(d(f'{f0} * (tn + fp) + {f1} * (tp + fn)', n))},"
        f" {n} FROM c"]
    return " UNION ALL ".join(rows)


@register("class_report", O.with_(O.V_ORD_RAW, O.V_SCORE, f"c AS ({_conf_sql(T_FOREST)})") + _class_report_sql())
def q_class_report(spark, sf):
    return round_doubles(EV.class_report(V.v_score(spark, sf), T_FOREST))


_CHOOSE = O.with_(O.V_ORD_RAW, O.V_SCORE, _grid_sql(EV.CALIBRATION_GRID), _GRID_CNT,
                  "ct AS (SELECT threshold, " + _prf_sql("tp", "(n_pos - tp)", "fp") + " FROM gc)")


@register("choose_threshold", _CHOOSE + "SELECT threshold, precision, recall, f1 FROM ct")
def q_choose_threshold(spark, sf):
    return round_doubles(EV.choose_threshold(V.v_score(spark, sf)))


@register("best_threshold", _CHOOSE + "SELECT threshold, precision, recall, f1 FROM ct ORDER BY f1 DESC,"
          " threshold LIMIT 1")
def q_best_threshold(spark, sf):
    return round_doubles(EV.best_threshold(EV.choose_threshold(V.v_score(spark, sf))))


_SWEEP = O.with_(O.V_ORD_RAW, O.V_SCORE, _grid_sql(EV.sweep_grid()), _GRID_CNT)


@register("threshold_sweep", _SWEEP + "SELECT threshold, tp, fp, n_pos, n_neg FROM gc")
def q_threshold_sweep(spark, sf):
    return EV.threshold_sweep(V.v_score(spark, sf))


@register("sweep_delta", _SWEEP + "SELECT g.threshold, g.tp, g.fp, g.n_pos - g.tp AS fn, g.n_neg - g.fp AS tn,"
          " (g.n_pos - b.tp) - (g.n_pos - g.tp) AS d_caught, g.fp - b.fp AS d_false_alarms, "
          + O.r("CAST(g.tp AS DOUBLE) / nullif(g.n_pos, 0)") + " AS recall, "
          + O.r("CAST(g.tp AS DOUBLE) / nullif(g.tp + g.fp, 0)") + " AS precision"
          f" FROM gc g, (SELECT tp, fp FROM gc WHERE threshold = {T_FOREST}) b")
def q_sweep_delta(spark, sf):
    return round_doubles(EV.sweep_delta(EV.threshold_sweep(V.v_score(spark, sf)), T_FOREST))


@register("metric_bundle", O.with_(O.V_ORD_RAW, O.V_SCORE, *_AUC_CTE, f"c AS ({_conf_sql(T_FOREST)})")
          + f"SELECT {T_FOREST}::DOUBLE AS threshold, {_prf_sql()}, {O.r('roc_auc')} AS roc_auc, "
          + O.r("CAST(tp + tn AS DOUBLE) / greatest(1, tp + tn + fp + fn)") + " AS accuracy, tp, fn, fp, tn"
          " FROM c, auc")
def q_metric_bundle(spark, sf):
    return round_doubles(EV.metric_bundle(V.v_score(spark, sf), T_FOREST))


_CMP = O.with_(
    O.V_ORD_RAW, O.V_SCORE, O.V_SCORES_LONG,
    f"st AS (SELECT *, CASE WHEN model = 'forest' THEN {T_FOREST} ELSE {T_BOOSTED} END AS t FROM v_scores_long)",
    "mc AS (SELECT model, count(*) FILTER (WHERE label = 1 AND p >= t) AS tp, count(*) FILTER (WHERE label = 1"
    " AND p < t) AS fn, count(*) FILTER (WHERE label = 0 AND p >= t) AS fp FROM st GROUP BY model)",
    "msc AS (SELECT model, p, sum(label) AS pos, count(*) - sum(label) AS neg FROM v_scores_long GROUP BY 1, 2)",
    "mcu AS (SELECT model, pos, neg, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN"
    " UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM msc)",
    "mauc AS (SELECT model, sum(pos * (nb + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc"
    " FROM mcu GROUP BY model)",
    "mraw AS (SELECT mc.model, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,"
    " coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall, coalesce(CAST(2 * tp AS DOUBLE) /"
    " nullif(2 * tp + fp + fn, 0), 0) AS f1, roc_auc FROM mc JOIN mauc USING (model))")


@register("model_comparison", _CMP + "SELECT model, round(f1, 4) AS f1, round(roc_auc, 4) AS roc_auc,"
          " round(precision, 4) AS precision, round(recall, 4) AS recall FROM mraw")
def q_model_comparison(spark, sf):
    return EV.model_comparison(V.v_scores_long(spark, sf), {"forest": T_FOREST, "boosted": T_BOOSTED})


@register("winner", _CMP + f"SELECT model, {O.r('f1')} AS f1 FROM mraw ORDER BY f1 DESC, CASE WHEN model ="
          " 'boosted' THEN 0 ELSE 1 END LIMIT 1")
def q_winner(spark, sf):
    cmp_ = EV.model_comparison(V.v_scores_long(spark, sf), {"forest": T_FOREST, "boosted": T_BOOSTED},
                               places=None)
    return round_doubles(EV.winner(cmp_, {"boosted": 0, "forest": 1}).select("model", "f1"))


@register("caught", _VS + f"SELECT count(*) FILTER (WHERE label = 1 AND p >= {T_FOREST}) AS caught, count(*)"
          " FILTER (WHERE label = 1) AS n_pos, " + O.r(f"coalesce(CAST(count(*) FILTER (WHERE label = 1 AND p >="
                                                        f" {T_FOREST}) AS DOUBLE) / nullif(count(*) FILTER (WHERE"
                                                        " label = 1), 0), 0)") + " AS caught_share FROM v_score")
def q_caught(spark, sf):
    return round_doubles(EV.caught(V.v_score(spark, sf), T_FOREST))


# p2 is kept for even keys only, so the rows that one side lacks are counted
@register("score_parity", _VS.rstrip() + ",\npb AS (SELECT l_orderkey, p2 FROM v_score WHERE l_orderkey % 2 = 0)\n"
          "SELECT count(b.l_orderkey) AS n, " + O.r("max(abs(p - b.p2))") + " AS max_abs_delta,"
          f" count(*) FILTER (WHERE (p >= {T_FOREST}) <> (b.p2 >= {T_FOREST})) AS n_flips,"
          " count(*) - count(b.l_orderkey) AS n_unmatched FROM v_score v LEFT JOIN pb b ON v.l_orderkey = b.l_orderkey")
def q_score_parity(spark, sf):
    s = V.v_score(spark, sf)
    return round_doubles(EV.score_parity(
        s.select("l_orderkey", "p"), s.where("l_orderkey % 2 = 0").select("l_orderkey", F.col("p2").alias("p")),
        "l_orderkey", T_FOREST))


@register("outcome_class", _VS + f"SELECT l_orderkey, label, {O.r('p')} AS p, p2 AS p2, p >= {T_FOREST} AS alarm,"
          f" CASE WHEN p >= {T_FOREST} AND label = 1 THEN 'correct alarm' WHEN p < {T_FOREST} AND label = 0 THEN"
          f" 'correct silence' WHEN p >= {T_FOREST} AND label = 0 THEN 'false alarm' ELSE 'miss' END AS outcome"
          " FROM v_score")
def q_outcome_class(spark, sf):
    return round_doubles(EV.outcome_class(V.v_score(spark, sf), T_FOREST))


# --- P2-P13 projections ---------------------------------------------------------
from strata.functions.columns import decode, long_form  # noqa: E402

_ORD_INT = {"l_orderkey", "o_priority", "l_linenumber_max", "label"}
_ORD_COLS = ["l_orderkey", *ORD_F, "label"]


def _sel_sql(cols, src="ord_ent"):
    return "SELECT " + ", ".join(c if c in _ORD_INT else f"{O.r(c)} AS {c}" for c in cols) + f" FROM {src}"


_DROP = ["o_priority", "l_tax_std", "no_such_column"]
_PICK = ["l_orderkey", "l_quantity_max", "l_discount_mean", "l_extendedprice_range", "label"]


@register("drop_cols", _ORD + _sel_sql([c for c in _ORD_COLS if c not in _DROP]))
def q_drop_cols(spark, sf):
    return round_doubles(V.v_ord_entities(spark, sf).drop(*_DROP))


@register("select_features", _ORD + _sel_sql(_PICK))
def q_select_features(spark, sf):
    return round_doubles(V.v_ord_entities(spark, sf).select(*_PICK))


@register("filter_label", _ORD + _sel_sql(["l_orderkey", "l_quantity_mean", "label"]) + " WHERE label = 1")
def q_filter_label(spark, sf):
    e = V.v_ord_entities(spark, sf)
    return round_doubles(e.filter(F.col("label") == 1).select("l_orderkey", "l_quantity_mean", "label"))


@register("decode_label", _ORD + "SELECT l_orderkey, label, CASE WHEN label = 1 THEN 'positive' WHEN label = 0"
          " THEN 'negative' END AS class_name FROM ord_ent")
def q_decode_label(spark, sf):
    e = V.v_ord_entities(spark, sf)
    return e.select("l_orderkey", "label", decode("label", {1: "positive", 0: "negative"}).alias("class_name"))


@register("head_n", _ORD + _sel_sql(["l_orderkey", "o_totalprice", "l_quantity_mean", "label"])
          + " ORDER BY l_orderkey LIMIT 5")
def q_head_n(spark, sf):
    e = V.v_ord_entities(spark, sf)
    return round_doubles(e.select("l_orderkey", "o_totalprice", "l_quantity_mean", "label")
                         .orderBy("l_orderkey").limit(5))


_WORDS_SQL = "CASE a0 " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in
    __import__("strata.operators.report", fromlist=["AGG_WORDS"]).AGG_WORDS.items()) + " ELSE a0 END"


@register("feature_dictionary", _ORDL.rstrip() + ",\n" + ",\n".join([
    "fl AS (SELECT feature, count(value) AS n_obs FROM ord_long GROUP BY feature)",
    "sig AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in O.ORD_SIGNALS)
    + ") t(signal, display, unit, system))",
    "fs AS (SELECT feature, n_obs, CASE WHEN regexp_extract(feature, '^(.*)_([^_]+)$', 1) = '' THEN feature ELSE"
    " regexp_extract(feature, '^(.*)_([^_]+)$', 1) END AS signal, CASE WHEN regexp_extract(feature,"
    " '^(.*)_([^_]+)$', 1) = '' THEN NULL ELSE regexp_extract(feature, '^(.*)_([^_]+)$', 2) END AS a0 FROM fl)"])
    + "\nSELECT fs.feature, fs.n_obs, fs.signal, CASE WHEN fs.signal = 'l_linenumber' THEN 'total' ELSE "
    + _WORDS_SQL + " END AS agg, coalesce(sig.display, replace(fs.signal, '_', ' ')) AS display,"
    " coalesce(sig.unit, '') AS unit, coalesce(sig.system, 'stay') AS system FROM fs LEFT JOIN sig USING (signal)")
def q_feature_dictionary(spark, sf):
    from strata.operators.report import feature_dictionary
    e = V.v_ord_entities(spark, sf)
    feats = long_form(e, [], ORD_F).groupBy("feature").agg(F.count("value").alias("n_obs"))
    sig = spark.createDataFrame(O.ORD_SIGNALS, "signal string, display string, unit string, system string")
    return feature_dictionary(feats, sig, length_signal=ORD.seq)


# --- F1-F4, F9, F11 preparation ---------------------------------------------------
from strata.operators import prep as PR  # noqa: E402

_DAYP = O.with_(O.V_DAY_RAW, O.DAY_ENT, O.DAY_SPLIT, *O.DAY_PREP)
_DKEYS = ["user_id", "day"]


def day_split(spark, sf):
    return S.stratified_split(cut_lineage(V.v_day_entities(spark, sf)), _DKEYS, "label", 0.2)


@register("drop_zero_variance", _DAYP + "SELECT feature FROM zv")
def q_drop_zero_variance(spark, sf):
    tr = day_split(spark, sf).filter(F.col("split") == "train")
    return PR.zero_variance_features(tr, DAY_F)


def _imputed(spark, sf):
    sp = day_split(spark, sf)
    tr = sp.filter(F.col("split") == "train")
    tr1, all1, zero = PR.drop_zero_variance(tr, sp, DAY_F)
    f1 = [f for f in DAY_F if f not in zero]
    tr2, all2, high, fill = PR.drop_high_null_and_impute(tr1, all1, f1)
    return all2, [f for f in f1 if f not in high]


@register("impute_median", _DAYP + "SELECT user_id, day, feature, " + O.r("value") + " AS value FROM imp")
def q_impute_median(spark, sf):
    all2, f2 = _imputed(spark, sf)
    return round_doubles(long_form(all2, _DKEYS, f2))


@register("variance_filter", _DAYP + "SELECT feature FROM kept")
def q_variance_filter(spark, sf):
    all2, f2 = _imputed(spark, sf)
    tr = all2.filter(F.col("split") == "train")
    _, _, keep = PR.variance_filter(tr, tr, f2)
    return spark.createDataFrame([(f,) for f in keep], "feature string")


@register("standardize", _DAYP + "SELECT user_id, day, feature, " + O.r("value") + " AS value FROM zs")
def q_standardize(spark, sf):
    sp = day_split(spark, sf)
    prep = PR.fit_prep(sp.filter(F.col("split") == "train"), DAY_F)
    return round_doubles(long_form(prep.transform(sp.drop("split")), _DKEYS, prep.output_features))


@register("apply_prep", _DAYP + "SELECT user_id, day, feature, " + O.r("value") + " AS value FROM zs"
          " WHERE split = 'test'")
def q_apply_prep(spark, sf):
    sp = day_split(spark, sf)
    prep = PR.fit_prep(sp.filter(F.col("split") == "train"), DAY_F)
    prep = PR.FittedPrep.from_json(prep.to_json())  # a stored preparation, re-applied
    test = sp.filter(F.col("split") == "test").drop("split")
    return round_doubles(long_form(prep.transform(test), _DKEYS, prep.output_features))


@register("class_weights", O.with_(O.V_ORD_RAW, O.ORD_LAB, O.ORD_SPLIT)
          + "SELECT label, count(*) AS n_c, " + O.r("sum(count(*)) OVER () / (2.0 * count(*))") + " AS weight"
          " FROM ord_split WHERE split = 'train' GROUP BY label")
def q_class_weights(spark, sf):
    tr = ord_split(spark, sf).filter(F.col("split") == "train")
    return round_doubles(PR.class_weights(tr))


# --- R2, R3 cohort bands and rail positions ------------------------------------------
from strata.operators import report as RP  # noqa: E402

_STATS_CTE = ("cst AS (SELECT feature, round(avg(value), 4) AS mean, round(CASE WHEN stddev_samp(value) = 0"
              " THEN 1.0 ELSE stddev_samp(value) END, 4) AS std, "
              + ", ".join(f"round(quantile_cont(value, {p}), 4) AS {n}" for n, p in
                          (("q01", 0.01), ("q25", 0.25), ("q75", 0.75), ("q99", 0.99)))
              + " FROM tr_long GROUP BY feature)")
_TEST_LONG = ("ord_te AS (SELECT * FROM ord_se WHERE split = 'test')",
              f"te_long AS ({O.long_sql('ord_te', ['l_orderkey'], ORD_F)})")
_BAND = _ORD_SPLIT_ENT.rstrip() + ",\n" + ",\n".join([_STATS_CTE, *_TEST_LONG]) + "\n"


def _ord_test_and_stats(spark, sf):
    se = ord_train_entities(spark, sf)
    stats = P.cohort_stats(se.filter(F.col("split") == "train"), ORD_F)
    return se.filter(F.col("split") == "test"), stats


@register("cohort_band", _BAND + "SELECT t.l_orderkey, t.feature, " + O.r("t.value") + " AS value, CASE WHEN"
          " t.value IS NULL OR s.q25 IS NULL OR s.q75 IS NULL THEN '' WHEN t.value > s.q75 THEN 'hi' WHEN t.value"
          " < s.q25 THEN 'lo' ELSE '' END AS band FROM te_long t LEFT JOIN cst s USING (feature)")
def q_cohort_band(spark, sf):
    te, stats = _ord_test_and_stats(spark, sf)
    return round_doubles(RP.cohort_band(te, ["l_orderkey"], ORD_F, stats))


_POS = _BAND.rstrip() + ",\n" + ",\n".join([
    "g AS (SELECT t.l_orderkey, t.feature, t.value, s.q25, s.q75, CASE WHEN s.q01 IS NOT NULL AND s.q99 IS NOT"
    " NULL AND s.q99 > s.q01 THEN s.q01 ELSE coalesce(s.mean, 0) - 2 * coalesce(nullif(s.std, 0), 1) END AS"
    " lo0, CASE WHEN s.q01 IS NOT NULL AND s.q99 IS NOT NULL AND s.q99 > s.q01 THEN s.q99 ELSE"
    " coalesce(s.mean, 0) + 2 * coalesce(nullif(s.std, 0), 1) END AS hi0 FROM te_long t LEFT JOIN cst s"
    " USING (feature))",
    "g2 AS (SELECT *, CASE WHEN value IS NOT NULL AND value < lo0 THEN value - (hi0 - lo0) * 0.08 ELSE lo0 END"
    " AS lo FROM g)",
    "g3 AS (SELECT *, CASE WHEN value IS NOT NULL AND value > hi0 THEN value + (hi0 - lo) * 0.08 ELSE hi0 END"
    " AS hi FROM g2)",
    "g4 AS (SELECT *, coalesce(nullif(hi - lo, 0), 1) AS span FROM g3)"]) + "\n"


def _at_sql(x):
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE " + O.r(f"least(greatest(({x} - lo) / span, 0), 1) * 100") + " END"


@register("cohort_position", _POS + "SELECT l_orderkey, feature, " + O.r("value") + " AS value, "
          + _at_sql("value") + " AS pos, " + _at_sql("q25") + " AS band_lo, " + _at_sql("q75")
          + " AS band_hi FROM g4")
def q_cohort_position(spark, sf):
    te, stats = _ord_test_and_stats(spark, sf)
    return round_doubles(RP.cohort_position(te, ["l_orderkey"], ORD_F, stats))


# --- J5, F5-F8, M1-M13, S3-S8, K1, K2, R1, R4: models and artefacts -----------------
from strata.operators import balance as BA  # noqa: E402
from strata.operators import model as M  # noqa: E402
from strata.plans import train_job as TJ  # noqa: E402

_KNN_F = [f for f in O.ORD_FEATURES if not f.endswith("_std")]     # a single-row entity has no std
_KNN_TIES = {"a": "CAST(l_quantity_max AS INTEGER) % 3", "b": "CAST(l_quantity_min AS INTEGER) % 2"}
_KNN_OFFSET = {"a": "l_quantity_mean + 1e8", "b": "l_discount_mean", "c": "l_tax_mean"}


def _knn_sql(columns: dict[str, str], keep: str = "label = 1") -> str:
    return _ORD_SPLIT_ENT.rstrip() + ",\n" + ",\n".join([
        "mino AS (SELECT l_orderkey, " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in columns.items())
        + f" FROM ord_tr WHERE {keep})",
        "pairs AS (SELECT a.l_orderkey, b.l_orderkey AS nn_key, " + " + ".join(
            f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in columns) + " AS d2 FROM mino a JOIN mino b"
        " ON a.l_orderkey <> b.l_orderkey)",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY d2, nn_key) AS nn_rank FROM pairs)"]) \
        + "\nSELECT l_orderkey, nn_rank, nn_key, " + O.r("sqrt(d2)") + " AS dist FROM rk WHERE nn_rank <= 5"


def _knn(spark, sf, columns: dict[str, str]):
    tr = ord_train_entities(spark, sf).filter(F.col("split") == "train")
    mino = tr.filter(F.col("label") == 1).select("l_orderkey", *[
        F.expr(e).cast("double").alias(c) for c, e in columns.items()])
    return round_doubles(BA.minority_knn(mino, "l_orderkey", list(columns), k=5).select(
        "l_orderkey", F.col("nn_rank").cast("long").alias("nn_rank"), "nn_key", "dist"))


@register("minority_knn", _knn_sql({f: f for f in _KNN_F}))
def q_minority_knn(spark, sf):
    """All numeric entity columns that every entity has."""
    return _knn(spark, sf, {f: f for f in _KNN_F})


@register("minority_knn_ties", _knn_sql(_KNN_TIES))
def q_minority_knn_ties(spark, sf):
    """Small integers: almost every distance is a tie."""
    return _knn(spark, sf, _KNN_TIES)


@register("minority_knn_offset", _knn_sql(_KNN_OFFSET))
def q_minority_knn_offset(spark, sf):
    """A column near 1e8 beside small ones."""
    return _knn(spark, sf, _KNN_OFFSET)


def _md5_u(salt: int) -> str:
    return f"(CAST('0x' || substr(md5('42:{salt}:' || j), 1, 13) AS BIGINT) / 4503599627370496.0)"


@register("smote_rows", _ORD_SPLIT_ENT.rstrip() + ",\n" + ",\n".join([
    "mino AS (SELECT l_orderkey, " + ", ".join(_KNN_F) + ", row_number() OVER (ORDER BY l_orderkey) - 1 AS i"
    " FROM ord_tr WHERE label = 1)",
    "pairs AS (SELECT a.i, b.l_orderkey AS nn_key, " + " + ".join(
        f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in _KNN_F) + " AS d2 FROM mino a JOIN mino b"
    " ON a.l_orderkey <> b.l_orderkey)",
    "rk AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d2, nn_key) - 1 AS r FROM pairs)",
    "need AS (SELECT count(*) FILTER (WHERE label = 1) AS n_min, count(*) FILTER (WHERE label = 0) AS n_maj"
    " FROM ord_tr)",
    "dr AS (SELECT j, n_min FROM need, range(1000000) t(j) WHERE j < n_maj - n_min)",
    f"draws AS (SELECT CAST(floor({_md5_u(1)} * n_min) AS BIGINT) AS i, CAST(floor({_md5_u(2)} * 5) AS BIGINT) AS r,"
    f" {_md5_u(3)} AS u FROM dr)",
    "syn AS (SELECT " + ", ".join(f"m.{f} + d.u * (n.{f} - m.{f}) AS {f}" for f in _KNN_F) + " FROM draws d JOIN mino m"
    " ON d.i = m.i JOIN rk ON rk.i = d.i AND rk.r = d.r JOIN mino n ON n.l_orderkey = rk.nn_key)"])
    + "\nSELECT l_orderkey, " + ", ".join(O.r(f) + f" AS {f}" for f in _KNN_F) + ", label, false AS synthetic FROM ord_tr"
    + " UNION ALL SELECT NULL, " + ", ".join(O.r(f) for f in _KNN_F) + ", 1, true FROM syn")
def q_smote_rows(spark, sf):
    """F8 + U1 on the training entities, row by row."""
    tr = ord_train_entities(spark, sf).filter(F.col("split") == "train")
    return round_doubles(BA.smote(tr, "l_orderkey", _KNN_F, "label", k=5))


@register("corr_wide", _ORD + _corr_sql(_KNN_F, "ord_ent"))
def q_corr_wide(spark, sf):
    """A13 over every numeric entity column."""
    return round_doubles(P.corr_lower(V.v_ord_entities(spark, sf), _KNN_F))


@register("smote")
def q_smote(spark, sf):
    data, prep = TJ.prepared(spark, sf)
    tr = data.filter(F.col("split") == "train")
    return BA.smote(tr, TJ.KEY, prep.kept, "label", k=5)


@register("rfe_select")
def q_rfe_select(spark, sf):
    return TJ.rfe_select(spark, sf, k=8, step=0.5)


@register("rfe_sweep")
def q_rfe_sweep(spark, sf):
    return TJ.rfe_sweep(spark, sf)


def _bundle_row(scored, t):
    return round_doubles(EV.metric_bundle(scored, t))


@register("rf_baseline")
def q_rf_baseline(spark, sf):
    _, _, scored, _ = TJ.baseline(spark, sf, "forest")
    return _bundle_row(scored, 0.5)


@register("gbt_baseline")
def q_gbt_baseline(spark, sf):
    _, _, scored, _ = TJ.baseline(spark, sf, "boosted")
    return _bundle_row(scored, 0.5)


@register("score_positive")
def q_score_positive(spark, sf):
    _, _, scored, _ = TJ.baseline(spark, sf, "forest")
    return scored


def _importances(spark, sf):
    model, _, _, feats = TJ.baseline(spark, sf, "forest")
    return RP.importance_table(feats, model.featureImportances.toArray(), spark)


@register("importance_topk")
def q_importance_topk(spark, sf):
    return RP.importance_topk(_importances(spark, sf), 10)


@register("importance_rank")
def q_importance_rank(spark, sf):
    return RP.importance_rank(_importances(spark, sf))


@register("observation_sheet")
def q_observation_sheet(spark, sf):
    data, prep = TJ.prepared(spark, sf)
    model, _, _, feats = TJ.baseline(spark, sf, "forest", (data, prep))
    imp = RP.importance_table(feats, model.featureImportances.toArray(), spark)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    band = RP.cohort_band(test, [TJ.KEY], feats, P.cohort_stats(train, feats))
    return round_doubles(RP.observation_sheet(band, imp, [TJ.KEY]))


_SIGNAL = (f"trl AS ({O.long_sql('ord_tr', ['label'], ORD_F)}),\nsig AS (SELECT feature, round(coalesce(CASE WHEN min(value) <"
           " max(value) THEN (avg(value) FILTER (WHERE label = 1) - avg(value) FILTER (WHERE label = 0)) / stddev_samp(value)"
           " END, 0), 6) AS weight FROM trl GROUP BY feature)\n")
_SIGNALS = _ORD_SPLIT_ENT.rstrip() + ",\n" + _SIGNAL


def _signals(spark, sf):
    return P.class_separation(ord_train_entities(spark, sf).filter(F.col("split") == "train"), ORD_F)


@register("signal_topk", _SIGNALS + "SELECT feature, weight FROM sig ORDER BY weight DESC, feature LIMIT 10")
def q_signal_topk(spark, sf):
    """K1 over weights that need no model."""
    return RP.importance_topk(_signals(spark, sf), 10)


@register("signal_rank", _SIGNALS + "SELECT feature, round(weight, 4) AS weight FROM sig ORDER BY abs(weight) DESC, feature")
def q_signal_rank(spark, sf):
    """K2 over weights that need no model."""
    return RP.importance_rank(_signals(spark, sf))


@register("signal_sheet", _BAND.rstrip() + ",\n" + _SIGNAL.rstrip() + ",\nw AS (SELECT feature, row_number() OVER (ORDER BY"
          " abs(weight) DESC, feature) AS rank, CASE WHEN max(abs(weight)) OVER () > 0 THEN abs(weight) / max(abs(weight)) OVER ()"
          " ELSE 0 END AS rel FROM sig)\nSELECT t.l_orderkey, CAST(w.rank AS INTEGER) AS rank, t.feature, " + O.r("t.value")
          + " AS value, CASE WHEN t.value IS NULL OR s.q25 IS NULL OR s.q75 IS NULL THEN '' WHEN t.value > s.q75 THEN 'hi' WHEN"
          " t.value < s.q25 THEN 'lo' ELSE '' END AS band, " + O.r("w.rel") + " AS rel_weight, w.rank <= 3 AS driver"
          " FROM te_long t LEFT JOIN cst s USING (feature) JOIN w USING (feature)")
def q_signal_sheet(spark, sf):
    """R4 over weights that need no model: the test entities' features by weight, with bands and drivers."""
    te, stats = _ord_test_and_stats(spark, sf)
    weights = _signals(spark, sf).select("feature", F.abs("weight").alias("weight"))
    band = RP.cohort_band(te, ["l_orderkey"], ORD_F, stats)
    return round_doubles(RP.observation_sheet(band, weights, ["l_orderkey"]))


_FOLDS = _ORD_SPLIT_ENT.rstrip() + ",\n" + O.folds_sql("fo", "ord_tr", ["l_orderkey"], "label", 5, 44)


def _ord_folds(spark, sf):
    tr = ord_train_entities(spark, sf).filter(F.col("split") == "train").drop("split")
    return cut_lineage(S.stratified_folds(tr, ["l_orderkey"], "label", 5, seed=44))


@register("fold_scalers", _FOLDS + ",\nfl AS (" + O.long_sql("fo", ["fold"], _KNN_F) + ")\nSELECT CAST(f AS INTEGER) AS fold, feature, "
          + O.r("avg(value)") + " AS mean, " + O.r("CASE WHEN min(value) = max(value) THEN 1.0 ELSE stddev_pop(value) END")
          + " AS scale FROM fl, range(5) t(f) WHERE fold <> f GROUP BY f, feature")
def q_fold_scalers(spark, sf):
    """F4 inside M3: the scalers of all training sides from one job."""
    sides = M.fold_scalers(_ord_folds(spark, sf), _KNN_F, 5)
    rows = [(fold, c, float(m), float(s)) for fold, side in enumerate(sides) for c, (m, s) in side.items()]
    return round_doubles(spark.createDataFrame(rows, "fold int, feature string, mean double, scale double"))


_CUT_EDGES = {"l_quantity_max": [5.0, 10.0, 20.0, 30.0, 38.0, 40.0, 45.0, 49.0],
              "l_discount_max": [0.01, 0.03, 0.05, 0.07, 0.08, 0.09], "l_linenumber_max": [1.0, 2.0, 3.0, 5.0]}
_ROOT_CUT = ("l_quantity_max", 5)


def _bin_sql(col: str) -> str:
    return " + ".join(f"CAST({col} > {e} AS INTEGER)" for e in _CUT_EDGES[col])


@register("boosted_histograms", _FOLDS + ",\nsides AS (SELECT CAST(f AS INTEGER) AS side, * FROM fo, range(5) t(f) WHERE fold <> f),\n"
          + "hb AS (" + " UNION ALL ".join(
              f"SELECT side, label, CASE WHEN {_ROOT_CUT[0]} <= {_CUT_EDGES[_ROOT_CUT[0]][_ROOT_CUT[1]]} THEN 1 ELSE 2 END"
              f" AS node, '{c}' AS feature, {_bin_sql(c)} AS bin FROM sides" for c in _CUT_EDGES)
          + ")\nSELECT side AS fold, node, feature, CAST(bin AS INTEGER) AS bin, sum(0.5 - label)::DOUBLE AS gradient,"
            " sum(0.25)::DOUBLE AS hessian, count(*) AS n FROM hb GROUP BY ALL")
def q_boosted_histograms(spark, sf):
    """M2: one aggregate with the gradient histograms of the open nodes of all folds' first trees, below a root
    that is cut at a fixed place."""
    import numpy as np

    from strata.operators import ensembles as EN
    from strata.operators.trees import BINS, FIX, Fit
    names = list(_CUT_EDGES)
    x = F.array(*[F.col(c).cast("double") for c in names])
    rows = EN.keyed_rows(M.training_sides(_ord_folds(spark, sf), 5), x, "label", F.col("l_orderkey"), F.col("side"))
    edges = {f: [np.array(e) for e in _CUT_EDGES.values()] for f in range(5)}
    order = {f: [f] for f in range(5)}
    state = EN.with_margins(EN.write_blocks(rows, edges), order)
    tops = {(f, 0): EN._Top(np.uint64(0)) for f in range(5)}
    for top in tops.values():
        top.split(0, names.index(_ROOT_CUT[0]), _ROOT_CUT[1], 0.0, (0, 0, 0), (0, 0, 0))
    sums = EN.boosted_histograms(state, {f: Fit(f, "boosted", 1) for f in range(5)}, tops, {ft: {1: 0, 2: 0} for ft in tops},
                                 {f: [] for f in range(5)}, 0, order)
    feature = F.element_at(F.array(*[F.lit(c) for c in names]), (F.col("cell") / BINS).cast("int") + 1)
    return sums.select(F.col("fit").alias("fold"), "node", feature.alias("feature"), (F.col("cell") % BINS).alias("bin"),
                       (F.col("a") / FIX).alias("gradient"), (F.col("b") / FIX).alias("hessian"), "n")


@register("rfe_final")
def q_rfe_final(spark, sf):
    return TJ.rfe_final(spark, sf)


def _wide(spark, sf):
    data, prep = TJ.prepared(spark, sf, True)
    return TJ.with_validation(data), prep


@register("leakfree_cv")
def q_leakfree_cv(spark, sf):
    data, prep = _wide(spark, sf)
    return round_doubles(TJ.leakfree_cv(spark, data, prep.kept))


@register("grid_search")
def q_grid_search(spark, sf):
    data, prep = _wide(spark, sf)
    cvm, grid, _ = TJ.tune(spark, data, prep.kept, "forest", grid_values=TJ.FOREST_GRID)
    return spark.createDataFrame(M.search_results(cvm, grid), "params string, cv_f1 double")


@register("random_search")
def q_random_search(spark, sf):
    data, prep = _wide(spark, sf)
    cvm, grid, _ = TJ.tune(spark, data, prep.kept, "boosted", space=TJ.BOOSTED_SPACE)
    return spark.createDataFrame(M.search_results(cvm, grid), "params string, cv_f1 double")


@register("deployable_fit")
def q_deployable_fit(spark, sf):
    data, prep = TJ.prepared(spark, sf, True)
    sel = [r["feature"] for r in TJ.rfe_select(spark, sf, k=50, wide=True, ready=(data, prep)).collect()]
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    scaler, model = M.deployable_fit(train, TJ.KEY, sel, M.random_forest())
    return M.p_positive(model.transform(scaler.transform(test))).select(TJ.KEY, "label", "p")


@register("finalize")
def q_finalize(spark, sf):
    data, prep = _wide(spark, sf)
    cvm, grid, clf = TJ.tune(spark, data, prep.kept, "forest", grid_values=TJ.FOREST_GRID)
    res = TJ.finalize(spark, data, prep.kept, cvm, grid, clf)
    return round_doubles(EV.metric_bundle(res["scored"], res["threshold"]))


@register("train_job")
def q_train_job(spark, sf):
    """The whole job on the long V-WIDE rows, with the published search."""
    return TJ.train_job(spark, V.v_wide_raw(spark, sf), V.WIDE_SPEC)


@register("score_table")
def q_score_table(spark, sf):
    return TJ.score_with_bundle(spark, sf)["reloaded_scored"]


@register("model_roundtrip", _ORD_SPLIT_ENT.rstrip() + ",\nper AS (SELECT least(count(*), 40) AS c FROM ord_se WHERE split = 'test'"
          " GROUP BY label)\nSELECT CAST(2000 + sum(c) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS max_abs_delta, CAST(0 AS BIGINT) AS n_flips,"
          " CAST(0 AS BIGINT) AS n_unmatched FROM per")
def q_model_roundtrip(spark, sf):
    """E12 export gate: 80 stratified test rows stacked (U2) with 2,000
    Gaussian rows drawn around the training means (X6), scored by the bundle
    before and after a save/load round trip."""
    r = TJ.score_with_bundle(spark, sf)
    loaded, test, data, original = r["loaded"], r["test"], r["data"], r["bundle"]
    feats = loaded.features
    train = data.filter(F.col("split") == "train")
    stats = long_form(train, [], feats).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    syn = S.gaussian_rows(spark, stats, 2000).select((-F.col("row_id") - 1).alias(TJ.KEY), *feats)
    smp = S.class_capped_sample(test, [TJ.KEY], "label", 80).select(TJ.KEY, *feats)
    stacked = smp.unionByName(syn)
    from strata.operators.scoring import score_table
    a, b = score_table(stacked, original, [TJ.KEY]), score_table(stacked, loaded, [TJ.KEY])
    return EV.score_parity(a, b, TJ.KEY, loaded.threshold)


@register("score_log")
def q_score_log(spark, sf):
    from strata.operators.scoring import log_scores, read_log
    r = TJ.score_with_bundle(spark, sf)
    scored2, bundle = r["reloaded_scored"], r["loaded"]
    path = TJ.work_dir(spark, "audit")
    for _ in range(2):      # the second is a replay
        log_scores(scored2, path, bundle.threshold, bundle.model_type, run_id="daily-1")
    return read_log(spark, path)


@register("score_stream")
def q_score_stream(spark, sf):
    from strata.streaming.scoring import score_stream
    r = TJ.score_with_bundle(spark, sf)
    bundle, test = r["loaded"], r["test"]
    src, sink, ck = (TJ.work_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    rows = test.select(TJ.KEY, "label", *bundle.features)
    rows.repartition(4).write.mode("overwrite").parquet(src)
    q = score_stream(spark, src, rows.schema, bundle, [TJ.KEY, "label"], sink, ck)
    q.awaitTermination()
    return spark.read.parquet(sink).drop("epoch")


_REQ = O.DAY_MEAN_FEATURES + ["hr_max"]


@register("score_rejects", O.with_(O.V_DAY_RAW, O.DAY_ENT)
          + "SELECT user_id, day, n_missing, array_to_string(list_slice(string_split(names, ','), 1, 5), ',')"
          " AS missing_first FROM (SELECT user_id, day, CAST(" + " + ".join(
              f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _REQ) + " AS INTEGER) AS n_missing, concat_ws(',', "
          + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _REQ) + ") AS names FROM day_ent)"
          " WHERE n_missing > 0")
def q_score_rejects(spark, sf):
    from strata.operators.scoring import split_rejects
    ent = V.v_day_entities(spark, sf)
    _, bad = split_rejects(ent, _REQ, keep=["user_id", "day"])
    return bad


@register("metrics_json", O.with_(O.V_ORD_RAW, O.V_SCORE, *_AUC_CTE, f"c AS ({_conf_sql(T_FOREST)})")
          + f"SELECT {T_FOREST}::DOUBLE AS threshold, {_prf_sql()}, {O.r('roc_auc')} AS roc_auc, tp, fn, fp, tn"
          " FROM c, auc")
def q_metrics_json(spark, sf):
    from strata.sources.tables import read_json_rows, write_json_rows
    path = TJ.work_dir(spark, "metrics")
    write_json_rows(EV.metric_bundle(V.v_score(spark, sf), T_FOREST, nested=True), path)
    schema = ("threshold double, precision double, recall double, f1 double, roc_auc double, accuracy double, "
              "confusion struct<tp:bigint,fn:bigint,fp:bigint,tn:bigint>")
    from pyspark.sql.types import _parse_datatype_string
    back = read_json_rows(spark, path, _parse_datatype_string(schema))
    return round_doubles(back.select("threshold", "precision", "recall", "f1", "roc_auc", "confusion.*"))


@register("scan_split", O.with_(O.V_ORD_RAW, O.ORD_ENT, O.ORD_LAB, O.ORD_SPLIT)
          + "SELECT e.l_orderkey, " + O.r("e.l_quantity_mean") + " AS l_quantity_mean, e.label FROM ord_ent e"
          " JOIN ord_split s USING (l_orderkey) WHERE s.split = 'test'")
def q_scan_split(spark, sf):
    from strata.sources.tables import scan_split, write_table
    path = TJ.work_dir(spark, "splits")
    ent = ord_train_entities(spark, sf).select("l_orderkey", "l_quantity_mean", "label", "split")
    write_table(ent, path, partition_by=["split"])
    return round_doubles(scan_split(spark, path, "test").drop("split"))


@register("report_pack")
def q_report_pack(spark, sf):
    data, prep = _wide(spark, sf)
    cvm, grid, clf = TJ.tune(spark, data, prep.kept, "forest", grid_values=TJ.FOREST_GRID)
    res = TJ.finalize(spark, data, prep.kept, cvm, grid, clf)
    mb = EV.metric_bundle(res["scored"], res["threshold"], nested=True).first().asDict(recursive=True)
    return TJ.report_pack(spark, data, res, "forest", mb, 80, len(prep.features_in))
