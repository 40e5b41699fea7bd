"""Training / finalisation jobs (M6, M9, M10, R1) composed from the operators.
``train_job`` takes any long table with its ``CohortSpec``; the other jobs are on
the V-ORD cohort.  All driver-side data are per-feature, per-threshold or
per-parameter rows; entity rows stay in Spark."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import combine_rows
from strata.operators import evaluate as EV
from strata.operators import model as M
from strata.operators import profile as P
from strata.operators import sampling as S
from strata.operators.aggregate import entity_table
from strata.operators.ensembles import bin_rows, grow, held_confusion, keyed_rows
from strata.operators.prep import FittedPrep, fit_prep, with_class_weight, with_positive_weight
from strata.operators.rank import rank_within
from strata.operators.report import importance_rank
from strata.operators.scoring import score_table
from strata.operators.trees import Fit
from strata.plans import views as V
from strata.session import cut_lineage, drop_written, ensure_checkpoint_dir
from strata.sources.bundle import Bundle, load_bundle, publish_bundle, save_bundle
from strata.sources.tables import normalize_raw
from strata.spec import CohortSpec

KEY = "l_orderkey"
ENTITY_ID = "entity_id"
ORD_F = V.ORD_SPEC.feature_columns()

# The published search.
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [None, 20], "minSamplesSplit": [2, 5]}
BOOSTED_SPACE = {"maxIter": ("int", 50, 400), "maxDepth": ("int", 2, 8), "stepSize": ("loguniform", 0.01, 0.3),
                 "subsamplingRate": ("uniform", 0.5, 1.0), "featureSubsetStrategy": ("share", 0.5, 1.0)}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (never a machine-local
    temp folder)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "strata-work", f"{name}-{uuid.uuid4().hex[:8]}")


def prepare(ent: DataFrame, key: str, features: list[str], var_thresh: float = 0.01) -> tuple[DataFrame, FittedPrep]:
    """Entities with the 80/20 split and the label-free preparation fitted on
    train (imputation + filters; scaling happens in the models)."""
    ent = cut_lineage(ent)
    sp = S.stratified_split(ent, [key], "label", 0.2)
    prep = fit_prep(sp.filter(F.col("split") == "train"), features, var_thresh=var_thresh, scale=False)
    data = cut_lineage(prep.transform(sp, scale=False))
    drop_written(ent)
    return data, prep


def prepared(spark: SparkSession, sf: str, wide: bool = False) -> tuple[DataFrame, FittedPrep]:
    """The V-ORD or V-WIDE entities, prepared."""
    if wide:
        return prepare(V.v_wide_entities(spark, sf), KEY, V.WIDE_SPEC.feature_columns())
    return prepare(V.v_ord_entities(spark, sf), KEY, ORD_F)


def with_validation(data: DataFrame, key: str = KEY) -> DataFrame:
    """tr2 / val inside train (another salt); test rows keep 'test'."""
    tr = data.filter(F.col("split") == "train").drop("split")
    v = S.stratified_split(tr, [key], "label", 0.2, seed=43, names=("tr2", "val"))
    return v.unionByName(data.filter(F.col("split") == "test"))


def fit_scored(train: DataFrame, test: DataFrame, feats: list[str], clf, weight: str | None = None):
    """Fit ``clf`` on scaled ``feats`` (scaler fitted on train) and score test."""
    scaler = M.PopulationScaler(inputCols=feats, outputCol="features").fit(train)
    tr = scaler.transform(train).withColumn("label", F.col("label").cast("double"))
    if weight == "balanced":
        tr = with_class_weight(tr, "label", "weight")
    elif weight == "positive":
        tr = with_positive_weight(tr, "label", "weight")
    model = clf.fit(tr)
    scored = M.p_positive(model.transform(scaler.transform(test)))
    return model, scaler, scored


def baseline(spark, sf, kind: str = "forest", ready: tuple[DataFrame, FittedPrep] | None = None):
    """A model on the V-ORD entities; ``ready`` is what ``prepared`` returned, for a caller that uses it too."""
    data, prep = ready or prepared(spark, sf)
    feats = prep.kept
    tr, te = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    if kind == "forest":
        clf = M.random_forest(num_trees=100, weight_col="weight")
        model, scaler, scored = fit_scored(tr, te, feats, clf, "balanced")
    else:
        clf = M.boosted_trees(n_iter=100, max_depth=6, step=0.3, weight_col="weight")
        model, scaler, scored = fit_scored(tr, te, feats, clf, "positive")
    return model, scaler, cut_lineage(scored.select(KEY, "label", "p")), feats      # read by several aggregates


def rfe_select(spark, sf, k: int = 8, step: float = 0.5, wide: bool = False,
               ready: tuple[DataFrame, FittedPrep] | None = None) -> DataFrame:
    """names kept by recursive elimination on scaled train features; ``ready`` as in ``baseline``."""
    data, prep = ready or prepared(spark, sf, wide)
    tr = data.filter(F.col("split") == "train")
    scaled = M.PopulationScaler(inputCols=prep.kept, outputCol="features").fit(tr).transform(tr)
    sel = M.RecursiveEliminator(k=k, step=step).fit(scaled)
    names = [prep.kept[i] for i in sel.indices]
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "slot int, feature string")


def rfe_final(spark, sf, k: int = 50) -> DataFrame:
    """one column less a round, ranked by 10 trees of depth 4; (feature, width, kept): the width at which a
    feature left, or k for those that stay."""
    data, prep = prepared(spark, sf, True)
    tr = data.filter(F.col("split") == "train")
    x = F.array(*[F.col(f).cast("double") for f in prep.kept])
    path: list[tuple[int, int]] = []
    rows = bin_rows(keyed_rows(tr, x, "label", F.col(KEY), F.lit(0)))
    kept = M.eliminate(rows, {0: [k]}, 1, 10, 4, path=path)[0, min(k, len(prep.kept))]
    told = [(prep.kept[c], width, False) for width, c in path] + [(prep.kept[c], len(kept), True) for c in kept]
    return spark.createDataFrame(told, "feature string, width int, kept boolean")


def sweep_widths(n: int) -> list[int]:
    """1 to 20, then by tens, up to the number of features."""
    return [k for k in [*range(1, 21), *range(30, n + 1, 10)] if k <= n]


def rfe_sweep(spark, sf, ks: list[int] | None = None, folds: int = 5, num_trees: int = 50,
              step: float = 0.5) -> DataFrame:
    """for each k, RFE on train then the k-feature forest's CV F1; ``best``
    marks the smallest k of the highest score."""
    data, prep = prepared(spark, sf)
    ks = [k for k in ks or sweep_widths(len(prep.kept)) if k <= len(prep.kept)]
    tr = cut_lineage(S.stratified_folds(data.filter(F.col("split") == "train"), [KEY], "label", folds, seed=44))
    x = F.array(*[F.col(f).cast("double") for f in prep.kept])
    sides = M.training_sides(tr, folds).unionByName(tr.withColumn("side", F.lit(folds)))     # the last is all of train
    rows = bin_rows(keyed_rows(sides, x, "label", F.col(KEY), F.col("side")))
    kept = M.eliminate(rows, {folds: ks}, step)
    fits = [Fit(fold, "forest", num_trees, 6, weights=rows.balanced(fold), seed=M.SEED, columns=tuple(kept[folds, k]))
            for k in ks for fold in range(folds)]
    held = keyed_rows(tr, x, "label", F.col(KEY), F.col("fold"))
    counts = held_confusion(grow(rows, fits), held, [(i, num_trees, 6, 2) for i in range(len(fits))])
    f1 = [M.f1_of(*counts[i]) for i in range(len(fits))]
    rows = [(k, sum(f1[i * folds:(i + 1) * folds]) / folds) for i, k in enumerate(ks)]
    top = max(f1 for _, f1 in rows)
    best = min(k for k, f1 in rows if f1 == top)
    return spark.createDataFrame([(k, f1, k == best) for k, f1 in rows], "k int, cv_f1 double, best boolean")


def tuning_folds(data: DataFrame, n_folds: int = 5, key: str = KEY) -> DataFrame:
    return cut_lineage(S.stratified_folds(data.filter(F.col("split") == "tr2"), [key], "label", n_folds, seed=44))


def leakfree_cv(spark, data: DataFrame, feats: list[str], n_folds: int = 5, k_features: int = 50,
                key: str = KEY) -> DataFrame:
    """M3: scale, eliminate, oversample and fit inside every fold; what each fold's own elimination kept and its F1."""
    pipe = M.leakfree_estimator(M.random_forest(seed=M.SEED), feats, key, k_features=k_features)
    found = M.cross_validate(pipe, [{}], tuning_folds(data, n_folds, key), n_folds=n_folds)
    rows = [(f, len(kept), len(feats) - len(kept), ",".join(feats[i] for i in kept), scores[0])
            for f, (kept, scores) in enumerate(zip(found.fold_features, found.fold_scores, strict=True))]
    return spark.createDataFrame(rows, "fold int, n_features int, n_dropped int, features string, f1 double")


def tune(spark, data: DataFrame, feats: list[str], kind: str, n_folds: int = 5, k_features: int = 50,
         grid_values: dict | None = None, space: dict | None = None, n_draws: int = 25, key: str = KEY):
    """M3 + M4 / M5: leak-free pipeline tuned on tr2 with stratified folds."""
    clf = M.random_forest(seed=M.SEED) if kind == "forest" else M.boosted_trees(seed=M.SEED)
    pipe = M.leakfree_estimator(clf, feats, key, k_features=k_features)
    tr2 = tuning_folds(data, n_folds, key)
    if space is not None:
        grid = M.random_param_maps(clf, space, n_draws)
    else:
        grid = M.param_grid(clf, grid_values or {})
    cvm = M.leakfree_search(pipe, grid, tr2, n_folds=n_folds)
    return cvm, grid, clf


def finalize(spark, data: DataFrame, feats: list[str], cvm, grid, clf, key: str = KEY):
    """M9: selected names -> threshold on val -> deployable refit on all of
    train -> test metrics at that threshold."""
    best = cvm.bestModel
    selected = [feats[i] for i in M.selected_indices(best)]
    val = data.filter(F.col("split") == "val")
    val_scored = M.p_positive(best.transform(val))
    choice = EV.best_threshold(EV.choose_threshold(val_scored)).first()
    threshold = float(choice["threshold"])
    params = M.best_params(cvm, grid)
    est = clf.copy(params)
    train = data.filter(F.col("split").isin("tr2", "val"))
    scaler, model = M.deployable_fit(train, key, selected, est)
    test = data.filter(F.col("split") == "test")
    scored = cut_lineage(M.p_positive(model.transform(scaler.transform(test))).select(key, "label", "p"))
    return {"selected": selected, "threshold": threshold, "params": params, "scaler": scaler,
            "model": model, "scored": scored, "cv_f1": float(max(cvm.avgMetrics))}


def bundle_of(result: dict, kind: str) -> Bundle:
    sc = result["scaler"]
    return Bundle(model=result["model"], features=list(result["selected"]), scaler_mean=sc.means,
                  scaler_scale=sc.scales, threshold=result["threshold"], model_type=kind)


def keyed_entities(ent: DataFrame, spec: CohortSpec) -> tuple[DataFrame, str]:
    """The entity table with one long key.  The number of a string or composite key is its rank in key order: dense,
    the same on every run, and found without bringing the keys to one place."""
    if len(spec.entity) == 1 and isinstance(ent.schema[spec.entity[0]].dataType, T.IntegralType):
        return ent, spec.entity[0]
    if ENTITY_ID in ent.columns:
        raise ValueError(f"column {ENTITY_ID} is taken")
    return rank_within(ent, [], list(spec.entity), out=ENTITY_ID), ENTITY_ID


def train_job(spark: SparkSession, source: str | DataFrame, spec: CohortSpec, out_dir: str | None = None,
              folds: int = 5, k_features: int = 50, n_draws: int = 25, demo_samples: int = 80,
              var_thresh: float = 0.01, forest_grid: dict | None = None,
              boosted_space: dict | None = None) -> DataFrame:
    """Aggregate -> split -> prepare -> tune forest and boosted trees
    leak-free -> finalise both -> pick the winner (boosted wins ties) -> publish
    the bundle, write run metrics and the report pack.  Returns the run-metrics row.

    ``source`` is a long table, or the path of one in Parquet, with the columns of
    ``spec``; its target must be "label".  An entity of one integer column is the row key; any other, of strings, dates
    or several columns, is numbered by a key dictionary first."""
    raw = spark.read.parquet(source) if isinstance(source, str) else source
    spec = spec.resolve(raw)
    absent = [c for c in (*spec.entity, spec.seq) if c not in raw.columns]
    if absent:
        raise ValueError(f"train_job needs the entity and sequence columns, got none of {absent}")
    if spec.target != "label":
        raise ValueError(f"train_job needs the target to be named label, got {spec.target}")
    ent, key = keyed_entities(entity_table(normalize_raw(raw, spec), spec), spec)
    out_dir = out_dir or work_dir(spark, "train")
    data, prep = prepare(ent, key, spec.feature_columns(), var_thresh)
    data = cut_lineage(with_validation(data, key))
    searches = {"forest": {"grid_values": forest_grid or FOREST_GRID},
                "boosted": {"space": boosted_space or BOOSTED_SPACE, "n_draws": n_draws}}
    results, scores = {}, {}
    for kind, options in searches.items():
        found = tune(spark, data, prep.kept, kind, folds, k_features, key=key, **options)
        results[kind] = finalize(spark, data, prep.kept, *found, key=key)
        scores[kind] = EV.metric_bundle(results[kind]["scored"], results[kind]["threshold"], nested=True).first().asDict(
            recursive=True)
    win = "boosted" if scores["boosted"]["f1"] >= scores["forest"]["f1"] else "forest"
    test = data.filter(F.col("split") == "test")
    publish_bundle(spark, bundle_of(results[win], win), os.path.join(out_dir, "bundle"), test, key)
    counts = {r["t"]: r["n"] for r in data.groupBy((F.col("split") == "test").alias("t")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    summary = prep.summary()
    per_model = F.struct(*[model_metrics(scores[k], results[k]).alias(k) for k in results])
    row = spark.range(1).select(
        F.lit(win).alias("winner"), F.lit(counts.get(False, 0)).alias("n_train"),
        F.lit(counts.get(True, 0)).alias("n_test"), F.lit(summary["n_candidates"]).alias("n_candidates"),
        F.lit(summary["after_variance_filter"]).alias("n_features_after_label_free_reduction"),
        per_model.alias("models")).select("*", "models.*").drop("models")
    row.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "metrics"))
    pack = report_pack(spark, data, results[win], win, scores[win], demo_samples, summary["n_candidates"], key)
    pack.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "report"))
    return row


def confusion_struct(c: dict) -> Column:
    return F.struct(*[F.lit(int(c[n])).cast("long").alias(n) for n in ("tp", "fn", "fp", "tn")])


def model_metrics(scores: dict, result: dict) -> Column:
    """What the run row says of one model."""
    params = json.dumps({p.name: v for p, v in result["params"].items()}, sort_keys=True)
    return F.struct(
        *[F.lit(scores[n]).cast("double").alias(n) for n in ("precision", "recall", "f1", "roc_auc", "threshold")],
        confusion_struct(scores["confusion"]).alias("confusion"), F.lit(result["cv_f1"]).alias("cv_f1"),
        F.lit(len(result["selected"])).alias("n_features"), F.lit(params).alias("best_params"))


def report_pack(spark, data: DataFrame, result: dict, kind: str, metrics: dict, n_samples: int,
                n_candidates: int, key: str = KEY) -> DataFrame:
    """One document: ranked weights, meta, per-feature cohort stats,
    threshold sweep, stratified sample rows (n_samples // 2 per class)."""
    feats = result["selected"]
    imp = spark.createDataFrame(M.feature_importances(result["model"], feats), "feature string, weight double")
    ranked = importance_rank(imp).agg(F.collect_list(F.struct("feature", "weight")).alias("top_features"))
    train = data.filter(F.col("split") != "test")
    test = data.filter(F.col("split") == "test")
    stats = P.cohort_stats(train, feats).agg(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct("mean", "std", "q01", "q25", "q75", "q99")))).alias("stats"))
    sweep = EV.sweep_artifact(EV.threshold_sweep(result["scored"])).select(F.struct("*").alias("sweep"))
    smp = S.class_capped_sample(test, [key], "label", n_samples, seed=M.SEED)
    names = F.array(*[F.lit(f) for f in feats])
    lab = F.when(F.col("label") == 1, F.lit("positive")).otherwise(F.lit("negative"))
    # sort by the seeded order first (maps are not orderable), then build the maps
    samples = smp.agg(F.sort_array(F.collect_list(F.struct(
        "_order", lab.alias("label"), F.array(*[F.round(F.col(f), 4) for f in feats]).alias("v")))).alias("_s")) \
        .select(F.transform("_s", lambda r: F.struct(r["label"].alias("label"), F.map_from_arrays(
            names, r["v"]).alias("features"))).alias("samples"))
    c = confusion_struct(metrics["confusion"])
    names_of = ("roc_auc", "f1", "precision", "recall", "accuracy")
    rounded = [F.round(F.lit(metrics[n]).cast("double"), 4).alias(n) for n in names_of]
    rounded.append(F.round(F.lit(float(result["threshold"])), 4).alias("threshold"))
    sizes = combine_rows(
        data.agg(F.count(F.when(F.col("split") != "test", 1)).alias("n_train"),
                 F.count(F.when(F.col("split") == "test", 1)).alias("n_test")),
        samples.select(F.size("samples").alias("n_demo_samples")))
    head = sizes.select(
        F.lit(kind).alias("model_type"),
        F.struct(*rounded, c.alias("confusion"), "n_train", "n_test", F.lit(n_candidates).alias("n_candidates"),
                 "n_demo_samples").alias("meta"),
        F.array(*[F.lit(f) for f in feats]).alias("features"))
    parts = [head, ranked, stats, sweep, samples]
    # each part is exactly one row: merge by position-free union + first()
    merged = combine_rows(*[p.select(F.struct("*").alias(f"_p{i}")) for i, p in enumerate(parts)])
    return merged.select(*[f"_p{i}.*" for i in range(len(parts))])


def score_with_bundle(spark, sf, path: str | None = None):
    """M11 + S7: train the forest baseline, save its bundle, load it back and
    score the test rows with the loaded bundle."""
    data, prep = prepared(spark, sf)
    model, scaler, scored, feats = baseline(spark, sf, "forest", (data, prep))
    b = Bundle(model=model, features=feats, scaler_mean=scaler.means, scaler_scale=scaler.scales,
               threshold=0.5, model_type="forest")
    path = path or work_dir(spark, "bundle")
    save_bundle(spark, b, path)
    loaded = load_bundle(spark, path)
    test = data.filter(F.col("split") == "test")
    return {"scored": scored, "reloaded_scored": score_table(test, loaded, [KEY, "label"]), "bundle": b,
            "loaded": loaded, "test": test, "data": data}
