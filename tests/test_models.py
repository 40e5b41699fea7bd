"""k-NN / SMOTE invariants, RFE schedule, leak-free pipeline, scoring."""
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import balance as BA
from strata.operators import model as M
from strata.operators.scoring import score_table, split_rejects
from strata.session import cut_lineage
from strata.sources.bundle import Bundle, load_bundle, save_bundle

FEATS = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def gauss(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(200):
        y = 1 if i < 20 else 0
        x = rng.normal(2.5 if y else 0.0, 1.0, 6)
        rows.append((i, y, *[float(v) for v in x]))
    return spark.createDataFrame(rows, "k long, label int, " + ", ".join(f"{f} double" for f in FEATS))


def test_knn_matches_brute_force(spark, gauss):
    mino = gauss.filter("label = 1")
    got = BA.minority_knn(mino, "k", FEATS, k=5, block_rows=7).collect()
    pdf = mino.toPandas()
    X, K = pdf[FEATS].to_numpy(), pdf.k.to_numpy()
    for r in got:
        i = int(np.where(K == r.k)[0][0])
        d = ((X - X[i]) ** 2).sum(1)
        d[i] = np.inf
        assert K[np.lexsort((K, d))[r.nn_rank - 1]] == r.nn_key


def test_knn_of_equal_points_compares_few_rows(spark, monkeypatch):
    df = spark.createDataFrame([(int(i * 7919 % 1009), float(i % 3), float(i % 2)) for i in range(1, 400)], "k long, a double, b double")
    blocks = BA._first_neighbours
    seen = []
    monkeypatch.setattr(BA, "_first_neighbours", lambda x, f, k, b, n: seen.append(n) or blocks(x, f, k, b, n))
    got = {(r.k, r.nn_rank): (r.nn_key, r.dist) for r in BA.minority_knn(df, "k", ["a", "b"], k=3, block_rows=10).collect()}
    pdf = df.toPandas()
    X, K = pdf[["a", "b"]].to_numpy(), pdf.k.to_numpy()
    for i in range(len(K)):
        d = ((X - X[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.lexsort((K, d))[:3]
        assert [got[K[i], r + 1] for r in range(3)] == [(K[j], d[j] ** 0.5) for j in near]
    assert len(got) == 3 * len(K) and seen == [6 * 4]


def test_smote_parity_and_segments(spark, gauss):
    out = BA.smote(gauss, "k", FEATS, "label", k=5)
    c = {(r.label, r.synthetic): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert c[(1, False)] + c[(1, True)] == c[(0, False)] == 180
    mino = gauss.filter("label = 1").toPandas()[FEATS].to_numpy()
    syn = out.filter("synthetic").toPandas()[FEATS].to_numpy()
    for s in syn[:40]:  # each synthetic row lies on a segment between two minority rows
        ok = False
        for a in mino:
            for b in mino:
                d = b - a
                if not d.any():
                    continue
                u = float(np.dot(s - a, d) / np.dot(d, d))
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(a + u * d, s, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok
    again = BA.smote(gauss, "k", FEATS, "label", k=5).filter("synthetic").toPandas()[FEATS].to_numpy()
    assert np.allclose(np.sort(again, axis=0), np.sort(syn, axis=0))  # seeded


def test_rfe_schedule():
    assert M.rfe_schedule(156, 50, 0.5) == [156, 78, 50]
    assert M.rfe_schedule(10, 4, 1) == [10, 9, 8, 7, 6, 5, 4]


def test_leakfree_cv_and_scores(spark, gauss):
    from strata.operators.sampling import stratified_folds
    data = stratified_folds(gauss, ["k"], "label", 3)
    clf = M.random_forest(num_trees=10, max_depth=4)
    pipe = M.leakfree_estimator(clf, FEATS, "k", k_features=4)
    grid = M.param_grid(clf, {"numTrees": [5, 10]})
    cvm = M.grid_search(pipe, grid, data, n_folds=3)
    assert len(cvm.avgMetrics) == 2 and all(0 <= m <= 1 for m in cvm.avgMetrics)
    assert len(M.selected_indices(cvm.bestModel)) == 4
    p = M.p_positive(cvm.bestModel.transform(gauss)).agg(F.min("p"), F.max("p")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0


def test_bundle_roundtrip_parity_and_rejects(spark, gauss, tmp_path):
    scaler = M.PopulationScaler(inputCols=FEATS).fit(gauss)
    model = M.random_forest(num_trees=5, max_depth=3).fit(
        scaler.transform(gauss).withColumn("label", F.col("label").cast("double")))
    b = Bundle(model=model, features=FEATS, scaler_mean=scaler.means, scaler_scale=scaler.scales,
               threshold=0.4, model_type="forest")
    save_bundle(spark, b, str(tmp_path / "b"))
    b2 = load_bundle(spark, str(tmp_path / "b"))
    s1 = {r.k: r.p for r in score_table(gauss, b, ["k"]).collect()}
    s2 = {r.k: r.p for r in score_table(gauss, b2, ["k"]).collect()}
    assert s1 == s2 and b2.card()["threshold"] == 0.4
    holes = gauss.withColumn("f1", F.when(F.col("k") < 3, None).otherwise(F.col("f1")))
    ok, bad = split_rejects(holes, FEATS, keep=["k"])
    assert ok.count() == 197 and {r.missing_first for r in bad.collect()} == {"f1"}
    with pytest.raises(ValueError):
        split_rejects(gauss.drop("f5"), FEATS)


@pytest.mark.parametrize("kind", ["clusters", "grid", "offset"])
def test_knn_ties_and_offsets(spark, kind):
    rng = np.random.default_rng(11)
    pts = np.concatenate([c + rng.normal(0, 1, (60, 3)) for c in rng.normal(0, 4, (4, 3))])
    pts[10] = pts[11]  # an exact duplicate: distance-0 tie broken by key
    if kind == "grid":
        pts = rng.integers(0, 2, pts.shape).astype(float)
    elif kind == "offset":
        pts[:, 0] += 1e8
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "k long, a double, b double, c double")
    for block_rows in (25, 20000):
        got = BA.minority_knn(df, "k", ["a", "b", "c"], k=5, block_rows=block_rows)
        assert got.count() == 5 * len(pts)
        for r in got.collect():
            d = ((pts - pts[r.k]) ** 2).sum(1)
            d[r.k] = np.inf
            assert np.lexsort((np.arange(len(pts)), d))[r.nn_rank - 1] == r.nn_key


def test_knn_emits_from_many_tasks(spark):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"))
    plan = BA.minority_knn(df, "k", ["a"], k=3)._jdf.queryExecution().toString()
    found = {int(n) for n in re.findall(r"hashpartitioning\(qb#\d+, rb#\d+, (\d+)\)", plan)}
    assert found and min(found) >= 9        # at least three blocks on either side


def test_knn_leaves_far_blocks_out_and_splits_hot_leaves(spark):
    rng = np.random.default_rng(3)
    pts = np.concatenate([c + rng.normal(0, 1, (50, 3)) for c in rng.normal(0, 1000, (8, 3))])
    pts = np.concatenate([pts, np.tile(pts[7], (200, 1))])      # a third of the rows are one point
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "k long, a double, b double, c double")
    x = df.select(F.col("k").alias("key"), F.array("a", "b", "c").alias("x"))
    placed, blocks = BA._placed(x, len(pts), 8, 60)
    assert placed.groupBy("block").count().agg(F.max("count")).first()[0] <= 90 and placed.count() == len(pts)
    box = placed.groupBy("block").agg(*[F.array(*[f(F.col("z")[i]) for i in range(3)]).alias(n)
                                        for n, f in (("lo", F.min), ("hi", F.max))])
    pairs = BA.block_pairs(box.withColumn("kth", F.lit(100.0)), 0.0, 4)
    assert 0 < pairs.count() < blocks * (blocks - 1) / 2
    got = BA.minority_knn(df, "k", ["a", "b", "c"], k=5, block_rows=60).collect()
    assert len(got) == 5 * len(pts)
    for r in got:
        d = ((pts - pts[r.k]) ** 2).sum(1)
        d[r.k] = np.inf
        assert np.lexsort((np.arange(len(pts)), d))[r.nn_rank - 1] == r.nn_key


def test_nan_feature_is_rejected(spark, gauss):
    holes = gauss.withColumn("f1", F.when(F.col("k") < 3, F.lit(float("nan"))).otherwise(F.col("f1")))
    ok, bad = split_rejects(holes, FEATS, keep=["k"])
    assert ok.count() == 197 and {r.missing_first for r in bad.collect()} == {"f1"}


def test_depth_below_one_is_an_error():
    with pytest.raises(ValueError):
        M.random_forest(max_depth=0)


def test_a_fold_never_sees_its_own_labels(spark, gauss):
    from strata.operators.sampling import stratified_folds
    data = cut_lineage(stratified_folds(gauss, ["k"], "label", 3))
    clf = M.random_forest(num_trees=5, max_depth=3)
    pipe = M.leakfree_estimator(clf, FEATS, "k", k_features=3)
    flip = data.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = (M.leakfree_search(pipe, [{}], d, n_folds=3) for d in (data, flip))
    assert a.fold_features[0] == b.fold_features[0] and len(a.fold_features) == 3
    assert 0 <= a.avgMetrics[0] <= 1


@pytest.mark.parametrize("kind", ["grid", "spread"])
def test_knn_inside_a_block_looks_at_near_leaves_only(monkeypatch, kind):
    rng = np.random.default_rng(6)
    pts = rng.integers(0, 4, (900, 3)).astype(float) if kind == "grid" else rng.normal(0, 1, (900, 3))
    pts[5] = np.inf
    monkeypatch.setattr(BA, "LEAF", 16)
    monkeypatch.setattr(BA, "HELD", 200)
    key, limit = np.arange(900), np.where(np.arange(400) % 3 == 0, 0.02, np.inf)
    looked, cut = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *r, **o: looked.append(a.size) or cut(a, *r, **o))
    i, j, d = BA._nearest(pts[:400], key[:400], pts, key, limit, 5)
    for q in range(400):
        with np.errstate(invalid="ignore"):
            d2 = ((pts - pts[q]) ** 2).sum(1)
        d2[q] = np.inf
        want = [p for p in np.lexsort((key, d2))[:5] if np.isfinite(d2[p]) and d2[p] <= limit[q]]
        assert j[i == q].tolist() == want and np.allclose(d[i == q], d2[want])
    assert sum(looked) < 400 * 900 / 2


def test_knn_rows_visit_only_blocks_within_their_bound(spark):
    boxes = spark.createDataFrame([(0, [0.0], [1.0]), (1, [1.5], [2.0]), (2, [9.0], [9.5])],
                                  "block int, lo array<double>, hi array<double>")
    rows = spark.createDataFrame([(i, [z], [z], kth, 0, [2, 1]) for i, (z, kth) in enumerate(
        [(0.1, 0.04), (0.9, 0.36), (1.0, 0.25), (0.0, 100.0)])],
        "key long, x array<double>, z array<double>, kth double, block int, near array<int>")
    got = rows.mapInPandas(BA._reached(boxes, 0.0), "key long, x array<double>, kth double, rb int").collect()
    assert sorted((r.key, r.rb) for r in got) == [(1, 1), (2, 1), (3, 1), (3, 2)]


def test_the_refit_of_a_search_begins_beside_its_folds(gauss, monkeypatch):
    from threading import Event
    clf = M.random_forest(num_trees=3, max_depth=3)
    pipe, grid = M.leakfree_estimator(clf, FEATS, "k", k_features=3), [{clf.numTrees: 3}, {clf.numTrees: 5}]
    begun, fit = Event(), M.PopulationScaler._fit
    monkeypatch.setattr(M.PopulationScaler, "_fit", lambda self, rows: begun.set() or fit(self, rows))
    monkeypatch.setattr(M, "cross_validate", lambda *a: begun.wait(60) and M.SearchResult([0.1, 0.4], None, [], []))
    best = M.leakfree_search(pipe, grid, gauss, n_folds=3).bestModel
    want = pipe.copy(grid[1]).fit(gauss.withColumn("label", F.col("label").cast("double")))
    assert M.selected_indices(best) == M.selected_indices(want)
    a, b = ({r["k"]: r["p"] for r in M.p_positive(m.transform(gauss)).select("k", "p").collect()} for m in (best, want))
    assert a == b and len(a) == 200


@pytest.mark.parametrize("kind", ["normal", "far", "huge"])
def test_knn_sums_few_distances_feature_by_feature(monkeypatch, kind):
    rng = np.random.default_rng(3)
    pts = rng.normal(0, 1, (1500, 30))
    pts = {"normal": pts, "far": 1e6 + pts, "huge": pts * 1e160}[kind]
    pts[700:720] = pts[3]       # ties
    key, summed, own = np.arange(1500), [], BA._exact
    monkeypatch.setattr(BA, "_exact", lambda x, refs, i, j: summed.append(len(i)) or own(x, refs, i, j))
    with np.errstate(all="ignore"):
        i, j, d = BA._nearest(pts[:300], key[:300], pts, key, np.full(300, np.inf), 5)
        for q in range(300):
            d2 = np.zeros(1500)
            for f in range(30):
                d2 += (pts[q, f] - pts[:, f]) ** 2
            d2[q] = np.inf
            want = [p for p in np.lexsort((key, d2))[:5] if np.isfinite(d2[p])]
            assert j[i == q].tolist() == want and d[i == q].tolist() == d2[want].tolist()
    assert kind == "huge" or sum(summed) < 300 * 1500 / 4


def test_a_fold_oversamples_columns_not_vectors(spark, gauss):
    rows = gauss.withColumn("features", M.assemble(FEATS))
    last = M.BalancedClassifier(estimator=M.random_forest(num_trees=2), featuresCol="features", keyCol="k")
    a, b = (sorted((tuple(r["features"]), r["label"]) for r in d.collect()) for d in
            (last.balanced_rows(rows), last.balanced_columns(gauss, [F.col(c) for c in FEATS])))
    assert a == b and len(a) > gauss.count()
