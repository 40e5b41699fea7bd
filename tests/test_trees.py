"""Trees: the split rule against brute force, and the two ways of growing against each other."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import ensembles as E
from strata.operators import trees as T


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = []
    for i in range(900):
        y = int(i % 5 == 0)
        x = [float(v) for v in (rng.normal(1.2 * y, 1), rng.integers(0, 4), rng.normal(0, 1), 1.0, rng.normal(-y, 2))]
        data.append((i, i % 3, y, x))
    df = spark.createDataFrame(data, "k long, fold int, y int, x array<double>")
    return E.keyed_rows(df, F.col("x"), "y", F.col("k"), F.col("fold") % 2).cache()


def _same(a, b):
    assert len(a) == len(b)
    for p, q in zip(a, b, strict=True):
        # the nodes may stand in another order: compare what the trees say of every bin pattern
        assert len(p.feature) == len(q.feature)
        x = np.random.default_rng(0).integers(0, T.BINS, (4000, 5)).astype(np.uint8)
        at, bt = (T.descend(t.feature, t.cut, t.left, x) for t in (p, q))
        for c in ("a", "b", "n", "depth"):
            assert np.array_equal(getattr(p, c)[at], getattr(q, c)[bt])
        assert np.isclose(p.gain.sum(), q.gain.sum())


def test_forest_is_the_same_by_passes_and_in_tasks(rows):
    fits = [T.Fit(0, "forest", 4, weights=(0.6, 2.5)),
            T.Fit(1, "forest", 3, max_depth=4, min_split=9, features=3, columns=(0, 1, 2, 4))]
    near = E.grow(rows, fits)
    for local in (0, 1500):
        far = E.grow(rows, fits, local_bytes=local)
        for i in range(2):
            _same(near.of(i), far.of(i))
    deep = near.of(0)[0]
    assert deep.depth.max() > 6 and ((deep.a == 0) | (deep.b == 0) | (deep.feature >= 0)).mean() > 0.9
    assert near.of(1)[0].depth.max() <= 4 and (near.of(1)[0].n[near.of(1)[0].feature >= 0] >= 9).all()


def test_boosting_is_the_same_by_passes_and_in_tasks(rows, monkeypatch):
    monkeypatch.setattr(E, "WRITE_EVERY", 2)
    fits = [T.Fit(0, "boosted", 3, max_depth=3, step=0.3, subsample=0.7, share=0.6),
            T.Fit(1, "boosted", 2, max_depth=2, step=0.1, weights=(1.0, 4.0), seed=7, columns=(4, 2, 0))]
    near, far = E.grow(rows, fits), E.grow(rows, fits, local_bytes=0)
    for i in range(2):
        _same(near.of(i), far.of(i))
    assert {len(set(t.feature[t.feature >= 0])) <= 3 for t in near.of(0)} == {True}


def test_smaller_limits_cut_the_same_tree_off(rows):
    grown = E.grow(rows, [T.Fit(0, "forest", 3), T.Fit(0, "forest", 3, max_depth=3, min_split=20)])
    x = np.random.default_rng(1).normal(0, 2, (500, 5))
    whole, small = grown.model(0, max_depth=3, min_split=20), grown.model(1)
    assert np.array_equal(whole.probability(x), small.probability(x))
    assert np.allclose(whole.importance, small.importance) and np.isclose(small.importance.sum(), 1)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_a_spread_model_scores_as_one_in_a_process(spark, rows, tmp_path, kind):
    from pyspark.ml.functions import array_to_vector

    from strata.operators.model import TreesModel
    grown = E.grow(rows, [T.Fit(0, kind, 6, max_depth=5, weights=(0.6, 2.5))])
    near, spread = grown.model(0), grown.model(0, model_bytes=0)
    assert isinstance(spread, E.SpreadModel) and np.array_equal(spread.importance, near.importance)
    seen = rows.select(F.monotonically_increasing_id().alias("row"), "x", array_to_vector("x").alias("features")).cache()
    want = {r["row"]: r["p"] for r in zip_rows(near, seen)}
    for part_bytes in (2000, E.PART_BYTES):
        got = {r["row"]: r["p"] for r in spread.scores(seen, part_bytes).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - p) < 1e-12 for k, p in want.items())
    TreesModel(spread).save(spark, str(tmp_path))
    loaded = TreesModel.load(spark, str(tmp_path), model_bytes=0)
    again = TreesModel.load(spark, str(tmp_path))
    assert isinstance(loaded.model, E.SpreadModel) and not isinstance(again.model, E.SpreadModel)
    for model in (TreesModel(spread), loaded, again):
        out = model.transform(seen.unionAll(seen)).collect()
        assert len(out) == 2 * len(want)
        assert all(abs(r["probability"][1] - want[r["row"]]) < 1e-12 and r["prediction"] == (want[r["row"]] >= 0.5) for r in out)


def zip_rows(model, seen):
    got = seen.collect()
    return [{"row": r["row"], "p": p} for r, p in zip(got, model.probability(np.array([r["x"] for r in got])), strict=True)]


def test_cells_of_a_level_are_summed_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    x, key = rng.integers(0, T.BINS, (4000, 9)).astype(np.uint8), rng.integers(0, 1 << 60, 4000)
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(4000) < 0.1)).astype(np.uint8)
    fit = T.Fit(0, "forest", 1, weights=(0.6, 2.5))
    whole = T.grow_forest(x, y, key, 0, fit)
    held = []
    summed = T.cells
    monkeypatch.setattr(T, "cells", lambda key, sums, span: held.append(len(key)) or summed(key, sums, span))
    monkeypatch.setattr(T, "RUN", 300)
    parts = T.grow_forest(x, y, key, 0, fit)
    assert all(np.array_equal(getattr(whole, c), getattr(parts, c)) for c in T.Tree.TYPES)
    assert max(held) <= 2 * 300


def test_first_split_equals_brute_force(rows):
    grown = E.grow(rows, [T.Fit(0, "boosted", 1, max_depth=1, step=1.0)])
    tree, edges = grown.of(0)[0], grown.edges[0]
    got = rows.where("grp = 0").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got])
    g, h = 0.5 - y, np.full(len(y), 0.25)
    best = (-1.0, None)
    for j, cuts in enumerate(edges):
        for c in cuts:
            m = x[:, j] <= c
            if h[m].sum() < 1 or h[~m].sum() < 1:
                continue
            gain = 0.5 * (g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1) - g.sum() ** 2 / (h.sum() + 1))
            if gain > best[0] + 1e-9:
                best = gain, (j, c, -g[m].sum() / (h[m].sum() + 1), -g[~m].sum() / (h[~m].sum() + 1))
    j, c, left, right = best[1]
    assert tree.feature[0] == j and edges[j][tree.cut[0]] == c
    assert np.allclose(T.leaf_values(tree, grown.fits[0])[1:], [left, right])


def test_forest_split_equals_brute_force():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 6, (60, 2)).astype(np.uint8), rng.integers(0, 2, 60)
    fit = T.Fit(0, "forest", 1, min_leaf=3, weights=(1.0, 1.7), features=2)
    tried = np.array([[1, 0]])
    key, sums = T.node_cells(x, np.arange(60), np.zeros(60, int), tried, (y == 0).astype(int), (y == 1).astype(int))
    _, slot, cut, gain, left, right = T.forest_splits(key, sums, 2, fit)

    def gini(m):
        w = np.where(y[m] == 1, 1.7, 1.0)
        p = w[y[m] == 1].sum() / w.sum()
        return w.sum() * 2 * p * (1 - p)

    scores = {(j, c): gini(x[:, tried[0, j]] <= c) + gini(x[:, tried[0, j]] > c) for j in range(2) for c in range(6)
              if 3 <= (x[:, tried[0, j]] <= c).sum() <= 57}
    assert np.isclose(scores[slot[0], cut[0]], min(scores.values()))
    assert left[0, 2] + right[0, 2] == 60


def test_held_rows_are_counted_as_the_model_scores_them(rows):
    grown = E.grow(rows, [T.Fit(0, "forest", 5), T.Fit(1, "boosted", 4, max_depth=3)])
    variants = [(0, 5, T.UNLIMITED, 2), (0, 3, 2, 10), (1, 4, T.UNLIMITED, 2)]
    got = E.held_confusion(grown, rows, variants)
    for v, (i, n, depth, least) in enumerate(variants):
        some = rows.where(F.col("grp") == i).collect()
        x, y = np.array([r["x"] for r in some]), np.array([r["y"] for r in some])
        model = grown.model(i, depth, least, n)
        said = model.probability(x) >= 0.5
        assert got[v] == ((said & (y == 1)).sum(), (said & (y == 0)).sum(), (~said & (y == 1)).sum())


def test_grouped_importances_are_the_models_own(rows):
    grown = E.grow(rows, [T.Fit(0, "forest", 5), T.Fit(1, "boosted", 4, max_depth=3)])
    for i, share in grown.importances().items():
        assert np.allclose(share, grown.model(i).importance) and share[3] == 0
    with pytest.raises(ValueError, match="no rows"):
        E.grow(rows, [T.Fit(9, "forest", 1)])


def test_a_pass_of_boosting_moves_one_row_a_task_and_node(rows):
    order, fits = {0: [0], 1: [1]}, {0: T.Fit(0, "boosted", 1, share=0.6), 1: T.Fit(1, "boosted", 1, subsample=0.5)}
    data = E.bin_rows(rows)
    state = E.with_margins(data.blocks, order)
    tops = {(i, 0): E._Top(np.uint64(0)) for i in fits}
    asked = (state, fits, tops, {ft: {0: 0} for ft in tops}, {0: [], 1: []}, 0, order)
    parts = E._boosted_parts(*asked).collect()
    assert 2 <= len(parts) <= 2 * state.rdd.getNumPartitions()
    cells = {(r["fit"], r["cell"]): (r["a"], r["b"], r["n"]) for r in E.boosted_histograms(*asked).collect()}
    assert {c // T.BINS for i, c in cells if i == 0} == set(T.drawn_columns(5, fits[0], 0))
    for i in fits:
        one = next(c // T.BINS for f, c in cells if f == i)
        n = sum(v[2] for (f, c), v in cells.items() if f == i and c // T.BINS == one)
        assert n == sum(data.sizes[i]) if i == 0 else 0 < n < sum(data.sizes[i])
        assert sum(v[1] for (f, c), v in cells.items() if f == i and c // T.BINS == one) == n * T.FIX / 4


def test_rows_go_down_small_and_large_trees_alike(monkeypatch):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, T.BINS, (3000, 4)).astype(np.uint8), rng.integers(0, 2, 3000).astype(np.uint8)
    tree = T.grow_forest(x, y, np.arange(3000), 0, T.Fit(0, "forest", 1, max_depth=7))
    small = T.descend(tree.feature, tree.cut, tree.left, x)
    monkeypatch.setattr(T, "SMALL_TREE", 0)
    assert np.array_equal(small, T.descend(tree.feature, tree.cut, tree.left, x)) and len(set(small)) > 20
    assert (tree.feature[small] < 0).all() and len(T.descend(tree.feature, tree.cut, tree.left, x[:0])) == 0


def test_a_block_draws_a_bag_once_for_the_fits_of_a_seed(monkeypatch):
    key, drawn = np.arange(500), []
    own = T.bag
    monkeypatch.setattr(T, "bag", lambda *a: drawn.append(a[1:]) or own(*a))
    block = np.random.default_rng(1).integers(0, T.BINS, (500, 4)).astype(np.uint8)
    bags, views = {}, {}
    for columns in ((0, 2), (3, 1), None):
        fit = T.Fit(0, "forest", 2, columns=columns)
        assert np.array_equal(E._seen(block, fit, views), fit.seen(block))
        for tree in range(2):
            assert np.array_equal(E._bag(key, fit, tree, bags), own(key, 42, tree))
    assert drawn == [(42, 0), (42, 1)]


def test_a_large_forest_stays_in_parts_and_says_the_same(spark, rows, tmp_path):
    from strata.operators.model import TreesModel
    fits = [T.Fit(0, "forest", 4, weights=(0.6, 2.5)), T.Fit(1, "forest", 3, min_split=4)]
    near, far = E.grow(rows, fits), E.grow(rows, fits, local_bytes=1500)
    sizes = {(r["fit"], r["tree"], r["part"]): r["n"] for r in
             far.trees.select("fit", "tree", "part", F.length("cut").alias("n")).collect()}
    for i in range(2):
        assert len({t for f, t, _ in sizes if f == i}) == fits[i].trees
        largest = max(len(t.feature) for t in far.of(i))
        assert max(n for (f, *_), n in sizes.items() if f == i) < 0.8 * largest     # no row holds a tree
    whole, spread = near.model(0), far.model(0, model_bytes=0)
    seen = rows.select(F.monotonically_increasing_id().alias("row"), "x").cache()
    want = {r["row"]: r["p"] for r in zip_rows(whole, seen)}
    for part_bytes in (2000, E.PART_BYTES):
        got = {r["row"]: r["p"] for r in spread.scores(seen, part_bytes).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - p) < 1e-12 for k, p in want.items())
    assert np.allclose(spread.importance, whole.importance)
    x = np.array([r["x"] for r in seen.collect()])
    TreesModel(spread).save(spark, str(tmp_path))
    again = TreesModel.load(spark, str(tmp_path)).model
    assert len(again.features) == 4 and np.allclose(again.probability(x), whole.probability(x), atol=1e-12, rtol=0)
    cut = far.model(0, 3, 20, model_bytes=0)     # ends inside the top of the trees
    small = {r["row"]: r["p"] for r in zip_rows(near.model(0, 3, 20), seen)}
    assert all(abs(r["p"] - small[r["row"]]) < 1e-12 for r in cut.scores(seen).collect())
    variants = [(0, 4, T.UNLIMITED, 2), (0, 3, 3, 20), (0, 2, T.UNLIMITED, 40), (1, 3, 9, 4)]
    assert E.held_confusion(far, rows, variants) == E.held_confusion(near, rows, variants)
    ours, theirs = far.importances(), near.importances()
    assert all(np.allclose(ours[i], theirs[i]) for i in range(2))


def test_a_shallow_forest_is_grown_without_moving_rows(rows):
    fits = [T.Fit(0, "forest", 3, max_depth=E.SHALLOW), T.Fit(0, "forest", 3, max_depth=E.SHALLOW + 1)]
    near, far = E.grow(rows, fits), E.grow(rows, fits, local_bytes=1500)
    parts = {r["fit"]: r["n"] for r in far.trees.groupBy("fit").agg(F.max("part").alias("n")).collect()}
    assert parts[0] == 0 and parts[1] > 0       # a part above 0 is what one task grew from rows sent there
    for i in range(2):
        _same(near.of(i), far.of(i))


def test_columns_summed_two_at_a_time_say_the_same(monkeypatch):
    rng = np.random.default_rng(6)
    xt, at = rng.integers(0, T.BINS, (5, 40000)).astype(np.uint8), rng.integers(0, 2, 40000)
    g, h = np.rint(rng.normal(0, 0.4, 40000) * T.FIX), np.rint(rng.random(40000) * T.FIX)
    counted = []
    own = np.bincount
    monkeypatch.setattr(T.np, "bincount", lambda *a, **k: counted.append(len(a[0])) or own(*a, **k))
    both = T.histograms(xt, at, 2, g, h, rows=True)
    assert len(counted) == 3 * 3        # two pairs and a column, three kinds
    monkeypatch.setattr(T, "PAIRED", 0)
    assert np.array_equal(both, T.histograms(xt, at, 2, g, h, rows=True))
    assert both.sum() == 5 * (g.sum() + h.sum() + 40000)


def test_a_boosted_tree_takes_its_rows_column_by_column(monkeypatch):
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, T.BINS, (3000, 6)).astype(np.uint8), rng.integers(0, 2, 3000)
    fit = T.Fit(0, "boosted", 2, max_depth=4, subsample=0.7, share=0.7)
    taken, own = [], T.some_rows
    monkeypatch.setattr(T, "some_rows", lambda xt, columns, rows: taken.append(xt) or own(xt, columns, rows))
    trees = E._boosted(x, y, np.arange(3000), fit)
    assert all(xt.flags.c_contiguous for xt in taken) and {len(xt) for xt in taken} == {4, 6}
    for xt in taken:
        rows = np.sort(rng.choice(xt.shape[1], 50))
        assert np.array_equal(own(xt, [2, 0], rows), xt[[2, 0]][:, rows])
    assert len(trees) == 2 and all((t.feature >= 0).any() for t in trees)


def test_cells_of_few_rows_share_a_double(monkeypatch):
    rng = np.random.default_rng(9)
    x, key = rng.integers(0, T.BINS, (3000, 9)).astype(np.uint8), rng.integers(0, 1 << 60, 3000)
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(3000) < 0.1)).astype(np.uint8)
    fit, said = T.Fit(0, "forest", 1, weights=(0.6, 2.5)), []
    own = T.packed
    monkeypatch.setattr(T, "packed", lambda *a: said.append(own(*a)) or said[-1])
    few = T.grow_forest(x, y, key, 0, fit)
    assert said and all(v is not None for v in said) and own(np.full(9, 1 << 17), np.zeros(9), 3) is None
    monkeypatch.setattr(T, "packed", lambda *a: None)
    plain = T.grow_forest(x, y, key, 0, fit)
    assert all(np.array_equal(getattr(few, c), getattr(plain, c)) for c in T.Tree.TYPES)


def test_a_large_node_is_summed_column_by_column(monkeypatch):
    rng = np.random.default_rng(11)
    x, key = rng.integers(0, T.BINS, (30000, 9)).astype(np.uint8), rng.integers(0, 1 << 60, 30000)
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(30000) < 0.1)).astype(np.uint8)
    a, b, tried = rng.integers(1, 4, 20000) * (y[:20000] == 0), 1 * (y[:20000] == 1), np.array([7, 0, 4])
    want = T.node_cells(x, np.arange(20000), np.zeros(20000, int), tried[None, :], a, b)
    for strip in (T.STRIP, 13000, 700):
        monkeypatch.setattr(T, "STRIP", strip)
        got = T.large_node_cells(np.ascontiguousarray(x.T), np.arange(20000), tried, a, b)
        assert all(np.array_equal(p, q) for p, q in zip(want, got, strict=True))
    fit, seen, own = T.Fit(0, "forest", 1, weights=(0.6, 2.5)), [], T.node_cells
    monkeypatch.setattr(T, "node_cells", lambda x, rows, at, *a: seen.append(np.bincount(at).max()) or own(x, rows, at, *a))
    alone = T.grow_forest(x, y, key, 0, fit)
    assert max(seen) < T.LARGE < 30000
    monkeypatch.setattr(T, "LARGE", 1 << 30)
    together = T.grow_forest(x, y, key, 0, fit)
    assert all(np.array_equal(getattr(alone, c), getattr(together, c)) for c in T.Tree.TYPES)


def test_a_deep_forest_of_a_middling_group_is_grown_in_tasks(rows, monkeypatch):
    monkeypatch.setattr(E, "FOREST_BYTES", 1500)
    fits = [T.Fit(0, "forest", 3, max_depth=E.SHALLOW), T.Fit(0, "forest", 3)]
    ways, near, far = {}, E._near, E._far_forests
    monkeypatch.setattr(E, "_near", lambda blocks, some: ways.update(near=list(some)) or near(blocks, some))
    monkeypatch.setattr(E, "_far_forests", lambda blocks, some, *a: ways.update(far=list(some)) or far(blocks, some, *a))
    grown = E.grow(rows, fits)
    assert ways == {"near": [1], "far": [0]}        # rows move once a task, not once a tree; a shallow one moves none
    monkeypatch.undo()
    _same(grown.of(1), E.grow(rows, fits, local_bytes=1500).of(1))


def test_many_shallow_forests_of_a_group_are_grown_where_its_columns_lie(rows, monkeypatch):
    columns = [None, (0, 2), (1,)]
    fits = [T.Fit(g, "forest", 6 + g, max_depth=4, weights=(0.6, 2.5), seed=41 + g, columns=c) for g in (0, 1) for c in columns]
    want, ways, shared = E.grow(rows, fits), [], E._shared
    monkeypatch.setattr(E, "_shared", lambda blocks, some: ways.append(list(some)) or shared(blocks, some))
    monkeypatch.setattr(E, "_far_forests", None)
    monkeypatch.setattr(E, "FOREST_BYTES", 0)
    got = E.grow(rows, fits)
    assert ways == [list(range(6))]
    for i in range(6):
        _same(want.of(i), got.of(i))


@pytest.mark.parametrize("most", [300, 1 << 20])
def test_a_shallow_tree_is_the_same_from_strips_of_rows(most):
    rng = np.random.default_rng(5)
    x, key = rng.integers(0, T.BINS, (2000, 9)).astype(np.uint8), rng.integers(0, 1 << 60, 2000)
    x[:, 3:] = 7        # most columns have no cut
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(2000) < 0.1)).astype(np.uint8)
    for fit in (T.Fit(0, "forest", 3, max_depth=5, min_leaf=3), T.Fit(0, "forest", 3, max_depth=2, columns=(4, 1, 0))):
        bags = []
        for at in range(0, 2000, most):
            drawn, code = T.bagged(key[at:at + most], y[at:at + most], fit.seed, 2)
            bags.append(((drawn + at).astype(np.int32), code))
        kept = [(r.copy(), c.copy()) for r, c in bags]
        got, want = T.grow_shallow(np.ascontiguousarray(x.T), bags, 2, fit), T.grow_forest(fit.seen(x), y, key, 2, fit)
        assert all(np.array_equal(getattr(got, c), getattr(want, c)) for c in T.Tree.TYPES)
        assert all(np.array_equal(p, q) for b, k in zip(bags, kept, strict=True) for p, q in zip(b, k, strict=True))


def test_rows_copied_into_node_order_grow_the_same_tree(monkeypatch):
    rng = np.random.default_rng(8)
    x, key = rng.integers(0, T.BINS, (9000, 6)).astype(np.uint8), rng.integers(0, 1 << 60, 9000)
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(9000) < 0.2)).astype(np.uint8)
    trees = []
    for again in (1, 3, 1 << 30):
        monkeypatch.setattr(T, "AGAIN", again)
        trees.append(T.grow_forest(x, y, key, 0, T.Fit(0, "forest", 1)))
    assert all(np.array_equal(getattr(t, c), getattr(trees[0], c)) for t in trees for c in T.Tree.TYPES)


def test_rows_of_few_trees_are_on_the_move_at_a_time(rows, monkeypatch):
    fits = [T.Fit(0, "forest", 4), T.Fit(1, "forest", 2, min_leaf=2)]
    given, drop, names = [], E.drop_shuffles, []
    mapped = E._mapped
    monkeypatch.setattr(E, "drop_shuffles", lambda spark: given.append(1) or drop(spark))
    monkeypatch.setattr(E, "_mapped", lambda df, run, schema: names.append(schema) or mapped(df, run, schema))
    monkeypatch.setattr(E, "ROUTED_BYTES", 1)
    far = E.grow(rows, fits, local_bytes=1500)
    assert len(given) == 6      # a tree at a time
    assert [n for n in names if "node int, x binary" in n] == ["fit int, tree int, node int, x binary, code binary"] * 6
    monkeypatch.undo()
    near = E.grow(rows, fits)
    for i in range(2):
        _same(near.of(i), far.of(i))


def test_rows_are_deleted_once_they_are_binned(spark, rows):
    from strata.session import cut_lineage, drop_written
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def kept():
        return {f.getPath().getName() for f in files.listStatus(at)}

    before = kept()
    data = E.bin_rows(rows)
    assert len(kept() - before) == 1 and data.blocks.count() > 0
    own = cut_lineage(rows.limit(5))
    drop_written(own)
    assert len(kept() - before) == 1


def test_a_held_row_goes_down_a_tree_once_for_all_limits():
    rng = np.random.default_rng(12)
    x, key = rng.integers(0, T.BINS, (3000, 5)).astype(np.uint8), rng.integers(0, 1 << 60, 3000)
    y = ((x[:, 0] > 30) & (x[:, 1] > 20) | (rng.random(3000) < 0.2)).astype(np.uint8)
    tree = T.grow_forest(x, y, key, 0, T.Fit(0, "forest", 1))
    at = T.descend(tree.feature, tree.cut, tree.left, x)
    for limit in ((T.UNLIMITED, 2), (4, 2), (0, 2), (T.UNLIMITED, 50), (7, 9)):
        assert np.array_equal(tree.ends(*limit)[at], T.descend(tree.stopped(*limit), tree.cut, tree.left, x))
