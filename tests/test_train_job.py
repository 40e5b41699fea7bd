"""The train job on a table of the caller's own: run row, report, bundle gate."""
import inspect
import json

import pytest
from pyspark.sql import functions as F

from strata.operators import model as M
from strata.operators.evaluate import ParityError
from strata.plans import train_job as TJ
from strata.sources import bundle as B
from strata.spec import CohortSpec

SPEC = CohortSpec(entity=("patient",), seq="hour", measures=("pulse", "temp", "never"), statics=("age",),
                  row_label="ill")


@pytest.fixture(scope="module")
def long_rows(spark):
    e = F.floor(F.col("id") / 4)
    u = (F.xxhash64("id") % 1000).cast("double") / 1000
    ill = (e % 4 == 0).cast("int")
    return spark.range(1200).select(
        e.alias("patient"), (F.col("id") % 4).alias("hour"), (70 + 12 * ill + 5 * u).alias("pulse"),
        F.when(F.col("id") % 7 != 0, 36.5 + u).alias("temp"), (20 + e % 60).cast("double").alias("age"),
        F.when(F.col("id") % 4 == 3, ill).otherwise(0).alias("ill"))


def test_train_job_takes_a_path_and_a_spec(spark, long_rows, tmp_path):
    src, out = str(tmp_path / "long"), str(tmp_path / "out")
    long_rows.write.parquet(src)
    row = TJ.train_job(spark, src, SPEC, out, folds=2, k_features=3, n_draws=1, demo_samples=10,
                       forest_grid={"numTrees": [3], "maxDepth": [3]},
                       boosted_space={"maxIter": ("int", 2, 3), "maxDepth": ("int", 2, 2)}).first()
    assert row.n_train == 240 and row.n_test == 60 and row.winner in ("forest", "boosted")
    for kind in ("forest", "boosted"):
        m = row[kind]
        assert sum(m.confusion) == 60 and m.n_features == 3 and json.loads(m.best_params)
        assert m.f1 > 0.8 and 0 <= m.precision <= 1 and 0 <= m.recall <= 1
    pack = spark.read.json(f"{out}/report").first()
    c = pack.meta.confusion
    assert c.tp + c.fn + c.fp + c.tn == 60 and pack.meta.n_train == 240 and pack.meta.n_demo_samples == 10
    assert pack.meta.accuracy == round((c.tp + c.tn) / 60, 4) and len(pack.top_features) == 3
    assert spark.read.json(f"{out}/metrics").first().winner == row.winner
    assert B.load_bundle(spark, f"{out}/bundle").features == pack.features


def test_train_job_takes_string_and_composite_keys(spark, long_rows):
    e = F.col("patient")
    rows = long_rows.select(F.concat(F.lit("p"), e % 30).alias("name"), F.expr("date'2020-01-01'").alias("day"),
                            *[c for c in long_rows.columns]).withColumn("day", F.date_add("day", F.floor(e / 30).cast("int")))
    spec = CohortSpec(entity=("name", "day"), seq="hour", measures=SPEC.measures, statics=SPEC.statics, row_label="ill")
    ent, key = TJ.keyed_entities(TJ.entity_table(rows, spec.resolve(rows)), spec)
    ids = {(r["name"], r["day"]): r[key] for r in ent.collect()}
    assert sorted(ids.values()) == list(range(1, 301)) and sorted(ids) == sorted(ids, key=ids.get)
    row = TJ.train_job(spark, rows, spec, folds=2, k_features=3, n_draws=1, demo_samples=10,
                       forest_grid={"numTrees": [3], "maxDepth": [3]},
                       boosted_space={"maxIter": ("int", 2, 3), "maxDepth": ("int", 2, 2)}).first()
    assert row.n_train == 240 and row.n_test == 60 and all(sum(row[k].confusion) == 60 for k in ("forest", "boosted"))


def test_train_job_names_what_it_cannot_take(spark, long_rows):
    with pytest.raises(ValueError, match="entity and sequence"):
        TJ.train_job(spark, long_rows, CohortSpec(entity=("ward", "patient"), seq="hour", measures=("pulse",)))
    clash = long_rows.select("*", F.lit("x").alias("name"), F.lit(1.0).alias("entity_id"))
    with pytest.raises(ValueError, match="entity_id"):
        TJ.train_job(spark, clash, CohortSpec(entity=("name", "patient"), seq="hour", measures=("pulse",),
                                              statics=("entity_id",), row_label="ill"))


def test_a_bundle_that_reads_back_otherwise_is_not_published(spark, tmp_path, monkeypatch):
    df = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"),
                                (F.col("id") % 10 > 6).cast("double").alias("label"))
    scaler = M.PopulationScaler(inputCols=["x"]).fit(df)
    model = M.random_forest(num_trees=2, max_depth=2).fit(scaler.transform(df))
    good = B.Bundle(model, ["x"], scaler.means, scaler.scales, 0.5, "forest")
    path = str(tmp_path / "b")
    assert B.publish_bundle(spark, good, path, df, "k").threshold == 0.5
    read = B.load_bundle

    def shifted(spark, where):
        b = read(spark, where)
        b.scaler_mean = [m + 5 for m in b.scaler_mean]
        return b

    monkeypatch.setattr(B, "load_bundle", shifted)
    worse = B.Bundle(model, ["x"], scaler.means, scaler.scales, 0.4, "forest")
    with pytest.raises(ParityError):
        B.publish_bundle(spark, worse, path, df, "k")
    assert read(spark, path).threshold == 0.5


def _constant_bundle(spark, threshold):
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"),
                                (F.col("id") % 10 > 6).cast("double").alias("label"))
    scaler = M.PopulationScaler(inputCols=["x"]).fit(df)
    model = M.random_forest(num_trees=2, max_depth=2).fit(scaler.transform(df))
    return df, B.Bundle(model, ["x"], scaler.means, scaler.scales, threshold, "forest")


def test_a_failed_publication_leaves_the_old_bundle(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    df, old = _constant_bundle(spark, 0.25)
    B.publish_bundle(spark, old, path, df, "k")
    new = B.Bundle(**{**old.__dict__, "threshold": 0.75})
    with monkeypatch.context() as m:
        m.setattr(B, "require_parity", lambda *a: (_ for _ in ()).throw(OSError("lost between trial and publication")))
        with pytest.raises(OSError):
            B.publish_bundle(spark, new, path, df, "k")
    assert B.load_bundle(spark, path).threshold == 0.25
    (tmp_path / "b" / "pointers" / "00000002").write_text("")         # a publisher that died before its pointer's text
    assert B.load_bundle(spark, path).threshold == 0.25
    assert B.publish_bundle(spark, new, path, df, "k").threshold == 0.75


def test_of_two_publishers_one_wins(spark, tmp_path):
    path = str(tmp_path / "b")
    df, first = _constant_bundle(spark, 0.25)
    second = B.Bundle(**{**first.__dict__, "threshold": 0.75})
    B.publish_bundle(spark, first, path, df, "k", after=0)
    with pytest.raises(B.PublishConflict):
        B.publish_bundle(spark, second, path, df, "k", after=0)
    assert B.load_bundle(spark, path).threshold == 0.25
    assert B.publish_bundle(spark, second, path, df, "k").threshold == 0.75


def test_a_replayed_run_logs_each_event_once(spark, tmp_path):
    from strata.operators.scoring import log_scores, read_log
    path = str(tmp_path / "audit")
    scored = spark.range(10).select(F.col("id").alias("k"), F.lit(0.5).alias("p"))
    for run in ("2024-01-01", "2024-01-01", "b"):
        log_scores(scored, path, 0.4, "forest", run_id=run)
    got = {r["run_id"]: r["count"] for r in read_log(spark, path).groupBy("run_id").count().collect()}
    assert got == {"2024-01-01": 10, "b": 10}
    with pytest.raises(ValueError):
        log_scores(scored, path, 0.4, "forest", run_id="../x")


def test_published_widths_and_search():
    assert TJ.sweep_widths(12) == list(range(1, 13)) and TJ.sweep_widths(45) == [*range(1, 21), 30, 40]
    assert len(M.param_grid(M.random_forest(), TJ.FOREST_GRID)) == 8
    draws = M.random_param_maps(M.boosted_trees(), TJ.BOOSTED_SPACE, 25)
    assert len(draws) == 25
    for d in draws:
        v = {p.name: x for p, x in d.items()}
        assert 50 <= v["maxIter"] <= 400 and 2 <= v["maxDepth"] <= 8 and 0.01 <= v["stepSize"] <= 0.3
        assert 0.5 <= v["subsamplingRate"] <= 1 and 0.5 <= float(v["featureSubsetStrategy"]) <= 1


def test_eliminations_to_several_widths_equal_single_ones(spark):
    df = spark.range(200).select(
        (F.col("id") % 2).cast("double").alias("label"),
        *[((F.col("id") % 2) * (i % 3) + (F.xxhash64("id", F.lit(i)) % 100) / 100).alias(f"f{i}") for i in range(6)])
    x = M.PopulationScaler(inputCols=[f"f{i}" for i in range(6)]).fit(df).transform(df)
    both = M.RecursiveEliminator(step=0.5, rankerTrees=4, rankerDepth=3).fit_widths(x, [2, 4])
    for k in (2, 4):
        alone = M.RecursiveEliminator(k=k, step=0.5, rankerTrees=4, rankerDepth=3).fit(x)
        assert both[k].indices == alone.indices and len(alone.indices) == k


def test_registered_searches_are_the_published_ones(spark, monkeypatch):
    from unittest.mock import MagicMock

    from strata.plans import catalog as C

    class Stop(Exception):
        pass

    def called(name, target, owner):
        seen = {}

        def stop(*args, **kwargs):
            seen.update(inspect.signature(real).bind(*args, **kwargs).arguments)
            raise Stop

        real = getattr(owner, target)
        with monkeypatch.context() as m:
            m.setattr(owner, target, stop)
            m.setattr(TJ, "prepared", lambda *a: (MagicMock(), MagicMock(kept=["x"])))
            m.setattr(TJ, "with_validation", lambda d: d)
            m.setattr(C.V, "v_wide_raw", lambda *a: None)
            with pytest.raises(Stop):
                C.QUERIES[name](None, "")
        return seen

    assert set(called("leakfree_cv", "leakfree_cv", TJ)) == {"spark", "data", "feats"}
    for name in ("grid_search", "finalize", "report_pack", "random_search"):
        got = called(name, "tune", TJ)
        boosted = name == "random_search"
        assert got["kind"] == ("boosted" if boosted else "forest"), name
        assert got.get("grid_values") == (None if boosted else TJ.FOREST_GRID), name
        assert got.get("space") == (TJ.BOOSTED_SPACE if boosted else None), name
        assert (got.get("n_folds", 5), got.get("k_features", 50), got.get("n_draws", 25)) == (5, 50, 25), name
    assert set(called("train_job", "train_job", TJ)) == {"spark", "source", "spec"}
    assert called("deployable_fit", "rfe_select", TJ)["k"] == 50
    assert called("gbt_baseline", "boosted_trees", M)["max_depth"] == 6


def test_a_query_prepares_its_rows_once(monkeypatch):
    from unittest.mock import MagicMock

    from strata.plans import catalog as C

    class Stop(Exception):
        pass

    def stop(*args, **kwargs):
        raise Stop

    ready, made, passed = (MagicMock(), MagicMock(kept=["x"])), [], []
    with monkeypatch.context() as m:
        m.setattr(TJ, "prepared", lambda *a: made.append(a) or ready)
        m.setattr(TJ, "rfe_select", lambda *a, ready=None, **k: passed.append(ready) or MagicMock())
        m.setattr(TJ, "baseline", lambda spark, sf, kind, ready=None: passed.append(ready) or (None, None, None, ["x"]))
        for owner, target, run in ((M, "deployable_fit", C.QUERIES["deployable_fit"]), (C.RP, "importance_table",
                                   C.QUERIES["observation_sheet"]), (TJ, "Bundle", TJ.score_with_bundle)):
            m.setattr(owner, target, stop)
            with pytest.raises((Stop, AttributeError)):
                run(None, "")
    assert len(made) == 3 and passed == [ready] * 3
    monkeypatch.setattr(TJ, "prepared", lambda *a: made.append(a))
    monkeypatch.setattr(M, "random_forest", stop)
    monkeypatch.setattr(M, "PopulationScaler", stop)
    for run in (TJ.baseline, TJ.rfe_select):
        with pytest.raises(Stop):
            run(None, "", ready=ready)
    assert len(made) == 3
