"""Exact bracketed percentiles and distributed ranks / running sums."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import quantile
from strata.operators.quantile import exact_percentiles
from strata.operators.rank import rank_within, running_sums


def test_bracket_path_matches_exact_percentile(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(0, 1, 3000), np.full(1500, 0.25), rng.integers(0, 5, 500)])
    rows = [(("a" if i % 3 else "b"), float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = exact_percentiles(df, ["g"], "v", probs, accuracy=200).collect()
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()
    want = {r.g: r.q for r in want}
    assert len(got) == 2 * len(probs)
    for r in got:
        assert abs(r.q - want[r.g][probs.index(r.p)]) < 1e-12


@pytest.mark.parametrize("accuracy", [100, 10000])
def test_percentiles_at_every_size_and_bracket_width(spark, accuracy):
    rng = np.random.default_rng(3)
    vals = {}
    for n in (1, 2, 6, 999, 40000):
        vals |= {f"smooth{n}": rng.normal(0, 1, n), f"ties{n}": rng.integers(0, 4, n).astype(float),
                 f"heavy{n}": rng.standard_cauchy(n) * 1e6}
    rows = pd.DataFrame([(g, float(x)) for g, v in vals.items() for x in v], columns=["g", "v"])
    nulls = spark.createDataFrame([("smooth6", None), ("none", None)], "g string, v double")
    df = spark.createDataFrame(rows).union(nulls).repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in exact_percentiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    assert len(got) == len(vals) * len(probs)
    for (g, p), q in got.items():
        want = float(np.quantile(vals[g], p))
        assert abs(q - want) <= 1e-9 * max(1.0, abs(want))


def test_a_bracket_that_misses_is_noticed(spark, monkeypatch):
    """With brackets moved away from their statistics every group is done again in full."""
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 5003).cast("double").alias("v"))
    asked = F.percentile_approx
    monkeypatch.setattr(quantile.F, "percentile_approx",
                        lambda c, edges, accuracy: asked(c, [e * 0.3 for e in edges], accuracy))
    got = {r.p: r.q for r in exact_percentiles(df, ["g"], "v", [0.5, 0.9]).collect()}
    vals = [float(i * 7919 % 5003) for i in range(5000)]
    assert all(abs(got[p] - np.quantile(vals, p)) < 1e-9 for p in (0.5, 0.9))


def test_rank_equals_window_rank_any_partitioning(spark):
    rows = [(i, i % 3, float((i * 7919) % 101)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, s int, o double")
    want = {r.id: r.rk for r in df.select("id", F.row_number().over(
        Window.partitionBy("s").orderBy("o", "id")).alias("rk")).collect()}
    for n in (1, 3, 7):
        got = {r.id: r.rank for r in rank_within(df, ["s"], ["o", "id"], n_parts=n).collect()}
        assert got == want


def test_running_sums_grouped(spark):
    rows = [(g, float(i), i) for g in ("x", "y") for i in range(50)]
    df = spark.createDataFrame(rows, "g string, k double, v long")
    out = {(r.g, r.k): r.v_cum for r in running_sums(df, ["k"], ["v"], groups=["g"], n_parts=5).collect()}
    assert out[("x", 49.0)] == sum(range(50)) and out[("y", 10.0)] == sum(range(11))


def test_a_null_group_is_a_group(spark):
    rows = [(i, None if i % 3 == 0 else i % 3, i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s int, o int")
    got = rank_within(df, ["s"], ["o", "id"]).collect()
    assert len(got) == 60
    for s in (None, 1, 2):
        order = [r[0] for r in sorted((x for x in rows if x[1] == s), key=lambda x: (x[2], x[0]))]
        assert [r.id for r in sorted((g for g in got if g.s == s), key=lambda g: g["rank"])] == order
    assert running_sums(df.select("s", "id", "o"), ["id"], ["o"], groups=["s"]).count() == 60
