"""Exact quotas, folds and determinism of the seeded samplers."""
import math

import pytest
from pyspark.sql import functions as F

from strata.operators import sampling as S


def labels(spark, n_pos=293, n_neg=3741):
    rows = [(i, 1 if i < n_pos else 0) for i in range(n_pos + n_neg)]
    return spark.createDataFrame(rows, "k long, label int")


def test_split_quotas_exact(spark):
    df = labels(spark)
    s = S.stratified_split(df, ["k"], "label", 0.2)
    n = df.count()
    n_test = math.ceil(0.2 * n)
    got = {(r.split, r.label): r["count"] for r in s.groupBy("split", "label").count().collect()}
    assert got[("test", 0)] + got[("test", 1)] == n_test
    quotas = S.largest_remainder([(0, 3741), (1, 293)], n - n_test)
    assert got[("train", 1)] == quotas[1] and got[("train", 0)] == quotas[0]


def test_split_is_deterministic_across_partitionings(spark):
    df = labels(spark)
    a = {r.k: r.split for r in S.stratified_split(df.repartition(3), ["k"], "label").collect()}
    b = {r.k: r.split for r in S.stratified_split(df.repartition(11), ["k"], "label").collect()}
    assert a == b


def test_folds_balanced_and_disjoint(spark):
    df = labels(spark)
    f = S.stratified_folds(df, ["k"], "label", 5)
    assert f.select("k").distinct().count() == df.count()
    per = f.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        c = [r["count"] for r in per if r.label == lab]
        assert max(c) - min(c) <= 1 and len(c) == 5


def test_sample_n_and_capped(spark):
    df = labels(spark)
    assert S.stratified_sample_n(df, ["k"], "label", 500).count() == 500
    cap = S.class_capped_sample(df, ["k"], "label", 80)
    got = {r.label: r["count"] for r in cap.groupBy("label").count().collect()}
    assert got == {0: 40, 1: 40}


def test_gaussian_rows(spark):
    st = spark.createDataFrame([("a", 1.0, 2.0), ("b", -3.0, 0.0)], "feature string, mean double, std double")
    g = S.gaussian_rows(spark, st, 2000)
    r = g.agg(F.avg("a"), F.stddev("a"), F.max("b"), F.min("b")).first()
    assert abs(r[0] - 1.0) < 0.5 and 4.0 < r[1] < 6.0 and r[2] == r[3] == -3.0


def test_gaussian_rows_do_not_depend_on_partitions(spark):
    st = spark.createDataFrame([("a", 1.0, 2.0), ("b", -3.0, 0.5)], "feature string, mean double, std double")
    one = sorted(map(tuple, S.gaussian_rows(spark, st, 500).collect()))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "7")
    try:
        assert sorted(map(tuple, S.gaussian_rows(spark, st, 500).collect())) == one
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_split_needs_no_sort_of_the_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    out = S.stratified_split(df, ["k"], "label", 0.2)
    plan = out._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert out.filter("split = 'test'").count() == 600


def test_folds_need_no_range_sort_and_name_a_missing_class(spark):
    df = labels(spark)
    plan = S.stratified_folds(df, ["k"], "label", 5)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()
    holes = df.withColumn("label", F.when(F.col("k") % 10 != 3, F.col("label")))
    for call in (lambda: S.stratified_folds(holes, ["k"], "label", 5), lambda: S.stratified_split(holes, ["k"], "label"),
                 lambda: S.class_capped_sample(holes, ["k"], "label", 4)):
        with pytest.raises(ValueError, match="NULL label"):
            call()
