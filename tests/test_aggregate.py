"""Toy hourly table: one row per entity, ever-label, range, length, names."""
import math

from pyspark.sql import functions as F

from strata.functions.columns import ordered_bits
from strata.operators.aggregate import entity_statics, entity_table
from strata.operators.profile import class_separation, columns_by_suffix
from strata.sources.tables import normalize_raw
from strata.spec import CohortSpec

SPEC = CohortSpec(entity=("stay_id",), seq="hour", measures=("HR", "Lactate", "Temp"),
                  statics=("Age", "Gender"), row_label="row_flag", target="ever_flag")


def toy(spark):
    rows = [(1, 60, 1, 80.0, 1.0, 1, 0), (1, 60, 1, 90.0, 2.0, 2, 0), (1, 60, 1, 110.0, 4.0, 3, 1),
            (2, 45, 0, 70.0, float("nan"), 1, 0), (2, 45, 0, 72.0, None, 2, 0), (None, 50, 1, 1.0, 1.0, 1, 1)]
    df = spark.createDataFrame(rows, "stay_id long, Age int, Gender int, HR double, Lactate double, "
                                     "hour int, row_flag int")
    return normalize_raw(df, SPEC)


def test_one_row_per_entity(spark):
    ent = entity_table(toy(spark), SPEC)
    assert ent.count() == 2


def test_label_is_ever_positive(spark):
    got = {r.stay_id: r.ever_flag for r in entity_table(toy(spark), SPEC).collect()}
    assert got == {1: 1, 2: 0}


def test_range_and_length(spark):
    r = {x.stay_id: x for x in entity_table(toy(spark), SPEC).collect()}
    assert r[1].HR_range == 30.0
    assert r[1].hour_max == 3 and r[2].hour_max == 2
    assert math.isclose(r[1].HR_std, 15.275252316519467)


def test_column_names_and_absent_measure(spark):
    cols = entity_table(toy(spark), SPEC).columns
    assert [c for c in cols if c.startswith("HR_")] == ["HR_min", "HR_max", "HR_mean", "HR_std", "HR_range"]
    assert not any(c.startswith("Temp") for c in cols)  # listed but absent -> skipped
    assert "row_flag" not in cols and "ever_flag" in cols


def test_nan_and_null_are_missing(spark):
    r = {x.stay_id: x for x in entity_table(toy(spark), SPEC).collect()}
    assert r[2].Lactate_max is None and r[2].Lactate_mean is None and r[2].Lactate_std is None
    assert r[1].Lactate_mean == 7.0 / 3


def test_first_static_by_sequence(spark):
    df = spark.createDataFrame([(1, 3, 30.0), (1, 1, None), (1, 2, 20.0), (2, 1, 5.0)],
                               "k long, s int, a double")
    spec = CohortSpec(entity=("k",), seq="s", measures=(), statics=("a",), row_label="none")
    from strata.operators.aggregate import entity_statics
    got = {r.k: r.a for r in entity_statics(df, spec).collect()}
    assert got == {1: 20.0, 2: 5.0}


def test_first_static_takes_the_smaller_of_a_tie_in_a_hash_aggregate(spark):
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 1.0, 1.0000000000000002, 0.9999999999999999, 2.0, 1.9999999999999998,
           1e308, -1e308, float("inf"), -float("inf"), 8.0, 7.999999999999999, -3.5, 0.1, 0.30000000000000004, None]
    rows = [(e, 1, odd[(e * 7 + i) % 20], (e * 3 + i * 5) % 11 - 5, f"s{(e + i) % 4}") for e in range(40) for i in range(3)]
    rows += [(e, 0, None, None, None) for e in range(40)] + [(e, 2, -9.0, -99, "a") for e in range(40)]
    df = spark.createDataFrame(rows, "stay_id long, hour int, d double, i int, s string")
    spec = CohortSpec(entity=("stay_id",), seq="hour", measures=(), statics=("d", "i"))
    out = entity_statics(df, spec)
    for r in out.collect():
        for c in (2, 3):
            tied = [x[c] for x in rows if x[0] == r.stay_id and x[1] == 1 and x[c] is not None]
            assert r[c - 1] == min(tied)
    assert "SortAggregate" not in out._jdf.queryExecution().toString()
    text = entity_statics(df, CohortSpec(entity=("stay_id",), seq="hour", measures=(), statics=("s",)))
    assert {r.s for r in text.collect()} <= {"s0", "s1", "s2", "s3"}


def test_ordered_bits_order_as_the_doubles(spark):
    import random
    import struct
    rng = random.Random(3)
    vals = [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(3000)]
    vals = [v for v in vals if v == v] + [x * 2.0 ** e for e in range(-1074, 1024) for x in (1.0, 1.0000000000000002)]
    got = [(r.v, r.b) for r in spark.createDataFrame([(v,) for v in vals], "v double").select(
        "v", ordered_bits(F.col("v")).alias("b")).collect()]
    got.sort()
    assert all((a[1] < b[1]) == (a[0] < b[0]) for a, b in zip(got, got[1:]))


def test_entity_table_sorts_nothing(spark):
    from strata.plans import views as V
    plan = V.v_ord_entities(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan.split("== Physical Plan ==")[1].split(
        "SortMergeJoin")[0]


def test_columns_by_suffix():
    assert columns_by_suffix(["a_mean", "b_max", "_mean", "c_mean"], "_mean") == {"a_mean": "a", "c_mean": "c"}


def test_class_separation(spark):
    rows = [(0, 1.0, 5.0, None, 1.0), (0, 3.0, 5.0, 2.0, None), (1, 6.0, 5.0, None, 4.0), (1, 8.0, 5.0, None, 4.5)]
    df = spark.createDataFrame(rows, "label int, up double, flat double, lone double, late double")
    got = {r.feature: r.weight for r in class_separation(df, ["up", "flat", "lone", "late"]).collect()}
    assert got["up"] == round(5.0 / math.sqrt(29.0 / 3), 6)
    assert got["flat"] == 0.0 and got["lone"] == 0.0 and got["late"] > 1
    assert class_separation(df.limit(0), ["up"]).count() == 0


def test_xy_join_builds_its_entities_once(spark, tmp_path):
    from strata.plans.catalog import QUERIES
    spark.createDataFrame([(1, 1, 5.0, 10.0, 0.0, 0.1, "R"), (1, 2, 45.0, 10.0, 0.09, 0.1, "R"), (2, 1, 3.0, 10.0, 0.0, 0.1, "N")],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 9.0, "1-URGENT"), (2, 8.0, "5-LOW"), (3, 8.0, "5-LOW")],
                          "o_orderkey long, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["xy_join"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(1, 25.0, 1), (2, 3.0, 0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 1       # no task holds the sorts and groups of both sides
