"""Cohort views on the driver's tables (see FIXTURES.md part B).

* V-ORD  — "stay" table: one row per lineitem, entity = order, seq = line
  number, four measures, two statics from orders, a row-level label.
* V-DAY  — sparse table from events: entity = (user, day), seq = hour, mean
  value per event type (mostly missing), row label = any error event.
* V-SCORE — deterministic pseudo-scores per V-ORD entity, for the evaluation
  operators without a model.

Each view is a lazy DataFrame; only the referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregate import entity_table
from strata.sources.tables import normalize_raw, table
from strata.spec import CohortSpec

# Fixed values of the views.
ORD_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORD_SPEC = CohortSpec(
    entity=("l_orderkey",), seq="l_linenumber", measures=ORD_MEASURES,
    statics=("o_totalprice", "o_priority"), row_label="is_pos", target="label")

DAY_EVENT_TYPES = ("click", "view", "signup", "purchase")
DAY_BIG_CLICK = 150.0
DAY_MEASURES = DAY_EVENT_TYPES + ("click_big", "const_one")
DAY_SPEC = CohortSpec(
    entity=("user_id", "day"), seq="hr", measures=DAY_MEASURES,
    statics=(), row_label="is_pos", target="label")


def _ord_label() -> Column:
    return ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 40) & (F.col("l_discount") >= 0.08)).cast("int")


def v_ord_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *ORD_MEASURES, "l_returnflag")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_totalprice",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("o_priority"))
    is_pos = _ord_label().alias("is_pos")
    raw = li.join(o, "l_orderkey", "inner").select(
        "l_orderkey", "l_linenumber", *ORD_MEASURES, "o_totalprice", "o_priority", is_pos)
    return normalize_raw(raw, ORD_SPEC)


def v_ord_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_table(v_ord_raw(spark, sf_dir), ORD_SPEC)


# V-WIDE: V-ORD with every measure also by line status and by return flag.
WIDE_PARTS = [("l_linestatus", v) for v in ("F", "O")] + [("l_returnflag", v) for v in ("A", "N", "R")]
WIDE_MEASURES = ORD_MEASURES + tuple(f"{m}_{v.lower()}" for _, v in WIDE_PARTS for m in ORD_MEASURES)
WIDE_SPEC = CohortSpec(entity=("l_orderkey",), seq="l_linenumber", measures=WIDE_MEASURES,
                       statics=("o_totalprice", "o_priority"), row_label="is_pos", target="label")


def v_wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-ORD's rows and label with 24 measures, most of them often missing: 123 entity features."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *ORD_MEASURES, "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_totalprice",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("o_priority"))
    parts = [F.when(F.col(c) == v, F.col(m)).alias(f"{m}_{v.lower()}") for c, v in WIDE_PARTS for m in ORD_MEASURES]
    is_pos = _ord_label().alias("is_pos")
    return normalize_raw(li.join(o, "l_orderkey", "inner").select(
        "l_orderkey", "l_linenumber", *ORD_MEASURES, *parts, "o_totalprice", "o_priority", is_pos), WIDE_SPEC)


def v_wide_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_table(v_wide_raw(spark, sf_dir), WIDE_SPEC)


def v_day_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hr"), "event_type", "value")
    et, v = F.col("event_type"), F.col("value")
    per_type = [F.avg(F.when(et == t, v)).alias(t) for t in DAY_EVENT_TYPES]
    big = F.avg(F.when((et == "click") & (v > DAY_BIG_CLICK), v)).alias("click_big")
    raw = (ev.groupBy("user_id", "day", "hr")
           .agg(*per_type, big, F.max((et == "error").cast("int")).alias("is_pos"))
           .withColumn("const_one", F.lit(1.0)))
    return normalize_raw(raw, DAY_SPEC)


def v_day_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_table(v_day_raw(spark, sf_dir), DAY_SPEC)


def v_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, label, p, p2): two deterministic scores with heavy ties."""
    li = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")     # no column of orders is used
    agg = li.groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("mq"), F.max("l_discount").alias("md"), F.max(_ord_label()).alias("label"))
    p = F.round(F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), 0.5 * F.col("mq") / 50 + 5 * F.col("md") - 0.35)), 2)
    p2 = F.round(0.5 * F.col("mq") / 50, 2)
    return agg.select("l_orderkey", "label", p.alias("p"), p2.alias("p2"))


def v_scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, l_orderkey, label, p): both pseudo-models stacked, for the
    comparison operators."""
    s = v_score(spark, sf_dir)
    return (s.select(F.lit("forest").alias("model"), "l_orderkey", "label", "p")
            .unionByName(s.select(F.lit("boosted").alias("model"), "l_orderkey", "label",
                                  F.col("p2").alias("p"))))
