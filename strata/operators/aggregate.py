"""Entity-level aggregation.

The whole per-entity table is ONE ``groupBy(entity).agg(...)``: partial
aggregation on the map side, one shuffle on the entity key, final aggregation.
The separate per-aggregate tables and the joins between them disappear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import first_non_null_by
from strata.spec import RANGE_AGG, CohortSpec

_AGG = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "std": F.stddev_samp,  # sample std (n-1); one observation -> NULL
}


def measure_aggs(spec: CohortSpec) -> list[Column]:
    """A1 + P4: ``measure_agg`` columns in (measure, agg) order."""
    return [_AGG[a](F.col(m)).alias(f"{m}_{a}") for m in spec.measures for a in spec.aggs]


def static_aggs(spec: CohortSpec, raw: DataFrame) -> list[Column]:
    """A2: first non-missing static per entity in sequence order."""
    return [first_non_null_by(s, spec.seq, raw.schema).alias(s) for s in spec.statics]


def length_agg(spec: CohortSpec) -> Column:
    """A3: length of stay = max of the sequence counter."""
    return F.max(spec.seq).alias(spec.length_col)


def label_agg(spec: CohortSpec) -> Column:
    """A4: ever-positive entity label."""
    return F.max(F.col(spec.row_label).cast("int")).alias(spec.target)


def _range_cols(spec: CohortSpec) -> list[Column]:
    """P5: range = max - min, derived after the aggregate."""
    return [(F.col(f"{m}_max") - F.col(f"{m}_min")).alias(f"{m}_{RANGE_AGG}") for m in spec.measures]


def entity_agg(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    spec = spec.resolve(raw)
    return raw.groupBy(*spec.entity).agg(*measure_aggs(spec))


def entity_range(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    spec = spec.resolve(raw)
    mm = [F.min(m).alias(f"{m}_min") for m in spec.measures] + [
        F.max(m).alias(f"{m}_max") for m in spec.measures]
    return raw.groupBy(*spec.entity).agg(*mm).select(*spec.entity, *_range_cols(spec))


def entity_statics(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    spec = spec.resolve(raw)
    return raw.groupBy(*spec.entity).agg(*static_aggs(spec, raw))


def entity_length(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    return raw.groupBy(*spec.entity).agg(length_agg(spec))


def entity_label(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    return raw.groupBy(*spec.entity).agg(label_agg(spec))


def entity_table(raw: DataFrame, spec: CohortSpec) -> DataFrame:
    """A5: one row per entity: statics, measure_{min,max,mean,std}, measure_range,
    seq_max and the ever-positive label, from a single hash aggregate."""
    spec = spec.resolve(raw)
    has_label = spec.row_label in raw.columns
    aggs = static_aggs(spec, raw) + measure_aggs(spec) + [length_agg(spec)]
    if has_label:
        aggs.append(label_agg(spec))
    agg = raw.groupBy(*spec.entity).agg(*aggs)
    base = [F.col(c) for c in spec.entity] + [F.col(s) for s in spec.statics] + [
        F.col(f"{m}_{a}") for m in spec.measures for a in spec.aggs]
    tail = [F.col(spec.length_col)] + ([F.col(spec.target)] if has_label else [])
    return agg.select(*base, *_range_cols(spec), *tail)


def static_join(ent: DataFrame, dim: DataFrame, key: str | list[str], how: str = "left") -> DataFrame:
    """Attach per-entity attributes held in another table.  Both sides are
    keyed by entity, so Catalyst plans a shuffle join on the key (or a
    broadcast if the dimension is small by its statistics)."""
    return ent.join(dim, key, how)


def xy_join(features: DataFrame, target: DataFrame, key: str | list[str]) -> DataFrame:
    """Re-align features and target that arrive as two tables, by key (no
    positional alignment exists in Spark)."""
    return features.join(target, key, "inner")
