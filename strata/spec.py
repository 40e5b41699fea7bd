"""CohortSpec: which columns of a long table are the entity key, the sequence
counter, the measures, the per-entity statics and the row label."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

# The base per-measure aggregates, in output order, and the
# derived range aggregate.
BASE_AGGS = ("min", "max", "mean", "std")
RANGE_AGG = "range"


@dataclass(frozen=True)
class CohortSpec:
    entity: tuple[str, ...]
    seq: str
    measures: tuple[str, ...]
    statics: tuple[str, ...] = ()
    row_label: str = "is_pos"
    target: str = "label"
    aggs: tuple[str, ...] = field(default=BASE_AGGS)

    def __post_init__(self):
        if isinstance(self.entity, str):
            object.__setattr__(self, "entity", (self.entity,))

    def resolve(self, df: DataFrame) -> "CohortSpec":
        """Keep only the measures / statics that exist in ``df`` (the input is
        allowed to carry a subset of the listed measures)."""
        cols = set(df.columns)
        return replace(
            self,
            measures=tuple(m for m in self.measures if m in cols),
            statics=tuple(s for s in self.statics if s in cols),
        )

    @property
    def length_col(self) -> str:
        return f"{self.seq}_max"

    def feature_columns(self) -> list[str]:
        """Entity-table feature columns in output order (statics, per-measure
        base aggregates, ranges, length)."""
        out = list(self.statics)
        for m in self.measures:
            out += [f"{m}_{a}" for a in self.aggs]
        out += [f"{m}_{RANGE_AGG}" for m in self.measures]
        out.append(self.length_col)
        return out
