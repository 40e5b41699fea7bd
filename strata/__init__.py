"""strata: cohort analytics on Spark.

Turn long per-event / per-hour tables into one row per entity, profile those
rows, split them with exact stratified quotas, prepare features fitted on the
training rows only, train and tune MLlib models inside cross-validation, and
evaluate / score with tie-aware metrics.  Everything is DataFrame / SQL / MLlib;
the few places that need per-partition numpy (exact k-NN for oversampling) go
through Arrow-batched ``mapInPandas``.
"""

from strata.spec import CohortSpec

__all__ = ["CohortSpec"]
__version__ = "0.1.0"
