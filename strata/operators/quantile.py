"""Exact percentiles (linear interpolation) without one task per group.

Spark's exact ``percentile`` merges every distinct value of a group into one
buffer, i.e. the whole column of a feature in one task.  Here, the same at
every size:

1. ``percentile_approx`` (rank error at most n / accuracy) gives, per group and
   p, a bracket [lo, hi] around the order statistics floor((n-1)p) and
   ceil((n-1)p).
2. One pass turns the group into *cells*, disjoint ranges of values in order:
   each distinct value inside a bracket is a cell, each gap between brackets is
   one cell.  A cell keeps its count, smallest and largest value.
3. Running counts over the cells (range partitions, so that a group's cells
   are spread over tasks) tell which cell holds an order statistic.  It is known
   if the cell has one value or if it is the first or last of its cell.
4. That is checked, not assumed: a group whose statistic falls inside a gap
   goes through steps 2 and 3 again with every distinct value as its own cell.

NULLs are ignored; a group without values has no rows; NaN counts as the
largest value.  The table of brackets has one row per group and is broadcast:
groups are features, or features by class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rank import running_sums
from strata.session import cut_lineage


def _cells(rows: DataFrame, groups: list[str], inside: Column, gap: Column) -> DataFrame:
    """(groups..., _lo, _hi, _c, _c_cum): the cells with inclusive running counts."""
    cells = (rows.groupBy(*groups, gap.alias("_gap"), F.when(inside, F.col("_v")).alias("_in"))
             .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_c")))
    return running_sums(cells.select(*groups, "_lo", "_hi", "_c"), ["_lo"], ["_c"], groups=groups)


def _pick(cells: DataFrame, sizes: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    """(groups..., _a0, _b0, _a1, ...): both order statistics of each p, NULL where
    a cell does not tell them."""
    before, upto = F.col("_c_cum") - F.col("_c"), F.col("_c_cum")

    def at(k: Column) -> Column:
        value = (F.when((k == before) | (F.col("_lo") == F.col("_hi")), F.col("_lo"))
                 .when(k == upto - 1, F.col("_hi")))
        return F.max(F.when((k >= before) & (k < upto), value))

    pos = [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    wanted = [e for i, x in enumerate(pos)
              for e in (at(F.floor(x)).alias(f"_a{i}"), at(F.ceil(x)).alias(f"_b{i}"))]
    return cells.join(F.broadcast(sizes), groups).groupBy(*groups, "_n").agg(*wanted)


def exact_percentiles(long: DataFrame, groups: list[str], value: str, probs: list[float],
                      accuracy: int = 10000, prob_col: str = "p", out: str = "q") -> DataFrame:
    """Return (groups..., p, q): the exact linear-interpolated percentile of
    ``value`` (NULLs ignored) for every p in ``probs`` inside every group."""
    margin = 3.0 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    vals = long.select(*groups, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    st = cut_lineage(vals.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_e")))
    sizes = st.select(*groups, "_n")

    v = F.col("_v")
    brackets = [(F.col("_e")[2 * i], F.col("_e")[2 * i + 1]) for i in range(len(probs))]
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in brackets])
    gap = reduce(lambda a, b: a + b, [(v > hi).cast("int") for _, hi in brackets])
    rows = vals.join(F.broadcast(st), groups)
    found = cut_lineage(_pick(_cells(rows, groups, inside, gap), sizes, groups, probs))

    ends = [f"_{s}{i}" for i in range(len(probs)) for s in "ab"]
    unknown = reduce(lambda a, b: a | b, [F.col(e).isNull() for e in ends])
    if not found.filter(unknown).isEmpty():
        again = vals.join(F.broadcast(found.filter(unknown).select(*groups)), groups, "left_semi")
        whole = _pick(_cells(again, groups, F.lit(True), F.lit(0)), sizes, groups, probs)
        found = found.filter(~unknown).unionByName(whole)

    def answer(i: int, p: float) -> Column:
        a, b, x = F.col(f"_a{i}"), F.col(f"_b{i}"), (F.col("_n") - 1).cast("double") * F.lit(float(p))
        share = x - F.floor(x)
        q = F.when(a == b, a).otherwise((F.lit(1.0) - share) * a + share * b)
        return F.struct(F.lit(float(p)).alias(prob_col), q.alias(out))

    answers = F.explode(F.array(*[answer(i, p) for i, p in enumerate(probs)])).alias("_r")
    return found.select(*groups, answers).select(*groups, f"_r.{prob_col}", f"_r.{out}")


def exact_percentiles_wide(long: DataFrame, groups: list[str], value: str,
                           probs: dict[str, float], **kw) -> DataFrame:
    """Same, one column per named probability: (groups..., name1, name2, ...)."""
    names = list(probs)
    ps = [probs[n] for n in names]
    q = exact_percentiles(long, groups, value, ps, **kw)
    return q.groupBy(*groups).agg(*[
        F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n) for n, p in zip(names, ps)])
