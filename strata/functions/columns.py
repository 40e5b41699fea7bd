"""Column-expression helpers.  All of them are plain Catalyst expressions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN and NULL are one concept (missing) in the cohort model: map NaN to
    NULL so that min/max/avg/stddev skip it."""
    c = col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_div(a: str | Column, b: str | Column, default=0.0) -> Column:
    """a / b with 0/0 (and x/0) giving ``default`` instead of an ANSI error.
    Pass ``default=None`` for the nullable variant."""
    q = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def ordered_bits(c: Column) -> Column:
    """A long that orders as the double does, one for each value: exponent and fraction side by side, negated for
    negative numbers.  Powers of two divide exactly, so the fraction is the double's own."""
    a = F.abs(c)
    least = F.lit(2.0 ** -1022)
    e0 = F.floor(F.log2(a)).cast("int")
    m0 = a / F.pow(F.lit(2.0), e0.cast("double"))
    e = e0 + (m0 >= 2).cast("int") - (m0 < 1).cast("int")      # where the logarithm was rounded over a power of two
    m = a / F.pow(F.lit(2.0), e.cast("double"))
    normal = (e + 1023).cast("long") * F.lit(1 << 52) + ((m - 1) * float(1 << 52)).cast("long")
    tiny = (a * 2.0 ** 537 * 2.0 ** 537).cast("long")
    bits = F.when(a == float("inf"), F.lit(2047 << 52)).when(a < least, tiny).otherwise(normal)
    return F.when(c < 0, -bits).otherwise(bits)


_INTS = (T.ByteType, T.ShortType, T.IntegerType)


def first_non_null_by(value: str, order: str, schema: T.StructType) -> Column:
    """Value of ``value`` on the row with the smallest ``order`` among rows where ``value`` is not NULL; of several
    rows with that ``order`` the smallest value.  Order-independent (unlike ``first``), so it is stable
    across partitions and task retries.

    For an ``order`` of at most 32 bits and a numeric value both go into one fixed-width number, (order, value), whose
    minimum is kept beside the value: the aggregate stays a hash aggregate.  Other types compare as a struct, which
    costs a sort."""
    v, o = F.col(value), F.col(order)
    kind = schema[value].dataType
    if isinstance(schema[order].dataType, _INTS) and isinstance(kind, (*_INTS, T.LongType, T.FloatType, T.DoubleType)):
        if isinstance(kind, _INTS):
            key = o.cast("long") * F.lit(1 << 32) + v.cast("long")
        else:
            low = v if isinstance(kind, T.LongType) else ordered_bits(v.cast("double"))
            key = o.cast("decimal(10,0)") * F.lit(Decimal(1 << 64)) + low.cast("decimal(20,0)")
        return F.min_by(v, F.when(v.isNotNull(), key))
    return F.min(F.when(v.isNotNull(), F.struct(o.alias("o"), v.alias("v")))).getField("v")


def pearson(x: str, y: str) -> Column:
    """Pearson correlation on pairwise-complete rows.  Returns NULL (not an
    ANSI divide-by-zero) for a constant column or fewer than two pairs."""
    cx, cy = F.col(x), F.col(y)
    cov = F.covar_pop(cx, cy)
    sx = F.stddev_pop(F.when(cy.isNotNull(), cx))
    sy = F.stddev_pop(F.when(cx.isNotNull(), cy))
    den = F.nullif(sx * sy, F.lit(0.0))
    return F.try_divide(cov, den)


def null_band(share: str | Column, hi: float = 0.90, mid: float = 0.50) -> Column:
    """Null-rate banding: > hi, > mid, else."""
    s = col(share)
    return (F.when(s > hi, F.lit(f">{int(hi * 100)}%"))
            .when(s > mid, F.lit(f">{int(mid * 100)}%"))
            .otherwise(F.lit(f"<={int(mid * 100)}%")))


def decode(c: str | Column, mapping: dict, default=None) -> Column:
    """Code -> name lookup as a CASE expression (for small fixed code sets)."""
    c = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def split_feature_name(c: str | Column) -> tuple[Column, Column]:
    """``Signal_agg`` -> (Signal, agg), split at the last underscore."""
    c = col(c)
    sig = F.regexp_extract(c, r"^(.*)_([^_]+)$", 1)
    agg = F.regexp_extract(c, r"^(.*)_([^_]+)$", 2)
    return (F.when(sig == "", c).otherwise(sig), F.when(sig == "", F.lit(None)).otherwise(agg))


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double/float column (used to compare with an oracle; the
    library itself never rounds except where the reference publishes rounded
    figures)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def long_form(df: DataFrame, ids: list[str], features: list[str],
              name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot ``features`` (cast to double) into (ids..., feature, value).
    Wide per-column statistics are computed in this form so that the
    aggregate stays small per row and inside codegen however wide the table."""
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in features])
    return cast.unpivot(ids, features, name, value)


def combine_rows(*parts) -> DataFrame:
    """Merge single-row aggregates (each a DataFrame of exactly one row, by
    construction) into one row without a join: union them by name and take
    the one non-NULL value of every column.  Extra Column arguments are
    appended."""
    dfs = [d for d in parts if isinstance(d, DataFrame)]
    extra = [c for c in parts if not isinstance(c, DataFrame)]
    cols = [c for d in dfs for c in d.columns]
    u = None
    for d in dfs:
        u = d if u is None else u.unionByName(d, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols]).select(*cols, *extra)
