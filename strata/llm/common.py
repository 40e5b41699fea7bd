"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import cut_lineage, ensure_checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with a function of this package, which the workers get."""
    ship_package(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()      # the worker stays for the next task

    return df.mapInArrow(tidy, schema)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back.  Unlike ``checkpoint()`` the copy is columnar and compressed, and
    every reader sees the same committed rows whatever executor is lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``: those whose id has the smallest hash, the
    same at any partitioning.  A cut of the hash at about twice the share that
    is needed keeps what each task sends to the driver in proportion."""
    n = df.count()
    h = F.xxhash64(F.col(id_col).cast("long"))
    if n > 2 * rows:
        df = df.where(h < int(-(1 << 63) + (1 << 64) * (2 * rows / n)))
    return df.orderBy(h, *[F.col(f"`{c}`") for c in df.columns]).limit(rows)


def byte_pieces(text: Column, size: int, most: int) -> Column:
    """At most ``most`` pieces of ``size`` bytes, spread evenly over a text."""
    raw = text.cast("binary")
    length = F.octet_length(raw)
    step = F.greatest(F.lit(size), (length / most).cast("int"))
    return F.filter(F.array(*[F.when(F.lit(j) * step < length, raw.substr(F.lit(j) * step + 1, F.lit(size)))
                              for j in range(most)]), lambda p: p.isNotNull())


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of an Arrow string or binary column; a null
    is an empty text.  No row is decoded or copied."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0 or ends is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(ends, width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``most`` bytes of a text column,
    or one longer row: a task's arrays stay small whatever a batch holds."""
    for batch in batches:
        _, offsets = utf8_column(batch.column(column))
        for a, b in doc_blocks(offsets, most):
            yield batch.slice(a, b - a)


def doc_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``most`` bytes each, or of one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def free_prefix(df: DataFrame, base: str) -> str:
    """``base``, longer by underscores until no column of ``df`` begins with it."""
    while any(c.lower().startswith(base.lower()) for c in df.columns):
        base += "_"
    return base


def same_row(left: str, right: str, *names: str) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return cond


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, root)`` for
    every node that has an edge, ``root`` its smallest reachable node.

    Minimum labels travel along the edges and along the labels themselves
    (pointer jumping), so a chain of n nodes needs about log n rounds.  Every
    step is a partially aggregated minimum or an equi-join that AQE can split;
    only the count of changed labels reaches the driver."""
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                       .where("a != b").distinct())
    lab = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("root")))
    while True:
        near = (both.join(lab.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        step = (lab.join(near, "node", "left")
                .select("node", F.col("root").alias("old"),
                        F.least("root", F.coalesce("m", "root")).alias("root")))
        up = lab.select(F.col("node").alias("root"), F.col("root").alias("up"))
        nxt = cut_lineage(step.join(up, "root", "left")
                          .select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")))
        changed = nxt.where("old != root").count()
        lab = nxt.select("node", "root")
        if not changed:
            return lab
