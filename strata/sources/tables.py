"""Sources and sinks (S1-S6): table scans with an explicit schema at the edge,
split-partitioned parquet tables, JSON artifacts."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import nan_to_null


class DatasetNotFound(FileNotFoundError):
    """Raised when an input path is missing, with guidance on what to pass."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory (lazy; Catalyst prunes the
    columns and pushes filters into the scan)."""
    return scan(spark, os.path.join(sf_dir, f"{name}.parquet"), fmt="parquet")


def scan(spark: SparkSession, path: str, fmt: str = "parquet",
         schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Scan a raw table.  Text formats get an explicit schema (no
    inference pass over the data); a missing path raises ``DatasetNotFound``
    with guidance instead of a bare analysis error."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "csv":
            df = reader.option("header", header).option("nanValue", "NaN").option(
                "nullValue", "NA").csv(path)
        elif fmt == "json":
            df = reader.json(path)
        else:
            df = reader.format(fmt).load(path)
    except AnalysisException as e:  # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise DatasetNotFound(
                f"Dataset not found: nothing to scan at {path}. Expected a file or folder with one row per entity "
                "and sequence step. CSV and JSON inputs also need schema=..., CSV a header row.") from e
        raise
    return df


def scan_raw(spark: SparkSession, path: str, spec, fmt: str = "parquet",
             schema: T.StructType | None = None) -> DataFrame:
    """S1 + P1 + T1/T2: scan, keep the spec's columns that exist, NaN -> NULL on
    every measure and fractional static, drop rows whose entity key is missing."""
    df = scan(spark, path, fmt=fmt, schema=schema)
    return normalize_raw(df, spec)


def normalize_raw(df: DataFrame, spec) -> DataFrame:
    spec = spec.resolve(df)
    keep = list(spec.entity) + [spec.seq] + list(spec.measures) + list(spec.statics)
    if spec.row_label in df.columns:
        keep.append(spec.row_label)
    def clean(c: str):
        if c in spec.measures:
            return nan_to_null(F.col(c).cast("double")).alias(c)
        if c in spec.statics and isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            return nan_to_null(c).cast(df.schema[c].dataType).alias(c)
        return F.col(c)

    out = df.select(*[clean(c) for c in keep])
    cond = None
    for k in spec.entity:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return out.filter(cond)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write an entity table (optionally partitioned by split)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def scan_split(spark: SparkSession, path: str, split: str, fmt: str = "parquet") -> DataFrame:
    """S3: read back one split; partition pruning reads only that folder."""
    return scan(spark, path, fmt=fmt).filter(F.col("split") == split)


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Artifacts (metrics, sweeps, stats) as JSON lines, nested structs kept."""
    df.write.mode(mode).json(path)


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an artifact with a fixed schema; an absent artifact yields an
    empty DataFrame of that schema instead of an error."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
