"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """Session for tests and the bench.  On a cluster, build your own session
    (or use the provided one); nothing in the library depends on these values."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is read, never
    overridden.  Only when it is unset on a local master (tests) a fresh local
    folder is created and registered; on a cluster that is an error, as other
    machines would not see it."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the loss
    of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_written(df: DataFrame) -> None:
    """Deletes what ``cut_lineage`` wrote for ``df``, which nothing may read any more."""
    file = df._jdf.queryExecution().analyzed()
    while not file.getClass().getSimpleName() == "LogicalRDD":
        file = file.children().head()
    file = file.rdd().getCheckpointFile()
    if file.isDefined():
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffled rows of finished jobs now, not when the driver's memory next fills up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in Python workers (the pandas-UDF stages
    pickle functions from this package): zip the package once per
    SparkContext and ``addPyFile`` it, the standard way to ship code to
    executors.  The zip is code, built on the driver; no data goes there."""
    import zipfile

    import strata
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(strata.__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="strata-pkg-"), "strata.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    sc._strata_shipped = True
