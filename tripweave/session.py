"""Session helpers.

Library code never creates a session on its own; callers (tests, bench,
the driver) pass one in.  ``tune`` only sets runtime SQL options that are
safe to change on a shared session, and ``checkpoint_dir`` reads the
cluster's shared checkpoint location instead of inventing a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime options every plan here relies on.
RUNTIME_CONF = {
    # duplicate JSON keys: last one wins, like a Python dict (divergence D30)
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a write into folders by type keeps a file of each type open instead of
    # sorting its rows, payload texts and all; beyond so many it sorts
    "spark.sql.maxConcurrentOutputFileWriters": "24",
    # a write's shuffle files are deleted when it ends: a plan of several stored
    # steps holds those of one step on disk, not of all
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tripweave") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRIPWEAVE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession, fallback=None) -> str:
    """The shared folder named by the cluster (``spark.checkpoint.dir``).

    Where the session names none, ``fallback`` (a path or a callable giving
    one) is installed; without it a temporary folder is made only for a
    single-machine ``local[..]`` session (tests, smoke runs), where the driver
    and the tasks are one process.  On a cluster the missing setting is an
    error: a machine-local folder would not be seen by other executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if fallback is not None:
            current = fallback() if callable(fallback) else fallback
        elif sc.master.split("[")[0] == "local":
            current = tempfile.mkdtemp(prefix="tripweave-")
        else:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def work_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one; ``clear`` removes it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tripweave/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str = "snappy",
           *more: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage: a lost executor repeats only the stage that reads the copy.
    Every call takes a folder of its own.  Rows of ``more`` are added one after the
    other, so that what each moves lies on disk alone.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/tables/{uuid.uuid4().hex}/{name}"
    for part in (df, *more):
        w = part.select(*df.columns).write.mode("append").option("compression", compression)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more (Spark has no public call for it)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete what this application stored (``stored``, derived landings, drains); results that read it are gone as well."""
    remove(spark, work_folder(spark))
