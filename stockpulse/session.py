"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on. Shuffle partition count is left to AQE: it starts
#: high on a cluster and is coalesced from the observed map output sizes.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "stockpulse", master: str | None = None, **settings) -> SparkSession:
    """Session with the job settings; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: there the
    driver and the executors are one process on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:  # gone with the driver process
        _local_dirs[context.applicationId] = tempfile.TemporaryDirectory(prefix="stockpulse-", ignore_cleanup_errors=True)
    return _local_dirs[context.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never reused."""
    return f"{shared_dir(spark)}/stockpulse/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of a result used several times. Losing an executor then costs a re-read.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.staged_at = path
    return written


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API: works on any store that Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def release(spark: SparkSession) -> None:
    """Plans, broadcasts and shuffles of the finished steps leave the driver's heap."""
    spark._jvm.System.gc()


def discard(*staged: DataFrame) -> None:
    """Remove staged copies once everything read from them has been written itself."""
    for df in staged:
        fs, where = file_system(df.sparkSession, df.staged_at)
        fs.delete(where, True)
    if staged:
        release(staged[0].sparkSession)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row result on every row of ``df``, as scalar subqueries: no join is planned."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})
