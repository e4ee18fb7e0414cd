"""Session settings, the shared scratch folder, and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # the name since Spark 4.1


def get_session(app: str = "bindery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="bindery-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def run_folder(spark: SparkSession) -> str:
    """The one folder under the shared folder that holds all stages of this application."""
    return f"{shared_folder(spark)}/bindery-{spark.sparkContext.applicationId}"


def drop_run_folder(spark: SparkSession) -> None:
    """Remove the stages of this application. DataFrames built on them can't be read any more."""
    _delete(spark, run_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the run folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later stages then survive a lost executor without replaying what came before, and values
    that a replay might change (such as a partition number) are frozen. The shuffle files of the
    write are of no more use once it is committed, so they are dropped.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path  # for :func:`discard`
    return out


def discard(*stages: DataFrame) -> None:
    """Remove stages (as :func:`materialize` returned them) that nothing reads any more."""
    for df in stages:
        _delete(df.sparkSession, df._stage_path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
