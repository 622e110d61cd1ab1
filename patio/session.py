"""Session settings the jobs are designed for."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "patio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC dates switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # A key that holds a large part of the rows is split over several join tasks, also
        # where the split costs one more exchange.
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Checkpoints go when the frames that were read from them are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A bare local session that names none gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    # In local-cluster mode, too, executors have folders of their own.
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"patio-{application}-")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several later actions read.

    The rows go to the shared folder, so they outlive a lost executor.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
