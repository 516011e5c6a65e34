"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits a partition that one hot key overfills and coalesces the small ones, so
# the shuffle partition count is only an upper bound for the cluster to set.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_partitions(data_bytes: int) -> int:
    """Partitions for a shuffle of that many bytes, each small enough for an executor's memory."""
    return min(max(200, data_bytes // SHUFFLE_BYTES), 200_000)


def build_session(
    app: str = "starloom",
    master: str | None = None,
    data_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for the dots.

    ``data_bytes`` is what the largest shuffle has to move and sizes the shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if data_bytes is not None:
        partitions = str(shuffle_partitions(data_bytes))
        builder = builder.config("spark.sql.shuffle.partitions", partitions)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster shares for checkpoints.

    Only a local session without that setting falls back to a folder of this machine, which is removed
    when the process ends. ``remove_scratch`` removes the shared one.
    """
    return f"{_application_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/starloom/{spark.sparkContext.applicationId}"


_OWN: list[str] = []


def _own_folder() -> str:
    """One folder for all that this process writes."""
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="starloom-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


def remove_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; results that still read them are lost."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` from a table in the scratch folder: what made it does not run again, nor is it lost
    with an executor."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
