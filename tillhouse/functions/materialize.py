"""Cutting lineage and finding shared scratch space.

Both use the shared folder that the cluster names in ``spark.checkpoint.dir``.  Only a session in a single process
(``local``, ``local[n]``) without that setting gets a temporary folder of its own.  What an application has stored below it
is removed when its driver ends, and earlier by ``release`` where a job knows that it is done with it.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}  # temporary folders by application, for local sessions without a setting


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _own.setdefault(spark.conf.get("spark.app.id"), tempfile.mkdtemp(prefix="tillhouse-"))


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tillhouse-{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of this application below the shared folder that no earlier call returned."""
    _clear_at_exit(spark)
    return f"{application_folder(spark)}/{label}-{uuid.uuid4()}"


_to_clear: set[str] = set()


def _clear_at_exit(spark: SparkSession) -> None:
    folder = application_folder(spark)
    if folder not in _to_clear:
        _to_clear.add(folder)
        atexit.register(_remove_quietly, spark, folder)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session or its JVM may be gone: a scratch folder may stay, the driver's exit must not fail
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, whatever file system it is in."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write ``df`` once to shared storage, as compressed Parquet, and read it back.

    Later branches of a plan see the same rows in the same partitions even when executors are lost in between, and read
    only the columns that they use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    return stored(df)
