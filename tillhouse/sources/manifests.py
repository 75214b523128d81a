"""Numbered manifests: small JSON files, of which each number is given once, so that writing one is a commit."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifests"


class ConflictError(RuntimeError):
    """Another writer has committed since the version that a change was based on."""


def files(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def manifest_path(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/{number:012d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = files(spark, f"{path}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def read_manifest(spark: SparkSession, path: str, number: int) -> str:
    return spark.read.text(manifest_path(path, number), wholetext=True).first()[0]


def publish_manifest(spark: SparkSession, path: str, number: int, text: str) -> None:
    """Write the manifest aside and give it its name, which fails if another writer has taken it."""
    jvm = spark._jvm
    fs, draft = files(spark, f"{path}/{FOLDER}/draft-{uuid.uuid4()}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    _, target = files(spark, manifest_path(path, number))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), no_overwrite)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise ConflictError(f"another writer has committed version {number} of {path}") from error
        raise
