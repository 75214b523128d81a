"""Reading and writing table sets.  Every path may be on any file system that Spark can reach."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tillhouse.functions.concurrency import run_together

log = logging.getLogger(__name__)


def _below(folder: str, name: str) -> str:
    return f"{str(folder).rstrip('/')}/{name}"


def _is_absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row, every column a string, empty fields null.

    The header supplies the column names unless ``columns`` does.  Either way all files of the path are checked against
    them, so a file with another header fails the job instead of shifting values into the wrong column.
    """
    names = columns or spark.read.csv(path, header=True).columns
    schema = StructType([StructField(name, StringType()) for name in names])
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def scan_csv_tables(
    spark: SparkSession, folder: str, files: Sequence[str], skip_invalid: bool = False, probe: bool = False
) -> dict[str, DataFrame]:
    """The files that exist, by name without extension.

    An absent file is skipped.  An unreadable one raises, or is skipped with ``skip_invalid``; ``probe`` reads a row of
    each to find out now rather than when the table is used.
    """

    def read(file: str) -> DataFrame | None:
        try:
            return _probed(scan_csv(spark, _below(folder, file)), probe)
        except Exception as error:
            if isinstance(error, AnalysisException) and _is_absent(error):
                log.warning("%s does not exist and is skipped", file)
            elif skip_invalid:
                log.warning("%s cannot be read and is skipped: %s", file, error)
            else:
                raise
            return None

    found = run_together(spark, {file.rpartition(".")[0] or file: partial(read, file) for file in files})
    return {name: df for name, df in found.items() if df is not None}


def scan_parquet_tables(
    spark: SparkSession, folder: str, names: Sequence[str], probe: bool = False
) -> dict[str, DataFrame]:
    """All the named tables, or an empty set if any of them is missing.  One that cannot be read raises."""

    def read(name: str) -> DataFrame:
        return _probed(spark.read.parquet(_below(folder, name)), probe)

    try:
        return run_together(spark, {name: partial(read, name) for name in names})
    except AnalysisException as error:
        if not _is_absent(error):
            raise
        log.error("some of the tables %s are missing in %s: %s", list(names), folder, error)
        return {}


def _probed(df: DataFrame, probe: bool) -> DataFrame:
    if probe:
        df.limit(1).collect()
    return df


def write_table(df: DataFrame, folder: str, name: str) -> str:
    """Replace the Parquet table ``<folder>/<name>`` and return its path."""
    path = _below(folder, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Replace several tables and return their paths."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    return run_together(spark, {name: partial(write_table, df, folder, name) for name, df in tables.items()})


def append_metrics(record: DataFrame, path: str) -> None:
    """Add records to a history.  Each run adds a file of its own, so runs do not rewrite each other's records."""
    record.write.mode("append").json(path, ignoreNullFields=False)


def read_metrics(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return spark.read.json(path, schema=schema)
