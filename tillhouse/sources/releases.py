"""Table sets that change together: all tables of a run become readable at once, or none does.

A release is a manifest that names the folder and schema of each table.  A run writes its tables to new folders and then one
manifest; a run that fails before that leaves the last release as it was.  A table set read from one release never mixes runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillhouse.functions.concurrency import run_together
from tillhouse.functions.materialize import remove
from tillhouse.sources import manifests


class Releases:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        return manifests.numbers(self.spark, self.path)

    def _tables(self, number: int) -> dict[str, dict]:
        return json.loads(manifests.read_manifest(self.spark, self.path, number))["tables"]

    def publish(self, tables: Mapping[str, DataFrame], base: int | None = None) -> int:
        """Write the tables and release them, with those of the last release that are not among them; returns the number.

        ``base`` is the release that the tables were made from, the last one by default.  If another run has released since,
        this one raises ``ConflictError`` and is not seen.  An empty table is released with its columns.
        """
        last = max(self.numbers(), default=0) if base is None else base
        kept = self._tables(last) if last else {}
        folder = f"data/{uuid.uuid4()}"

        def write(name: str, df: DataFrame) -> dict:
            df.write.option("compression", "zstd").parquet(f"{self.path}/{folder}/{name}")
            return {"folder": f"{folder}/{name}", "schema": df.schema.jsonValue()}

        written = run_together(self.spark, {name: partial(write, name, df) for name, df in tables.items()})
        text = json.dumps({"number": last + 1, "tables": {**kept, **written}})
        manifests.publish_manifest(self.spark, self.path, last + 1, text)
        return last + 1

    def read(self, names: Sequence[str] | None = None, number: int | None = None) -> dict[str, DataFrame]:
        """Tables of one release, the last by default, all of them unless named."""
        found = self._tables(self.numbers()[-1] if number is None else number)
        if missing := set(names or ()) - set(found):
            raise KeyError(f"not in the release: {sorted(missing)}")
        return {
            name: self.spark.read.schema(StructType.fromJson(found[name]["schema"])).parquet(f"{self.path}/{found[name]['folder']}")
            for name in (found if names is None else names)
        }

    def remove_before(self, number: int) -> None:
        """Forget earlier releases and delete the folders that only they name."""
        released = self.numbers()
        if number not in released:
            raise KeyError(f"no release {number}")
        old = [n for n in released if n < number]
        used = {table["folder"] for n in released if n >= number for table in self._tables(n).values()}
        unused = {table["folder"] for n in old for table in self._tables(n).values()} - used
        for path in [manifests.manifest_path(self.path, n) for n in old] + [f"{self.path}/{folder}" for folder in unused]:
            remove(self.spark, path)
