"""Versioned tables: keyed rows in Parquet that batches of changes are merged into.

A table is a folder.  Its rows are divided by a hash of their key into a fixed number of buckets, and a version is a
manifest, a JSON file that names for each bucket the folder that holds its rows.  A merge writes new folders for the buckets
that the batch touches and then one manifest, whose appearance under its number is the commit: until then, and if the job
fails, readers see the version before, and folders that no manifest names are only waste.  Files are never changed, so old
versions stay readable until ``remove_before``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tillhouse.functions.keys import MAX_BROADCAST_KEYS, KeySet
from tillhouse.functions.materialize import stored
from tillhouse.sources import manifests
from tillhouse.sources.manifests import ConflictError

BUCKETS = 64
BUCKET = "_bucket"
_DATA = "data"


@dataclass(frozen=True)
class Version:
    """A state of a table: its number, schema, keys, number of buckets, and the folder of each bucket that has rows."""

    number: int
    schema: StructType
    keys: tuple[str, ...]
    buckets: int
    folders: dict[int, str]

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "schema": self.schema.jsonValue(),
                "keys": self.keys,
                "buckets": self.buckets,
                "folders": self.folders,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Version:
        found = json.loads(text)
        folders = {int(bucket): folder for bucket, folder in found["folders"].items()}
        return cls(found["number"], StructType.fromJson(found["schema"]), tuple(found["keys"]), found["buckets"], folders)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def create(self, df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> Version:
        """The first version.  Of rows that share a key any one is kept unless they were made distinct before."""
        if self.versions():
            raise ConflictError(f"{self.path} exists")
        empty = Version(0, df.schema, tuple(keys), buckets, {})
        return self._commit(empty, df.dropDuplicates(list(keys)))

    def versions(self) -> list[int]:
        return manifests.numbers(self.spark, self.path)

    def version(self, number: int | None = None) -> Version:
        number = self.versions()[-1] if number is None else number
        return Version.from_json(manifests.read_manifest(self.spark, self.path, number))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        version = self.version(number)
        return self._rows(version, version.folders)

    def merge(
        self,
        changes: DataFrame,
        order: str | None = None,
        deleted: str | None = None,
        base: int | None = None,
        max_broadcast: int = MAX_BROADCAST_KEYS,
    ) -> Version:
        """Insert, replace and delete rows by key, as the next version.

        Of the changes to a key, and its present row, the one with the greatest ``order`` stays, a change before a present
        row of the same order; nulls are least.  Without ``order`` a change replaces the present row.  A change for
        which ``deleted`` holds removes its key.  A null is a key like any other.  Changes that touch a bucket rewrite
        it, and no other.  ``base`` is the version that the changes were made for; if it isn't the last one,
        ``ConflictError`` is raised, as it is if another merge commits first.
        """
        last = self.version()
        if base is not None and base != last.number:
            raise ConflictError(f"{self.path} is at version {last.number}, not {base}")
        keys, columns = list(last.keys), last.schema.fieldNames()
        gone = F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)) if deleted else F.lit(False)
        chosen = changes.select(
            *(F.col(field.name).cast(field.dataType).alias(field.name) for field in last.schema.fields),
            gone.alias("_gone"),
            F.lit(1).alias("_new"),
        )
        newest = [F.desc_nulls_last(order)] if order else []
        rest = sorted(set(columns) - {*keys, order})
        tie = [F.asc_nulls_last(name) for name in rest if last.schema[name].dataType.typeName() not in ("map", "variant")]
        ranked = Window.partitionBy(*keys).orderBy(*newest, F.desc("_new"), F.desc("_gone"), *tie)

        def first(rows: DataFrame) -> DataFrame:
            # a limit per key on the map side as well, so a key with any number of changes sends one per task
            return rows.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")

        batch = stored(first(chosen).withColumn(BUCKET, self._bucket(keys, last.buckets)), "merge-batch")
        touched = [row[0] for row in batch.select(BUCKET).distinct().collect()]  # as many as there are buckets at most
        present = self._rows(last, [bucket for bucket in last.folders if bucket in touched])
        changed = KeySet.of(batch.select(*[F.col(key).alias(f"_{key}") for key in keys]))
        same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
        known = F.broadcast(changed.keys) if changed.fits(max_broadcast) else changed.keys
        untouched = present.join(known, same, "left_anti")
        if order:  # a present row may be newer than the change
            rivals = present.join(known, same, "left_semi").select("*", F.lit(False).alias("_gone"), F.lit(0).alias("_new"))
            winners = first(batch.drop(BUCKET).unionByName(rivals))
        else:
            winners = batch
        kept = winners.where(~F.col("_gone")).select(*columns)
        return self._commit(last, untouched.select(*columns).unionByName(kept), touched)

    def changes(self, older: int, newer: int) -> DataFrame:
        """The rows of two versions that only one of them has, with ``change`` 'removed' or 'added', read from rewritten buckets."""
        before, after = self.version(older), self.version(newer)
        buckets = [b for b in range(before.buckets) if before.folders.get(b) != after.folders.get(b)]
        sides = [(self._rows(before, buckets), -1), (self._rows(after, buckets), 1)]
        names = [name for name in after.schema.fieldNames() if name in before.schema.fieldNames()]
        both = reduce(DataFrame.unionByName, (df.select(*names, F.lit(sign).alias("_sign")) for df, sign in sides))
        net = both.groupBy(*names).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
        return net.select(*names, F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"))

    def remove_before(self, number: int) -> None:
        """Forget the versions before ``number``, and delete folders that no later one names."""
        kept = {folder for n in self.versions() if n >= number for folder in self.version(n).folders.values()}
        for n in [n for n in self.versions() if n < number]:
            old = self.version(n)
            fs, path = manifests.files(self.spark, manifests.manifest_path(self.path, n))
            fs.delete(path, False)
            for folder in set(old.folders.values()) - kept:
                fs, path = manifests.files(self.spark, f"{self.path}/{folder}")
                fs.delete(path, True)

    def _bucket(self, keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _rows(self, version: Version, buckets) -> DataFrame:
        folders = [f"{self.path}/{version.folders[b]}" for b in buckets if b in version.folders]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def _commit(self, last: Version, rows: DataFrame, touched: Sequence[int] | None = None) -> Version:
        """Write the rows of the touched buckets, all by default, and the manifest that puts them in place."""
        folder = f"{_DATA}/{uuid.uuid4()}"
        placed = rows.withColumn(BUCKET, self._bucket(last.keys, last.buckets)).repartition(BUCKET)
        placed.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        fs, data = manifests.files(self.spark, f"{self.path}/{folder}")
        written = [status.getPath().getName() for status in fs.listStatus(data)]
        new = {int(name.partition("=")[2]): f"{folder}/{name}" for name in written if name.startswith(f"{BUCKET}=")}
        old = {} if touched is None else {b: f for b, f in last.folders.items() if b not in set(touched)}
        version = Version(last.number + 1, last.schema, last.keys, last.buckets, {**old, **new})
        manifests.publish_manifest(self.spark, self.path, version.number, version.to_json())
        return version
