"""Tables in buckets of keys, of which a write replaces only those it touches.

Parquet has no transactions. A bucket's rows lie in a folder of the version that wrote them, `data/v=<n>/_bucket=<k>`, and are
never written again. A manifest says which version each bucket is at; it is published last, by a rename, so a reader sees
either the old table or the new one, and a failed write leaves no trace.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.files import expire_notes, located, newest_note, publish_note, remove, table_exists

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Manifest:
    """What a table consists of: `versions` by bucket, the columns, and what else its owner keeps with it."""

    version: int = 0
    buckets: int = 0
    versions: dict[int, int] = field(default_factory=dict)
    columns: T.StructType | None = None
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class BucketTable:
    """Keyed rows under `path`. The number of buckets is fixed by the first write."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 16

    def manifest(self) -> Manifest:
        _, found = newest_note(self.spark, self._notes)
        if found is None:
            return Manifest(buckets=self.buckets)
        versions = {int(k): v for k, v in found["versions"].items()}
        return Manifest(found["version"], found["buckets"], versions, T.StructType.fromJson(found["columns"]), found["notes"])

    @property
    def _notes(self) -> str:
        return f"{self.path}/manifest"

    def read(self, manifest: Manifest | None = None, only: Collection[int] | None = None) -> DataFrame | None:
        """The rows with `_bucket`, or those of some buckets alone; None where there are none."""
        manifest = manifest or self.manifest()
        wanted = manifest.versions if only is None else {k: v for k, v in manifest.versions.items() if k in only}
        if not wanted:
            return None
        paths = [f"{self.path}/data/v={v}/{BUCKET}={k}" for k, v in sorted(wanted.items())]
        # The columns come from the manifest, so no file is opened to look for them.
        columns = T.StructType([*manifest.columns.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(columns).option("basePath", f"{self.path}/data").parquet(*paths).select(*columns.fieldNames())

    def with_bucket(self, rows: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self.keys, (manifest or self.manifest()).buckets))

    def replace(self, rows: DataFrame, touched: Collection[int], manifest: Manifest, notes: dict | None = None) -> Manifest:
        """Put the rows (with `_bucket`) in place of all that the touched buckets hold, and publish that.

        `notes` replaces the manifest's. Files of other buckets stay as they are.
        """
        version = manifest.version + 1
        folder = f"{self.path}/data/v={version}"
        remove(self.spark, folder)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        filled = {k for k in touched if table_exists(self.spark, f"{folder}/{BUCKET}={k}")}
        versions = {k: v for k, v in manifest.versions.items() if k not in touched} | {k: version for k in filled}
        own = T.StructType([f for f in rows.schema.fields if f.name != BUCKET])
        late = [f for f in (manifest.columns or T.StructType()).fields if f.name not in own.fieldNames()]
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in [*own.fields, *late]])
        new = Manifest(version, manifest.buckets, versions, nullable, manifest.notes if notes is None else notes)
        self._publish(new)
        return new

    def expire(self) -> None:
        """Delete versions of buckets that the manifest has replaced, and older manifests. Readers that began before must have finished."""
        now = self.manifest()
        fs, root = located(self.spark, f"{self.path}/data")
        held = {(v, k) for k, v in now.versions.items()}
        for folder in fs.globStatus(located(self.spark, f"{self.path}/data/v=*/{BUCKET}=*")[1]) or ():
            at = folder.getPath()
            v, k = int(at.getParent().getName()[2:]), int(at.getName().split("=")[1])
            if v <= now.version and (v, k) not in held:
                fs.delete(at, True)
        for version in fs.listStatus(root) if fs.exists(root) else ():
            if int(version.getPath().getName()[2:]) not in {v for v, _ in held}:
                fs.delete(version.getPath(), True)
        expire_notes(self.spark, self._notes)

    def _publish(self, manifest: Manifest) -> None:
        publish_note(self.spark, self._notes, manifest.version, {
            "version": manifest.version, "buckets": manifest.buckets, "versions": manifest.versions,
            "columns": json.loads(manifest.columns.json()), "notes": manifest.notes,
        })
