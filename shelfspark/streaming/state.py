"""Results that streams keep up to date: a table by key, in hash buckets, with versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators.skew import landed
from shelfspark.sources import folders

# Choose it so that a bucket of the full table is a few hundred MB.
BUCKETS = 16
_COMMIT = "bucket int, written long, batch long"


class KeyedTable:
    """Rows by key below a shared folder, of which a merge rewrites only the buckets it touches.

    `rows/version=v/bucket=b` holds rows, `commits/version=v` names the version in which each bucket
    was last written (one row per bucket).  A version is there once its commit is: rows are written
    first, so a run that stops in between leaves the former version whole.  A merge
    starts from the newest commit before its own version, so repeating a version replaces it.
    Commits but the last two, and buckets that neither names, are removed.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, folder, schema, keys, buckets

    def versions(self) -> list[int]:
        """Committed versions in rising order."""
        found = [int(name.split("=")[1]) for name in folders.children(self.spark, f"{self.folder}/commits") if name.startswith("version=")]
        return sorted(v for v in found if folders.exists(self.spark, f"{self.folder}/commits/version={v}/_SUCCESS"))

    def commit(self, version: int) -> tuple[dict[int, int], int | None]:
        """(bucket -> version that wrote it, batch that committed)."""
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.folder}/commits/version={version}").collect()  # one row per bucket
        return {r["bucket"]: r["written"] for r in rows if r["bucket"] >= 0}, rows[0]["batch"]

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, written: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/rows/version={v}/bucket={b}" for b, v in sorted(written.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows as of the newest commit, or the newest one before a version."""
        versions = [v for v in self.versions() if before is None or v < before]
        return self._read(self.commit(versions[-1])[0] if versions else {})

    def merge(self, version: int, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], batch: int | None = None) -> None:
        """Replace the rows of the delta's buckets by combine(their former rows, delta)."""
        versions = [v for v in self.versions() if v < version]
        written = self.commit(versions[-1])[0] if versions else {}
        delta = landed(delta.withColumn("_bucket", self._bucket()), "delta")
        touched = {r[0] for r in delta.select("_bucket").distinct().collect()}  # at most one per bucket
        folder = f"{self.folder}/rows/version={version}"
        if touched:
            old = self._read({b: v for b, v in written.items() if b in touched})
            rows = combine(old, delta.drop("_bucket")).select(*self.schema.names)
            # the key's own hash as well, so that a large bucket is several files
            spread = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(8))
            rows.withColumn("bucket", self._bucket()).repartition("bucket", spread).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        made = {int(name.split("=")[1]) for name in folders.children(self.spark, folder) if name.startswith("bucket=")} if touched else set()
        written = {b: v for b, v in written.items() if b not in touched} | dict.fromkeys(made, version)
        entries = [(b, v, batch) for b, v in sorted(written.items())] or [(-1, -1, batch)]
        self.spark.createDataFrame(entries, _COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/version={version}")
        self._prune(version)

    def _prune(self, version: int) -> None:
        kept = [v for v in self.versions() if v <= version][-2:]
        for v in self.versions():
            if v < kept[0]:
                folders.remove(self.spark, f"{self.folder}/commits/version={v}")
        named = {(v, b) for k in kept for b, v in self.commit(k)[0].items()}
        for name in folders.children(self.spark, f"{self.folder}/rows"):
            v = int(name.split("=")[1])
            held = {int(b.split("=")[1]) for b in folders.children(self.spark, f"{self.folder}/rows/{name}") if b.startswith("bucket=")}
            if v > version:
                continue
            for b in held:
                if (v, b) not in named:
                    folders.remove(self.spark, f"{self.folder}/rows/{name}/bucket={b}")
            if not any((v, b) in named for b in held):
                folders.remove(self.spark, f"{self.folder}/rows/{name}")
