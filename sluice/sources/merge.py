"""Merges into stored tables: Parquet in hash buckets of which a merge reads and rewrites those that its source touches.

A table is a folder with one partition for each bucket of the columns `by`; its number of buckets is part of the partition's name. A
merge finds the buckets of its source (at most `buckets` numbers), forms the new rows of those buckets with the operators of
`relational`, stores them in the work folder, and puts them in place by dynamic partition overwrite, so that
the files of other buckets are neither read nor written. Buckets that end empty are deleted last. A merge that fails
before its commit leaves the table as it was; each bucket is replaced by a rename.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as R
from ..session import stored


class StoredTable:
    """A table under `path`, in buckets of the columns `by`. `buckets` grows with the table; it stays the same for its life."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.by, self.buckets = spark, path.rstrip("/"), list(by), buckets
        self.name = f"__bucket_of_{buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, mode: str) -> None:
        placed = df.withColumn(self.name, self.bucket()).repartition(self.buckets, self.name)
        placed.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.name).parquet(self.path)

    def create(self, df: DataFrame) -> StoredTable:
        self._write(df, "error")
        return self

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().drop(self.name)

    def touched(self, *sources: DataFrame) -> list[int]:
        """Buckets that the sources' rows fall in: a number for each bucket at most."""
        found: set[int] = set()
        for s in sources:
            found |= {r[0] for r in s.select(self.bucket()).distinct().collect()}
        return sorted(found)

    def _merge(self, sources: Sequence[DataFrame], merged: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replaces the buckets that the sources touch by merged(their rows); returns those buckets."""
        touched = self.touched(*sources)
        if not touched:
            return touched
        old = self._rows().filter(F.col(self.name).isin(*touched)).drop(self.name)
        new = stored(merged(old).select(*old.columns))
        left = set(self.touched(new))
        if left - set(touched):
            raise ValueError("a merge made rows of buckets that its source does not touch")
        if left:
            self._write(new, "overwrite")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for b in set(touched) - left:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{self.name}={b}"), True)
        return touched

    def _within(self, columns: Sequence[str]) -> None:
        if not set(self.by) <= set(columns):
            raise ValueError(f"rows that meet must share a bucket: {self.by} are not among {list(columns)}")

    def upsert(self, source: DataFrame, keys: Sequence[str]) -> list[int]:
        self._within(keys)
        return self._merge([source], lambda old: R.upsert(old, source, keys))

    def insert_ignore(self, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> list[int]:
        self._within(keys)
        return self._merge([source], lambda old: R.insert_ignore(old, source, keys, order))

    def replace_scope(self, scope: DataFrame, new: DataFrame, keys: Sequence[str]) -> list[int]:
        self._within(keys)
        return self._merge([scope, new], lambda old: R.replace_scope(old, scope, new, keys))

    def mirror_delete(self, loaded: DataFrame, category: str, keys: Sequence[str]) -> list[int]:
        self._within([category])
        return self._merge([loaded], lambda old: R.mirror_delete(old, loaded, category, keys))
