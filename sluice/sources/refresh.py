"""The latest state of append-only logs, refreshed from the files that changed.

A snapshot is a folder of versions, each with the folded state and the signatures (path, time, size) of the files that it has seen, and
one small file that names the current version. A refresh lists the logs, reads those that are new or have grown, folds
them over the old state, writes a new version and then renames the name into place, so that readers see the old
version or the new one. A file that shrank or went cannot be taken back out of the state: then all logs are read anew.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import latest_by

SIGNATURES = "path string, modified timestamp, size long"


class FoldedLog:
    """Latest `columns` of each of `keys` by `order` over JSON-lines files below `logs`; versions are kept below `path`."""

    def __init__(self, spark: SparkSession, logs: str, path: str, schema: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]):
        self.spark, self.logs, self.path = spark, logs, path.rstrip("/")
        self.schema, self.keys, self.order, self.columns = schema, list(keys), list(order), list(columns)

    # --- the file that names the current version ---

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        """The folder of the version that readers see; None before the first refresh."""
        p, fs = self._fs(f"{self.path}/CURRENT")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return f"{self.path}/{bytes(stream.readAllBytes()).decode()}"
        finally:
            stream.close()

    def _commit(self, version: str) -> None:
        fresh, fs = self._fs(f"{self.path}/CURRENT-{version}")
        out = fs.create(fresh, True)
        out.write(bytearray(version.encode()))
        out.close()
        jvm = self.spark._jvm
        rename = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fresh, self._fs(f"{self.path}/CURRENT")[0], rename)

    # --- signatures ---

    def listing(self) -> DataFrame:
        """(path, modified, size) of the logs now; their contents are not read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(self.logs)
        return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))

    def changes(self) -> DataFrame:
        """(path, kind) of files that are new, have grown, or were rewritten (shrank, changed at their size, or went)."""
        now, version = self.listing(), self.current()
        seen = self.spark.read.schema(SIGNATURES).parquet(f"{version}/signatures") if version else self.spark.createDataFrame([], SIGNATURES)
        old = seen.select("path", F.struct("modified", "size").alias("old"))
        both = now.select("path", F.struct("modified", "size").alias("new")).join(old, "path", "full_outer")
        kind = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "rewritten").when(F.col("new") == F.col("old"), None).when(F.col("new.size") > F.col("old.size"), "grown").otherwise("rewritten")
        return both.select("path", kind.alias("kind")).filter("kind is not null")

    def is_stale(self) -> bool:
        return not self.changes().isEmpty()

    # --- state ---

    def read(self) -> DataFrame:
        """The state of the current version: keys, order, columns."""
        return self.spark.read.parquet(f"{self.current()}/state")

    def _fold(self, events: DataFrame) -> DataFrame:
        return latest_by(events, self.keys, self.order, [*self.order, *self.columns])

    def refresh(self) -> list[str]:
        """Takes in what changed and returns the files that were read; a snapshot that is up to date is left alone."""
        found = self.changes().collect()  # a row for each changed file
        if not found and self.current():
            return []
        signatures = self.listing().collect()
        again = any(r["kind"] == "rewritten" for r in found)
        paths = sorted(r["path"] for r in (signatures if again or not self.current() else found))
        columns = [*self.keys, *self.order, *self.columns]
        events = (self.spark.read.schema(self.schema).json(paths) if paths else self.spark.createDataFrame([], self.schema)).select(*columns)
        if self.current() and not again:
            events = self.read().select(*columns).unionByName(events)
        version = f"v{time.time_ns()}"
        self._fold(events).write.parquet(f"{self.path}/{version}/state")
        self.spark.createDataFrame(signatures, SIGNATURES).coalesce(1).write.parquet(f"{self.path}/{version}/signatures")
        self._commit(version)
        return paths
