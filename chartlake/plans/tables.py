"""Written layers: every write goes to a new folder, and readers are handed its path.
Overwriting a path while a plan still reads it fails half-way and loses the data; a new
folder never does. A folder counts once Spark's own ``_SUCCESS`` file is in it (keep
``mapreduce.fileoutputcommitter.marksuccessfuljobs`` on); the one whose write began
last is read. Nothing is deleted or renamed. One model run at a time writes under a root."""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import PARQUET
from ..sources.landing import MARK_DONE

DONE = "_SUCCESS"


def names_under(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the files and folders directly under ``path``; none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class RunFolders:
    """The run folders of one layer, ``root/run-<start>-<id>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> str | None:
        """Path of the newest finished folder."""
        for name in reversed(names_under(self.spark, self.root)):
            if name.startswith("run-") and DONE in names_under(self.spark, f"{self.root}/{name}"):
                return f"{self.root}/{name}"
        return None

    def exists(self) -> bool:
        return self.current() is not None

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The newest finished rows. With ``schema`` a folder that holds no file (a
        partitioned layer without rows) can be read too."""
        path = self.current()
        if path is None:
            raise FileNotFoundError(f"nothing written under {self.root}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(path)

    def write(self, df: DataFrame, partition_by: list[str] | None = None, clustered: bool = False) -> DataFrame:
        """Write ``df`` to a new folder; returns the rows read back from there. ``clustered``:
        a partition's rows lie together already, so they aren't moved."""
        return self.write_batches([df], partition_by, clustered)

    def write_batches(self, batches: Sequence[DataFrame], partition_by: list[str] | None = None,
                      clustered: bool = False, order: Sequence[str] = ()) -> DataFrame:
        """``write`` of a layer that comes in several frames of the same columns, one job after the
        other; the folder counts when the last one is in it. ``order``: what a task's rows are sorted by."""
        path = f"{self.root}/run-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        for i, df in enumerate(batches):
            # Few files per partition folder, hot partitions split (AQE).
            out = df.hint("rebalance", *partition_by) if partition_by and not clustered else df
            out = out.sortWithinPartitions(*partition_by or [], *order) if order else out
            (out.write.mode("append" if i else "errorifexists").partitionBy(*partition_by or [])
                .options(**PARQUET).option(MARK_DONE, i == len(batches) - 1).parquet(path))
        return self.spark.read.schema(batches[0].schema).parquet(path).select(*batches[0].columns)

    def partition_values(self, column: str) -> list[str]:
        """Values of a partition column of the newest folder, from the listing (one
        entry per partition; no data is read). Spark writes no folder for an empty partition."""
        path, prefix = self.current(), f"{column}="
        return [n[len(prefix):] for n in names_under(self.spark, path) if n.startswith(prefix)] if path else []
