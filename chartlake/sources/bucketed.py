"""Bucketed tables of the session catalog, for joins whose sides were shuffled when
they were written."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame | Sequence[DataFrame], name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to the new folder ``path`` as table ``name``, in ``buckets`` buckets of
    ``key``; returns the table. Several frames of the same columns are added one after the
    other, each in files of its own. The rebalance brings a bucket's rows to one task (one file)
    and splits a hot one over several. A join on ``key`` with a table of as many buckets
    needs no exchange of either. A join reads a bucket in one task, and AQE can't
    split it there: choose a key without hot values (a left join's NULLs salted), or
    leave the join to the shuffle, which AQE does split."""
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark = frames[0].sparkSession
    for i, part in enumerate(frames):
        (part.hint("rebalance", buckets, key).write.format("parquet").mode("append" if i else "errorifexists")
             .option("path", path).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(name))
    return spark.table(name)
