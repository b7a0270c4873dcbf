"""Landing zone: newline-delimited JSON under ``year=/month=/day=``
(OP-01 .. OP-03)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_ARTIST, RAW_TRACK
from .quarantine import good_rows, landing_lines

PARTITIONS = ["year", "month", "day"]
# What a path names the values of rows without a date.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
# Write option: whether the job leaves ``_SUCCESS`` in its folder.
MARK_DONE = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def _read(spark: SparkSession, path: str, schema, infer: bool = False,
          mode: str = "PERMISSIVE") -> DataFrame:
    # Declared schema (partition keys typed int: "month=04" reads as 4);
    # basePath keeps partition discovery when a sub-path or glob is given.
    # Lines that don't fit it are left out (``quarantine`` keeps them), or
    # fail the job with mode FAILFAST.
    # ``infer=True`` is the opt-in auto-detect of the source tables: it costs
    # a pass over the data and types an all-empty ``images: []`` as
    # array<string>, so the declared schema is the default.
    if infer:
        return spark.read.option("basePath", path.split("/year=")[0]).option("mode", mode).json(path)
    return good_rows(landing_lines(spark, path), schema, mode)


def read_raw_tracks(spark: SparkSession, path: str, infer: bool = False,
                    mode: str = "PERMISSIVE") -> DataFrame:
    return _read(spark, path, RAW_TRACK, infer, mode)


def read_raw_artists(spark: SparkSession, path: str, infer: bool = False,
                     mode: str = "PERMISSIVE") -> DataFrame:
    return _read(spark, path, RAW_ARTIST, infer, mode)


def landing_items(response: DataFrame, items: str = "items",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """A response frame with an ``items`` array -> one compact JSON text per
    non-NULL item (``value``). NULL or empty arrays give no rows. NULL fields
    are written as ``null`` (as a JSON encoder of the item dict would)."""
    x = response.select(*keep, F.explode(items).alias("__item"))
    return x.filter(F.col("__item").isNotNull()).select(
        *keep, F.to_json("__item", {"ignoreNullFields": "false"}).alias("value"))


def partition_columns(run_ts) -> list:
    """Zero-padded string partition values from the run timestamp, so the
    paths read ``month=04``; they read back as int. A Python date/datetime
    is used as the wall-clock date it states (no time-zone shift); a Column
    is formatted in the session time zone."""
    if isinstance(run_ts, (_dt.date, _dt.datetime)):
        return [F.lit(f"{run_ts.year:04d}").alias("year"),
                F.lit(f"{run_ts.month:02d}").alias("month"),
                F.lit(f"{run_ts.day:02d}").alias("day")]
    return [F.date_format(run_ts, "yyyy").alias("year"),
            F.date_format(run_ts, "MM").alias("month"),
            F.date_format(run_ts, "dd").alias("day")]


def write_landing(lines: DataFrame, root: str, run_ts=None,
                  partition_cols: list | None = None, compression: str = "none",
                  clustered: bool = False, finished: bool = True) -> None:
    """Append NDJSON lines (column ``value``) under
    ``root/year=YYYY/month=MM/day=DD/``. Either a run timestamp (one
    partition) or per-row ``partition_cols`` (backfill) names the partition.
    ``compression`` (e.g. ``gzip``) is told from the files' names by every scan.
    ``clustered``: the lines of a partition lie together already. ``finished``: with Spark's
    ``_SUCCESS``; False where further appends of the same lot follow.
    Writes are appends of new files, so a re-run never clobbers data a
    reader may hold; an empty input writes no partition at all."""
    if partition_cols is None:
        if run_ts is None:
            raise ValueError("run_ts or partition_cols is required")
        partition_cols = partition_columns(run_ts)
    cols = [F.col(c) if isinstance(c, str) else c for c in partition_cols]
    out = lines.select("value", *[c.alias(n) for c, n in zip(cols, PARTITIONS)])
    # REBALANCE: AQE clusters rows by partition so each task writes few
    # partition folders (no file explosion), and splits a hot snapshot over
    # several tasks instead of sending it to one.
    if not clustered:
        out = out.hint("rebalance", *PARTITIONS)
    (out.write.mode("append").partitionBy(*PARTITIONS)
        .option("compression", compression).option(MARK_DONE, finished).text(root))
