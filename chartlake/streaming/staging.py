"""Incremental staging with Structured Streaming: landing NDJSON -> staged
Parquet, partitioned by snapshot date. An availableNow file stream reads
only files it has not seen (tracked in the checkpoint), and the file sink
commits each micro-batch through its metadata log, so a batch is written
exactly once even when a run is retried; readers of the output folder see
committed files only. Lines that don't fit the feed's schema are left out, as in
the batch scans."""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import operators as ops
from ..schemas import RAW_ARTIST, RAW_TRACK
from ..sources.quarantine import good_rows, landing_lines

_FEEDS = {
    "tracks": (RAW_TRACK, ops.stage_tracks, "track_snapshot_date"),
    "artists": (RAW_ARTIST, ops.stage_artists, "artist_snapshot_date"),
}


def start_staging_stream(spark: SparkSession, landing_root: str, kind: str, out: str,
                         checkpoint: str,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    schema, stage, date = _FEEDS[kind]
    lines = landing_lines(spark, landing_root, stream=True, max_files_per_trigger=max_files_per_trigger)
    staged = stage(good_rows(lines, schema))
    return (staged.writeStream.format("parquet")
                  .option("path", out)
                  .option("checkpointLocation", checkpoint)
                  .partitionBy(date)
                  .outputMode("append")
                  .trigger(availableNow=True)
                  .start())
