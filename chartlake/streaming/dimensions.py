"""Incremental dimension maintenance with Structured Streaming.

The landing zone is a directory of NDJSON files that only grows. A file
stream over it with ``trigger(availableNow=True)`` processes exactly the files
not yet seen, then stops: the scheduled "incremental model" run. The newest raw
row per key is Spark's own keyed aggregation state, kept in the checkpoint (in
the cluster-shared folder): the greatest (snapshot, remaining raw columns), the
order of the batch dimensions, so ties are broken on the raw text too, whatever
files or runs the rows come in. Late files never win.

Every micro-batch writes the rows of the keys it touched to a folder of its
own number. A replayed batch writes the same rows to the same folder again."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import operators as ops
from ..schemas import RAW_ARTIST, RAW_TRACK, with_partitions
from ..session import PARQUET, state_on_disk
from ..sources.quarantine import good_rows, landing_lines

BATCH = "batch"
_KINDS = {
    # kind: (raw schema, stage, dimension, key, order column and tie-breaks of the dimension)
    "artists": (RAW_ARTIST, ops.stage_artists, ops.dim_artists, "artist_id",
                ["artist_snapshot_date", "artist_name", "artist_popularity", "artist_genres",
                 "artist_uri", "artist_image_url"]),
    "albums": (RAW_TRACK, ops.stage_tracks, ops.dim_albums, "album_id",
               ["track_snapshot_date", "album_name", "album_release_date",
                "album_release_date_precision", "album_type"]),
}


def start_dimension_stream(spark: SparkSession, landing_root: str, kind: str, out: str,
                           checkpoint: str,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the availableNow stream landing -> ``out/batch=N``. ``landing_root``
    is the feed folder (…/tracks for albums, …/artists for artists). Lines that
    don't fit the feed's schema and rows without a key are left out.
    ``read_dimension`` gives the dimension."""
    state_on_disk(spark)
    schema, stage, _, key, order = _KINDS[kind]
    lines = landing_lines(spark, landing_root, stream=True, max_files_per_trigger=max_files_per_trigger)
    newest = (stage(good_rows(lines, schema)).filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.max(F.struct(*order)).alias("row")))

    def write(batch: DataFrame, number: int) -> None:
        batch.select(key, "row.*").write.mode("overwrite").options(**PARQUET).parquet(f"{out}/{BATCH}={number}")

    return (newest.writeStream.foreachBatch(write)
                  .outputMode("update")
                  .option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True)
                  .start())


def read_dimension(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """The dimension that a stream's batches under ``out`` hold: the newest of a key's
    rows, one partial aggregate over the rows written. Without any batch yet, no rows.
    While a batch is being written a reader sees some of its keys in their new
    state and others in the last."""
    raw, stage, dim, key, order = _KINDS[kind]
    staged = stage(spark.createDataFrame([], with_partitions(raw))).select(key, *order).schema
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in staged])
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return dim(spark.createDataFrame([], schema))
    return dim(spark.read.schema(schema).parquet(out))
