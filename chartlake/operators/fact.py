"""Star join (OP-11): staged tracks LEFT JOIN both dimensions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import spread_null_key


# What the fact takes from a staged track.
FACT_TRACK_COLUMNS = ["track_snapshot_date", "track_id", "primary_artist_id", "album_id", "track_name",
                      "track_popularity", "duration_ms", "explicit", "track_uri"]
_SALT = ("track_id", "track_snapshot_date", "track_uri", "duration_ms")


def album_join_key() -> Column:
    """Staged tracks' ``album_id``; a salted value that no album has where it is NULL."""
    return spread_null_key("album_id", *_SALT)


def build_fact(stg_tracks: DataFrame, dim_albums: DataFrame,
               dim_artists: DataFrame, album_key: str | None = None) -> DataFrame:
    """``fct_snapshot_top_items``: one row per staged track row, 17 columns.

    No broadcast hints: both dimensions grow with the data (albums with
    orders, artists with suppliers). The planner broadcasts a side whose
    size estimate is under ``autoBroadcastJoinThreshold`` and AQE converts a
    sort-merge join to a broadcast join once the dimension stage has run
    and its real size is known. A NULL key (e.g. a track without artists)
    is the typical hot key of the left side: it is replaced by a salted,
    never-matching value so those rows spread over all partitions; other
    skewed keys are split by AQE's skew-join handling.

    ``album_key`` names a column of ``stg_tracks`` that holds the album's key with
    NULL ones salted already (``album_join_key``): tables bucketed by it and by the
    dimension's ``album_id`` join without a shuffle of the staged rows."""
    t = stg_tracks.select(*FACT_TRACK_COLUMNS,
                          *([F.col(album_key).alias("__album_key")] if album_key else []))
    al = dim_albums.select(F.col("album_id").alias("__album_id"), "album_name",
                           "album_release_date_parsed", "album_type")
    ar = dim_artists.select(F.col("artist_id").alias("__artist_id"), "artist_name",
                            "artist_popularity", "artist_genres", "artist_uri",
                            "artist_image_url")
    if not album_key:
        t = t.withColumn("__album_key", album_join_key())
    j = t.join(al, t["__album_key"] == al["__album_id"], "left")
    # Made here, so that it doesn't travel to the albums.
    j = j.withColumn("__artist_key", spread_null_key("primary_artist_id", *_SALT))
    j = j.join(ar, j["__artist_key"] == ar["__artist_id"], "left")
    return j.select(
        "track_snapshot_date", "track_id",
        F.col("primary_artist_id").alias("artist_id"), "album_id",
        "track_name", "track_popularity", "duration_ms", "explicit", "track_uri",
        "album_name", "album_release_date_parsed", "album_type",
        "artist_name", "artist_popularity", "artist_genres", "artist_uri",
        "artist_image_url")
