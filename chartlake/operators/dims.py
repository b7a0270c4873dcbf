"""Dimensions (OP-09, OP-10): latest attributes per album / artist."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_partial_date
from .latest import latest_by_key


def dim_albums(stg_tracks: DataFrame) -> DataFrame:
    base = stg_tracks.select("album_id", "album_name", "album_release_date",
                             "album_release_date_precision", "album_type",
                             "track_snapshot_date")
    latest = latest_by_key(base, ["album_id"], "track_snapshot_date")
    return latest.select(
        "album_id", "album_name",
        parse_partial_date("album_release_date", "album_release_date_precision")
        .alias("album_release_date_parsed"),
        "album_type",
        F.col("track_snapshot_date").alias("last_seen_album_snapshot_date"))


def dim_artists(stg_artists: DataFrame) -> DataFrame:
    base = stg_artists.select("artist_id", "artist_name", "artist_popularity",
                              "artist_genres", "artist_uri", "artist_image_url",
                              "artist_snapshot_date")
    latest = latest_by_key(base, ["artist_id"], "artist_snapshot_date")
    return latest.select(
        "artist_id", "artist_name", "artist_popularity", "artist_genres",
        "artist_uri", "artist_image_url",
        F.col("artist_snapshot_date").alias("last_seen_artist_snapshot_date"))


DIM_ALBUM_COLUMNS = ["album_id", "album_name", "album_release_date_parsed",
                     "album_type", "last_seen_album_snapshot_date"]
DIM_ARTIST_COLUMNS = ["artist_id", "artist_name", "artist_popularity",
                      "artist_genres", "artist_uri", "artist_image_url",
                      "last_seen_artist_snapshot_date"]
