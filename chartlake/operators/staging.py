"""Staging: flatten raw snapshot rows into typed, renamed columns (OP-05, OP-06)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import first_field, safe_date


def _snapshot_cols(prefix: str):
    return [F.col("year").cast("int").alias("snapshot_year"),
            F.col("month").cast("int").alias("snapshot_month"),
            F.col("day").cast("int").alias("snapshot_day"),
            safe_date("year", "month", "day").alias(f"{prefix}_snapshot_date")]


def stage_tracks(raw: DataFrame) -> DataFrame:
    """Raw track rows -> ``stg_top_tracks`` (20 columns, one per raw row)."""
    return raw.select(
        F.col("id").alias("track_id"),
        F.col("name").alias("track_name"),
        first_field("artists", "id").alias("primary_artist_id"),
        F.col("album.id").alias("album_id"),
        F.col("popularity").cast("int").alias("track_popularity"),
        F.col("duration_ms").cast("bigint").alias("duration_ms"),
        F.col("explicit").cast("boolean").alias("explicit"),
        F.col("uri").alias("track_uri"),
        first_field("artists", "name").alias("primary_artist_name"),
        first_field("artists", "uri").alias("primary_artist_uri"),
        F.col("album.name").alias("album_name"),
        F.col("album.release_date").alias("album_release_date"),
        F.col("album.release_date_precision").alias("album_release_date_precision"),
        F.col("album.album_type").alias("album_type"),
        F.col("album.uri").alias("album_uri"),
        first_field("album.images", "url").alias("album_image_url"),
        *_snapshot_cols("track"),
    )


def stage_artists(raw: DataFrame) -> DataFrame:
    """Raw artist rows -> ``stg_top_artists`` (11 columns)."""
    return raw.select(
        F.col("id").alias("artist_id"),
        F.col("name").alias("artist_name"),
        F.col("uri").alias("artist_uri"),
        F.col("popularity").cast("int").alias("artist_popularity"),
        F.col("genres").alias("artist_genres"),
        F.col("followers.total").cast("bigint").alias("artist_follower_count"),
        first_field("images", "url").alias("artist_image_url"),
        *_snapshot_cols("artist"),
    )
