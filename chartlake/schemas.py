"""Declared schemas of the landing zone (no inference: an empty ``images: []``
would otherwise be inferred as ``array<string>`` and break ``images[0].url``)."""
from pyspark.sql import types as T

_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

IMAGE = T.StructType([T.StructField("url", _S), T.StructField("height", _I),
                      T.StructField("width", _I)])
IMAGES = T.ArrayType(IMAGE)
LINKS = T.MapType(_S, _S)

ARTIST_REF = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S), T.StructField("uri", _S),
    T.StructField("type", _S), T.StructField("href", _S),
])

ALBUM = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S),
    T.StructField("release_date", _S), T.StructField("release_date_precision", _S),
    T.StructField("album_type", _S), T.StructField("uri", _S),
    T.StructField("images", IMAGES), T.StructField("total_tracks", _I),
])

# Partition columns come from the path (year=/month=/day=), typed int.
PARTITION_FIELDS = [T.StructField("year", _I), T.StructField("month", _I),
                    T.StructField("day", _I)]

RAW_TRACK = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S), T.StructField("type", _S),
    T.StructField("popularity", _I), T.StructField("duration_ms", _L),
    T.StructField("explicit", _B), T.StructField("uri", _S), T.StructField("href", _S),
    T.StructField("preview_url", _S), T.StructField("track_number", _I),
    T.StructField("disc_number", _I), T.StructField("is_playable", _B),
    T.StructField("is_local", _B), T.StructField("external_urls", LINKS),
    T.StructField("external_ids", LINKS),
    T.StructField("available_markets", T.ArrayType(_S)),
    T.StructField("artists", T.ArrayType(ARTIST_REF)),
    T.StructField("album", ALBUM),
])

RAW_ARTIST = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S), T.StructField("type", _S),
    T.StructField("uri", _S), T.StructField("href", _S),
    T.StructField("popularity", _I), T.StructField("genres", T.ArrayType(_S)),
    T.StructField("followers", T.StructType([T.StructField("total", _L),
                                              T.StructField("href", _S)])),
    T.StructField("images", IMAGES), T.StructField("external_urls", LINKS),
])

# Details table used by enrichment (stands in for the remote batch lookup).
ARTIST_DETAILS = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S), T.StructField("uri", _S),
    T.StructField("popularity", _I), T.StructField("genres", T.ArrayType(_S)),
    T.StructField("images", IMAGES),
])


def with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + PARTITION_FIELDS)
