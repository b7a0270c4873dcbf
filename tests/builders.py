"""Hand-written raw rows for unit tests (shapes of FIXTURES.md §1)."""
from __future__ import annotations

import datetime as dt

from chartlake.schemas import RAW_ARTIST, RAW_TRACK, with_partitions

_TRACK_FIELDS = [f.name for f in RAW_TRACK.fields]
_ARTIST_FIELDS = [f.name for f in RAW_ARTIST.fields]


def _date(d):
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def album(id="L1", name="Album 1", release_date="2001-02-03", precision="day",
          album_type="album", images=(("img/L1",),)):
    return {"id": id, "name": name, "release_date": release_date,
            "release_date_precision": precision, "album_type": album_type,
            "uri": None if id is None else f"album:{id}",
            "images": None if images is None else [{"url": u[0], "height": 1, "width": 1}
                                                   for u in images],
            "total_tracks": None}


def track(id, name, date, artists=(("A1", "Artist 1"),), alb=None, popularity=50,
          duration_ms=1000, explicit=False):
    d = _date(date)
    row = {f: None for f in _TRACK_FIELDS}
    row.update({
        "id": id, "name": name, "type": "track", "popularity": popularity,
        "duration_ms": duration_ms, "explicit": explicit,
        "uri": None if id is None else f"track:{id}",
        "artists": None if artists is None else [
            {"id": a[0], "name": a[1], "uri": f"artist:{a[0]}", "type": "artist", "href": None}
            for a in artists],
        "album": album() if alb is None else alb,
        "year": d.year, "month": d.month, "day": d.day})
    return row


def artist(id, name, date, popularity=40, genres=("pop",), followers=10,
           images=(("img/A",),)):
    d = _date(date)
    row = {f: None for f in _ARTIST_FIELDS}
    row.update({
        "id": id, "name": name, "type": "artist",
        "uri": None if id is None else f"artist:{id}", "popularity": popularity,
        "genres": None if genres is None else list(genres),
        "followers": {"total": followers, "href": None},
        "images": None if images is None else [{"url": u[0], "height": 1, "width": 1}
                                               for u in images],
        "year": d.year, "month": d.month, "day": d.day})
    return row


def raw_tracks_df(spark, rows):
    schema = with_partitions(RAW_TRACK)
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def raw_artists_df(spark, rows):
    schema = with_partitions(RAW_ARTIST)
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
