from .landing import landing_items, read_raw_artists, read_raw_tracks, write_landing
from .tables import load_table
from .ingest import ingest_feeds, ingest_run, top_items

__all__ = ["landing_items", "read_raw_artists", "read_raw_tracks", "write_landing", "load_table",
           "ingest_feeds", "ingest_run", "top_items"]
