"""DataFrame -> DataFrame operators."""
from .dims import dim_albums, dim_artists
from .enrich import (enrich_artists, enrichment_candidates, latest_snapshot,
                     lookup_details, shape_details, snapshot_entities, to_parallel_arrays, zip_arrays)
from .fact import FACT_TRACK_COLUMNS, album_join_key, build_fact
from .latest import latest_by_key
from .marts import (genre_distribution, item_changes, list_changes, popularity_trends, present,
                    presentation_order,
                    share_of_buckets, share_of_total, streaks, track_persistence, track_vintages)
from .ordered import with_position
from .payload import PAYLOAD_FIELDS, iso_date, merged_with_counts, zip_payload
from .staging import stage_artists, stage_tracks
from .topk import snapshot_top_k
from .upsert import PartTable, one_per_key, upsert, upsert_latest

zip_rows = zip_arrays

__all__ = [n for n in dir() if not n.startswith("_")]
