"""Every registered query: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables through the scale binding (directly, or via
the workspace's landed and materialised layers derived from them). Array
columns are exposed as ``|``-joined sorted text for the oracle compare."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..functions import first_field, parse_partial_date
from ..schemas import RAW_ARTIST
from ..sources.detect import detected_fields as found_fields, rescued_rows, with_detected
from ..sources.landing import landing_items, read_raw_artists
from ..sources.quarantine import bad_lines
from ..sources.tables import load_table
from .batches import key_batches
from .binding import snapshot_of
from .models import workspace
from .tables import RunFolders

Query = Callable[[SparkSession, str], DataFrame]


def _txt(c: str):
    return F.array_join(F.array_sort(F.col(c)), "|")


def _with_txt(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[_txt(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _run_folder(spark, root, name: str) -> str:
    """A new folder for what one run of a query writes."""
    return f"{workspace(spark, root).base}/{name}-{uuid.uuid4().hex[:12]}"


# -- sources ---------------------------------------------------------------------
def scan_tracks(spark, root):
    r = workspace(spark, root).raw_tracks()
    return r.select(
        "id", "name", "type", "popularity", "duration_ms", "explicit", "uri", "href",
        "track_number", "is_playable", F.col("external_urls")["web"].alias("web_url"),
        F.array_join("available_markets", "|").alias("markets"),
        first_field("artists", "id").alias("primary_artist_id"),
        first_field("artists", "name").alias("primary_artist_name"),
        F.col("album.id").alias("album_id"),
        F.col("album.release_date").alias("album_release_date"),
        F.col("album.release_date_precision").alias("album_release_date_precision"),
        F.col("album.album_type").alias("album_type"),
        first_field("album.images", "url").alias("album_image_url"),
        "year", "month", "day")


def scan_artists(spark, root):
    r = workspace(spark, root).raw_artists()
    return r.select(
        "id", "name", "type", "uri", "popularity", _txt("genres").alias("genres"),
        F.col("followers.total").alias("followers_total"),
        first_field("images", "url").alias("image_url"),
        F.col("external_urls")["web"].alias("web_url"), "year", "month", "day")


def _top_tracks(spark, root):
    """Top-10 parts per ship month by quantity (ties: smaller part key).
    Ranked on the numeric key; the text id is built for the k survivors only."""
    li = load_table(spark, root, "lineitem")
    x = li.select(snapshot_of("l_shipdate").alias("snapshot_date"), "l_partkey", "l_quantity")
    t = ops.snapshot_top_k(x, "snapshot_date", "l_partkey", "l_quantity", k=10)
    return t.select("snapshot_date",
                    F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("item_id"),
                    F.col("score").cast("bigint").alias("score"), "item_rank")


def snapshot_top_k(spark, root):
    return _top_tracks(spark, root)


def q_landing_items(spark, root):
    """The top-k response per snapshot (k items at most: a bounded group)
    -> one JSON line per item, with the zero-padded partition values."""
    t = _top_tracks(spark, root)
    resp = t.groupBy("snapshot_date").agg(F.array_sort(F.collect_list(
        F.struct("item_rank", F.col("item_id").alias("id"), "score"))).alias("items"))
    resp = resp.select(F.date_format("snapshot_date", "yyyy").alias("year"),
                       F.date_format("snapshot_date", "MM").alias("month"),
                       F.date_format("snapshot_date", "dd").alias("day"), "items")
    return landing_items(resp, keep=("year", "month", "day"))


# -- staging / dims / fact -------------------------------------------------------
def stg_top_tracks(spark, root):
    return ops.stage_tracks(workspace(spark, root).raw_tracks())


def stg_top_artists(spark, root):
    return _with_txt(ops.stage_artists(workspace(spark, root).raw_artists()), "artist_genres")


def partial_date(spark, root):
    s = workspace(spark, root).stg_tracks()
    return (s.select("album_release_date", "album_release_date_precision").distinct()
             .withColumn("album_release_date_parsed",
                         parse_partial_date("album_release_date", "album_release_date_precision")))


def latest_by_key(spark, root):
    li = load_table(spark, root, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"),
        "l_orderkey", "l_linenumber", "l_quantity")
    return ops.latest_by_key(li, ["l_partkey"], "ship_date", ["l_orderkey", "l_linenumber"])


def dim_albums(spark, root):
    return ops.dim_albums(workspace(spark, root).stg_tracks())


def dim_artists(spark, root):
    return _with_txt(ops.dim_artists(workspace(spark, root).stg_artists()), "artist_genres")


def _split_newest(ws, kind, date):
    """The staged rows of a feed: those of the older snapshots and those of the newest one, which the partition
    listing names."""
    df = ws.stg_tracks() if kind == "tracks" else ws.stg_artists()
    newest = ws.snapshot_dates(kind).agg(F.max(date)).scalar()
    is_newest = F.coalesce(F.col(date) == newest, F.lit(False))     # rows without a date are old
    return df.filter(~is_newest), df.filter(is_newest)


def upsert_albums(spark, root):
    """Dimension of all older snapshots, upserted with the newest one."""
    old, new = _split_newest(workspace(spark, root), "tracks", "track_snapshot_date")
    older = [ops.dim_albums(rows) for rows in key_batches(old, "album_id")]
    # Large: written part by part, so that the shuffle files of one part only are on disk.
    written = (older[0] if len(older) == 1 else
               RunFolders(spark, _run_folder(spark, root, "older-albums")).write_batches(older))
    return ops.upsert(written, ops.dim_albums(new), "album_id")


def upsert_artists(spark, root):
    old, new = _split_newest(workspace(spark, root), "artists", "artist_snapshot_date")
    return _with_txt(ops.upsert(ops.dim_artists(old), ops.dim_artists(new), "artist_id"),
                     "artist_genres")


def upsert_parts(spark, root):
    """The album dimension in parts by key: created from the older snapshots, then the newest
    one merged into the parts that its albums fall into."""
    old, new = _split_newest(workspace(spark, root), "tracks", "track_snapshot_date")
    older = [ops.dim_albums(rows) for rows in key_batches(old, "album_id")]
    table = ops.PartTable(spark, _run_folder(spark, root, "parts"), older[0].schema, "album_id", parts=64)
    table.create(*older)
    table.upsert(ops.dim_albums(new))
    return table.read()


def fct_bucketed(spark, root):
    """The star join over bucketed staged tracks and albums: no shuffle of the staged
    rows for the albums."""
    ws = workspace(spark, root)
    tracks, albums = ws.bucketed_star()
    return _with_txt(ops.build_fact(tracks, albums, ws.dim_artists(), album_key="album_key"), "artist_genres")


def fct_snapshot_top_items(spark, root):
    """The star join over the staged tracks and the dimension tables (the
    dimensions are tables in the reference too; their build is measured by
    the ``dim_*`` queries)."""
    ws = workspace(spark, root)
    f = ops.build_fact(ws.stg_tracks(), ws.dim_albums(), ws.dim_artists())
    return _with_txt(f, "artist_genres")


# -- marts (over the materialised fact table, as in the reference) ---------------
def mart_avg_popularity_trends(spark, root):
    return ops.popularity_trends(workspace(spark, root).fact())


def mart_genre_distribution(spark, root):
    return ops.genre_distribution(workspace(spark, root).fact())


def mart_track_vintages(spark, root):
    return ops.track_vintages(workspace(spark, root).fact())


def mart_list_changes(spark, root):
    """Snapshot dates come from the staged tables' partition folders."""
    ws = workspace(spark, root)
    return ops.list_changes(ws.stg_tracks(), ws.stg_artists(),
                            ws.snapshot_dates("tracks"), ws.snapshot_dates("artists"))


def mart_track_persistence(spark, root):
    ws = workspace(spark, root)
    dates = (ws.stg_tracks().filter(F.col("track_id").isNotNull())
               .select("track_snapshot_date"))
    return ops.track_persistence(ws.fact(), dates)


def _in_order(spark, root, name, mart, *ties):
    return ops.with_position(mart, [*ops.presentation_order(name), *ties], _run_folder(spark, root, name))


def ordered_track_persistence(spark, root):
    """The persistence view in its display order; ties by track id."""
    return _in_order(spark, root, "mart_track_persistence", mart_track_persistence(spark, root),
                     F.col("track_id").asc())


def ordered_track_vintages(spark, root):
    """The decade shares in their display order (date, then the decades' own order)."""
    return _in_order(spark, root, "mart_track_vintages", mart_track_vintages(spark, root))


def ordered_genre_distribution(spark, root):
    """The genre shares in their display order; ties by genre."""
    return _in_order(spark, root, "mart_genre_distribution", mart_genre_distribution(spark, root),
                     F.col("genre").asc())


# -- enrichment (reads the dimension table, as the reference's MERGE does) --------
def _newest(ws):
    """Newest staged track snapshot, from the partition listing (a scalar
    subquery over one row per snapshot; no scan of the staged rows)."""
    return ops.latest_snapshot(ws.snapshot_dates("tracks")).scalar()


def latest_snapshot(spark, root):
    """Read from the staged tracks; only the partition column is scanned."""
    return ops.latest_snapshot(workspace(spark, root).stg_tracks())


def snapshot_entities(spark, root):
    ws = workspace(spark, root)
    return ops.snapshot_entities(ws.stg_tracks(), as_of=_newest(ws))


def enrichment_candidates(spark, root):
    ws = workspace(spark, root)
    return ops.enrichment_candidates(ws.stg_tracks(), ws.dim_artists(), as_of=_newest(ws))


def lookup_details(spark, root):
    ws = workspace(spark, root)
    cand = ops.enrichment_candidates(ws.stg_tracks(), ws.dim_artists(), as_of=_newest(ws))
    found = ops.lookup_details(cand, ws.details())
    return found.select("id", "name", "uri", "popularity", _txt("genres").alias("genres"),
                        first_field("images", "url").alias("image_url"))


def zip_arrays(spark, root):
    """Details rows packed into columnar payloads of at most 50 ids (id
    ranges of the unique numeric key), then zipped back into rows. All seven
    arrays: genres travel as JSON text (of every seventh supplier cut off, of every
    fifth an empty array), the snapshot as ISO text (of every ninth an impossible day, of
    every eighth in another notation)."""
    key = F.substring("id", 2, 30).cast("bigint")
    genres = (F.when(key % 7 == 3, F.lit('["cut off'))
               .when(key % 5 == 2, F.lit("[]")).otherwise(F.to_json("genres")))
    day = (F.when(key % 9 == 4, F.lit("1997-02-30")).when(key % 8 == 5, F.lit("1 May 1997"))
            .otherwise(F.format_string("1997-%02d-%02d", key % 12 + 1, key % 28 + 1)))
    d = workspace(spark, root).details().select(
        "id", "name", "popularity", genres.alias("genres"), "uri",
        first_field("images", "url").alias("image_url"), day.alias("snapshot_date"),
        F.floor(key / 50).alias("batch"))
    payload = ops.to_parallel_arrays(d, "batch", ops.PAYLOAD_FIELDS, order="id")
    z = ops.zip_payload(payload)
    return z.select("id", "name", "popularity", F.array_join("genres", "|").alias("genres"), "uri",
                    "image_url", "snapshot_date")


def enrich_artists(spark, root):
    ws = workspace(spark, root)
    dim = ops.enrich_artists(ws.stg_tracks(), ws.dim_artists(), ws.details(), as_of=_newest(ws))
    return _with_txt(dim, "artist_genres")


def merge_counts(spark, root):
    """What the newest snapshot's merge into the older artist dimension changes: counted
    while its rows are written, without a job of its own."""
    from pyspark.sql import Observation
    ws = workspace(spark, root)
    old, new = _split_newest(ws, "artists", "artist_snapshot_date")
    merge = Observation()
    merged = ops.merged_with_counts(ops.dim_artists(old), ops.dim_artists(new), "artist_id", merge)
    merged.write.parquet(_run_folder(spark, root, "merge"))
    return spark.createDataFrame([merge.get], "matched long, inserted long, affected long")


def quarantine_lines(spark, root):
    """A landing zone with bad lines: those of every fifth supplier end half-way, those
    of another fifth have text for a number. Per snapshot: lines, those that the scan gives and
    their popularity, and those that the quarantine holds."""
    ws = workspace(spark, root)
    feed = f"{ws.damaged_landing()}/artists"
    good = read_raw_artists(spark, feed).groupBy("year", "month", "day").agg(
        F.count("*").alias("good_lines"), F.sum("popularity").alias("good_popularity"))
    bad = bad_lines(spark, feed, RAW_ARTIST).groupBy("year", "month", "day").agg(F.count("*").alias("bad_lines"))
    keys = ["year", "month", "day"]
    both = good.join(bad, keys, "full_outer")
    return both.select(*keys, F.coalesce("good_lines", F.lit(0)).alias("good_lines"), "good_popularity",
                       F.coalesce("bad_lines", F.lit(0)).alias("bad_lines"))


def _drifted(spark, root):
    return rescued_rows(spark, f"{workspace(spark, root).drifted_landing()}/artists", RAW_ARTIST)


def detected_fields(spark, root):
    """Fields that the declared schema doesn't name: their detected type and lines."""
    return found_fields(_drifted(spark, root))


def scan_detected(spark, root):
    """The artist scan with a column for each of them; objects and mixtures as JSON text."""
    d = with_detected(_drifted(spark, root))

    def field(name, kind):                        # a small table may have no line with it
        if name not in d.columns:
            return F.lit(None).cast(kind).alias(name)
        return (F.to_json(name) if d.schema[name].dataType.typeName() == "variant" else F.col(name).cast(kind)).alias(name)

    return d.select("id", "popularity", first_field("images", "url").alias("image_url"), field("label", "string"),
                    field("rank", "bigint"), field("weight", "double"), field("mixed", "string"), field("tour", "string"),
                    "year", "month", "day")


# -- streaming (incremental model maintenance) -------------------------------------
def _streamed(spark, root, kind: str, feed: str):
    from ..streaming import read_dimension, start_dimension_stream
    ws = workspace(spark, root)
    run = _run_folder(spark, root, "stream")
    q = start_dimension_stream(spark, f"{ws.land(feed)}/{feed}", kind, f"{run}/dim", f"{run}/checkpoint")
    q.awaitTermination()                          # availableNow stops by itself
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_dimension(spark, f"{run}/dim", kind)


def stream_dim_artists(spark, root):
    """The artist dimension maintained by an availableNow file stream over the landing
    zone, with keyed state; must equal the batch-built dimension."""
    return _with_txt(_streamed(spark, root, "artists", "artists"), "artist_genres")


def stream_dim_albums(spark, root):
    """The album dimension likewise, from the track feed."""
    return _streamed(spark, root, "albums", "tracks")


QUERIES: dict[str, Query] = {
    "scan_tracks": scan_tracks,
    "scan_artists": scan_artists,
    "landing_items": q_landing_items,
    "snapshot_top_k": snapshot_top_k,
    "stg_top_tracks": stg_top_tracks,
    "stg_top_artists": stg_top_artists,
    "partial_date": partial_date,
    "latest_by_key": latest_by_key,
    "dim_albums": dim_albums,
    "dim_artists": dim_artists,
    "upsert_albums": upsert_albums,
    "upsert_artists": upsert_artists,
    "upsert_parts": upsert_parts,
    "fct_snapshot_top_items": fct_snapshot_top_items,
    "fct_bucketed": fct_bucketed,
    "mart_avg_popularity_trends": mart_avg_popularity_trends,
    "mart_genre_distribution": mart_genre_distribution,
    "mart_track_vintages": mart_track_vintages,
    "mart_list_changes": mart_list_changes,
    "mart_track_persistence": mart_track_persistence,
    "ordered_track_persistence": ordered_track_persistence,
    "ordered_track_vintages": ordered_track_vintages,
    "ordered_genre_distribution": ordered_genre_distribution,
    "latest_snapshot": latest_snapshot,
    "snapshot_entities": snapshot_entities,
    "enrichment_candidates": enrichment_candidates,
    "lookup_details": lookup_details,
    "zip_arrays": zip_arrays,
    "enrich_artists": enrich_artists,
    "merge_counts": merge_counts,
    "quarantine_lines": quarantine_lines,
    "detected_fields": detected_fields,
    "scan_detected": scan_detected,
    "stream_dim_artists": stream_dim_artists,
    "stream_dim_albums": stream_dim_albums,
}
