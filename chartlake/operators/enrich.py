"""Enrichment (OP-18 .. OP-23): add details for entities of the newest
snapshot that the dimension lacks. Everything stays distributed; nothing is
collected to the driver."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import first_field
from .upsert import upsert


def latest_snapshot(df: DataFrame, date: str = "track_snapshot_date") -> DataFrame:
    """One row, ``latest_snapshot_date``; NULL on an empty table (the
    "no data" outcome)."""
    return df.agg(F.max(date).alias("latest_snapshot_date"))


def _as_of(stg_tracks: DataFrame, date: str, as_of):
    """The snapshot to enrich: ``as_of`` (a backfill date parameter) or the
    newest one as a scalar subquery (a partition filter either way)."""
    if as_of is None:
        return latest_snapshot(stg_tracks, date).scalar()
    return as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("date")


def snapshot_entities(stg_tracks: DataFrame, date: str = "track_snapshot_date",
                      entity: str = "primary_artist_id", as_of=None) -> DataFrame:
    """Distinct non-NULL entity ids in the newest snapshot (or ``as_of``)."""
    newest = _as_of(stg_tracks, date, as_of)
    return (stg_tracks.filter((F.col(date) == newest) & F.col(entity).isNotNull())
                      .select(F.col(entity).alias("artist_id")).distinct())


def enrichment_candidates(stg_tracks: DataFrame, dim: DataFrame,
                          key: str = "artist_id", as_of=None) -> DataFrame:
    """Entities of the newest snapshot absent from the dimension (left-anti
    join; the reference's driver-side set difference)."""
    known = dim.select(F.col(key).alias("artist_id")).filter(F.col("artist_id").isNotNull())
    return snapshot_entities(stg_tracks, as_of=as_of).join(known, "artist_id", "left_anti")


def lookup_details(ids: DataFrame, details: DataFrame, id_col: str = "artist_id",
                   detail_key: str = "id") -> DataFrame:
    """Resolve ids against a details table: empty/NULL ids dropped, ids with
    no details vanish silently, NULL detail rows dropped. A left-semi join
    from the details side; AQE broadcasts the id set when it is small. A
    details table with several rows for one id yields one of them,
    deterministically (the greatest row), so the upsert source stays keyed;
    the dedupe runs on the matched rows only."""
    from .latest import latest_by_key
    wanted = (ids.select(F.col(id_col).alias("__id"))
                 .filter(F.col("__id").isNotNull() & (F.col("__id") != "")).distinct())
    d = details.filter(F.col(detail_key).isNotNull())
    found = d.join(wanted, d[detail_key] == wanted["__id"], "left_semi")
    rest = [c for c, t in found.dtypes if c != detail_key and "map<" not in t]
    return latest_by_key(found, [detail_key], rest[0], rest[1:]) if rest else found.distinct()


def zip_arrays(df: DataFrame, arrays: Sequence[str], keep: Sequence[str] = (),
               pos: str | None = "pos") -> DataFrame:
    """Parallel arrays -> one row per offset (``UNNEST ... WITH OFFSET`` joined
    on the offset). ``arrays_zip`` pads shorter arrays with NULL; the offset
    joins would drop the excess instead, so rows beyond the shortest array are
    removed to keep that semantics."""
    arrays = list(arrays)
    shortest = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    z = df.select(*keep, F.posexplode(F.arrays_zip(*arrays)).alias("__pos", "__z"),
                  shortest.alias("__n"))
    z = z.filter(F.col("__pos") < F.col("__n"))
    out = [*keep] + ([F.col("__pos").alias(pos)] if pos else []) + \
          [F.col(f"__z.{a}").alias(a) for a in arrays]
    return z.select(*out)


def to_parallel_arrays(df: DataFrame, batch: str, fields: Sequence[str],
                       order: str) -> DataFrame:
    """Rows -> one payload row per ``batch`` holding one array per field, all
    in ``order`` (the columnar shape of a batch lookup response). Callers
    must choose a batch key with a bounded number of rows per batch."""
    packed = F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order])))
    agg = df.groupBy(batch).agg(packed.alias("__rows"))
    def field(name):
        return F.transform("__rows", lambda x: x.getField(name)).alias(name)

    return agg.select(batch, *[field(f) for f in fields])


def genres_array(col, quoted: bool = False) -> F.Column:
    """JSON text (``'["a","b"]'``) -> ``array<string>``. Unquoted elements by
    default (our decision, so enriched genres equal staged ones);
    ``quoted=True`` keeps each element's JSON text (``'"a"'``), as a
    JSON-array query function on JSON text returns it."""
    if quoted:
        return F.transform(F.parse_json(col).cast("array<variant>"), lambda x: F.to_json(x))
    return F.from_json(col, T.ArrayType(T.StringType()))


def shape_details(found: DataFrame, snapshot_date) -> DataFrame:
    """Details rows -> dimension rows, stamped with the newest snapshot."""
    g = found.schema["genres"].dataType
    genres = genres_array(F.col("genres")) if isinstance(g, T.StringType) else F.col("genres")
    return found.select(
        F.col("id").alias("artist_id"), F.col("name").alias("artist_name"),
        F.col("popularity").cast("int").alias("artist_popularity"),
        genres.alias("artist_genres"), F.col("uri").alias("artist_uri"),
        first_field("images", "url").alias("artist_image_url"),
        snapshot_date.cast("date").alias("last_seen_artist_snapshot_date"))


def enrich_artists(stg_tracks: DataFrame, dim: DataFrame, details: DataFrame,
                   as_of=None) -> DataFrame:
    """candidates -> lookup -> shape -> upsert into the dimension. Returns the
    new dimension (lazy); with no candidates it equals ``dim``. ``as_of``
    backfills an older snapshot instead of the newest."""
    found = lookup_details(enrichment_candidates(stg_tracks, dim, as_of=as_of), details)
    snap = _as_of(stg_tracks, "track_snapshot_date", as_of)
    return upsert(dim, shape_details(found, snap), "artist_id")
