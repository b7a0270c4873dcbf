"""The model run (OP-24): land -> scan -> stage -> dimensions (upsert) ->
enrich -> fact -> marts, each materialised as the reference materialises it
(views stay lazy, tables are written, incremental models are upserted).

Everything is written under the cluster-shared folder named by
``spark.checkpoint.dir`` (a written table also cuts lineage, so a lost
executor only recomputes from the last written layer)."""
from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..schemas import RAW_ARTIST, RAW_TRACK
from ..session import drop_shuffle_files, shared_dir
from ..sources.bucketed import write_bucketed
from ..sources.landing import HIVE_NULL, read_raw_artists, read_raw_tracks, write_landing
from ..sources.quarantine import quarantine
from . import binding
from .batches import snapshot_batches
from .tables import DONE, RunFolders, names_under

STG_TRACK_COLUMNS = [
    "track_id", "track_name", "primary_artist_id", "album_id", "track_popularity",
    "duration_ms", "explicit", "track_uri", "primary_artist_name", "primary_artist_uri",
    "album_name", "album_release_date", "album_release_date_precision", "album_type",
    "album_uri", "album_image_url", "snapshot_year", "snapshot_month", "snapshot_day",
    "track_snapshot_date"]
STG_ARTIST_COLUMNS = [
    "artist_id", "artist_name", "artist_uri", "artist_popularity", "artist_genres",
    "artist_follower_count", "artist_image_url", "snapshot_year", "snapshot_month",
    "snapshot_day", "artist_snapshot_date"]
FACT_COLUMNS = [
    "track_snapshot_date", "track_id", "artist_id", "album_id", "track_name",
    "track_popularity", "duration_ms", "explicit", "track_uri", "album_name",
    "album_release_date_parsed", "album_type", "artist_name", "artist_popularity",
    "artist_genres", "artist_uri", "artist_image_url"]


def to_lines(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Raw rows -> (value = compact JSON of the item, zero-padded y/m/d; texts are taken as they are). ``order``:
    expressions that a task's lines of a partition are sorted by; alike ones next to each other take less room."""
    item_cols = [c for c in raw.columns if c not in ("year", "month", "day")]
    keys = [F.expr(c).alias(f"__order{i}") for i, c in enumerate(order)]
    kinds = dict(raw.dtypes)
    dates = [F.col(c) if kinds[c] == "string" else F.lpad(F.col(c).cast("string"), width, "0").alias(c)
             for c, width in (("year", 4), ("month", 2), ("day", 2))]
    lines = raw.select(
        F.to_json(F.struct(*item_cols), {"ignoreNullFields": "false"}).alias("value"), *dates, *keys)
    if not order:
        return lines
    # The partition first: a sort that the write adds would undo this one.
    return (lines.sortWithinPartitions(*lines.columns[1:])
                 .select("value", "year", "month", "day"))


def backfill(lines: DataFrame, root: str, finished: bool = True) -> None:
    """``to_lines`` of the binding's feeds (snapshot by snapshot) into the landing zone."""
    write_landing(lines, root, partition_cols=["year", "month", "day"], compression="gzip", clustered=True,
                  finished=finished)


def _key(value: str) -> Column:
    """The number in an item's id."""
    return F.get_json_object(value, "$.id").substr(F.lit(2), F.lit(30)).cast("bigint")


FEEDS = {"artists": binding.raw_artists, "tracks": binding.raw_tracks}
# Track rows are moved three times, beside the orders: shorter stretches.
FEED_FINER = {"artists": 1, "tracks": 2}
FEED_ORDER = {"artists": ["id"], "tracks": []}     # tracks come in order


class Workspace:
    """Landing zone and materialised layers for one source directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        drop_shuffle_files(spark)
        tag = hashlib.sha1(self.root.encode()).hexdigest()[:10]
        app = spark.sparkContext.applicationId
        self.base = f"{shared_dir(spark)}/chartlake/{app}/ws-{tag}"
        self.tables = {n: RunFolders(spark, f"{self.base}/{n}") for n in
                       ("stg_tracks", "stg_artists", "dim_albums", "dim_artists",
                        "fct_snapshot_top_items")}
        self._landed: dict[tuple[str, ...], str] = {}      # by feeds
        self._attempt: str | None = None
        self._batches: dict[str, list[Column | None]] = {}
        self._damaged: str | None = None
        self._drifted: str | None = None
        self._bucketed: tuple[DataFrame, DataFrame] | None = None
        self._lock = threading.RLock()
        self._frames: dict[str, DataFrame] = {}
        self._layer_locks: dict[str, threading.Lock] = {}

    # -- OP-03 + OP-01/02 ----------------------------------------------------
    def land(self, *kinds: str) -> str:
        """Backfill the landing zone from the binding (once): both feeds, or those named.
        A feed counts when Spark has finished it; one whose write failed is never gone on
        with, so a failed attempt never leaves half a backfill."""
        kinds = tuple(sorted(kinds or FEEDS))
        with self._lock:
            if kinds not in self._landed:
                self._landed[kinds] = self._committed_landing(kinds) or self._backfilled(kinds)
            return self._landed[kinds]

    def _backfilled(self, kinds: tuple[str, ...]) -> str:
        at = self._attempt
        if at is None or any(self._begun(at, k) and not self._done(at, k) for k in kinds):
            at = self._attempt = f"{self.base}/landing-{uuid.uuid4().hex[:12]}"
        for kind in [k for k in kinds if not self._done(at, k)]:
            self._backfill(kind, f"{at}/{kind}")
        return at

    def _backfill(self, kind: str, path: str, change=lambda lines: lines) -> None:
        # A stretch of snapshots at a time: the shuffle files of one are gone before the next one's are written.
        if kind not in self._batches:
            self._batches[kind] = snapshot_batches(binding.snapshots(self.spark, self.root), "d", FEED_FINER[kind])
        for i, batch in enumerate(self._batches[kind], 1):
            lines = to_lines(FEEDS[kind](self.spark, self.root, batch), FEED_ORDER[kind])
            backfill(change(lines), path, finished=i == len(self._batches[kind]))

    def _begun(self, landing: str, kind: str) -> bool:
        return kind in names_under(self.spark, landing)

    def _done(self, landing: str, kind: str) -> bool:
        return DONE in names_under(self.spark, f"{landing}/{kind}")

    def _committed_landing(self, kinds: tuple[str, ...]) -> str | None:
        """A landing attempt finished earlier in this application (e.g. by
        another session on the same context)."""
        for name in names_under(self.spark, self.base):
            attempt = f"{self.base}/{name}"
            if name.startswith("landing-") and all(self._done(attempt, kind) for kind in kinds):
                return attempt
        return None

    def damaged_landing(self) -> str:
        """A landing zone of the artist feed with bad lines among the good ones (once):
        suppliers divisible by 5 have their line cut in half, those with remainder 1
        have text where a number belongs."""
        with self._lock:
            if self._damaged is None:
                out = f"{self.base}/damaged-{uuid.uuid4().hex[:12]}"
                key = F.col("key")
                value = (F.when(key % 5 == 0, F.col("value").substr(F.lit(1), F.floor(F.length("value") / 2)))
                          .when(key % 5 == 1, F.regexp_replace("value", r'"popularity":\d+', '"popularity":"high"'))
                          .otherwise(F.col("value")))
                self._backfill("artists", f"{out}/artists",
                               lambda lines: lines.withColumn("key", _key("value")).withColumn("value", value))
                self._damaged = out
            return self._damaged

    def drifted_landing(self) -> str:
        """A landing zone of the artist feed whose lines differ in their fields (once), by the
        supplier's number: a text and a number in some, a number with a fraction in others, an
        object, a value that is a number or a text, and empty ``images``."""
        with self._lock:
            if self._drifted is None:
                out = f"{self.base}/drifted-{uuid.uuid4().hex[:12]}"
                key = F.col("key")

                def when(divisor, rest, *text):
                    return F.when(key % divisor == rest, F.concat(*text)).otherwise("")

                n = key.cast("string")
                extra = F.concat(
                    when(4, 0, F.lit(',"label":"label '), n, F.lit('"')), when(3, 0, F.lit(',"rank":'), n),
                    when(6, 1, F.lit(',"weight":'), n, F.lit(".5")), when(6, 2, F.lit(',"weight":'), n),
                    when(5, 1, F.lit(',"tour":{"stop":'), n, F.lit("}")),
                    when(8, 3, F.lit(',"mixed":'), n), when(8, 5, F.lit(',"mixed":"none"')))
                value = F.when(key % 7 == 0, F.regexp_replace("value", r'"images":\[[^\]]*\]', '"images":[]')) \
                         .otherwise(F.col("value"))
                value = F.concat(F.left(value, F.length(value) - 1), extra, F.lit("}"))
                self._backfill("artists", f"{out}/artists",
                               lambda lines: lines.withColumn("key", _key("value")).withColumn("value", value))
                self._drifted = out
            return self._drifted

    def raw_tracks(self) -> DataFrame:
        return read_raw_tracks(self.spark, f"{self.land('tracks')}/tracks")

    def raw_artists(self) -> DataFrame:
        return read_raw_artists(self.spark, f"{self.land('artists')}/artists")

    # -- staging (views, materialised once, partitioned by snapshot date) ------
    def _materialised(self, name: str, build, partition: str | None,
                      columns: list[str], clustered: bool = False, order: Sequence[str] = ()) -> DataFrame:
        """Write once, then hand out the same DataFrame (its file index is
        listed once, not on every query). One lock per layer, so independent
        layers can be built by concurrent jobs."""
        with self._lock:
            lock = self._layer_locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._frames:
                t, df = self.tables[name], build()
                written = (t.read(df.schema) if t.exists()
                           else t.write_batches([df], [partition] if partition else None, clustered, order))
                self._frames[name] = written.select(*columns)
            return self._frames[name]

    # Each landed file holds one snapshot, and few files a hot one: a staged file for each.
    def stg_tracks(self) -> DataFrame:
        return self._materialised("stg_tracks", lambda: ops.stage_tracks(self.raw_tracks()),
                                  "track_snapshot_date", STG_TRACK_COLUMNS, clustered=True,
                                  order=["primary_artist_id", "track_id"])

    def stg_artists(self) -> DataFrame:
        return self._materialised("stg_artists", lambda: ops.stage_artists(self.raw_artists()),
                                  "artist_snapshot_date", STG_ARTIST_COLUMNS, clustered=True, order=["artist_id"])

    def snapshot_dates(self, kind: str) -> DataFrame:
        """Distinct snapshot dates of a staged feed (``tracks``/``artists``)
        from its partition folders: no scan; one row per snapshot."""
        name, col = {"tracks": ("stg_tracks", "track_snapshot_date"),
                     "artists": ("stg_artists", "artist_snapshot_date")}[kind]
        (self.stg_tracks if kind == "tracks" else self.stg_artists)()     # materialised
        # Rows without a date lie in Hive's default partition, which names no date.
        values = [v for v in self.tables[name].partition_values(col) if v != HIVE_NULL]
        return self.spark.createDataFrame([(v,) for v in values], "d string").select(
            F.col("d").cast("date").alias(col))

    def dim_artists(self) -> DataFrame:
        """The artist dimension as a table (incremental model in the reference)."""
        return self._materialised("dim_artists", lambda: ops.dim_artists(self.stg_artists()),
                                  None, ops.dims.DIM_ARTIST_COLUMNS)

    def dim_albums(self) -> DataFrame:
        return self._materialised("dim_albums", lambda: ops.dim_albums(self.stg_tracks()),
                                  None, ops.dims.DIM_ALBUM_COLUMNS)

    def bucketed_star(self) -> tuple[DataFrame, DataFrame]:
        """The staged tracks and the album dimension as bucketed tables (once per
        session), as many buckets as shuffle partitions."""
        with self._lock:
            if self._bucketed is None:
                run, n = uuid.uuid4().hex[:12], int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                staged = self.stg_tracks()
                # What the star join reads of a staged row, and the salted key.
                tracks = [rows.select(*ops.FACT_TRACK_COLUMNS, ops.album_join_key().alias("album_key"))
                          for rows in in_batches(staged, "track_snapshot_date")]
                self._bucketed = tuple(
                    write_bucketed(df, f"chartlake_{name}_{run}", f"{self.base}/bucketed-{run}/{name}", key, n)
                    for name, df, key in (("tracks", tracks, "album_key"), ("albums", self.dim_albums(), "album_id")))
            return self._bucketed

    def details(self) -> DataFrame:
        return binding.artist_details(self.spark, self.root)

    def warm(self) -> None:
        """Materialise every layer; independent layers are submitted as
        concurrent jobs."""
        self.land()
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(self.stg_tracks), pool.submit(self.stg_artists)]:
                f.result()
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(self.dim_albums), pool.submit(self.dim_artists)]:
                f.result()
        self.fact()

    # -- gold -------------------------------------------------------------------
    def fact(self) -> DataFrame:
        name = "fct_snapshot_top_items"
        with self._lock:
            lock = self._layer_locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._frames:
                table, dims = self.tables[name], (self.dim_albums(), self.dim_artists())
                self._frames[name] = (table.read(ops.build_fact(self.stg_tracks().limit(0), *dims).schema).select(*FACT_COLUMNS)
                                      if table.exists() else write_fact(table, self.stg_tracks(), *dims))
            return self._frames[name]


def in_batches(staged: DataFrame, date: str, finer: int = 1) -> list[DataFrame]:
    """``staged`` in stretches of snapshots (whole folders of a layer partitioned by ``date``)."""
    return [staged if batch is None else staged.filter(batch) for batch in snapshot_batches(staged, date, finer)]


def write_fact(table: RunFolders, stg_tracks: DataFrame, dim_albums: DataFrame, dim_artists: DataFrame) -> DataFrame:
    """The star join as a new folder of ``table``, stretch by stretch of snapshots; rows of an
    artist next to each other. Its rows are moved up to three times, the last time with their artist's columns,
    while all layers lie beside them: shorter stretches than the artists'."""
    facts = [ops.build_fact(rows, dim_albums, dim_artists)
             for rows in in_batches(stg_tracks, "track_snapshot_date", finer=2)]
    return table.write_batches(facts, ["track_snapshot_date"], order=["artist_id", "track_id"]).select(*FACT_COLUMNS)


_WORKSPACES: dict[tuple[str, str], Workspace] = {}
_WS_LOCK = threading.Lock()


def workspace(spark: SparkSession, root: str) -> Workspace:
    """The workspace of ``root`` for this session (sessions sharing a context
    share the written layers, not DataFrame objects)."""
    key = (spark.sparkContext.applicationId, id(spark), root.rstrip("/"))
    with _WS_LOCK:
        if key not in _WORKSPACES:
            _WORKSPACES[key] = Workspace(spark, root)
        return _WORKSPACES[key]


# -- OP-24: a full run ----------------------------------------------------------
def merged_dimension(table: RunFolders, stg: DataFrame, build, key: str) -> DataFrame:
    """Incremental model with a unique key, not yet written. First run: the dimension.
    Later runs: MERGE the latest row per key into what the last run wrote (keys gone from
    staging survive). As in the reference, the source is rebuilt from all history, which
    also picks up late files for old snapshots and further files of the newest one."""
    # ``build`` is latest-by-key, so the source keys are unique by construction.
    rows = build(stg)
    return ops.upsert(table.read(rows.schema), rows, key) if table.exists() else rows


def run_models(spark: SparkSession, root: str, out: str | None = None) -> dict[str, DataFrame]:
    """Run the whole DAG over the scale binding of the tables in ``root``."""
    ws = workspace(spark, root)
    return run_models_on(spark, ws.stg_tracks(), ws.stg_artists(), ws.details(),
                         out or ws.base)


def stage_landing(spark: SparkSession, landing_root: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Your own feeds: landing folder (``tracks/`` and ``artists/`` with
    ``year=/month=/day=`` partitions) -> staged tables written under ``out``
    (new folders, partitioned by snapshot date) -> (stg_tracks, stg_artists). Lines
    that don't fit the feed's schema are written to ``out/quarantine`` instead."""
    for kind, schema in (("tracks", RAW_TRACK), ("artists", RAW_ARTIST)):
        quarantine(spark, f"{landing_root}/{kind}", schema, f"{out}/quarantine/{kind}")
    t = RunFolders(spark, f"{out}/stg_tracks").write(
        ops.stage_tracks(read_raw_tracks(spark, f"{landing_root}/tracks")), ["track_snapshot_date"])
    a = RunFolders(spark, f"{out}/stg_artists").write(
        ops.stage_artists(read_raw_artists(spark, f"{landing_root}/artists")), ["artist_snapshot_date"])
    return t.select(*STG_TRACK_COLUMNS), a.select(*STG_ARTIST_COLUMNS)


def run_models_on(spark: SparkSession, stg_t: DataFrame, stg_a: DataFrame,
                  details: DataFrame, out: str) -> dict[str, DataFrame]:
    """Run the DAG in dependency order on staged feeds and a details table
    (columns of ``schemas.ARTIST_DETAILS``), writing under ``out``. Returns
    every relation, each read back from its written table (marts unsorted;
    see ``present``); the persistence mart stays a lazy view."""
    base = out
    artists = RunFolders(spark, f"{base}/run/dim_artists")
    albums = RunFolders(spark, f"{base}/run/dim_albums")
    # Enrichment runs between the artist dimension and the fact: both changes in one write.
    d_art = artists.write(ops.enrich_artists(
        stg_t, merged_dimension(artists, stg_a, ops.dim_artists, "artist_id"), details))
    d_alb = albums.write(merged_dimension(albums, stg_t, ops.dim_albums, "album_id"))
    fact = write_fact(RunFolders(spark, f"{base}/run/fct_snapshot_top_items"), stg_t, d_alb, d_art)
    dates = stg_t.filter(F.col("track_id").isNotNull()).select("track_snapshot_date")
    marts = {
        "mart_avg_popularity_trends": ops.popularity_trends(fact),
        "mart_genre_distribution": ops.genre_distribution(fact),
        "mart_track_vintages": ops.track_vintages(fact),
        "mart_list_changes": ops.list_changes(stg_t, stg_a),
    }
    result = {"stg_top_tracks": stg_t, "stg_top_artists": stg_a, "dim_artists": d_art,
              "dim_albums": d_alb, "fct_snapshot_top_items": fact}
    for name, df in marts.items():
        result[name] = RunFolders(spark, f"{base}/run/{name}").write(df)
    # The persistence mart is a view in the reference: left lazy.
    result["mart_track_persistence"] = ops.present(
        "mart_track_persistence", ops.track_persistence(fact, dates))
    return result


def register_views(relations: dict[str, DataFrame]) -> list[str]:
    """Expose every relation of a model run as a temporary view under its
    model name, so the marts can be queried with SQL
    (``spark.sql("SELECT * FROM mart_list_changes")``)."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)
    return sorted(relations)
