from pyspark.sql import functions as F

from chartlake.plans import run_models

SF = "/root/testdata/sf0.001"


def test_models_rerun_is_stable(spark):
    first = run_models(spark, SF)
    a1 = sorted(map(tuple, first["dim_albums"].collect()))
    r1 = sorted(tuple(r) for r in first["dim_artists"].select(
        "artist_id", "artist_name", "last_seen_artist_snapshot_date").collect())
    m1 = sorted(map(tuple, first["mart_track_persistence"].collect()))
    second = run_models(spark, SF)          # incremental path: upsert into committed versions
    assert sorted(map(tuple, second["dim_albums"].collect())) == a1
    assert sorted(tuple(r) for r in second["dim_artists"].select(
        "artist_id", "artist_name", "last_seen_artist_snapshot_date").collect()) == r1
    assert sorted(map(tuple, second["mart_track_persistence"].collect())) == m1
    # fact grain: one row per staged track row
    assert second["fct_snapshot_top_items"].count() == second["stg_top_tracks"].count()
    # every materialised mart is non-empty
    for name in ("mart_avg_popularity_trends", "mart_genre_distribution",
                 "mart_track_vintages", "mart_list_changes"):
        assert second[name].count() > 0, name
    assert second["mart_avg_popularity_trends"].filter(
        F.col("avg_track_popularity").isNull()).count() == 0


def test_a_second_file_of_the_newest_day_is_merged(spark, tmp_dir):
    from chartlake import operators as ops
    from chartlake.plans.models import merged_dimension
    from chartlake.plans.tables import RunFolders
    from builders import artist, raw_artists_df

    def stg(rows_):
        return ops.stage_artists(raw_artists_df(spark, rows_))

    t = RunFolders(spark, f"{tmp_dir}/dim")
    t.write(merged_dimension(t, stg([artist("A1", "v1", "2024-01-01")]), ops.dim_artists, "artist_id"))
    later = stg([artist("A1", "v1", "2024-01-01"), artist("A5", "n", "2024-01-01"), artist("A6", "n", "2023-01-01")])
    out = t.write(merged_dimension(t, later, ops.dim_artists, "artist_id"))
    assert {r.artist_id for r in out.collect()} == {"A1", "A5", "A6"}


def test_partition_without_a_date_is_no_snapshot(spark, tmp_dir):
    from chartlake.plans.models import HIVE_NULL, Workspace
    from chartlake.plans.tables import RunFolders
    ws = Workspace(spark, SF)
    df = ws.stg_tracks().limit(5)
    bad = df.withColumn("track_snapshot_date", F.lit(None).cast("date"))
    t = RunFolders(spark, f"{tmp_dir}/stg")
    t.write(df.unionByName(bad), ["track_snapshot_date"])
    assert HIVE_NULL in t.partition_values("track_snapshot_date")
    ws.tables["stg_tracks"] = t
    dates = [r[0] for r in ws.snapshot_dates("tracks").collect()]
    assert dates and None not in dates


def test_new_session_reuses_written_layers(spark):
    from chartlake.plans.models import workspace
    a = workspace(spark, SF)
    landed = a.land()
    other = spark.newSession()
    b = workspace(other, SF)
    assert b is not a and b.land() == landed
    assert b.stg_tracks().count() == a.stg_tracks().count()


def test_models_on_own_landing_feeds(spark, tmp_dir):
    from chartlake.plans import run_models_on, stage_landing
    from chartlake.plans.models import to_lines
    from chartlake.schemas import ARTIST_DETAILS
    from chartlake.sources import write_landing
    from builders import artist, raw_artists_df, raw_tracks_df, track
    land = f"{tmp_dir}/landing"
    for kind, raw in (("tracks", raw_tracks_df(spark, [
            track("T1", "a", "2024-01-01", artists=(("A1", "x"),)),
            track("T1", "a", "2024-01-02", artists=(("A1", "x"),)),
            track("T2", "b", "2024-01-02", artists=(("A2", "y"),))])),
                      ("artists", raw_artists_df(spark, [artist("A1", "x", "2024-01-01")]))):
        write_landing(to_lines(raw), f"{land}/{kind}", partition_cols=["year", "month", "day"])
    stg_t, stg_a = stage_landing(spark, land, f"{tmp_dir}/out")
    details = spark.createDataFrame([("A2", "y", "artist:A2", 5, ["jazz"], [])], ARTIST_DETAILS)
    out = run_models_on(spark, stg_t, stg_a, details, f"{tmp_dir}/out")
    assert sorted(r.artist_id for r in out["dim_artists"].collect()) == ["A1", "A2"]
    p = {r.track_id: r.consecutive_snapshots_in_top_10
         for r in out["mart_track_persistence"].collect()}
    assert p == {"T1": 2, "T2": 1}
    genres = {(r.track_snapshot_date.day, r.genre) for r in out["mart_genre_distribution"].collect()}
    assert (2, "jazz") in genres and (1, "pop") in genres


def test_register_views_for_sql(spark):
    from chartlake.plans import register_views
    out = run_models(spark, SF)
    names = register_views(out)
    assert "mart_list_changes" in names and "fct_snapshot_top_items" in names
    n = spark.sql("SELECT count(*) FROM fct_snapshot_top_items").collect()[0][0]
    assert n == out["stg_top_tracks"].count()


def test_cli_query_and_models(spark, capsys):
    from chartlake.__main__ import main
    main(["query", "latest_snapshot", "--src", SF, "--rows", "1"])
    assert "latest_snapshot_date" in capsys.readouterr().out
    main(["models", "--src", SF, "--rows", "1"])
    out = capsys.readouterr().out
    assert "== mart_track_persistence" in out and "== mart_list_changes" in out


def test_models_on_empty_feeds(spark, tmp_dir):
    from chartlake import operators as ops
    from chartlake.plans import run_models_on
    from chartlake.plans.models import STG_ARTIST_COLUMNS, STG_TRACK_COLUMNS
    from chartlake.schemas import ARTIST_DETAILS
    from builders import raw_artists_df, raw_tracks_df
    stg_t = ops.stage_tracks(raw_tracks_df(spark, [])).select(*STG_TRACK_COLUMNS)
    stg_a = ops.stage_artists(raw_artists_df(spark, [])).select(*STG_ARTIST_COLUMNS)
    details = spark.createDataFrame([], ARTIST_DETAILS)
    out = run_models_on(spark, stg_t, stg_a, details, f"{tmp_dir}/out")
    for name, df in out.items():
        assert df.count() == 0, name


def test_failed_write_never_becomes_current(spark, tmp_dir):
    import pytest as _pytest
    from pyspark.sql import functions as F
    from chartlake.plans.tables import RunFolders
    t = RunFolders(spark, f"{tmp_dir}/tbl")
    t.write(spark.range(5))
    good = t.current()
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("boom")))
                                .otherwise(F.col("id")).alias("id"))
    with _pytest.raises(Exception):
        t.write(bad)
    assert t.current() == good and t.read().count() == 5


def test_snapshot_dates_from_partition_listing(spark):
    from chartlake import operators as ops
    from chartlake.plans.models import workspace
    ws = workspace(spark, SF)
    listed = sorted(r[0] for r in ws.snapshot_dates("tracks").collect())
    scanned = sorted(r[0] for r in ws.stg_tracks().select("track_snapshot_date").distinct().collect())
    assert listed == scanned and len(listed) == 83
    a = sorted(map(tuple, ops.list_changes(ws.stg_tracks(), ws.stg_artists()).collect()), key=repr)
    b = sorted(map(tuple, ops.list_changes(ws.stg_tracks(), ws.stg_artists(),
                                           ws.snapshot_dates("tracks"),
                                           ws.snapshot_dates("artists")).collect()), key=repr)
    assert a == b


def test_a_model_run_writes_the_artist_dimension_once(spark, tmp_dir):
    """The merge and the enrichment reach the dimension in one write, and a plan on an
    earlier run's folder goes on reading that."""
    import os

    from chartlake import operators as ops
    from chartlake.plans import run_models_on
    from chartlake.plans.models import STG_ARTIST_COLUMNS, STG_TRACK_COLUMNS
    from chartlake.schemas import ARTIST_DETAILS
    from builders import artist, raw_artists_df, raw_tracks_df, track
    details = spark.createDataFrame([("A2", "y", "artist:A2", 5, ["jazz"], [])], ARTIST_DETAILS)

    def run(*artists):
        stg_t = ops.stage_tracks(raw_tracks_df(spark, [track("T2", "b", "2024-01-02", artists=(("A2", "y"),))]))
        stg_a = ops.stage_artists(raw_artists_df(spark, list(artists)))
        return run_models_on(spark, stg_t.select(*STG_TRACK_COLUMNS), stg_a.select(*STG_ARTIST_COLUMNS),
                             details, f"{tmp_dir}/out")["dim_artists"]

    first = run(artist("A1", "x", "2024-01-01"))
    second = run(artist("A3", "z", "2024-01-02"))
    assert len(os.listdir(f"{tmp_dir}/out/run/dim_artists")) == 2          # a folder a run
    assert sorted(r.artist_id for r in first.collect()) == ["A1", "A2"]
    assert sorted(r.artist_id for r in second.collect()) == ["A1", "A2", "A3"]
