import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartlake import operators as ops
from builders import album, artist, raw_artists_df, raw_tracks_df, track
from conftest import rows

D = dt.date


@pytest.fixture
def raw_t(spark):
    return raw_tracks_df(spark, [
        track("T1", "One", "2024-01-01", alb=album("L1", release_date="2001-02-03")),
        track("T1", "One", "2024-01-02", alb=album("L1", release_date="2001-02-03",
                                                   album_type="single")),
        track("T2", "Two", "2024-01-02", artists=(), alb=album("L2", "Two LP", "1999", "year",
                                                               images=())),
        track("T3", "Three", "2024-01-02", artists=None, alb=album(None)),
        track("T4", "Four", "2024-01-02", artists=(("A9", "Unknown"),),
              alb=album("L3", release_date="2021-02-30")),
    ])


@pytest.fixture
def raw_a(spark):
    return raw_artists_df(spark, [
        artist("A1", "Artist 1", "2024-01-01", popularity=10, genres=("pop",)),
        artist("A1", "Artist 1b", "2024-01-02", popularity=20, genres=("pop", "rock")),
        artist("A2", "Artist 2", "2024-01-02", genres=(), images=()),
        artist(None, "No id", "2024-01-02"),
    ])


def test_stage_tracks_shape(raw_t):
    s = ops.stage_tracks(raw_t)
    assert len(s.columns) == 20
    got = {r.track_id: r for r in s.filter(F.col("track_snapshot_date") == D(2024, 1, 2)).collect()}
    assert got["T1"].primary_artist_id == "A1" and got["T1"].album_image_url == "img/L1"
    assert got["T2"].primary_artist_id is None          # empty artists array
    assert got["T2"].album_image_url is None            # empty images array
    assert got["T3"].primary_artist_id is None and got["T3"].album_id is None
    assert got["T1"].snapshot_day == 2 and got["T1"].track_popularity == 50


def test_stage_artists_shape(raw_a):
    s = ops.stage_artists(raw_a)
    assert len(s.columns) == 11
    got = {(r.artist_id, r.artist_snapshot_date): r for r in s.collect()}
    assert got[("A2", D(2024, 1, 2))].artist_image_url is None
    assert got[("A1", D(2024, 1, 2))].artist_follower_count == 10


def test_dim_albums_latest_and_parse(raw_t):
    d = ops.dim_albums(ops.stage_tracks(raw_t))
    got = {r.album_id: r for r in d.collect()}
    assert set(got) == {"L1", "L2", "L3"}                # NULL album id dropped
    assert got["L1"].album_type == "single"              # newest snapshot wins
    assert got["L1"].last_seen_album_snapshot_date == D(2024, 1, 2)
    assert got["L1"].album_release_date_parsed == D(2001, 2, 3)
    assert got["L2"].album_release_date_parsed == D(1999, 1, 1)
    assert got["L3"].album_release_date_parsed is None   # bad date


def test_dim_artists_latest(raw_a):
    d = ops.dim_artists(ops.stage_artists(raw_a))
    got = {r.artist_id: r for r in d.collect()}
    assert set(got) == {"A1", "A2"}
    assert got["A1"].artist_name == "Artist 1b" and got["A1"].artist_genres == ["pop", "rock"]
    assert len(d.columns) == 7


def test_latest_by_key_tie_break_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 2), "b"), (1, D(2024, 1, 2), "a"), (1, D(2024, 1, 1), "z"),
         (None, D(2024, 1, 3), "n")], "k int, d date, v string")
    for parts in (1, 3):
        for method in ("aggregate", "window"):
            got = rows(ops.latest_by_key(df.repartition(parts), ["k"], "d", method=method))
            assert got == [(1, D(2024, 1, 2), "b")]      # tie -> greatest remaining column


def test_latest_by_key_plans_prune_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("d"))
    plan = ops.latest_by_key(df, ["k"], "d", method="window")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan
    plan = ops.latest_by_key(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(struct(" in plan and "max_by" not in plan
    kept = ops.latest_by_key(df, ["k"], "d", ["k", "d"])                 # names given twice
    assert rows(kept) == rows(ops.latest_by_key(df, ["k"], "d"))
    m = ops.latest_by_key(df.withColumn("m", F.create_map(F.lit("a"), "d")), ["k"], "d")
    assert "partial_max_by" in m._jdf.queryExecution().executedPlan().toString()
    assert rows(m.select("k", "d")) == rows(kept)


def test_fact_left_joins(raw_t, raw_a):
    st, sa = ops.stage_tracks(raw_t), ops.stage_artists(raw_a)
    f = ops.build_fact(st, ops.dim_albums(st), ops.dim_artists(sa))
    assert len(f.columns) == 17
    assert f.count() == st.count()                       # grain = staged row
    got = {(r.track_id, r.track_snapshot_date): r for r in f.collect()}
    t1 = got[("T1", D(2024, 1, 1))]
    # SCD-1: an old snapshot carries the current artist/album attributes
    assert t1.artist_popularity == 20 and t1.album_type == "single"
    assert got[("T4", D(2024, 1, 2))].artist_name is None   # artist not in the dimension
    assert got[("T3", D(2024, 1, 2))].album_name is None    # NULL album id never matches


def test_first_of_several_artists_and_images(spark):
    raw = raw_tracks_df(spark, [track("T1", "a", "2024-01-01",
                                      artists=(("A1", "lead"), ("A2", "feat")),
                                      alb=album("L1", images=(("big",), ("small",))))])
    r = ops.stage_tracks(raw).collect()[0]
    assert (r.primary_artist_id, r.primary_artist_name, r.album_image_url) == ("A1", "lead", "big")
