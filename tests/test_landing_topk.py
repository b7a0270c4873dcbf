import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from chartlake import operators as ops
from chartlake.operators.topk import check_kind
from chartlake.sources import landing_items, read_raw_artists, read_raw_tracks, write_landing
from builders import track

D = dt.date


def test_landing_items_drops_null_items(spark):
    resp = spark.createDataFrame(
        [(1, [{"id": "a", "n": None}, None, {"id": "b", "n": 2}]), (2, []), (3, None)],
        "r int, items array<struct<id:string,n:int>>")
    got = sorted(r.value for r in landing_items(resp).collect())
    assert got == ['{"id":"a","n":null}', '{"id":"b","n":2}']


def test_landing_round_trip_zero_padded(spark, tmp_dir):
    lines = spark.createDataFrame(
        [(json.dumps({"id": "T1", "name": "x", "popularity": 5,
                      "artists": [{"id": "A1", "name": "y"}],
                      "album": {"id": "L1", "images": []}}),)], "value string")
    root = os.path.join(tmp_dir, "tracks")
    write_landing(lines, root, run_ts=dt.datetime(2024, 4, 5, 6, 7, 8))
    assert os.path.isdir(os.path.join(root, "year=2024", "month=04", "day=05"))
    r = read_raw_tracks(spark, root).collect()[0]
    assert (r.year, r.month, r.day) == (2024, 4, 5)
    assert r.album.images == [] and r.artists[0].id == "A1"
    s = ops.stage_tracks(read_raw_tracks(spark, root)).collect()[0]
    assert s.album_image_url is None and s.track_snapshot_date == D(2024, 4, 5)


def test_landing_empty_feed_writes_nothing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "artists")
    write_landing(spark.createDataFrame([], "value string"), root, run_ts=D(2024, 1, 1))
    assert not os.path.exists(os.path.join(root, "year=2024"))


def test_scan_partition_filter(spark, tmp_dir):
    from chartlake.plans.models import to_lines
    from builders import raw_tracks_df
    raw = raw_tracks_df(spark, [track("T1", "a", "2024-01-01"), track("T2", "b", "2024-02-01")])
    root = os.path.join(tmp_dir, "t")
    write_landing(to_lines(raw), root, partition_cols=["year", "month", "day"])
    st = ops.stage_tracks(read_raw_tracks(spark, root))
    q = st.filter(F.col("track_snapshot_date") == D(2024, 2, 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(year" in plan
    assert [r.track_id for r in q.collect()] == ["T2"]


def test_snapshot_top_k(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 5.0), (1, "c", 1.0), (1, "a", 1.0), (2, "z", 1.0)],
        "d int, item string, s double")
    got = sorted(tuple(r) for r in ops.snapshot_top_k(df, "d", "item", "s", k=2).collect())
    assert got == [(1, "a", 6.0, 1), (1, "b", 5.0, 2), (2, "z", 1.0, 1)]
    plan = ops.snapshot_top_k(df, "d", "item", "s", k=2)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan
    with pytest.raises(ValueError):
        check_kind("playlists")
    assert check_kind("tracks") == "tracks"


def test_zero_byte_file_reads_as_no_rows(spark, tmp_dir):
    d = os.path.join(tmp_dir, "tracks", "year=2024", "month=01", "day=02")
    os.makedirs(d)
    open(os.path.join(d, "top_tracks_empty.json"), "w").close()     # empty feed (Q20)
    assert read_raw_tracks(spark, os.path.join(tmp_dir, "tracks")).count() == 0


def test_ingest_run_writes_top_k_and_reads_back(spark, tmp_dir):
    from chartlake.sources import ingest_run
    from builders import raw_tracks_df
    raw = raw_tracks_df(spark, [track(f"T{i}", f"n{i}", "2024-01-01", popularity=i)
                                for i in range(15)])
    items = raw.drop("year", "month", "day").withColumn("score", F.col("popularity"))
    run = dt.datetime(2025, 4, 10, 8, 30, 0)
    ingest_run(items, "tracks", "score", tmp_dir, run, k=10)
    st = ops.stage_tracks(read_raw_tracks(spark, os.path.join(tmp_dir, "tracks")))
    got = sorted(r.track_id for r in st.collect())
    assert got == sorted(f"T{i}" for i in range(5, 15))
    assert {r.track_snapshot_date for r in st.collect()} == {D(2025, 4, 10)}
    assert os.path.isdir(os.path.join(tmp_dir, "tracks", "year=2025", "month=04", "day=10"))
    with pytest.raises(ValueError):
        ingest_run(items, "albums", "score", tmp_dir, run)


def test_inferred_schema_is_opt_in(spark, tmp_dir):
    lines = spark.createDataFrame([('{"id":"A1","name":"x","images":[],"genres":["pop"]}',)],
                                  "value string")
    root = os.path.join(tmp_dir, "artists")
    write_landing(lines, root, run_ts=D(2024, 1, 1))
    inferred = read_raw_artists(spark, root, infer=True)
    assert dict(inferred.dtypes)["images"] == "array<string>"     # why the schema is declared
    declared = read_raw_artists(spark, root)
    assert dict(declared.dtypes)["images"].startswith("array<struct<url:string")
    assert dict(declared.dtypes)["month"] == "int"


def test_run_timestamp_partition_is_time_zone_free(spark, tmp_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        lines = spark.createDataFrame([('{"id":"T1"}',)], "value string")
        write_landing(lines, os.path.join(tmp_dir, "t"), run_ts=dt.datetime(2024, 1, 1, 0, 30))
        assert os.path.isdir(os.path.join(tmp_dir, "t", "year=2024", "month=01", "day=01"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_top_k_null_scores_rank_last(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 1.0), (1, "c", None)],
                               "d int, item string, s double")
    got = sorted(tuple(r) for r in ops.snapshot_top_k(df, "d", "item", "s", k=2).collect())
    assert got == [(1, "a", None, 2), (1, "b", 1.0, 1)]


def test_ingest_feeds_tolerates_a_failing_feed(spark, tmp_dir):
    from chartlake.sources import ingest_feeds
    from builders import raw_tracks_df
    items = raw_tracks_df(spark, [track("T1", "a", "2024-01-01")]).drop("year", "month", "day")
    status = ingest_feeds({"tracks": (items, "popularity"),
                           "artists": (items, "no_such_column")}, tmp_dir,
                          dt.datetime(2024, 5, 6, 7, 8, 9), keep_score=True)
    assert status["tracks"] == "ok" and status["artists"].startswith("error")
    st = ops.stage_tracks(read_raw_tracks(spark, os.path.join(tmp_dir, "tracks")))
    assert [(r.track_snapshot_date, r.track_popularity) for r in st.collect()] == \
        [(D(2024, 5, 6), 50)]
