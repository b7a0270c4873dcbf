import datetime as dt

from pyspark.sql import functions as F

from chartlake import operators as ops
from builders import album, artist, raw_artists_df, raw_tracks_df, track
from conftest import rows

D = dt.date


def fact_from(spark, tracks, artists):
    st = ops.stage_tracks(raw_tracks_df(spark, tracks))
    sa = ops.stage_artists(raw_artists_df(spark, artists))
    return ops.build_fact(st, ops.dim_albums(st), ops.dim_artists(sa)), st, sa


def test_popularity_trends_nulls_and_duplicates(spark):
    f, _, _ = fact_from(spark, [
        track("T1", "a", "2024-01-01", popularity=10),
        track("T1", "a", "2024-01-01", popularity=10),     # re-run on the same day
        track("T2", "b", "2024-01-01", artists=(("A9", "x"),), popularity=40),
    ], [artist("A1", "x", "2024-01-01", popularity=30)])
    r = ops.popularity_trends(f).collect()[0]
    assert r.avg_track_popularity == 20.0                 # duplicates weigh (Q10)
    assert r.avg_artist_popularity == 30.0                # NULL ignored


def test_genre_distribution_shares(spark):
    f, _, _ = fact_from(spark, [
        track("T1", "a", "2024-01-01", artists=(("A1", "x"),)),
        track("T1", "a", "2024-01-01", artists=(("A1", "x"),)),
        track("T2", "b", "2024-01-01", artists=(("A2", "y"),)),
        track("T3", "c", "2024-01-01", artists=(("A3", "z"),)),   # empty genres
        track("T4", "d", "2024-01-01", artists=(("A9", "q"),)),   # no artist match
    ], [artist("A1", "x", "2024-01-01", genres=("pop", "rock")),
        artist("A2", "y", "2024-01-01", genres=("pop",)),
        artist("A3", "z", "2024-01-01", genres=())])
    got = {r.genre: r for r in ops.genre_distribution(f).collect()}
    assert got["pop"].track_count == 2 and got["pop"].total_tracks == 2
    assert got["pop"].percentage_of_tracks == 100.0
    assert got["rock"].percentage_of_tracks == 50.0       # shares may sum past 100 (Q3)


def test_track_vintages_buckets_and_total(spark):
    years = [1919, 1920, 1999, 2000, 2020, 2031]
    tracks = [track(f"T{i}", f"n{i}", "2024-01-01",
                    alb=album(f"L{i}", release_date=str(y), precision="year"))
              for i, y in enumerate(years)]
    tracks.append(track("TX", "bad", "2024-01-01", alb=album("LX", release_date="x",
                                                            precision="year")))
    f, _, _ = fact_from(spark, tracks, [])
    got = {r.release_decade: (r.track_count, r.total_tracks)
           for r in ops.track_vintages(f).collect()}
    assert got == {"Older or Unknown": (1, 6), "1920s": (1, 6), "1990s": (1, 6),
                   "2000s": (1, 6), "2020s": (2, 6)}
    total = ops.track_vintages(f).agg(F.sum("percentage_of_tracks")).collect()[0][0]
    assert abs(total - 100.0) < 1e-9


def _changes(spark, tracks, artists):
    st = ops.stage_tracks(raw_tracks_df(spark, tracks))
    sa = ops.stage_artists(raw_artists_df(spark, artists))
    return rows(ops.list_changes(st, sa))


def test_list_changes_new_dropped_and_rename(spark):
    got = _changes(spark, [
        track("T1", "a", "2024-01-01"), track("T2", "b", "2024-01-01"),
        track("T2", "b2", "2024-01-02"), track("T3", "c", "2024-01-02"),
        track("T9", "old", "2023-12-01"),
    ], [artist("A1", "x", "2024-01-01"), artist("A1", "x", "2024-01-02"),
        artist(None, "nobody", "2024-01-02")])
    d = D(2024, 1, 2)
    assert got == sorted([
        (d, "Track", "T1", "a", "Dropped Off"), (d, "Track", "T2", "b", "Dropped Off"),
        (d, "Track", "T2", "b2", "New Entry"), (d, "Track", "T3", "c", "New Entry"),
    ], key=repr)


def test_list_changes_single_snapshot_is_empty(spark):
    assert _changes(spark, [track("T1", "a", "2024-01-01")],
                    [artist("A1", "x", "2024-01-01")]) == []


def test_list_changes_missing_artist_feed_on_newest_date(spark):
    got = _changes(spark, [track("T1", "a", "2024-01-01"), track("T1", "a", "2024-01-02")],
                   [artist("A1", "x", "2024-01-01")])
    assert got == [(D(2024, 1, 2), "Artist", "A1", "x", "Dropped Off")]   # Q7


def test_streaks(spark):
    # T1 in snapshots 1,2,4 -> streak 1; T2 in 2,3,4 -> streak 3; T3 ends early.
    dates = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    t = [track("T1", "a", dates[i]) for i in (0, 1, 3)]
    t += [track("T2", "b", dates[i]) for i in (1, 2, 3)]
    t += [track("T3", "c", dates[i]) for i in (0, 1)]
    t += [track(None, "nil", dates[3])]
    f, st, _ = fact_from(spark, t, [])
    got = rows(ops.track_persistence(f))
    assert got == [("T1", "a", 1), ("T2", "b", 3)]
    dates_df = st.filter(F.col("track_id").isNotNull()).select("track_snapshot_date")
    assert rows(ops.track_persistence(f, dates_df)) == got


def test_streak_rows_sum_to_distinct_appearances(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select(
        (F.col("id") % 97).alias("item"), F.lit("n").alias("name"),
        F.date_add(F.lit(D(2024, 1, 1)), ((F.col("id") * 7919) % 40).cast("int")).alias("d"))
    s = ops.streaks(df, "d", "item", "name")
    # reference form (unpartitioned dense_rank) on the same input
    fd = df.select("d", "item", "name").distinct()
    r = fd.withColumn("g", F.dense_rank().over(Window.orderBy("d"))
                      - F.row_number().over(Window.partitionBy("item").orderBy("d", "name")))
    ref = (r.groupBy("item", "name", "g").agg(F.count("*").alias("n"), F.max("d").alias("e"))
             .filter(F.col("e") == fd.agg(F.max("d")).scalar()).select("item", "name", "n"))
    assert rows(s) == rows(ref)


def test_streak_plan_has_no_single_partition_exchange_on_rows(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("item"), F.lit("n").alias("name"),
                                  F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 5).cast("int"))
                                  .alias("d"))
    s = ops.streaks(df, "d", "item", "name")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    # the only single-partition exchanges allowed are over the distinct dates
    s.collect()


def test_same_day_rename_splits_streak_deterministically(spark):
    # Q8: row_number partitions by id while the streak groups by (id, name);
    # the name tie-break makes the split reproducible.
    f, _, _ = fact_from(spark, [
        track("T1", "a", "2024-01-01"), track("T1", "a", "2024-01-02"),
        track("T1", "b", "2024-01-02"), track("T1", "b", "2024-01-03"),
    ], [])
    # ranks 1,2,2,3 minus row numbers 1,2,3,4 -> groups (a: 0,0) and (b: -1,-1)
    assert rows(ops.track_persistence(f)) == [("T1", "b", 2)]


def test_present_orders_marts(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "1990s"), (D(2024, 1, 2), "Older or Unknown"),
                                (D(2024, 1, 2), "2020s")], "track_snapshot_date date, release_decade string")
    got = [tuple(r) for r in ops.present("mart_track_vintages", df).collect()]
    assert got == [(D(2024, 1, 2), "2020s"), (D(2024, 1, 2), "Older or Unknown"),
                   (D(2024, 1, 1), "1990s")]


def test_null_track_id_is_reported_but_null_artist_id_is_not(spark):
    # Q6: the artist side filters NULL ids, the track side does not.
    got = _changes(spark, [track("T1", "a", "2024-01-01"), track(None, "ghost", "2024-01-02"),
                           track("T1", "a", "2024-01-02")],
                   [artist("A1", "x", "2024-01-01"), artist("A1", "x", "2024-01-02"),
                    artist(None, "nobody", "2024-01-02")])
    assert got == [(D(2024, 1, 2), "Track", None, "ghost", "New Entry")]


def test_marts_keep_every_snapshot(spark):
    # Q1: the "latest" marts are not filtered to the newest date.
    f, _, _ = fact_from(spark, [track("T1", "a", "2024-01-01"), track("T1", "a", "2024-01-02")],
                        [artist("A1", "x", "2024-01-01", genres=("pop",))])
    dates = {r[0] for r in ops.genre_distribution(f).select("track_snapshot_date").collect()}
    assert dates == {D(2024, 1, 1), D(2024, 1, 2)}
    dates = {r[0] for r in ops.track_vintages(f).select("track_snapshot_date").collect()}
    assert dates == {D(2024, 1, 1), D(2024, 1, 2)}
