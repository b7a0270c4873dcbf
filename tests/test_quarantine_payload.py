"""Bad landing lines, JSON-text payloads, merge counts and one-shuffle shares."""
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chartlake import operators as ops
from chartlake.plans.models import stage_landing
from chartlake.schemas import RAW_ARTIST, RAW_TRACK
from chartlake.sources.landing import read_raw_artists
from chartlake.sources.quarantine import bad_lines, quarantine

GOOD = '{"id":"a%d","name":"n","popularity":%d,"genres":["x"],"images":[],"unknown":1}'
BAD = ['{broken', '{"id":"b","popularity":"high"}', '[1, 2]', '17', '"text"', '{"id":"c","followers":{"total":"many"}}', '{"id":"d"} tail {']


def land(folder, lines):
    os.makedirs(folder)
    with open(f"{folder}/part.json", "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def feed(tmp_dir):
    land(f"{tmp_dir}/raw/artists/year=2024/month=04/day=01", [GOOD % (1, 10), *BAD, "", "  ", GOOD % (2, 20)])
    land(f"{tmp_dir}/raw/artists/year=2024/month=04/day=02", [GOOD % (1, 30), BAD[0]])
    land(f"{tmp_dir}/raw/artists/year=2024/month=04/day=03", [BAD[0]])
    land(f"{tmp_dir}/raw/tracks/year=2024/month=04/day=02", ['{"id":"t1","name":"T"}', "{broken"])
    return tmp_dir


def test_scan_sees_good_lines_whatever_is_selected(spark, feed):
    df = read_raw_artists(spark, f"{feed}/raw/artists")
    assert df.columns == [*RAW_ARTIST.names, "year", "month", "day"]
    for c in ("id", "popularity", "genres"):
        assert df.select(c).count() == 3 and df.filter(F.col(c).isNull()).count() == 0
    assert sorted((r.id, r.popularity, r.month, r.day) for r in df.collect()) == [("a1", 10, 4, 1), ("a1", 30, 4, 2), ("a2", 20, 4, 1)]
    assert read_raw_artists(spark, f"{feed}/raw/artists/year=2024/month=04/day=02").first().day == 2


def test_failfast(spark, feed):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_artists(spark, f"{feed}/raw/artists", mode="FAILFAST").collect()
    good = read_raw_artists(spark, f"{feed}/raw/artists", mode="failfast").limit(0)
    assert good.columns[-3:] == ["year", "month", "day"]
    with pytest.raises(ValueError):
        read_raw_artists(spark, f"{feed}/raw/artists", mode="DROPMALFORMED")


def test_quarantine_keeps_lines_with_their_file(spark, feed):
    bad = bad_lines(spark, f"{feed}/raw/artists", RAW_ARTIST).collect()
    assert sorted(r.line for r in bad) == sorted([*BAD, BAD[0], BAD[0]])
    counts = {r.file.split("day=")[1][:2]: r.lines for r in
              quarantine(spark, f"{feed}/raw/artists", RAW_ARTIST, f"{feed}/kept").collect()}
    assert counts == {"01": len(BAD), "02": 1, "03": 1}
    quarantine(spark, f"{feed}/raw/tracks", RAW_TRACK, f"{feed}/kept")          # another folder; the first stays
    assert len([f for f in os.listdir(f"{feed}/kept") if f.startswith("run-")]) == 2


def test_staging_and_list_changes_never_see_bad_lines(spark, feed):
    stg_t, stg_a = stage_landing(spark, f"{feed}/raw", f"{feed}/out")
    assert {str(r.artist_snapshot_date) for r in stg_a.collect()} == {"2024-04-01", "2024-04-02"}
    assert stg_t.count() == 1 and stg_t.first().track_id == "t1"
    # The day that holds a bad line only is no snapshot.
    changes = {(r.item_id, r.change_status, str(r.snapshot_date)) for r in ops.list_changes(stg_t, stg_a).collect()}
    assert changes == {("t1", "New Entry", "2024-04-02"), ("a2", "Dropped Off", "2024-04-02")}
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{feed}/out/quarantine").count() == len(BAD) + 3


def test_payload_seven_arrays(spark):
    genres = ['["a","b"]', "[]", '["cut', "not json", None, '{"a":1}']
    days = ["2024-02-29", "2023-02-29", "20240229", "x", None, "2024-1-1"]
    n = len(genres)
    payload = spark.createDataFrame([(list("ABCDEF"), ["n"] * n, list(range(n)), genres, ["u"] * n, [None] * n, days)],
                                    "id array<string>, name array<string>, popularity array<int>, genres array<string>, "
                                    "uri array<string>, image_url array<string>, snapshot_date array<string>")
    rows = {r.id: r for r in ops.zip_payload(payload).collect()}
    assert [rows[k].genres for k in "ABCDE"] == [["a", "b"], [], None, None, None]
    assert [str(rows[k].snapshot_date) for k in "ABCDEF"] == ["2024-02-29", *["None"] * 5]


def test_merge_counts(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    obs = Observation()
    got = ops.merged_with_counts(target, source, "k", obs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        map(tuple, ops.upsert(target, source, "k").collect()), key=repr)
    assert obs.get == {"matched": 1, "inserted": 1, "affected": 2}
    obs = Observation()
    assert ops.merged_with_counts(target, source.limit(0), "k", obs).count() == 3
    assert obs.get["affected"] == 0


def test_shares_shuffle_the_data_once(spark):
    """Broadcasts off: one exchange of rows by (date, item); behind it only counts move."""
    rows = [("2024-01-01", "t1", ["x", "y"]), ("2024-01-01", "t1", ["y", None]), ("2024-01-01", "t2", ["y"]),
            ("2024-01-01", "t3", []), ("2024-01-01", "t4", None), (None, "t5", ["x"]), ("2024-01-02", "t1", ["x", "x"])]
    df = spark.createDataFrame(rows, "d string, i string, b array<string>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ops.share_of_buckets(df, "d", "i", "b", "g")
        got = {(r.d, r.g): (r.track_count, r.total_tracks) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {("2024-01-01", "x"): (1, 2), ("2024-01-01", "y"): (2, 2), ("2024-01-01", None): (1, 2), ("2024-01-02", "x"): (1, 1)}
    final = plan.split("== Initial Plan ==")[0]
    assert "Join" not in final and final.count("hashpartitioning(d") == 3 and final.count("hashpartitioning(d#") >= 1
    assert sum("i#" in line for line in final.splitlines() if "hashpartitioning" in line) == 1
