"""What landing and scanning cost: bytes landed, rows moved before they are widened, parses a line."""
import datetime as dt
import gzip
import json
import os
import time
from types import SimpleNamespace

import pytest

from chartlake.operators import FACT_TRACK_COLUMNS
from chartlake.plans import batches, binding, models
from chartlake.plans.models import to_lines, workspace
from chartlake.plans.tables import RunFolders
from chartlake.schemas import RAW_ARTIST, RAW_TRACK
from chartlake.session import drop_shuffle_files
from chartlake.sources.detect import detected_fields, rescued_rows, with_detected
from chartlake.sources.landing import read_raw_artists, read_raw_tracks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def tables(spark, tmp_dir):
    """Two suppliers in good standing (one part of theirs unknown), one in none, one line without a date."""
    lines = [(1, 1, 1, 1, 3.0, "1996-01-05"), (1, 2, 1, 2, 4.0, "1996-01-09"), (1, 1, 1, 3, 5.0, "1996-01-20"),
             (2, 9, 2, 1, 1.0, "1996-02-01"), (2, 2, 3, 2, 2.0, "1996-02-02"), (3, None, 2, 1, 6.0, None)]
    spark.createDataFrame(
        [(o, p, s, n, q, 10.0 * q, "R", "O", d and dt.datetime.fromisoformat(d)) for o, p, s, n, q, d in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(1, "one", "TIN"), (2, "two", "BRASS")],
                          "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_dir}/part.parquet")
    spark.createDataFrame([(1, "S1", 0, 5.0), (2, "S2", 0, 6.0), (3, "S3", 0, -1.0)],
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_dir}/supplier.parquet")
    spark.createDataFrame([(1, "F", 10.0, dt.date(1996, 1, 1), "1-URGENT"), (2, "O", 20.0, dt.date(1996, 1, 2), "5-LOW")],
                          "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
                          ).write.parquet(f"{tmp_dir}/orders.parquet")
    return tmp_dir


def test_landing_zones_are_compressed_and_whole(spark, tables):
    ws = workspace(spark, tables)
    for zone in (ws.land(), ws.damaged_landing(), ws.drifted_landing()):
        files = [os.path.join(d, f) for d, _, names in os.walk(zone) for f in names if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
        for f in files:
            assert gzip.open(f).read().count(b"\n") > 0
    landed = read_raw_tracks(spark, f"{ws.land()}/tracks").collect()
    assert sorted((r.id or "", r.album.id, r.popularity, r.year) for r in landed) == [
        ("", "L3", 12, None), ("T1", "L1", 6, 1996), ("T1", "L1", 10, 1996), ("T2", "L1", 8, 1996),
        ("T2", "L2", 4, 1996), ("T9", "L2", 2, 1996)]
    artists = read_raw_artists(spark, f"{ws.land()}/artists").collect()
    assert sorted(((r.id, r.month, r.popularity, r.genres, r.followers.total) for r in artists), key=str) == [
        ("A1", 1, 15, ["BRASS", "TIN"], 12), ("A2", 2, 5, [], 1), ("A2", None, 5, [], 6)]


def test_rows_travel_before_the_items_are_built(spark, tables):
    tracks = plan(to_lines(binding.raw_tracks(spark, tables)))           # a plan's first step is its last line
    assert "to_json" not in tracks[tracks.index("REBALANCE_PARTITIONS_BY_COL"):]
    assert "track:" in tracks[:tracks.index("REBALANCE_PARTITIONS_BY_COL")]
    artists = plan(binding.raw_artists(spark, tables))
    assert "Join" not in artists[artists.rindex("REBALANCE_PARTITIONS_BY_COL"):artists.index("lineitem.parquet")]


@pytest.mark.parametrize("schema", [RAW_TRACK, RAW_ARTIST])
def test_a_line_is_parsed_once(spark, tmp_dir, schema):
    os.makedirs(f"{tmp_dir}/year=2024/month=01/day=02")
    lines = [json.dumps({"id": "1", "popularity": 3, "more": 7}), json.dumps({"id": "2", "popularity": "x"}),
             '{"id": "3"', "null", "  ", json.dumps({"id": "4"})]
    with open(f"{tmp_dir}/year=2024/month=01/day=02/a.json", "w") as f:
        f.write("\n".join(lines))
    read = read_raw_tracks if schema is RAW_TRACK else read_raw_artists
    rows = read(spark, tmp_dir)
    assert plan(rows).split("DataFilters")[0].count("from_json") == 1
    assert sorted((r.id, r.popularity) for r in rows.collect()) == [("1", 3), ("4", None)]
    drifted = rescued_rows(spark, tmp_dir, schema)
    fields = detected_fields(drifted)
    assert plan(fields).split("DataFilters")[0].count("from_json") == 2          # the schema's fields, and all as VARIANT
    assert [tuple(r) for r in fields.collect()] == [("more", "BIGINT", 1)]
    assert sorted((r.id, r.more) for r in with_detected(drifted).collect()) == [("1", 7), ("4", None)]


def test_rows_that_lie_together_are_not_moved_again(spark, tmp_dir):
    rows = spark.range(40).selectExpr("id", "date'2024-01-01' d").repartition(4)
    moved = {}
    for clustered in (False, True):
        root = f"{tmp_dir}/{clustered}"
        assert RunFolders(spark, root).write(rows, ["d"], clustered).count() == 40
        moved[clustered] = sum(f.endswith(".parquet") for _, _, names in os.walk(root) for f in names)
    assert moved == {False: 1, True: 4}


def test_staged_snapshots_are_whole(spark, tables):
    ws = workspace(spark, tables)
    assert sorted((str(r.track_snapshot_date), r.track_id or "") for r in ws.stg_tracks().collect()) == [
        ("1996-01-01", "T1"), ("1996-01-01", "T1"), ("1996-01-01", "T2"), ("1996-02-01", "T2"),
        ("1996-02-01", "T9"), ("None", "")]
    for kind, staged in (("tracks", "stg_tracks"), ("artists", "stg_artists")):
        ws.snapshot_dates(kind)
        files = {root: sum(f.startswith("part-") for _, _, names in os.walk(root) for f in names)
                 for root in (f"{ws.land()}/{kind}", f"{ws.base}/{staged}")}
        assert len(set(files.values())) == 1                     # one staged file for a landed one


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for root in folders for _, _, names in os.walk(root.getPath()) for f in names
            if f.startswith("shuffle_") and f.endswith(".data")}


def test_written_layers_leave_no_shuffle_files(spark, tables):
    ws = workspace(spark, tables)
    before = shuffle_files(spark)
    assert ws.fact().count() == 6                                # lands, stages, builds the dimensions and the fact
    deadline = time.time() + 10                                  # removed behind the query's end
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    stored = [f for layer in ws.tables for _, _, names in os.walk(f"{ws.base}/{layer}") for f in names if f.startswith("part-")]
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)


def test_the_launchers_word_on_shuffle_files_counts():
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for launched in (True, False):
        said = {}
        conf = SimpleNamespace(contains=lambda k: launched)
        drop_shuffle_files(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf),
                                           conf=SimpleNamespace(set=said.__setitem__)))
        assert said == ({} if launched else {key: "true"})


def test_only_what_an_item_needs_travels_to_its_snapshot(spark, tables):
    tracks = plan(to_lines(binding.raw_tracks(spark, tables)))
    moved = tracks[:tracks.index("REBALANCE_PARTITIONS_BY_COL")]
    for read in ("l_quantity", "l_extendedprice", "l_shipdate", "o_totalprice", "o_orderpriority"):
        assert read not in moved
    below = tracks[tracks.index("REBALANCE_PARTITIONS_BY_COL"):]
    assert "o_orderkey" in [line for line in below.split("\n") if "Join" in line][-1]      # the first join made


def test_every_row_falls_into_one_stretch(spark, monkeypatch):
    rows = spark.sql("""select if(i % 10 = 0, null, date_add(date'2024-01-01', int(if(i < 60, 3, i % 7)))) d, i
                        from (select explode(sequence(0, 99)) i)""")
    assert batches.snapshot_batches(rows, "d") == [None]
    monkeypatch.setattr(batches, "BATCH_ROWS", 10)
    monkeypatch.setattr(batches, "MAX_BATCHES", 5)
    cuts = batches.snapshot_batches(rows, "d")
    parts = [[r.i for r in rows.filter(c).collect()] for c in cuts]
    assert 1 < len(cuts) <= 5 and all(parts)
    assert sorted(i for part in parts for i in part) == list(range(100))
    assert batches.snapshot_batches(rows.filter("d is null"), "d") == [None]


def test_layers_in_stretches_are_whole_and_count_at_the_end(spark, tables, monkeypatch):
    whole = workspace(spark, tables)
    tracks, fact = (sorted(map(repr, df.collect())) for df in (whole.stg_tracks(), whole.fact()))
    monkeypatch.setattr(batches, "BATCH_ROWS", 1)
    done = []

    def backfill(lines, path, finished=True, real=models.backfill):
        real(lines, path, finished)
        done.append((os.path.basename(path), os.path.exists(f"{path}/_SUCCESS")))

    monkeypatch.setattr(models, "backfill", backfill)
    monkeypatch.setattr(models, "_WORKSPACES", {})
    ws = workspace(spark, f"{tables}/.")                          # the same tables, layers of their own
    assert sorted(map(repr, ws.fact().collect())) == fact
    assert sorted(map(repr, ws.stg_tracks().collect())) == tracks
    for kind in ("tracks", "artists"):
        marks = [m for k, m in done if k == kind]
        assert len(marks) > 1 and marks == [False] * (len(marks) - 1) + [True]


def test_a_failed_feed_is_not_gone_on_with(spark, tables, monkeypatch):
    ws, real = workspace(spark, tables), models.backfill
    artists = ws.land("artists")
    assert not os.path.exists(f"{artists}/tracks")               # a query on artists alone lands no tracks

    def broken(lines, path, finished=True):
        real(lines, path, False)
        raise OSError("lost")

    monkeypatch.setattr(models, "backfill", broken)
    with pytest.raises(OSError):
        ws.land("tracks")
    monkeypatch.setattr(models, "backfill", real)
    landed = ws.land()
    assert landed != artists and read_raw_tracks(spark, f"{landed}/tracks").count() == 6
    assert read_raw_artists(spark, f"{landed}/artists").count() == 3


def test_alike_lines_lie_next_to_each_other(spark, tables):
    feed = f"{workspace(spark, tables).land('tracks')}/tracks"
    for d, _, names in os.walk(feed):
        for f in names:
            if f.startswith("part-"):
                items = [json.loads(line) for line in gzip.open(f"{d}/{f}", "rt")]
                keys = [(i["artists"][0]["id"], i["id"] or "") for i in items]
                assert keys == sorted(keys)


def test_bucketed_tracks_hold_what_the_join_reads(spark, tables, monkeypatch):
    monkeypatch.setattr(batches, "BATCH_ROWS", 1)
    ws = workspace(spark, tables)
    tracks, _ = ws.bucketed_star()
    assert tracks.columns == [*FACT_TRACK_COLUMNS, "album_key"] and tracks.count() == 6
    assert all(f.endswith(".zstd.parquet") for f in map(os.path.basename, tracks.inputFiles()))


def test_the_fact_comes_in_shorter_stretches(spark, tables, monkeypatch):
    rows = spark.sql("select date_add(date'2024-01-01', int(i % 40)) d from (select explode(sequence(0, 399)) i)")
    monkeypatch.setattr(batches, "BATCH_ROWS", 40)
    monkeypatch.setattr(batches, "MAX_BATCHES", 5)
    assert [len(batches.snapshot_batches(rows, "d", finer)) for finer in (1, 2)] == [5, 10]
    asked, real = [], batches.snapshot_batches
    monkeypatch.setattr(models, "snapshot_batches",
                        lambda rows, date, finer=1: asked.append((date, finer)) or real(rows, date, finer))
    ws = workspace(spark, tables)
    ws.land()
    assert asked == [("d", 1), ("d", 2)]                          # artists, tracks
    assert ws.fact().count() == 6 and asked[2:] == [("track_snapshot_date", 2)]


def test_a_dimension_by_parts_of_its_keys(spark, tables, monkeypatch):
    from chartlake.plans import registry
    whole = {q: sorted(map(repr, registry.QUERIES[q](spark, tables).collect())) for q in ("upsert_albums", "upsert_parts")}
    monkeypatch.setattr(batches, "BATCH_ROWS", 1)
    made, create = [], registry.ops.PartTable.create
    monkeypatch.setattr(registry.ops.PartTable, "create", lambda self, *frames: made.append(len(frames)) or create(self, *frames))
    for q, rows in whole.items():
        assert sorted(map(repr, registry.QUERIES[q](spark, tables).collect())) == rows and len(rows) == 3
    assert made and made[0] > 1
    parts = [f for d, _, names in os.walk(workspace(spark, tables).base) if "/parts-" in d for f in names if f.startswith("part-")]
    assert parts and all(f.endswith(".zstd.parquet") for f in parts)
    keyed = spark.range(30).selectExpr("if(id % 3 = 0, null, id % 7) k", "id")
    split = [[r.id for r in part.collect()] for part in batches.key_batches(keyed, "k")]
    assert sorted(i for part in split for i in part) == list(range(30)) and len(split) == batches.MAX_BATCHES
