import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartlake import operators as ops
from chartlake.operators.upsert import DuplicateKeyError
from chartlake.schemas import ARTIST_DETAILS
from builders import artist, raw_artists_df, raw_tracks_df, track
from conftest import rows

D = dt.date


def _details(spark, rows_):
    return spark.createDataFrame(rows_, ARTIST_DETAILS)


def test_upsert_semantics(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    src = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    out = ops.upsert(tgt, src, "k")
    assert rows(out) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(ops.upsert(out, src, "k")) == rows(out)        # idempotent


def test_upsert_rejects_duplicate_source_keys(spark):
    tgt = spark.createDataFrame([("a", 1)], "k string, v int")
    src = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(DuplicateKeyError):
        ops.upsert(tgt, src, "k", check_unique=True)


def test_upsert_aligns_columns(spark):
    tgt = spark.createDataFrame([("a", 1, "x")], "k string, v int, w string")
    src = spark.createDataFrame([(5, "a")], "v int, k string")
    assert rows(ops.upsert(tgt, src, "k")) == [("a", 5, None)]


@pytest.fixture
def stg(spark):
    st = ops.stage_tracks(raw_tracks_df(spark, [
        track("T1", "a", "2024-01-01", artists=(("A1", "x"),)),
        track("T2", "b", "2024-01-02", artists=(("A1", "x"),)),
        track("T3", "c", "2024-01-02", artists=(("A2", "y"),)),
        track("T4", "d", "2024-01-02", artists=(("A3", "z"),)),
        track("T5", "e", "2024-01-02", artists=()),
        track("T6", "f", "2024-01-01", artists=(("A4", "old"),)),
    ]))
    sa = ops.stage_artists(raw_artists_df(spark, [artist("A1", "x", "2024-01-01")]))
    return st, ops.dim_artists(sa)


def test_latest_snapshot_and_entities(spark, stg):
    st, _ = stg
    assert ops.latest_snapshot(st).collect()[0][0] == D(2024, 1, 2)
    assert rows(ops.snapshot_entities(st)) == [("A1",), ("A2",), ("A3",)]
    empty = st.filter(F.lit(False))
    assert ops.latest_snapshot(empty).collect()[0][0] is None
    assert ops.snapshot_entities(empty).count() == 0


def test_candidates_and_lookup(spark, stg):
    st, dim = stg
    cand = ops.enrichment_candidates(st, dim)
    assert rows(cand) == [("A2",), ("A3",)]
    det = _details(spark, [("A2", "y", "artist:A2", 7, ["jazz"], [("u2", 1, 1)]),
                           ("A5", "w", None, 1, [], [])])
    ids = spark.createDataFrame([("A2",), ("A3",), ("",), (None,)], "artist_id string")
    assert [r.id for r in ops.lookup_details(ids, det).collect()] == ["A2"]   # A3 vanishes


def test_enrich_artists(spark, stg):
    st, dim = stg
    det = _details(spark, [("A2", "y", "artist:A2", 7, ["jazz"], []),
                           ("A3", "z", "artist:A3", 9, None, [("u3", 1, 1)])])
    out = {r.artist_id: r for r in ops.enrich_artists(st, dim, det).collect()}
    assert set(out) == {"A1", "A2", "A3"}
    assert out["A2"].artist_image_url is None                 # images: [] -> NULL (Q14)
    assert out["A3"].artist_image_url == "u3"
    assert out["A2"].last_seen_artist_snapshot_date == D(2024, 1, 2)
    assert out["A1"].last_seen_artist_snapshot_date == D(2024, 1, 1)


def test_enrich_with_json_genres(spark):
    found = spark.createDataFrame(
        [("A1", "x", "u", 1, '["pop","hip hop"]', [("i", 1, 1)])],
        "id string, name string, uri string, popularity int, genres string, "
        "images array<struct<url:string,height:int,width:int>>")
    r = ops.shape_details(found, F.lit(D(2024, 1, 1))).collect()[0]
    assert r.artist_genres == ["pop", "hip hop"]              # unquoted (Q13 decision)


def test_zip_arrays_offsets(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [10, 20])], "k int, n array<string>, v array<int>")
    got = rows(ops.zip_arrays(df, ["n", "v"], keep=["k"]))
    assert got == [(1, 0, "a", 10), (1, 1, "b", 20)]        # excess dropped like offset joins


def test_parallel_arrays_round_trip(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "g int, id string, v int")
    p = ops.to_parallel_arrays(df, "g", ["id", "v"], order="id")
    assert rows(p) == [(1, ["a", "b"], [1, 2]), (2, ["c"], [3])]
    assert rows(ops.zip_arrays(p, ["id", "v"], pos=None)) == [("a", 1), ("b", 2), ("c", 3)]


def test_enrich_backfill_as_of(spark, stg):
    st, dim = stg
    assert rows(ops.snapshot_entities(st, as_of=D(2024, 1, 1))) == [("A1",), ("A4",)]
    det = _details(spark, [("A4", "old", "artist:A4", 3, [], [])])
    out = {r.artist_id: r for r in ops.enrich_artists(st, dim, det, as_of=D(2024, 1, 1)).collect()}
    assert out["A4"].last_seen_artist_snapshot_date == D(2024, 1, 1)


def test_genres_json_quoted_and_unquoted(spark):
    from chartlake.operators.enrich import genres_array
    df = spark.createDataFrame([('["pop","hip hop"]',), ("[]",)], "g string")
    got = df.select(genres_array("g").alias("u"), genres_array("g", quoted=True).alias("q")).collect()
    assert got[0].u == ["pop", "hip hop"] and got[0].q == ['"pop"', '"hip hop"']
    assert got[1].u == [] and got[1].q == []


def test_zip_arrays_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, [1]), (2, [], []), (3, ["a"], [None])],
                               "k int, n array<string>, v array<int>")
    got = rows(ops.zip_arrays(df, ["n", "v"], keep=["k"]))
    assert got == [(3, 0, "a", None)]


def test_lookup_dedupes_repeated_detail_rows(spark):
    det = _details(spark, [("A2", "y", "u", 1, [], []), ("A2", "z", "u", 2, [], [])])
    ids = spark.createDataFrame([("A2",)], "artist_id string")
    got = [(r.id, r.name) for r in ops.lookup_details(ids, det).collect()]
    assert got == [("A2", "z")]
