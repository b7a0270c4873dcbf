"""Upserts that rewrite touched parts only, the bucketed star join, and row positions."""
import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartlake import operators as ops
from chartlake.operators.upsert import PartTable
from chartlake.sources.bucketed import write_bucketed
from conftest import rows

SCHEMA = "k string, v int"


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _table(spark, path, rows_, parts=16):
    df = spark.createDataFrame(rows_, SCHEMA)
    t = PartTable(spark, path, df.schema, "k", parts)
    t.create(df)
    return t


def test_upsert_rewrites_touched_parts_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    old = [(f"k{i}", i) for i in range(200)]
    t = _table(spark, path, old)
    before = _files(path)
    new = [("k7", -7), ("new", 1)]
    src = spark.createDataFrame(new, SCHEMA)
    expected = rows(ops.upsert(spark.createDataFrame(old, SCHEMA), src, "k"))
    touched = t.upsert(src)
    after = _files(path)
    assert 1 <= len(touched) <= 2
    folders = tuple(f"/part_of_16={p}/" for p in touched)
    kept = {f: m for f, m in before.items() if not any(p in f for p in folders)}
    assert kept and {f: after[f] for f in kept} == kept                   # neither rewritten nor moved
    assert not set(after) & (set(before) - set(kept))                     # all files of touched parts are new
    assert all(any(p in f for p in folders) for f in set(after) - set(before))
    assert rows(t.read()) == expected
    assert t.upsert(src) == touched and rows(t.read()) == expected        # idempotent


def test_parts_empty_source_null_keys_duplicates_and_columns(spark, tmp_dir):
    t = _table(spark, os.path.join(tmp_dir, "t"), [("a", 1), (None, 2), (None, 2)])
    before = _files(t.path)
    assert t.upsert(spark.createDataFrame([], SCHEMA)) == [] and _files(t.path) == before
    with pytest.raises(PySparkException, match="duplicate source key"):
        t.upsert(spark.createDataFrame([("a", 3), ("a", 4)], SCHEMA))
    assert rows(t.read()) == rows(spark.createDataFrame([("a", 1), (None, 2), (None, 2)], SCHEMA))
    t.upsert(spark.createDataFrame([(None, "b", 9)], "k string, k2 string, extra int").select(
        F.col("k2").alias("k"), "extra"))                                 # no v: NULL; extra dropped
    t.upsert(spark.createDataFrame([(None, 5)], SCHEMA))                  # a NULL key matches nothing
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted(
        [("a", 1), ("b", None), (None, 2), (None, 2), (None, 5)], key=repr)
    with pytest.raises(ValueError, match="part_of_16"):
        PartTable(spark, t.path, t.schema, "k", 8).read()
    empty = _table(spark, os.path.join(tmp_dir, "e"), [])
    assert empty.read().count() == 0
    empty.upsert(spark.createDataFrame([("x", 1)], SCHEMA))
    assert rows(empty.read()) == [("x", 1)]


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], SCHEMA)
    assert rows(ops.one_per_key(df, ["k"])) == rows(df)
    with pytest.raises(PySparkException, match="duplicate source key"):
        ops.one_per_key(df.union(df), ["k"]).collect()


def test_positions_over_many_partitions(spark, tmp_dir):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for n, coalesce in (("a", "true"), ("b", "false")):
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            out = ops.with_position(df, [F.col("g").desc(), F.col("k").asc()], os.path.join(tmp_dir, n)).collect()
            expected = sorted((-r.g, r.k) for r in df.collect())
            assert [(-r.g, r.k) for r in sorted(out, key=lambda r: r.position)] == expected
            assert sorted(r.position for r in out) == list(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert ops.with_position(df.limit(0), [F.col("k")], os.path.join(tmp_dir, "none")).count() == 0


def test_bucketed_album_join_has_no_exchange_of_the_staged_rows(spark, tmp_dir):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    tag = os.path.basename(tmp_dir)
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        stg = spark.range(3000).select(
            F.lit("2024-01-01").cast("date").alias("track_snapshot_date"), F.concat(F.lit("T"), "id").alias("track_id"),
            F.concat(F.lit("A"), F.col("id") % 7).alias("primary_artist_id"),
            F.when(F.col("id") % 3 > 0, F.concat(F.lit("L"), F.col("id") % 400)).alias("album_id"),  # a third NULL
            F.lit("n").alias("track_name"), F.lit(1).alias("track_popularity"), F.col("id").alias("duration_ms"),
            F.lit(False).alias("explicit"), F.lit("u").alias("track_uri"))
        albums = spark.range(300).select(F.concat(F.lit("L"), "id").alias("album_id"), F.lit("x").alias("album_name"),
                                         F.lit(None).cast("date").alias("album_release_date_parsed"),
                                         F.lit("album").alias("album_type"))
        artists = spark.createDataFrame([("A1", "one", 5, ["g"], "u", "i")],
                                        "artist_id string, artist_name string, artist_popularity int, "
                                        "artist_genres array<string>, artist_uri string, artist_image_url string")
        bt = write_bucketed(stg.withColumn("album_key", ops.album_join_key()), f"t_{tag}", f"{tmp_dir}/t", "album_key", 8)
        ba = write_bucketed(albums, f"a_{tag}", f"{tmp_dir}/a", "album_id", 8)
        fact = ops.build_fact(bt, ba, artists, album_key="album_key")
        assert rows(fact) == rows(ops.build_fact(stg, albums, artists))
        plan = fact._jdf.queryExecution().executedPlan().toString()
        exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert not any("album" in e for e in exchanged), exchanged          # only the artist join shuffles
        sizes = bt.groupBy(F.pmod(F.hash("album_key"), F.lit(8)).alias("b")).count().collect()
        assert max(r["count"] for r in sizes) < 2 * 3000 / 8                # NULL albums are spread
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
