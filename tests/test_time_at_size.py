"""What a layer costs again for each stretch, and what grows with its rows: stretches, sorts, state, listings."""
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from chartlake.plans import batches, binding, registry
from chartlake.plans.models import to_lines
from chartlake.session import STATE_CONF
from test_landing_size import plan, tables  # noqa: F401

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_a_layer_is_cut_into_few_stretches(spark, monkeypatch):
    rows = spark.sql("select date_add(date'2024-01-01', int(i)) d from (select explode(sequence(0, 99)) i)")
    monkeypatch.setattr(batches, "BATCH_ROWS", 1)            # more rows than any number of stretches holds
    assert [len(batches.snapshot_batches(rows, "d", finer)) for finer in (1, 2)] == [5, 10]
    assert len(batches.key_batches(rows, "d")) == 5


def test_an_orders_fields_are_made_for_joined_lines_only(spark, tables):  # noqa: F811
    lines = plan(to_lines(binding.raw_tracks(spark, tables))).split("\n")
    join = max(i for i, line in enumerate(lines) if "Join" in line)          # the first join made
    made = [i for i, line in enumerate(lines) if "1-URGENT" in line]
    assert made and max(made) < join


def test_rows_are_sorted_before_they_are_widened(spark, tables):  # noqa: F811
    df = to_lines(binding.raw_tracks(spark, tables), [])
    text = plan(df)
    sort = text.index("Sort [year")
    assert "StructsToJson" in text[:sort] and "StructsToJson" not in text[sort:]
    # A write puts no sort of the lines on top where its partition columns hold no NULL and are in order.
    assert [f.nullable for f in df.schema.fields if f.name in ("year", "month", "day")] == [False] * 3
    assert sorted({(r.year, r.month, r.day) for r in df.collect()}) == [
        ("1996", "01", "01"), ("1996", "02", "01"), ("__HIVE_DEFAULT_PARTITION__",) * 3]


def test_release_texts_are_those_of_a_format(spark):
    rows = [(dt.date(1996, 3, 4), 10.0), (dt.date(1996, 12, 24), 60000.0), (dt.date(1996, 1, 1), 9.9e6),
            (dt.date(1996, 1, 1), 1.0e8), (dt.date(1996, 1, 1), -1.0e9), (dt.date(1996, 1, 1), None), (None, 5.0)]
    df = (spark.createDataFrame(rows, "o_orderdate date, o_totalprice double")
          .crossJoin(spark.sql("select explode(array('1-URGENT', '2-HIGH', '3-MEDIUM', null)) o_orderpriority")))
    y = F.year("o_orderdate") - F.floor(F.col("o_totalprice") / 50000).cast("int") * 10
    m, d, p = F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.col("o_orderpriority")
    want = (F.when(F.col("o_orderdate").isNull(), F.lit(None).cast("string"))
             .when(p == "1-URGENT", F.format_string("%04d-%02d-%02d", y, m, d))
             .when(p == "2-HIGH", F.format_string("%04d-%02d", y, m)).otherwise(F.format_string("%04d", y)))
    got = df.select(binding.release_fields()[0].alias("got"), want.alias("want")).collect()
    assert len(got) == 28 and all(r.got == r.want for r in got)
    assert {"1996-03-04", "-18004", "201996-01", "null", None} <= {r.got for r in got}


@pytest.mark.parametrize("said", [None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"])
def test_a_streams_state_lies_on_disk_unless_told_otherwise(spark, tables, said):  # noqa: F811
    from chartlake.plans.models import workspace
    from chartlake.streaming import read_dimension, start_dimension_stream
    other = spark.newSession()                               # a session that isn't ours
    for key in STATE_CONF:
        other.conf.unset(key)
    if said:
        other.conf.set(PROVIDER, said)
    run = f"{tables}/{uuid.uuid4().hex[:8]}"
    q = start_dimension_stream(other, f"{workspace(spark, tables).land('tracks')}/tracks", "albums", f"{run}/dim", f"{run}/checkpoint")
    q.awaitTermination()
    assert q.exception() is None
    state = q.recentProgress[0].stateOperators[0]
    assert state.numRowsTotal == 3 and any(m.startswith("rocksdb") for m in state.customMetrics) == (said is None)
    assert other.conf.get(PROVIDER) == (said or STATE_CONF[PROVIDER])
    assert sorted(r.album_id for r in read_dimension(other, f"{run}/dim", "albums").collect()) == ["L1", "L2", "L3"]


@pytest.mark.parametrize("query", ["upsert_albums", "upsert_artists"])
def test_the_newest_snapshot_is_taken_from_the_listing(spark, tables, query):  # noqa: F811
    df = registry.QUERIES[query](spark, tables)
    text = plan(df)
    assert df.count() > 0 and "Subquery" in text
    # The older rows, the newest ones and their keys; the newest date comes from a row per folder.
    assert text.count("FileScan") == 3 and "Scan ExistingRDD" in text
