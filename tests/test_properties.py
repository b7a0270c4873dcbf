"""Property tests: operators vs brute force in plain Python on random input."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartlake import operators as ops

D0 = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

triples = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9),
                             st.sampled_from(["a", "b", None])), min_size=0, max_size=40)


@SETTINGS
@given(data=triples)
def test_latest_by_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data or [(0, 0, "a")], "k int, d int, v string")
    if not data:
        df = df.limit(0)
    best = {}
    for k, d, v in data:
        key = (d, (v is not None, v or ""))           # newest, then greatest v, NULL lowest
        if k not in best or key > best[k][0]:
            best[k] = (key, (k, d, v))
    expect = sorted(b[1] for b in best.values())
    for method in ("aggregate", "window"):
        got = sorted(tuple(r) for r in ops.latest_by_key(df, ["k"], "d", method=method).collect())
        assert got == expect


@SETTINGS
@given(tgt=st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
       src=st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8))
def test_upsert_matches_dict_update(spark, tgt, src):
    t = spark.createDataFrame(list(tgt.items()) or [(0, 0)], "k int, v int")
    if not tgt:
        t = t.limit(0)
    s = spark.createDataFrame(list(src.items()) or [(0, 0)], "k int, v int")
    if not src:
        s = s.limit(0)
    expect = dict(tgt)
    expect.update(src)
    got = ops.upsert(t, s, "k")
    assert sorted(tuple(r) for r in got.collect()) == sorted(expect.items())
    assert sorted(tuple(r) for r in ops.upsert(got, s, "k").collect()) == sorted(expect.items())


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 4)), max_size=40))
def test_streaks_match_brute_force(spark, data):
    df = spark.createDataFrame([(D0 + dt.timedelta(days=d), i, "n") for d, i in data],
                               "d date, item int, name string")
    got = sorted(tuple(r) for r in ops.streaks(df, "d", "item", "name").collect())
    dates = sorted({d for d, _ in data})
    expect = []
    if dates:
        last = len(dates) - 1
        for item in {i for _, i in data}:
            seen = {dates.index(d) for d, i in data if i == item}
            if last in seen:
                n = 0
                while last - n in seen:
                    n += 1
                expect.append((item, "n", n))
    assert got == sorted(expect)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 2), st.sampled_from("xyz"), st.integers(0, 5)),
                     max_size=40))
def test_share_of_total_matches_brute_force(spark, data):
    df = spark.createDataFrame(data or [(0, "x", 0)], "d int, b string, i int")
    if not data:
        df = df.limit(0)
    got = {(r.d, r.b): (r.track_count, r.total_tracks, r.percentage_of_tracks)
           for r in ops.share_of_total(df, "d", "b", "i").collect()}
    expect = {}
    for d, b in {(d, b) for d, b, _ in data}:
        c = len({i for dd, bb, i in data if dd == d and bb == b})
        t = len({i for dd, _, i in data if dd == d})
        expect[(d, b)] = (c, t, c / t * 100)
    assert got == expect


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(1, 9)),
                     max_size=40), k=st.integers(1, 4))
def test_top_k_matches_brute_force(spark, data, k):
    df = spark.createDataFrame(data or [(0, 0, 1)], "d int, item int, s int")
    if not data:
        df = df.limit(0)
    got = sorted(tuple(r) for r in ops.snapshot_top_k(df, "d", "item", "s", k=k).collect())
    expect = []
    for d in {d for d, _, _ in data}:
        tot = {}
        for dd, it, s in data:
            if dd == d:
                tot[it] = tot.get(it, 0) + s
        ranked = sorted(tot.items(), key=lambda x: (-x[1], x[0]))[:k]
        expect += [(d, it, s, r + 1) for r, (it, s) in enumerate(ranked)]
    assert got == sorted(expect)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None]),
                               st.sampled_from([1, 2, 3])), max_size=30))
def test_item_changes_match_set_difference(spark, data):
    df = spark.createDataFrame(data or [(0, "x", 1)], "i int, n string, d int")
    if not data:
        df = df.limit(0)
    got = [(r.item_id, r.item_name, r.change_status) for r in
           ops.item_changes(df, "d", "i", "n", F.lit(3), F.lit(2), "T").collect()]
    now = {(i, n) for i, n, d in data if d == 3}
    before = {(i, n) for i, n, d in data if d == 2}
    expect = sorted([(i, n, "New Entry") for i, n in now - before] +
                    [(i, n, "Dropped Off") for i, n in before - now], key=repr)
    assert sorted(got, key=repr) == expect


@SETTINGS
@given(tgt=st.dictionaries(st.integers(0, 6), st.tuples(st.integers(0, 9), st.integers(0, 9)),
                           max_size=6),
       src=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 9)),
                    max_size=10))
def test_upsert_latest_equals_recompute(spark, tgt, src):
    t = spark.createDataFrame([(k, d, v) for k, (d, v) in tgt.items()] or [(0, 0, 0)],
                              "k int, d int, v int")
    if not tgt:
        t = t.limit(0)
    s = spark.createDataFrame(src or [(0, 0, 0)], "k int, d int, v int")
    if not src:
        s = s.limit(0)
    got = sorted(tuple(r) for r in ops.upsert_latest(t, s, "k", "d").collect())
    best = {}
    for k, d, v in [(k, d, v) for k, (d, v) in tgt.items()] + src:
        if k not in best or (d, v) > best[k]:
            best[k] = (d, v)
    assert got == sorted((k, d, v) for k, (d, v) in best.items())
