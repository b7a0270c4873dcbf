import datetime as dt

from pyspark.sql import functions as F

from chartlake.functions import (decade_rank, first_field, first_of, parse_partial_date,
                                 release_decade, safe_date)

D = dt.date


def test_parse_partial_date_precisions(spark):
    cases = [
        ("2001-02-03", "day", D(2001, 2, 3)),
        ("2020-2-3", "day", D(2020, 2, 3)),        # one-digit month/day accepted
        ("2021-02-30", "day", None),               # impossible date -> NULL
        ("1999", "day", None),                     # text shorter than the precision
        ("1999-07", "month", D(1999, 7, 1)),
        ("1999", "year", D(1999, 1, 1)),
        ("1999", "decade", None),                  # unknown precision
        ("1999", None, None),                      # NULL precision
        (None, "day", None),
        ("0000", "year", None),                    # outside the DATE range
        ("garbage", "year", None),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "t string, p string")
    got = [r[0] for r in df.select(parse_partial_date("t", "p")).collect()]
    assert got == [c[2] for c in cases]


def test_safe_date_and_first(spark):
    df = spark.createDataFrame(
        [(2024, 2, 29, [{"url": "a"}]), (2023, 2, 29, []), (2023, 13, 1, None)],
        "y int, m int, d int, imgs array<struct<url:string>>")
    out = df.select(safe_date("y", "m", "d").alias("d"), first_field("imgs", "url").alias("u"),
                    first_of("imgs").alias("f")).collect()
    assert [r.d for r in out] == [D(2024, 2, 29), None, None]
    assert [r.u for r in out] == ["a", None, None]
    assert out[1].f is None


def test_release_decade_boundaries(spark):
    years = [1919, 1920, 1929, 1930, 1999, 2000, 2019, 2020, 2031, None]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = [r[0] for r in df.select(release_decade("y")).collect()]
    assert got == ["Older or Unknown", "1920s", "1920s", "1930s", "1990s", "2000s",
                   "2010s", "2020s", "2020s", "Older or Unknown"]
    ranks = [r[0] for r in df.select(decade_rank(release_decade("y"))).collect()]
    assert ranks == [13, 11, 11, 10, 4, 3, 2, 1, 1, 13]


def test_decade_rank_sorts_newest_first(spark):
    df = spark.createDataFrame([("Older or Unknown",), ("1990s",), ("2020s",)], "d string")
    got = [r[0] for r in df.orderBy(decade_rank("d")).collect()]
    assert got == ["2020s", "1990s", "Older or Unknown"]
    # a plain text sort would not give this order
    assert got != sorted(got, reverse=True)


def test_scale_conf_sizes_partitions():
    from chartlake.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)            # 100 TiB: 256 MiB each
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    c = scale_conf(1024 ** 4, 1000)                  # 1 TiB: 256 MiB each
    assert int(c["spark.sql.shuffle.partitions"]) == 4096
    assert int(scale_conf(1024, 8)["spark.sql.shuffle.partitions"]) == 16


def test_launcher_settings_win(monkeypatch, spark):
    import pyspark
    from chartlake import session

    class Launched:
        def contains(self, key):
            return key in ("spark.sql.session.timeZone", "spark.master")
    monkeypatch.setattr(pyspark, "SparkConf", Launched)
    set_ = {}

    class Builder:
        def appName(self, _):
            return self

        def config(self, k, v):
            set_[k] = v
            return self

        def getOrCreate(self):
            return spark
    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    session.get_session()
    assert "spark.sql.session.timeZone" not in set_ and "spark.sql.adaptive.enabled" in set_
    assert "spark.driver.memory" not in set_


def test_a_cluster_needs_a_shared_folder():
    import pytest
    from chartlake.session import _own_dir
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            _own_dir(master)
    assert _own_dir("local[4]") and _own_dir("local") and _own_dir("local[*]")
