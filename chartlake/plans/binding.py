"""Scale binding: the snapshot feeds derived from the driver's TPC-H-style
tables, so every operator's work grows with the data.

Snapshot = first day of the ship month. One raw *track* row per line item:
track = part, primary artist = supplier, album = order. One raw *artist* row
per (snapshot, supplier) for suppliers in good standing (``s_acctbal > 0``);
the others reach the track feed but never the artist feed, so they are the
enrichment candidates. The details lookup table is derived from supplier and
nation. The same rules are written in SQL in ``plans/oracle.py``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.landing import HIVE_NULL
from ..sources.tables import load_table


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def snapshot_of(ts: str) -> Column:
    # timestamp_ntz -> date is time-zone free; then the first of the month.
    return F.trunc(F.col(ts).cast("date"), "month")


def path_date(d: str) -> dict[str, Column]:
    """``year``, ``month`` and ``day`` of a snapshot as a landing path names them, also where there is none: a write
    partitioned by columns without NULLs keeps the order of its rows and sorts no lines."""
    parts = {"year": (F.year(d), 4), "month": (F.month(d), 2), "day": (F.dayofmonth(d), 2)}
    return {name: F.coalesce(F.lpad(c.cast("string"), width, "0"), F.lit(HIVE_NULL)) for name, (c, width) in parts.items()}


def _image(url: Column) -> Column:
    return F.array(F.struct(url.alias("url"), F.lit(640).alias("height"),
                            F.lit(640).alias("width")))


def release_fields(o_orderdate: str = "o_orderdate", price: str = "o_totalprice",
                   priority: str = "o_orderpriority") -> tuple[Column, Column]:
    """(release_date text, precision). Release year = order year minus ten
    years per 50,000 of order value; precision follows the order priority.
    Day texts are not validated here, so e.g. a 29 February in a non-leap
    release year is a bad date the parser must NULL."""
    y = F.year(o_orderdate) - F.floor(F.col(price) / 50000).cast("int") * 10
    m, d = F.month(o_orderdate), F.dayofmonth(o_orderdate)
    p = F.col(priority)
    # Padding costs a fraction of a format; it cuts what is longer and puts zeros before a sign.
    year = F.when(y.between(0, 9999), F.lpad(y.cast("string"), 4, "0")).otherwise(F.format_string("%04d", y))
    month, day = F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")
    text = (F.when(F.col(o_orderdate).isNull(), F.lit(None).cast("string"))
             .when(p == "1-URGENT", F.concat(year, F.lit("-"), month, F.lit("-"), day))
             .when(p == "2-HIGH", F.concat(year, F.lit("-"), month))
             .otherwise(year))
    prec = (F.when(p == "1-URGENT", "day").when(p == "2-HIGH", "month")
             .when(p == "3-MEDIUM", "year").when(p == "5-LOW", "decade"))
    return text, prec


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot (``d``) of each line item."""
    return load_table(spark, root, "lineitem").select(snapshot_of("l_shipdate").alias("d"))


def raw_tracks(spark: SparkSession, root: str, batch: Column | None = None) -> DataFrame:
    """Raw track rows (nested, landing shape) plus year/month/day as a landing path names them; a snapshot's rows
    lie together, those of an artist next to each other. ``batch``: a filter on the snapshot ``d``."""
    # What an item says of its line is worked out where that is read: less to move.
    li = load_table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.least(F.lit(100), F.floor(F.col("l_quantity") * 2)).cast("int").alias("popularity"),
        (F.floor("l_extendedprice").cast("bigint") + 60000).alias("duration_ms"),
        (F.col("l_returnflag") == "R").alias("explicit"),
        (F.col("l_linestatus") == "O").alias("is_playable"), snapshot_of("l_shipdate").alias("d"))
    li = li if batch is None else li.filter(batch)
    part = load_table(spark, root, "part").select("p_partkey", "p_name")
    supp = load_table(spark, root, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rel_text, rel_prec = release_fields()
    album_type = (F.when(F.col("o_orderstatus") == "F", "album")
                   .when(F.col("o_orderstatus") == "O", "single")
                   .when(F.col("o_orderstatus") == "P", "compilation"))
    orders = load_table(spark, root, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    # The largest table first, so that the others' names don't travel to it. What an item says of its order is
    # worked out behind that join: a stretch reads all orders, but needs those of its lines.
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
           .select(*li.columns, rel_text.alias("rel_text"), rel_prec.alias("rel_prec"), album_type.alias("album_type"))
           .join(part, li.l_partkey == part.p_partkey, "left")
           .join(supp, li.l_suppkey == supp.s_suppkey, "left"))
    # The rows travel to their snapshot, and are sorted there, as they are read; the items, many times as wide, are built
    # behind that, in the order that a partitioned write asks for.
    j = j.drop("p_partkey", "s_suppkey").hint("rebalance", "d")
    j = (j.withColumns({"id": _id("T", "l_partkey"), "artist_id": _id("A", "l_suppkey"), **path_date("d")})
          .sortWithinPartitions("year", "month", "day", "artist_id", "id"))
    return j.select(
        "id",
        F.col("p_name").alias("name"),
        F.lit("track").alias("type"),
        "popularity", "duration_ms", "explicit",
        _id("track:", "l_partkey").alias("uri"),
        _id("/tracks/", "l_partkey").alias("href"),
        F.lit(None).cast("string").alias("preview_url"),
        F.col("l_linenumber").alias("track_number"),
        F.lit(1).alias("disc_number"),
        "is_playable",
        F.lit(False).alias("is_local"),
        F.create_map(F.lit("web"), _id("/tracks/", "l_partkey")).alias("external_urls"),
        F.create_map(F.lit("sku"), _id("P", "l_partkey")).alias("external_ids"),
        F.array(_id("N", "s_nationkey")).alias("available_markets"),
        F.array(F.struct(F.col("artist_id").alias("id"), F.col("s_name").alias("name"),
                         _id("artist:", "l_suppkey").alias("uri"),
                         F.lit("artist").alias("type"),
                         F.lit(None).cast("string").alias("href"))).alias("artists"),
        F.struct(_id("L", "l_orderkey").alias("id"),
                 _id("Album ", "l_orderkey").alias("name"),
                 F.col("rel_text").alias("release_date"), F.col("rel_prec").alias("release_date_precision"),
                 "album_type", _id("album:", "l_orderkey").alias("uri"),
                 _image(_id("img/L", "l_orderkey")).alias("images"),
                 F.lit(None).cast("int").alias("total_tracks")).alias("album"),
        "year", "month", "day")


def raw_artists(spark: SparkSession, root: str, batch: Column | None = None) -> DataFrame:
    """Raw artist rows: one per (snapshot, supplier in good standing); a snapshot's rows lie together.
    ``batch`` as in ``raw_tracks``."""
    # Spread as read, or the task that reads a row group would join and count all of it. Most rows
    # of a (snapshot, supplier) then lie together, so the partial aggregate leaves few to send.
    li = load_table(spark, root, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", snapshot_of("l_shipdate").alias("d"))
    li = (li if batch is None else li.filter(batch)).hint("rebalance", "d", "l_suppkey")
    part = load_table(spark, root, "part").select("p_partkey", "p_type")
    supp = (load_table(spark, root, "supplier").select("s_suppkey", "s_name", "s_acctbal")
            .filter(F.col("s_acctbal") > 0))
    j = (li.join(supp, li.l_suppkey == supp.s_suppkey, "inner")
           .join(part, li.l_partkey == part.p_partkey, "left"))
    g = (j.groupBy("d", "l_suppkey", "s_name")
          .agg(F.count(F.lit(1)).alias("n"),
               F.array_sort(F.collect_set("p_type")).alias("genres"),
               F.sum("l_quantity").alias("q"))).hint("rebalance", "d")
    return g.select(
        _id("A", "l_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.lit("artist").alias("type"), _id("artist:", "l_suppkey").alias("uri"),
        F.lit(None).cast("string").alias("href"),
        F.least(F.lit(100), F.col("n") * 5).cast("int").alias("popularity"),
        "genres",
        F.struct(F.col("q").cast("bigint").alias("total"),
                 F.lit(None).cast("string").alias("href")).alias("followers"),
        _image(_id("img/A", "l_suppkey")).alias("images"),
        F.create_map(F.lit("web"), _id("/artists/", "l_suppkey")).alias("external_urls"),
        F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"))


def artist_details(spark: SparkSession, root: str) -> DataFrame:
    """Details lookup table (every supplier), standing in for the remote
    batch lookup: genres = [lower-case nation name]."""
    supp = load_table(spark, root, "supplier")
    nation = load_table(spark, root, "nation").select("n_nationkey", "n_name")
    j = supp.join(nation, supp.s_nationkey == nation.n_nationkey, "left")
    return j.select(
        _id("A", "s_suppkey").alias("id"), F.col("s_name").alias("name"),
        _id("artist:", "s_suppkey").alias("uri"),
        F.least(F.lit(100), F.greatest(F.lit(0), F.floor(F.col("s_acctbal") / 100)))
        .cast("int").alias("popularity"),
        F.array(F.lower("n_name")).alias("genres"),
        _image(_id("img/A", "s_suppkey")).alias("images"))
