"""Helpers shared by the operators: written intermediates, gapless indexes,
connected components."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


_held: dict = {}


def held(key: Hashable, make: Callable):
    """What a Python worker keeps between its tasks (a model, a tokenizer), made once. Spark's
    workers go from one stage to the next: what another operator left there is dropped first."""
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder and read it
    back: lineage is cut at files every executor can read again."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gapless_index(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, in column ``name``.

    No task holds a whole key: rows are numbered inside the partition they were
    written from, and shifted by the counts of the partitions before it (one
    count per key and partition)."""
    d = materialise(df.withColumn("_part", F.spark_partition_id()), name)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (d.groupBy(key, "_part").agg(F.count("*").alias("_n"))
              .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .select(key, "_part", "_shift"))
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    return (d.withColumn("_inside", F.row_number().over(inside))
            .join(counts, [key, "_part"])
            .withColumn(name, F.col("_inside") - 1 + F.col("_shift"))
            .drop("_inside", "_shift", "_part"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node in ``edges``; root is the smallest node that
    can be reached. Alternates the large-star and small-star steps: each links
    a node's neighbours to the smallest of them, until no edge changes. Every
    round is an aggregate and a join on the node, written to the shared folder."""
    e = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "edges")

    def state(d):
        return tuple(d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    old, new = None, state(e)
    while new != old:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        e = materialise(small.filter("u <> v").distinct(), "edges")
        old, new = new, state(e)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
