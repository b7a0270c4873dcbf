"""Batch-lookup payloads as they come: parallel arrays whose genres are JSON text and
whose snapshot date is ISO text."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import genres_array, zip_arrays

PAYLOAD_FIELDS = ["id", "name", "popularity", "genres", "uri", "image_url", "snapshot_date"]


def iso_date(text) -> Column:
    """``yyyy-MM-dd`` text as a date; NULL for any other text and for impossible days."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def zip_payload(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per offset of the seven parallel arrays PAYLOAD_FIELDS; ``genres`` is parsed
    from JSON text and ``snapshot_date`` from ISO text. Bad JSON and bad dates are NULL and
    fail nothing; a JSON array without elements stays empty."""
    z = zip_arrays(payload, PAYLOAD_FIELDS, keep=keep, pos=None)
    return z.withColumn("genres", genres_array(F.col("genres"))).withColumn("snapshot_date", iso_date("snapshot_date"))


def merged_with_counts(target: DataFrame, source: DataFrame, key: str, observation) -> DataFrame:
    """``upsert(target, source, key)`` from one full outer join, its counts taken by
    ``observation`` on the same pass: ``matched`` (keys of both sides), ``inserted`` (new
    keys) and ``affected`` (their sum; 0 for an empty source). Source rows without a key are
    inserted; source keys must be unique, as for a MERGE (``affected`` would exceed the
    source's rows otherwise, and the merge fails)."""
    cols = target.columns
    src = source.select(F.struct(*[F.col(c) if c in source.columns else
                                   F.lit(None).cast(target.schema[c].dataType).alias(c) for c in cols]).alias("s"))
    tgt = target.select(F.struct(*cols).alias("t"))
    both = tgt.join(src, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    has_s, has_t = F.col("s").isNotNull(), F.col("t").isNotNull()
    counted = both.observe(observation,
                           F.count(F.when(has_s & has_t, 1)).alias("matched"),
                           F.count(F.when(has_s & ~has_t, 1)).alias("inserted"),
                           F.count(F.when(has_s, 1)).alias("affected"))
    return counted.select(F.when(has_s, F.col("s")).otherwise(F.col("t")).alias("r")).select("r.*")
