"""Landing lines that don't fit their declared schema: kept out of every scan,
and written, with the file they stand in, to a quarantine folder."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_FIELDS

CORRUPT = "_corrupt_record"
_KEYS = [f.name for f in PARTITION_FIELDS]


def landing_lines(spark: SparkSession, path: str, stream: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Non-blank lines (``line``, ``file``, year, month, day) under ``path``, which may be
    the feed's folder, a folder or a glob below it; with ``stream``, as a file stream."""
    schema = T.StructType([T.StructField("value", T.StringType()), *PARTITION_FIELDS])
    reader = (spark.readStream if stream else spark.read).schema(schema)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.option("basePath", path.split("/year=")[0]).text(path)
    return (lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), *_KEYS)
            .filter(F.trim("line") != ""))


def made_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with column ``name``. As a generator's output it is made once a row; a plain column
    would be made again for each part of a filter on it, and again behind the filter."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def parsed_lines(lines: DataFrame, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """``landing_lines`` with ``item``, the line under ``schema``, and ``bad``: not valid JSON,
    no object, a field of another type, or a line that doesn't end where an object does (the
    parser stops behind the first object; a second object on the line is not seen). The whole schema is parsed whatever is selected
    afterwards (a file reader would parse the selected fields only, and a line would be good
    or bad by the query that asks). With mode FAILFAST a bad line fails the job."""
    if mode.upper() == "FAILFAST":
        return made_once(lines, "item", F.from_json("line", schema, {"mode": "FAILFAST"})).withColumn("bad", F.lit(False))
    if mode.upper() != "PERMISSIVE":
        raise ValueError(f"mode {mode!r}: PERMISSIVE or FAILFAST")
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    item = F.from_json("line", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (made_once(lines, "item", item)
            .withColumn("bad", F.col("item").isNull() | F.col(f"item.{CORRUPT}").isNotNull() | ~F.rtrim("line").endswith("}")))


def good_rows(lines: DataFrame, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """The fields of the lines that fit ``schema``, and year, month, day."""
    rows = parsed_lines(lines, schema, mode).filter(~F.col("bad"))
    return rows.select(*[F.col(f"item.{f.name}").alias(f.name) for f in schema.fields], *_KEYS)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines that don't fit ``schema``: line, file, year, month, day."""
    return parsed_lines(landing_lines(spark, path), schema).filter("bad").select("line", "file", *_KEYS)


def quarantine(spark: SparkSession, path: str, schema: T.StructType, to: str) -> DataFrame:
    """Write the bad lines under ``path`` to a new folder under ``to``; returns their number
    by file (``file``, ``lines``), read back from there. Every run writes a folder of its own,
    so what an earlier one kept stays; no bad line, no row."""
    out = f"{to.rstrip('/')}/run-{uuid.uuid4().hex}"
    bad = bad_lines(spark, path, schema)
    bad.write.parquet(out)
    return spark.read.schema(bad.schema).parquet(out).groupBy("file").agg(F.count("*").alias("lines"))
