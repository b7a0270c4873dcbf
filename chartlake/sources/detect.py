"""Landing scans of feeds whose fields differ: the declared schema stays, fields it
doesn't name are kept as VARIANT values and may be added with the types detected."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_FIELDS
from .quarantine import landing_lines, made_once, parsed_lines

RESCUED = "rescued"


def rescued_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the lines that fit ``schema``, year, month, day, and ``rescued``: a map
    of the line's other top-level fields to VARIANT values (NULL if it has none). A name
    that differs from a declared one in case only is another field. A field named twice on
    a line has both entries (a column of ``with_detected`` takes the first). Fields inside
    declared structs that the structs don't name are not kept."""
    names = [f.name for f in schema.fields]
    rows = parsed_lines(landing_lines(spark, path), schema).filter(~F.col("bad"))
    fields = F.from_json("line", T.MapType(T.StringType(), T.VariantType()))
    rows = made_once(rows, "other", F.map_filter(fields, lambda k, _: ~k.isin(names)))
    return rows.select(*[F.col(f"item.{n}").alias(n) for n in names], *[f.name for f in PARTITION_FIELDS],
                       F.when(F.size("other") > 0, F.col("other")).alias(RESCUED))


def detected_fields(rows: DataFrame) -> DataFrame:
    """Per rescued field: ``field``, ``type`` (the one type that all its values have or widen
    to; VARIANT for a mixture) and ``lines``. A JSON null is no value, but counts as a line."""
    each = rows.select(F.explode(RESCUED).alias("field", "value"))
    return each.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("lines"))


def with_detected(rows: DataFrame) -> DataFrame:
    """``rescued_rows`` with a column for each rescued field instead of the map, in the order of
    their names: scalars and arrays of scalars with their detected type, all else as
    VARIANT. The fields' names and types come to the driver, as with any schema
    inference; a field named like a column of ``rows`` in another case stays out."""
    taken = {c.lower() for c in rows.columns}
    columns = []
    for r in sorted(detected_fields(rows).collect(), key=lambda r: r.field):
        if r.field.lower() in taken:
            continue
        taken.add(r.field.lower())
        plain = not any(w in r.type for w in ("OBJECT", "VARIANT", "VOID"))
        value = F.col(RESCUED)[r.field]
        columns.append((F.try_variant_get(value, "$", r.type) if plain else value).alias(r.field))
    return rows.select(*[c for c in rows.columns if c != RESCUED], *columns)
