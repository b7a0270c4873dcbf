"""Fields beyond the declared schema: kept, counted, typed."""
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.sources.detect import detected_fields, rescued_rows, with_detected

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()),
    T.StructField("images", T.ArrayType(T.StructType([T.StructField("url", T.StringType())])))])


def _land(spark, root, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(
        os.path.join(root, "year=2024/month=01/day=02"))


def test_files_whose_fields_differ(spark, tmp_dir):
    root = os.path.join(tmp_dir, "feed")
    _land(spark, root, ['{"id":"a","n":1,"images":[]}', '{"id":"b","x":1,"ID":"other"}'])
    _land(spark, root, ['{"id":"c","images":[{"url":"u"}],"x":2.5,"o":{"p":[1]},"tags":["s"]}',
                        '{"id":"d","m":1}', '{"id":"e","m":"t","none":null}', '{"id":"f","n":"bad","x":9}', '{"id":"g"'])
    rows = rescued_rows(spark, root, SCHEMA)
    assert {r.field: (r.type, r.lines) for r in detected_fields(rows).collect()} == {
        "x": ("DECIMAL(21,1)", 2), "o": ("OBJECT<p: ARRAY<BIGINT>>", 1), "tags": ("ARRAY<STRING>", 1),
        "m": ("VARIANT", 2), "none": ("VOID", 1), "ID": ("STRING", 1)}
    typed = with_detected(rows)
    assert typed.columns == ["id", "n", "images", "year", "month", "day", "m", "none", "o", "tags", "x"]
    assert typed.schema["images"].dataType == SCHEMA["images"].dataType           # not array<string>
    got = {r.id: r for r in typed.withColumn("m", F.to_json("m")).withColumn("o", F.to_json("o")).collect()}
    assert set(got) == set("abcde")                                               # bad lines are no rows
    assert got["a"].images == [] and got["a"].x is None and got["a"].day == 2
    assert (float(got["b"].x), float(got["c"].x)) == (1.0, 2.5) and got["c"].tags == ["s"]
    assert got["c"].o == '{"p":[1]}' and (got["d"].m, got["e"].m) == ("1", '"t"')


def test_no_other_fields_and_no_lines(spark, tmp_dir):
    root = os.path.join(tmp_dir, "feed")
    _land(spark, root, ['{"id":"a"}'])
    rows = rescued_rows(spark, root, SCHEMA)
    assert rows.collect()[0].rescued is None and detected_fields(rows).count() == 0
    assert with_detected(rows).columns == ["id", "n", "images", "year", "month", "day"]
    empty = rows.filter("id = 'zz'")
    assert with_detected(empty).count() == 0
