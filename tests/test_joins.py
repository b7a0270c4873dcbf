from pyspark.sql import functions as F


def test_null_keys_spread_and_never_match(spark):
    from chartlake.operators.joins import spread_null_key
    left = spark.createDataFrame([(None, i) for i in range(200)] + [("k", 999)], "k string, i int")
    right = spark.createDataFrame([("k", "hit")], "k2 string, v string")
    l2 = left.withColumn("jk", spread_null_key("k", "i"))
    out = l2.join(right, l2["jk"] == right["k2"], "left")
    assert out.filter(F.col("v") == "hit").count() == 1
    assert out.filter(F.col("k").isNull() & F.col("v").isNull()).count() == 200
    assert l2.select("jk").distinct().count() == 201          # NULLs no longer one key
