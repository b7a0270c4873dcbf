"""Logistic regression by gradient descent, written as one Spark SQL expression.

The training rows are few (a bounded table), so the model is kept in its dual
form: every gradient step adds multiples of training rows to the weights, hence
w = sum(alpha_i * x_i), and only the alphas and the rows' inner products are
needed while training. The weights are then one grouped sum."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def train(rows: DataFrame, features: DataFrame, epochs: int = 150, rate: float = 1.0,
          decay: float = 0.002) -> DataFrame:
    """``rows`` (row, target in 0..1, weight), ``features`` (row, feature, value)
    -> (feature, w). Without rows there are no weights.

    Both tables must be small: the inner products are a table of rows x rows."""
    a = features.groupBy("row", "feature").agg(F.sum("value").alias("value"))
    b = a.select(F.col("row").alias("other"), "feature", F.col("value").alias("_v"))
    gram = (a.join(b, "feature").groupBy("row", "other").agg(F.sum(F.col("value") * F.col("_v")).alias("g"))
            .groupBy("row").agg(F.collect_list(F.struct("other", "g")).alias("gs")))
    one = (rows.join(gram, "row").groupBy()
           .agg(F.array_sort(F.collect_list(F.struct("row", "target", "weight", "gs"))).alias("r"))
           .select("r", F.transform("r", lambda x: x["row"]).alias("ids"))
           .select("r", "ids", F.aggregate("r", F.lit(0.0), lambda s, x: s + x["weight"]).alias("mass"))
           .select("ids", F.transform("r", lambda x: F.struct(
               x["target"].alias("t"), (x["weight"] / F.col("mass")).alias("m"),
               F.transform(x["gs"], lambda g: F.struct(
                   F.array_position("ids", g["other"]).cast("int").alias("j"), g["g"].alias("g"))).alias("gs")
           )).alias("r")))
    zero = F.transform(F.col("ids"), lambda _: F.lit(0.0))

    def step(alpha, _):
        return F.transform(F.col("r"), lambda x, i: F.element_at(alpha, i + 1) * F.lit(1 - rate * decay)
                           + F.lit(rate) * x["m"] * (x["t"] - sigmoid(
                               F.aggregate(x["gs"], F.lit(0.0),
                                           lambda s, g: s + g["g"] * F.element_at(alpha, g["j"])))))

    alpha = one.select("ids", F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), zero, step).alias("alpha"))
    alpha = alpha.select(F.explode(F.arrays_zip("ids", "alpha")).alias("z")).select(
        F.col("z.ids").alias("row"), F.col("z.alpha").alias("alpha"))
    return a.join(alpha, "row").groupBy("feature").agg(F.sum(F.col("alpha") * F.col("value")).alias("w"))
