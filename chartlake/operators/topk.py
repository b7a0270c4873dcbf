"""Top-k items per snapshot (OP-04): the "top items" feed itself."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The feed's item kinds and its page size.
ITEM_KINDS = ("tracks", "artists")
DEFAULT_K = 10


def snapshot_top_k(df: DataFrame, date: str, item: str, score: Column | str,
                   k: int = DEFAULT_K, score_name: str = "score",
                   rank_name: str = "item_rank") -> DataFrame:
    """The ``k`` best items per snapshot date by summed ``score``
    (ties: smaller item first). Planned as hash aggregate (partial before
    the shuffle) then ``row_number() <= k``, which Catalyst turns into a
    partial ``WindowGroupLimit`` before the date shuffle: a hot date sends at
    most k rows per task, never its whole group."""
    if k < 1:
        raise ValueError("k must be >= 1")
    sc = F.col(score) if isinstance(score, str) else score
    agg = df.groupBy(date, item).agg(F.sum(sc).alias(score_name))
    w = Window.partitionBy(date).orderBy(F.col(score_name).desc_nulls_last(),
                                         F.col(item).asc_nulls_last())
    return (agg.withColumn(rank_name, F.row_number().over(w))
               .filter(F.col(rank_name) <= k))


def check_kind(kind: str) -> str:
    if kind not in ITEM_KINDS:
        raise ValueError(f"item kind must be one of {ITEM_KINDS}, got {kind!r}")
    return kind
