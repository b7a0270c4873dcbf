"""Approximate nearest neighbours by multi-index hashing.

A rotation learned from a bounded sample (PCA, then iterative quantisation) turns
vectors into binary codes. Rows are dealt to blocks; in each block the codes are
cut into substrings and every substring is an index. A code within Hamming radius
r of a query has a substring within r // SUBSTRINGS of the query's (pigeonhole), so
probing the substring values that near retrieves all of them; they are reranked by
the distance of the original vectors. The radius is the least that holds RECALL of
the neighbours of calibration rows among the sample; neighbours among more rows are
nearer, so that more of them are within it. A query with fewer than k codes within
it in a block is compared with all of it.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SAMPLE = 8_192          # rows the rotation and the radius are learned from, at most
CALIBRATION = 256       # queries among them
RECALL = 0.97           # share of their neighbours that the radius holds, at least
BITS = 64               # at most; fewer dimensions give fewer bits
SUBSTRINGS = 4
BLOCK = 16_384          # rows of a block, about
QUERY_BLOCK = 4_096     # queries compared with a block at a time, about


def learn(x: np.ndarray, k: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, projection, radius) from sample rows: PCA directions rotated so that
    signs lose least, and the Hamming distance within which RECALL of the true
    neighbours of the calibration rows are."""
    mean = x.mean(0)
    _, _, vt = np.linalg.svd(x - mean, full_matrices=False)
    p = vt[:BITS].T
    y = (x - mean) @ p
    r = np.linalg.qr(np.random.default_rng(7).normal(size=(p.shape[1], p.shape[1])))[0]
    for _ in range(rounds):
        u, _, wt = np.linalg.svd(np.where(y @ r > 0, 1.0, -1.0).T @ y)
        r = (u @ wt).T
    p = p @ r
    bits = (x - mean) @ p > 0
    far = []
    for i in range(0, len(x), max(1, len(x) // CALIBRATION)):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.argsort(d)[:k]
        far.append((bits[near] != bits[i]).sum(1))
    return mean, p, int(np.quantile(np.concatenate(far), RECALL, method="higher"))


class BlockIndex:
    """Multi-index hash tables over the codes of one block."""

    def __init__(self, bits: np.ndarray):
        self.cuts = np.array_split(np.arange(bits.shape[1]), min(SUBSTRINGS, bits.shape[1]))
        self.codes = [self.value(bits, c) for c in self.cuts]
        self.tables = [np.unique(v, return_inverse=True) for v in self.codes]

    @staticmethod
    def value(bits: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return bits[:, cut] @ (np.uint64(1) << np.arange(len(cut), dtype=np.uint64))

    def within(self, bits: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` of one query's."""
        q = [int(self.value(bits[None, :], c)[0]) for c in self.cuts]
        found = np.zeros(len(self.codes[0]), bool)
        for (values, bucket), v in zip(self.tables, q):
            found |= (np.bitwise_count(values ^ np.uint64(v)) <= radius // len(self.cuts))[bucket]
        rows = np.flatnonzero(found)
        far = sum(np.bitwise_count(c[rows] ^ np.uint64(v)).astype(np.int64) for c, v in zip(self.codes, q))
        return rows[far <= radius]


def _search(model, k: int):
    mean, p, radius = model

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            x, ids = np.array(rows["embedding"].tolist(), np.float64), rows["vec_id"].to_numpy()
            index = BlockIndex((x - mean) @ p > 0)
            squares = (x ** 2).sum(1)
            qs = np.array(queries["embedding"].tolist(), np.float64)
            codes = (qs - mean) @ p > 0
            for q, code, qid in zip(qs, codes, queries["vec_id"].tolist()):
                near = index.within(code, radius)
                near = near[ids[near] != qid]
                if len(near) < k:
                    near = np.flatnonzero(ids != qid)
                if len(near) > k:                                # a product first, the measure itself for the nearest
                    d, size = squares[near] - 2 * (x[near] @ q), squares[near].max() + q @ q
                    near = near[d <= np.partition(d, k - 1)[k - 1] + 1e-9 * size]
                d = np.sqrt(((x[near] - q) ** 2).sum(1))
                if len(near) > k:
                    cut = np.partition(d, k - 1)[k - 1]
                    near, d = near[d <= cut], d[d <= cut]
                best = np.lexsort((ids[near], d))[:k]
                out["query_id"] += [qid] * len(best)
                out["vec_id"] += ids[near[best]].tolist()
                out["score"] += d[best].tolist()
        return pd.DataFrame({"query_id": np.array(out["query_id"], np.int64),
                             "vec_id": np.array(out["vec_id"], np.int64),
                             "score": np.array(out["score"], np.float64)})
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a finite, non-zero vector of the most common length."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.filter(~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: its ``k`` nearest
    others by Euclidean distance as (query_id, rank, vec_id, score).

    Vectors that are null, empty, zero or hold null or non-finite components take
    no part; vectors of a length other than the most common one neither. Ties go
    to the smaller vec_id. Rows that repeat a vec_id: the query's own id is never
    its neighbour, and of rows with one id the smallest vector counts. Empty tables give an
    empty result; other columns are not read."""
    v = materialise(usable(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    sizes = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return v.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                        F.lit(0.0).alias("score"))
    n = sizes["count"]
    v = v.filter(F.size("embedding") == sizes["d"])
    sample = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
    model = learn(np.array(sample["embedding"].tolist(), np.float64), k)
    is_query = F.col("vec_id") % every == 0
    blocks = -(-n // BLOCK)
    query_blocks = -(-max(1, v.filter(is_query).count()) // QUERY_BLOCK)

    def dealt(salt, parts):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")

    def everywhere(parts):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    rows = v.select("vec_id", "embedding", dealt("row", blocks).alias("b"), everywhere(query_blocks).alias("q"))
    queries = v.filter(is_query).select("vec_id", "embedding", everywhere(blocks).alias("b"),
                                        dealt("query", query_blocks).alias("q"))
    best = rows.groupBy("b", "q").cogroup(queries.groupBy("b", "q")).applyInPandas(
        _search(model, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
