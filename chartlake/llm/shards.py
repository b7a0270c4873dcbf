"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a vector of shard sums, largest first. Two of them are
combined by adding them in opposite order; the two with the largest spread are
combined first, until one is left. Chunks of groups are differenced in parallel
tasks, each to one vector; the vectors are differenced in turn, in as many levels
as keep every task at FAN vectors. Only vectors of shard sums meet in one task.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_index, materialise

CHUNK = 20_000         # groups differenced in one task, about
FAN = 4_096            # vectors differenced in one task, about
OVERHEAD = 16


def difference(vectors: np.ndarray) -> np.ndarray:
    """Places of an (n, k) array of partial partitions (each largest first) in
    their combination: (n, k) of the final shard of each vector's entries."""
    n, k = vectors.shape
    live = {i: vectors[i] for i in range(n)}
    heap = [(int(v[-1] - v[0]), i) for i, v in live.items()]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        s = live.pop(a) + live.pop(b)[::-1]
        order = np.argsort(-s, kind="stable")
        s = s[order]
        i = n + len(merged)
        merged.append((a, b, order.astype(np.int16)))
        live[i] = s
        heapq.heappush(heap, (int(s[-1] - s[0]), i))
    place = {n + len(merged) - 1: np.arange(k, dtype=np.int16)}
    out = np.zeros((n, k), np.int16)
    for i in range(len(merged) - 1, -1, -1):                 # undo the combinations
        at = place.pop(n + i)
        a, b, order = merged[i]
        for child, where in ((a, order), (b, k - 1 - order)):
            p = np.empty(k, np.int16)
            p[where] = at
            if child < n:
                out[child] = p
            else:
                place[child] = p
    if n and not merged:
        out[0] = np.arange(k)
    return out


def _groups(shards: int):
    def run(batches):
        if batches := [b for b in batches if b.num_rows]:            # a partition may be empty
            t = pa.Table.from_batches(batches)
            size = t.column("bytes").to_numpy()
            v = np.zeros((len(size), shards), np.int64)
            v[:, 0] = size
            yield from pa.table({"grp": t.column("grp"), "bytes": t.column("bytes"),
                                 "node": pa.array(np.full(len(size), TaskContext.get().partitionId(), np.int64)),
                                 "pos": pa.array(difference(v)[:, 0].astype(np.int32))}).to_batches()
    return run


def _vectors(batches):
    if batches := [b for b in batches if b.num_rows]:
        t = pa.Table.from_batches(batches)
        v = np.array(t.column("vec").to_pylist(), np.int64)
        order = np.argsort(-v, axis=1, kind="stable")
        place = difference(np.take_along_axis(v, order, 1))
        perm = np.empty_like(place)
        np.put_along_axis(perm, order, place, 1)
        yield from pa.table({"node": t.column("node"), "vec": t.column("vec"),
                             "parent": pa.array(np.full(len(v), TaskContext.get().partitionId(), np.int64)),
                             "perm": pa.array(perm.astype(np.int32).tolist(), pa.list_(pa.int32()))}).to_batches()


def partition_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (grp, bytes) -> (grp, shard)."""
    chunks = -(-max(1, groups.count()) // CHUNK)
    items = materialise(groups.select("grp", "bytes").repartition(chunks, "grp").mapInArrow(
        _groups(shards), "grp long, bytes long, node long, pos int"), "kk-groups")

    def vectors(sums):                                  # (node, pos, bytes) -> (node, vec)
        m = sums.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("pos", "bytes"))).alias("m"))
        return m.select("node", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                        lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0))).alias("vec"))

    place, n = items, chunks
    cur = vectors(items.groupBy("node", "pos").agg(F.sum("bytes").alias("bytes")))
    while True:
        parts = -(-n // FAN)
        dealt = cur.repartition(parts, "node") if parts > 1 else cur.repartition(1)
        level = materialise(dealt.mapInArrow(
            _vectors, "node long, vec array<long>, parent long, perm array<int>"), "kk-vectors")
        place = place.join(level.select("node", "parent", "perm"), "node").select(
            "grp", F.col("parent").alias("node"), F.get("perm", "pos").alias("pos"))
        if parts == 1:
            return place.select("grp", F.col("pos").alias("shard"))
        cur = vectors(level.select(F.col("parent").alias("node"), F.explode(F.arrays_zip("perm", "vec")).alias("z"))
                      .groupBy("node", F.col("z.perm").alias("pos")).agg(F.sum("z.vec").alias("bytes")))
        n = parts


def assign_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes and 16), text_crc32,
    law (``bytes``), shard, slot (gapless from 0 in each shard) and grown_shard
    (null under this law).

    Rows with equal texts go to one shard together; a null text counts as empty
    and goes with the empty ones. (Texts are told apart by a 64-bit hash: texts
    that share one would only stay together too.) Sizes are as near equal as
    indivisible groups allow. Repeated rows each give a row and have a slot of
    their own; an empty table gives an empty result; other columns are not read."""
    text = F.coalesce("text", F.lit(""))
    rows = materialise(docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                                   F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("grp")), "shard-rows")
    place = partition_groups(rows.groupBy("grp").agg(F.sum("size").alias("bytes")), shards)
    placed = gapless_index(rows.join(place, "grp"), "shard", ["doc_id", "grp"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
