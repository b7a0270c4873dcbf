"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ
in at most two bits agree exactly in one segment (pigeonhole) and differ by at
most two bits in the next. The 23-bit perfect Golay code decodes that next
segment to the indices of all codewords within four bits: one index for vectors
within two bits of a codeword, six for the others, and two vectors at distance
two or less always share one. (exact segment, codeword index) are the join
keys. Fingerprints that share a key are verified: they are at distance two or
less exactly if some 64-bit word is within one bit of both, and at most 65
fingerprints are within one bit of a word, so no group grows with the data.
"""
from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialise

SHINGLE = 3
MAX_BITS = 2
GENERATOR = 0xAE3                      # x^11+x^9+x^7+x^6+x^5+x+1 of the (23,12) code
SEGMENTS = ((0, 22), (22, 21), (43, 21))   # (first bit, bits), each padded to 23


def _syndromes(v: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit vectors by the generator."""
    v = v.copy()
    for i in range(22, 10, -1):
        v ^= np.where(v >> i & 1, GENERATOR << (i - 11), 0)
    return v


def golay_offsets() -> np.ndarray:
    """For each of the 2,048 syndromes six error patterns of weight four or
    less; where only one exists it is repeated."""
    found: list[list[int]] = [[] for _ in range(2048)]
    words = np.array([sum(1 << i for i in c) for w in range(5)
                      for c in itertools.combinations(range(23), w)], np.int64)
    for s, e in zip(_syndromes(words).tolist(), words.tolist()):
        found[s].append(e)
    return np.array([(f * 6)[:6] for f in found], np.int64)


def golay_indices(v: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(n, 6) information bits of the codewords within four bits of each vector."""
    return (v[:, None] ^ offsets[_syndromes(v)]) >> 11


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text: bit j is set if it is set in over half
    the XXH64 (seed 42) of the word shingles; no words give zero."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[k - 1:].tolist())),
                    np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):                 # bounded memory for long texts
        part = h[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << j for j in np.flatnonzero(2 * ones > len(h)).tolist())


def _fingerprints(batches):
    for b in batches:
        texts = b.column(2).cast(pa.binary())
        fps = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])


def _keys(batches):
    offsets = golay_offsets()
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        u = fp.view(np.uint64)
        seg = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        keys = np.concatenate([((np.int64(i) << 35) | (seg[i] << 12))[:, None]
                               | golay_indices(seg[(i + 1) % 3], offsets) for i in range(3)], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(fp, keys.shape[1])), pa.array(keys.ravel())], names=["fp", "key"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp (signed), fingerprint
    (16 hex digits), component_id (smallest doc_id reachable over links of two
    bits or less) and group_fp (a fingerprint that stands for the group).

    Null and empty texts have no words: fingerprint zero, linked like any other.
    A null doc_id is never the smallest unless the group has no other. Repeated
    rows each give a row. An empty table gives an empty result; other columns of
    ``docs`` are not read."""
    fps = materialise(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long"), "fingerprints")
    first = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    keys = first.select("fp").mapInArrow(_keys, "fp long, key long")
    shared = (keys.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
              .filter("lo <> hi").select("key"))
    cand = keys.join(shared, "key", "left_semi").select("fp").distinct()
    ball = cand.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")).select(
        "fp", F.when(F.col("bit") < 0, F.col("fp"))
        .otherwise(F.expr("fp ^ shiftleft(1L, bit)")).alias("word"))
    near = (ball.groupBy("word").agg(F.array_sort(F.collect_set("fp")).alias("g"))   # 65 at most
            .filter(F.size("g") > 1)
            .select(F.col("g")[0].alias("a"), F.explode(F.slice("g", 2, 64)).alias("b")))
    comp = materialise(connected_components(near, "a", "b"), "components")
    low = (comp.join(first, comp.node == first.fp).groupBy("root")
           .agg(F.min("first_id").alias("component_id")))
    of_fp = comp.join(low, "root").select(F.col("node").alias("fp"), F.col("root").alias("group_fp"),
                                          "component_id")
    of_fp = (first.join(of_fp, "fp", "left")
             .select("fp", F.coalesce("group_fp", "fp").alias("group_fp"),
                     F.coalesce("component_id", "first_id").alias("component_id")))
    return fps.join(of_fp, "fp").select(
        "doc_id", "text_hash", "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_fp")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the row of the
    smallest doc_id (of rows that repeat it, one). Columns as they came."""
    found = near_duplicates(docs)
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("group_fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
            .select("k.*"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"),
                       F.xxhash64("text").alias("_hash"))
    return (rows.join(kept, rows._id.eqNullSafe(kept.doc_id) & (rows._hash == kept.text_hash), "left_semi")
            .dropDuplicates(["_id", "_hash"]).select("row.*"))
