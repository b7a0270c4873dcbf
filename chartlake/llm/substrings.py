"""Exact repeated substrings by difference-cover suffix sorting.

Every 400-byte window belongs to its anchor: the 200-byte gram in it that hashes
least. Equal windows have equal anchors, so windows meet by their anchor's hash:

1. An anchor's windows form one stretch of text. Stretches that recur whole are
   settled by counting their hashes.
2. A stretch that recurs only in part is sorted with the other stretches of its
   anchor. Tasks take buckets of anchors and run the difference-cover algorithm on
   them: the triples at positions 1 and 2 modulo 3 are sorted and named, names are
   tripled again and again until they stand for 243 bytes, the remaining windows are
   merged in by their first bytes and the name that follows (for any two positions
   some shift of at most two bytes brings both into the sample), and adjacent
   prefixes of 400 bytes are compared.
3. An anchor with very many different stretches would overfill a bucket; its
   windows are counted one by one by a 128-bit hash instead.

Order below 400 bytes is all that is needed, so no name stands for more.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

LENGTH = 400
GRAM = 200
SPAN = LENGTH - GRAM + 1          # grams in a window
STEP = 1 << 19                    # windows of a document worked on at a time
BUCKET = 4_000                    # stretches sorted in one task, about
CROWDED = 4_000                   # stretches of one anchor from which windows are counted

_MASK = np.uint64((1 << 20) - 1)
_powers: dict[int, tuple] = {}


def _tables(base: int):
    """(values of the bytes, powers of the base, inverse powers) modulo 2^64."""
    if base not in _powers:
        n = STEP + 2 * LENGTH + 2
        p = np.ones(n, np.uint64)
        p[1:] = base
        q = np.ones(n, np.uint64)
        q[1:] = pow(base, -1, 1 << 64)
        values = np.random.default_rng(base).integers(0, 1 << 64, 256, np.uint64)
        _powers[base] = values, np.cumprod(p), np.cumprod(q)
    return _powers[base]


class Hashes:
    """Hashes of any piece of a stretch of bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        values, powers, self.inverse = _tables(base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


OTHER_BASE = 0xD1342543DE82EF95


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = v
    blocks = blocks.reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def stretches(text: bytes):
    """(first window, last window, hash of the anchor, hash of the stretch) of all
    stretches of one text; the first of equal least grams is the anchor."""
    out = []
    for at in range(0, len(text) - LENGTH + 1, STEP):
        data = np.frombuffer(text, np.uint8, min(len(text) - at, STEP + LENGTH - 1), at)
        h = Hashes(data)
        grams = np.arange(len(data) - GRAM + 1)
        g = h.of(grams, grams + GRAM)
        least = (sliding_min((g & ~_MASK) | grams.astype(np.uint64), SPAN) & _MASK).astype(np.int64)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        last = np.append(first[1:], len(least)) - 1
        anchor = least[first]
        whole = h.of(first, last + LENGTH) ^ ((anchor - first) * 1_000_003 + (last - first)).astype(np.uint64)
        out.append((first + at, last + at, g[anchor].view(np.int64), whole.view(np.int64)))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4


def _stretches(batches):
    for b in batches:
        rows = [stretches(t) if t is not None and len(t) >= LENGTH else None
                for t in (x.as_py() for x in b.column(2).cast(pa.binary()))]
        n = [len(r[0]) if r else 0 for r in rows]
        keys = pa.array(np.repeat(np.arange(len(n)), n))
        cols = [np.concatenate([r[i] for r in rows if r] or [np.empty(0, np.int64)]) for i in range(4)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(keys), b.column(1).take(keys)] + [pa.array(c) for c in cols],
            names=["doc_id", "text_hash", "lo", "hi", "anchor", "whole"])


def repeated_windows(parts: list[bytes], windows: list[int]) -> list[np.ndarray]:
    """Difference-cover sorting of the parts; for each of the first ``windows[i]``
    windows of part i, whether its 400 bytes also start at another window."""
    size = [-(-(len(p) + 3) // 3) * 3 for p in parts]                # parts start at multiples of 3
    start = np.concatenate(([0], np.cumsum(size)))
    x = np.zeros(int(start[-1]) + 3 * LENGTH, np.int64)              # 0: end of a part
    for p, s in zip(parts, start.tolist()):
        x[s:s + len(p)] = np.frombuffer(p, np.uint8)
        x[s:s + len(p)] += 1
    m = len(x) // 3 - 1

    def named(*keys):
        """Ranks of the rows of ``keys`` in their sorted order."""
        name = keys[0]
        for k in keys[1:]:
            name = np.unique(name * (int(k.max(initial=0)) + 1) + k, return_inverse=True)[1]
        return name

    name = np.zeros((3, m), np.int64)                                # of positions 3*j + class
    for c in (1, 2):
        i = 3 * np.arange(m) + c
        name[c] = (x[i] * 257 + x[i + 1]) * 257 + np.append(x, 0)[i + 2]
    both = name[1:].ravel()
    both = np.unique(both, return_inverse=True)[1]
    covered = 3
    while covered < 243:
        r, s = both.reshape(2, m), covered // 3
        then = np.zeros((2, 2, m), np.int64)
        for k in (1, 2):
            then[k - 1, :, :max(0, m - k * s)] = r[:, k * s:]
        both = named(both, then[0].ravel(), then[1].ravel())
        covered *= 3
    name[1:] = both.reshape(2, m)

    def prefix(i):
        return name[i % 3, i // 3]

    w = np.array(windows)
    first = np.cumsum(w) - w
    p = np.arange(int(w.sum())) + np.repeat(start[:-1] - first, w)   # all windows
    found = np.zeros(len(p), bool)
    for shift in range(3):
        own = np.flatnonzero((p + shift) % 3 > 0)
        q = p[own]
        i = q + shift
        if shift == 0:
            keys = prefix(i), prefix(i + 156), x[i + 399]
        elif shift == 1:
            keys = prefix(i), prefix(i + 156), x[q]
        else:
            keys = prefix(i), prefix(i + 153), x[i + 396] * 257 + x[i + 397], x[q] * 257 + x[q + 1]
        if len(own):
            rank = named(*keys)
            found[own] |= np.bincount(rank)[rank] > 1                # equal neighbours in sorted order
    return np.split(found, np.cumsum(w)[:-1])


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in edge.reshape(-1, 2)]


def _sort_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    parts, lo = pdf["bytes"].tolist(), pdf["lo"].to_numpy()
    out = []
    found = repeated_windows(parts, [len(p) - LENGTH + 1 for p in parts])
    for i, (single, flags) in enumerate(zip(pdf["single"].tolist(), found)):
        if single and flags.any():
            out += [(i, lo[i] + a, lo[i] + b) for a, b in runs(flags)]
    at = [r[0] for r in out]
    return pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").iloc[at].to_numpy(),
                         "text_hash": pdf["text_hash"].iloc[at].to_numpy(),
                         "lo": np.array([r[1] for r in out], np.int64), "hi": np.array([r[2] for r in out], np.int64)})


def _cut(batches):
    """The bytes of the stretches asked for."""
    for b in batches:
        out = []
        for d, h, t, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                 b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist()):
            out += [(d, h, w["lo"], w["single"], w["anchor"], t[w["lo"]:w["hi"] + LENGTH]) for w in want]
        cols = list(zip(*out)) if out else [()] * 6
        kinds = [pa.int64()] * 3 + [pa.bool_(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["doc_id", "text_hash", "lo", "single", "anchor", "bytes"])


def _count_windows(batches):
    """(window, two hashes of its bytes) of every window of the stretches."""
    for b in batches:
        ids, cols = [], [[], [], []]
        for i, (lo, t) in enumerate(zip(b.column(2).to_pylist(), b.column(4).to_pylist())):
            data = np.frombuffer(t, np.uint8)
            for at in range(0, len(data) - LENGTH + 1, STEP):
                part = data[at:at + STEP + LENGTH - 1]
                p = np.arange(len(part) - LENGTH + 1)
                ids.append(np.full(len(p), i))
                cols[0].append(p + at + lo)
                cols[1].append(Hashes(part).of(p, p + LENGTH).view(np.int64))
                cols[2].append(Hashes(part, OTHER_BASE).of(p, p + LENGTH).view(np.int64))
        take = pa.array(np.concatenate(ids or [np.empty(0, np.int64)]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(take), b.column(1).take(take), b.column(3).take(take)]
            + [pa.array(np.concatenate(c or [np.empty(0, np.int64)])) for c in cols],
            names=["doc_id", "text_hash", "single", "p", "f1", "f2"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lo, hi): the windows from byte lo to byte hi occur
    elsewhere. ``docs``: doc_id, text_hash, text."""
    all_ = materialise(docs.filter(F.octet_length("text") >= LENGTH).mapInArrow(
        _stretches, "doc_id long, text_hash long, lo long, hi long, anchor long, whole long"), "stretches")
    tag = F.xxhash64("doc_id", "text_hash", "lo")
    kinds = all_.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(tag).alias("tag"))
    kinds = materialise(kinds, "stretch-kinds")
    many = kinds.groupBy("anchor").agg(F.count("*").alias("d"), F.sum("n").alias("total")).filter("total > 1")
    asked = kinds.join(many.select("anchor", "d"), "anchor")
    asked = materialise(all_.join(asked, ["anchor", "whole"])
                        .withColumn("need", (F.col("d") > 1) & ((F.col("n") == 1) | (F.col("tag") == tag)))
                        .select("doc_id", "text_hash", "lo", "hi", "anchor", "n", "d", "need"), "stretches-asked")
    settled = asked.filter("n > 1").select("doc_id", "text_hash", "lo", "hi")
    wanted = (asked.filter("need").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(
        "lo", "hi", "anchor", (F.col("n") == 1).alias("single"))).alias("want")))
    d = docs.filter(F.octet_length("text") >= LENGTH)
    cut = materialise(d.join(wanted, d.doc_id.eqNullSafe(wanted.doc_id) & (d.text_hash == wanted.text_hash))
                      .select(d.doc_id, d.text_hash, d.text, "want")
                      .mapInArrow(_cut, "doc_id long, text_hash long, lo long, single boolean, anchor long, "
                                        "bytes binary"), "stretch-bytes")
    crowded = many.filter(F.col("d") > CROWDED).select("anchor")
    usual = cut.join(crowded, "anchor", "left_anti")
    buckets = -(-max(1, cut.count()) // BUCKET)
    sorted_ = (usual.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
               .select("bucket", "doc_id", "text_hash", "lo", "single", "bytes").groupBy("bucket")
               .applyInPandas(_sort_bucket, "doc_id long, text_hash long, lo long, hi long"))
    windows = cut.join(crowded, "anchor", "left_semi").select("doc_id", "text_hash", "lo", "single", "bytes")
    windows = materialise(windows.mapInArrow(
        _count_windows, "doc_id long, text_hash long, single boolean, p long, f1 long, f2 long"), "windows")
    again = windows.groupBy("f1", "f2").agg(F.count("*").alias("c")).filter("c > 1").select("f1", "f2")
    counted = windows.filter("single").join(again, ["f1", "f2"], "left_semi").select(
        "doc_id", "text_hash", F.col("p").alias("lo"), F.col("p").alias("hi"))
    return settled.unionByName(sorted_).unionByName(counted)


def _keep(batches):
    for b in batches:
        out = []
        for d, t, ranges in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                                b.column(2).to_pylist()):
            t = t or b""
            kept, at, spans = [], 0, []
            for lo, hi in sorted((r["lo"], r["hi"] + LENGTH) for r in ranges or ()):
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
            for lo, hi in spans:
                kept.append(t[at:lo])
                at = hi
            kept = b"".join([*kept, t[at:]])
            out.append((d, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept,
                        [{"start": a, "end": z} for a, z in spans]))
        cols = list(zip(*out)) if out else [()] * 7
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), span]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept (the remaining bytes) and removed (start and end of the runs).

    A byte goes if a 400-byte string that covers it also starts anywhere else, in
    another document, another row or the same text. Null texts count as empty and,
    like all under 400 bytes, lose nothing; rows that repeat are copies of each
    other; an empty table gives none; other columns are not read."""
    d = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                    F.col("text").cast("string"))
    ranges = (repeated_ranges(d).groupBy("doc_id", "text_hash")
              .agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
              .withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"))
    joined = d.join(ranges, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        _keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
               "removed array<struct<start: long, end: long>>")
