"""Benchmark decontamination by latent semantic retrieval.

Passages become TF-IDF vectors over hashed words, with passage counts from all
documents. A distributed randomised SVD of the benchmark's passages (each task
adds its rows' share of A'(A*Q)) gives the latent space. Every 48-word window of
every document, 16 words apart, is projected into it and compared by cosine with
every benchmark passage. That also finds paraphrases. A hit holds CLOSE of its passage's
words in order, so windows of segments that hold fewer of every passage's words, order
aside, are left out before the projection; no hit is lost. The passages' shingles (runs
of words) are looked up in every document beside it, which finds all that are
copied word for word, however many passages there are. Candidates of both are
checked word by word: the longest common subsequence with the passage, and the
answer's words.
"""
from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

FEATURES = 1 << 16       # hashed words
RANK = 256               # of the latent space, at most
BLOCK, BLOCKS = 16, 3    # a window is BLOCKS blocks of BLOCK words
PASSAGE = 96             # words of a benchmark passage, at most
QUERIES = 16_384         # benchmark passages compared at a time, at most
COMMON = 0.5             # words in more than this share of passages carry no weight
COSINE = 0.4
SAME, CLOSE, ANSWER = 0.75, 0.55, 0.6    # of the passage's words; of the answer's
TOGETHER = 16_384        # words of texts compared at a time (one part of a long text may be more)
SEGMENT = 128            # words whose windows are judged by the passages' words together
SHORT = 8                # passages of fewer words must occur word for word
SHINGLE = 8              # words of a shingle, at most
FILTER = 22              # bits of a shingle's hash that are looked up first

PART = 1 << 20           # characters hashed at a time, to the end of a word

_GAP = re.compile(r"\W")
_tables: dict = {}


def _characters() -> np.ndarray:
    """Which code points are letters, digits or the underscore."""
    if "word" not in _tables:
        _tables["word"] = np.fromiter((c == 95 or chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _tables["word"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, n at least, of an odd number modulo 2^64 and of its inverse."""
    if len(_tables.get("up", ())) < n:
        base = 0x9E3779B97F4A7C15
        for name, x in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(n + 1, x, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all their bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_ids(text: str | None) -> np.ndarray:
    """32-bit hashes of the lower-case words (runs of letters, digits and
    underscores): polynomials over the words' code points, from prefix sums."""
    lower, out, at = text.lower() if text else "", [], 0
    while at < len(lower):
        gap = _GAP.search(lower, min(at + PART, len(lower)))
        end = gap.start() if gap else len(lower)
        points = np.frombuffer(lower[at:end].encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.zeros(len(points) + 2, np.int8)
        inside[1:-1] = _characters()[points]
        edges = np.flatnonzero(np.diff(inside))
        up, down = _powers(len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix(points + np.uint64(1)) * up[:len(points)], out=sums[1:])
        starts, ends = edges[::2], edges[1::2]
        out.append(mix((sums[ends] - sums[starts]) * down[starts]).astype(np.uint32))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _hash_words(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([word_ids(t.as_py()).tobytes() for t in b.column(2)],
                                                pa.binary())], names=["doc_id", "text_hash", "words"])


def hashed_documents(docs: DataFrame) -> DataFrame:
    return materialise(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                                   F.col("text").cast("string"))
                       .mapInArrow(_hash_words, "doc_id long, text_hash long, words binary"), "word-ids")


def _count_passages(batches):
    """Passages of BLOCK * BLOCKS words that hold each feature; feature -1: all."""
    total, n = np.zeros(FEATURES, np.int64), 0
    size = BLOCK * BLOCKS
    held, waiting = [], 0
    for b in batches:
        for w in b.column(0):
            f = (np.frombuffer(w.as_py(), np.uint32) % FEATURES).astype(np.int64)
            if len(f):
                held.append(np.unique((np.arange(len(f)) // size) * FEATURES + f) % FEATURES)
                waiting += len(f)
                n += -(-len(f) // size)
            if waiting > 1 << 20:
                total += np.bincount(np.concatenate(held), minlength=FEATURES)
                held, waiting = [], 0
    if held:
        total += np.bincount(np.concatenate(held), minlength=FEATURES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))],
                                     names=["feature", "n"])


def passage_counts(hashed: DataFrame) -> tuple[np.ndarray, int]:
    """How many passages of all documents hold each feature: FEATURES numbers."""
    rows = (hashed.select("words").mapInArrow(_count_passages, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(FEATURES, np.int64)
    own = rows[rows.feature >= 0]
    counts[own.feature.to_numpy()] = own.n.to_numpy()
    return counts, int(rows[rows.feature < 0].n.sum())


def benchmark_passages(benchmark: DataFrame) -> DataFrame:
    """(item_id, part, words, answer): items of more than PASSAGE words are cut in
    parts of nearly equal length; the answer is the column ``answer`` if there is
    one."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")

    def cut(batches):
        for b in batches:
            rows = []
            for item, text, ans in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = word_ids(text)
                parts = np.array_split(w, -(-len(w) // PASSAGE)) if len(w) else []
                rows += [(item, i, p.tobytes(), word_ids(ans).tobytes()) for i, p in enumerate(parts)]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["item_id", "part", "words", "answer"])

    return materialise(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"),
                                        answer.alias("answer"))
                       .mapInArrow(cut, "item_id long, part int, words binary, answer binary"), "benchmark")


def weigh(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of one passage, of length one. A passage of common
    words only keeps them at equal weight."""
    f, n = np.unique(words % FEATURES, return_counts=True)
    v = n * idf[f]
    if not v.any():
        v = n.astype(np.float64)
    keep = v > 0
    return f[keep], v[keep] / np.linalg.norm(v[keep])


def latent_space(passages: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, basis): right singular vectors of the passages' TF-IDF matrix,
    by randomised subspace iteration. Each step is one job over the passages; the
    driver holds features x rank numbers, at most FEATURES * RANK."""
    def used(batches):
        for b in batches:
            f = [weigh(np.frombuffer(w.as_py(), np.uint32), idf)[0] for w in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(f)).astype(np.int64))],
                                             names=["feature"])

    feats = np.sort(passages.select("words").mapInArrow(used, "feature long").distinct()
                    .toPandas()["feature"].to_numpy(np.int64))
    rank = min(RANK, passages.count(), len(feats))
    column = np.full(FEATURES, -1, np.int64)
    column[feats] = np.arange(len(feats))
    q = np.linalg.qr(np.random.default_rng(11).normal(size=(len(feats), rank)))[0]
    for _ in range(3):
        shared = passages.sparkSession.sparkContext.broadcast(q)

        def share(batches):
            basis = shared.value
            out = np.zeros_like(basis)
            for b in batches:
                for w in b.column(0):
                    f, v = weigh(np.frombuffer(w.as_py(), np.uint32), idf)
                    c = column[f]
                    out[c] += np.outer(v, v @ basis[c])
            at = np.flatnonzero(out.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array([r.tobytes() for r in out[at]], pa.binary())], names=["row", "v"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            rows, at = np.unique(pdf["row"].to_numpy(), return_inverse=True)
            total = np.zeros((len(rows), rank))
            np.add.at(total, at, np.stack([np.frombuffer(v) for v in pdf["v"]]))
            return pd.DataFrame({"row": rows, "v": [r.tobytes() for r in total]})

        z = (passages.select("words").mapInArrow(share, "row long, v binary")
             .groupBy(F.col("row") % 64).applyInPandas(add, "row long, v binary").toPandas())
        full = np.zeros((len(feats), rank))
        full[z["row"].to_numpy()] = np.stack([np.frombuffer(v) for v in z["v"]])
        u, _, _ = np.linalg.svd(full, full_matrices=False)
        q = u
        shared.unpersist()
    return feats, q.astype(np.float32)


def common_subsequence(passage: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per passage word."""
    places: dict[int, int] = {}
    for i, w in enumerate(passage.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(passage)) - 1
    v = full
    for w in words.tolist():
        u = v & places.get(w, 0)
        v = (v + u) | (v - u)
    return len(passage) - (v & full).bit_count()


def occurs(passage: np.ndarray, words: np.ndarray) -> bool:
    n = len(passage)
    return any(np.array_equal(words[i:i + n], passage)
               for i in np.flatnonzero(words[:max(0, len(words) - n + 1)] == passage[0]))


def shingle_size(n: int) -> int:
    """Words of the shingles of a passage of ``n`` words: all of a short one, and a
    third of a longer one, from 4 to SHINGLE."""
    return n if n < SHORT else min(SHINGLE, max(4, n // 3))


def shingles(words: np.ndarray, sizes: set[int]):
    """(size, hashes of the runs of so many words, by their first word) for each size."""
    factors = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    wide = words.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(words), np.uint64)
    for i in range(min(max(sizes, default=0), len(words))):
        h = h[:len(words) - i] + wide[i:] * factors[i]
        if i + 1 in sizes:
            yield i + 1, h


def reach(n: int) -> int:
    """Words on either side of a window in which a passage of ``n`` words is looked for."""
    return max(0, n - BLOCK * (BLOCKS - 1)) + 4


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (n[i] numbers), for all i in turn."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Searcher:
    def __init__(self, feats, basis, idf, queries):
        self.column = np.full(FEATURES, -1, np.int32)
        self.column[feats] = np.arange(len(feats))
        self.weight = np.where(idf > 0, idf, 0.0).astype(np.float32)
        self.rows = basis * np.where(idf[feats] > 0, idf[feats], 1.0).astype(np.float32)[:, None]
        self.queries = queries                                   # (item_id, part, words, answer)
        self.lists = [w.tolist() for _, _, w, _ in queries]
        sizes = np.array([len(w) for _, _, w, _ in queries])
        self.least = CLOSE * sizes                               # words that a hit holds
        self.reach = reach(int(sizes.max()))
        self.vocabulary, code = np.unique(np.concatenate([w for _, _, w, _ in queries]), return_inverse=True)
        # Of each word, from ``first``: the passages that hold it, and how often.
        at, self.times = np.unique(code * len(queries) + np.repeat(np.arange(len(queries)), sizes), return_counts=True)
        code, self.holder = np.divmod(at, len(queries))
        self.first = np.searchsorted(code, np.arange(len(self.vocabulary) + 1))
        self.known = np.zeros(FEATURES, bool)
        self.known[self.vocabulary % FEATURES] = True
        lat = np.zeros((len(queries), basis.shape[1]), np.float32)
        for i, (_, _, w, _) in enumerate(queries):
            f, v = weigh(w, idf)
            lat[i] = v.astype(np.float32) @ basis[self.column[f]]
        self.latent = lat / np.maximum(np.linalg.norm(lat, axis=1, keepdims=True), 1e-12)
        self.answers = []
        for _, _, w, a in queries:
            if len(a):
                self.answers.append(set(a.tolist()))
            else:                                                # its rarest quarter stands for the answer
                u = np.unique(w)
                rare = u[np.argsort(-idf[u % FEATURES], kind="stable")[:max(1, len(u) // 4)]]
                self.answers.append(set(rare.tolist()))

        found: dict[int, list] = {}                              # shingle size -> (hashes, passage, place)
        for i, (_, _, w, _) in enumerate(queries):
            for size, h in shingles(w, {shingle_size(len(w))}):
                found.setdefault(size, []).append((h, np.full(len(h), i), np.arange(len(h))))
        self.shingles = {}
        for size, rows in found.items():
            h, query, place = map(np.concatenate, zip(*rows))
            order = np.argsort(h, kind="stable")
            known = np.zeros(1 << FILTER, bool)
            known[h >> np.uint64(64 - FILTER)] = True
            self.shingles[size] = known, h[order], query[order], place[order]

    def copies(self, parts: list[np.ndarray]) -> list[tuple[int, int, int]]:
        """(part, passage, where it would begin) of the passages' shingles in some texts."""
        sizes = np.array([len(p) for p in parts])
        ends = np.cumsum(sizes)
        out = []
        for size, h in shingles(np.concatenate(parts), set(self.shingles)):
            known, keys, query, place = self.shingles[size]
            at = np.flatnonzero(known[h >> np.uint64(64 - FILTER)])
            if not len(at):
                continue
            low, high = np.searchsorted(keys, h[at]), np.searchsorted(keys, h[at], side="right")
            part = np.searchsorted(ends, at, side="right")
            n = np.where(at + size <= ends[part], high - low, 0)              # no run of two texts' words
            row = spread(low, n)
            begin = np.repeat(at - (ends - sizes)[part], n) - place[row]
            out.append(np.stack((np.repeat(part, n), query[row], begin), axis=1))
        return np.unique(np.concatenate(out), axis=0).tolist() if out else []

    def segments(self, parts: list[np.ndarray]):
        """(part, first word, passages it may hold) of the segments of some texts that may
        hold any: with what is in reach they hold as many of the passage's words as a hit does."""
        words = np.concatenate(parts)
        at = np.flatnonzero(self.known[words % FEATURES])
        near = np.minimum(np.searchsorted(self.vocabulary, words[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[near] == words[at]
        at, code = at[same], near[same]                          # the passages' words, by place
        sizes = np.array([len(p) for p in parts])
        before, n = np.cumsum(sizes) - sizes, -(-sizes // SEGMENT)
        part = np.repeat(np.arange(len(parts)), n)
        begin = spread(np.zeros(len(parts), np.int64), n) * SEGMENT
        low = np.searchsorted(at, before[part] + np.maximum(begin - self.reach, 0))
        high = np.searchsorted(at, before[part] + np.minimum(begin + SEGMENT + BLOCK * BLOCKS + self.reach, sizes[part]))
        held = np.unique(np.repeat(np.arange(len(part)), high - low) * len(self.vocabulary)
                         + code[spread(low, high - low)])
        segment, code = np.divmod(held, len(self.vocabulary))
        n = self.first[code + 1] - self.first[code]
        row = spread(self.first[code], n)
        found = np.bincount(np.repeat(segment, n) * len(self.queries) + self.holder[row], self.times[row],
                            len(part) * len(self.queries)).reshape(len(part), -1) >= self.least
        some = np.flatnonzero(found.any(axis=1))
        return part[some], begin[some], found[some]

    def windows(self, parts: list[np.ndarray]):
        """(part, first word, latent vector of length one) of all windows of some texts. The
        texts are laid out in blocks with BLOCKS - 1 empty ones between them, so
        that no window holds words of two."""
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, self.rows.shape[1]), np.float32)
        sizes = np.array([len(p) for p in parts])
        blocks = -(-sizes // BLOCK) + BLOCKS - 1
        begin = np.concatenate(([0], np.cumsum(blocks)[:-1]))
        col = self.column[np.concatenate(parts) % FEATURES]
        at = np.flatnonzero(col >= 0)
        before = np.cumsum(sizes) - sizes
        place = at + np.repeat(begin * BLOCK - before, sizes)[at]
        if not len(at):
            return at, at, np.empty((0, self.rows.shape[1]), np.float32)
        block, first = np.unique(place // BLOCK, return_index=True)
        sums = np.add.reduceat(self.rows.take(col[at], axis=0), first, axis=0)
        low = begin[np.searchsorted(begin, block, side="right") - 1]
        starts = np.unique(np.concatenate([np.maximum(low, block - i) for i in range(BLOCKS)]))
        lat = np.zeros((len(starts), sums.shape[1]), np.float32)
        for i in range(BLOCKS):
            j = np.minimum(np.searchsorted(block, starts + i), len(block) - 1)
            ok = block[j] == starts + i
            lat[ok] += sums[j[ok]]
        lat /= np.maximum(np.linalg.norm(lat, axis=1, keepdims=True), 1e-12)
        part = np.searchsorted(begin, starts, side="right") - 1
        return part, (starts - begin[part]) * BLOCK, lat

    def hits(self, texts: list[np.ndarray]) -> list[list[tuple[int, float, float, float]]]:
        """For each text (item_id, cosine, share of its words in order, share of the
        answer) of the items in it."""
        out: list[dict] = [{} for _ in texts]
        held, size = [], 0
        for i, words in enumerate(texts):
            for at in range(0, len(words), 65536):               # long texts part by part, overlapping
                held.append((out[i], words[max(0, at - 2 * PASSAGE):at + 65536 + 2 * PASSAGE]))
                size += len(held[-1][1])
                if size >= TOGETHER:
                    self.compare(held)
                    held, size = [], 0
        if held:
            self.compare(held)
        return [[(k, c, s, f) for k, (s, f, c) in sorted(o.items(), key=lambda x: (x[0] is None, x[0]))] for o in out]

    def compare(self, held: list[tuple[dict, np.ndarray]]) -> None:
        parts = [p for _, p in held]
        part, begin, able = self.segments(parts)
        segment, starts, lat = self.windows([parts[p][b:b + SEGMENT + BLOCK * (BLOCKS - 1)]
                                             for p, b in zip(part.tolist(), begin.tolist())])
        own = starts < SEGMENT                                   # the others begin in the next segment
        segment, starts, lat = segment[own], starts[own], lat[own]
        owner, starts = part[segment], starts + begin[segment]
        cos = lat @ self.latent.T
        rows, cols = np.nonzero((cos >= COSINE) & able[segment])
        near, around = -1, frozenset()
        for s, q, c in zip(rows.tolist(), cols.tolist(), cos[rows, cols].tolist()):
            out, words = held[owner[s]]
            start = int(starts[s])
            if s != near:                                        # the words near the window, of any passage's reach
                near, around = s, frozenset(words[max(0, start - PASSAGE):start + BLOCK * BLOCKS + PASSAGE].tolist())
            n = len(self.lists[q])
            if sum(map(around.__contains__, self.lists[q])) < CLOSE * n:
                continue                                         # no subsequence is longer than that
            wide = reach(n)
            self.check(out, q, words[max(0, start - wide):start + BLOCK * BLOCKS + wide], c)
        for p, q, begin in self.copies(parts):
            out, words = held[p]
            n = len(self.lists[q])
            region = words[max(0, begin - 4):begin + n + 4]
            if sum(map(frozenset(region.tolist()).__contains__, self.lists[q])) < CLOSE * n:
                continue
            low = max(0, begin - BLOCK * (BLOCKS - 1)) // BLOCK * BLOCK               # of the windows that overlap it
            _, starts, lat = self.windows([words[low:begin + n + BLOCK * BLOCKS]])
            near = lat[low + starts < begin + n] @ self.latent[q]
            self.check(out, q, region, float(near.max(initial=0.0)))

    def check(self, out: dict, q: int, region: np.ndarray, c: float) -> None:
        """Enter the passage's item in ``out`` if the region holds it."""
        item, _, passage, _ = self.queries[q]
        n = len(passage)
        same = float(occurs(passage, region)) if n < SHORT else common_subsequence(passage, region) / n
        if same < CLOSE:
            return
        answer = self.answers[q]
        found = len(answer.intersection(region.tolist())) / len(answer)
        if same >= SAME or found >= ANSWER:
            out[item] = max(out.get(item, (0, 0, 0)), (same, found, c))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, text_hash,
    item_id, cosine, lcs (share of the passage's words found in order), answer
    (share of the answer's words found).

    Null and empty texts hold nothing; an item without words is never found; with
    an empty table on either side the result is empty. Long texts are searched
    whole. Rows that repeat give rows each; null ids are carried; other columns
    are not read. A benchmark of more than QUERIES passages is compared in blocks."""
    spark = docs.sparkSession
    schema = "doc_id long, text_hash long, item_id long, cosine double, lcs double, answer double"
    hashed = hashed_documents(docs)
    passages = benchmark_passages(benchmark)
    counts, total = passage_counts(hashed)
    idf = np.log((1.0 + total) / (1.0 + counts))
    idf[counts > COMMON * total] = 0.0
    if not passages.count():
        return spark.createDataFrame([], schema)
    feats, basis = latent_space(passages, idf)
    out = None
    blocks = -(-passages.count() // QUERIES)
    for i in range(blocks):
        rows = passages.filter(F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(blocks)) == i).collect()
        queries = [(r["item_id"], r["part"], np.frombuffer(r["words"], np.uint32), np.frombuffer(r["answer"], np.uint32))
                   for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["part"], bytes(r["words"])))]
        model = spark.sparkContext.broadcast((feats, basis, idf, queries))

        def search(batches, model=model):
            finder = Searcher(*model.value)
            for b in batches:
                found = finder.hits([np.frombuffer(w.as_py(), np.uint32) for w in b.column(2)])
                rows = [(d, h, *x) for d, h, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), found)
                        for x in f]
                cols = list(zip(*rows)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.float64()] * 3)],
                    names=["doc_id", "text_hash", "item_id", "cosine", "lcs", "answer"])

        found = hashed.mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. Columns as they
    came."""
    leaks = materialise(find_leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64("text").alias("_hash"))
    return rows.join(leaks, rows._id.eqNullSafe(leaks.doc_id) & (rows._hash == leaks.text_hash),
                     "left_anti").select("row.*")
