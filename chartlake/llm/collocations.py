"""Phrase collocations by best-first branch-and-bound growth.

A phrase grows to the right, word by word, from its first word w. However it grows,
cutting it behind w gives 1000 * a * n / (f(w) * r) with r >= a, so floor(1000 * n / f(w))
bounds the score of everything that begins with w: the prefix count's bound. Waves expand
each language's words of the best bounds first; a wave counts, over all documents, every
extension by one word of its phrases that may be frequent, level by level. Afterwards the
language's 2000th surviving score is known, and words whose bound is below it are never
expanded; the loop ends when no word of a bound that reaches it is left.

Which phrases a scan counts is told by Bloom filters of a bounded size: a phrase that a
filter wrongly lets through is counted and then found infrequent, none is missed. Counts
are kept by the phrase itself, first in the tasks, then by shuffles on (language, phrase).
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WORDS = 5                    # a phrase's words, at most
LEAST = 100                  # occurrences of a candidate
TOP = 2000                   # phrases of a language
FIRST_WAVE = 64              # the first wave expands words of up to LEAST times this occurrences
CHUNK = 4 << 20              # bytes of text that are counted together in a task
MOST_BITS = 1 << 28          # of a Bloom filter (32 MB)
PROBES = 4
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
BREAK = b"."                 # between pieces; never part of a word

_PIECE = re.compile(rb"[.,;:!?\n-\r]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- phrases as numbers ----------------------------------------------------------
def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _grow(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of phrases with hash ``h`` that go on with words of hash ``word``."""
    h = (h ^ word) * _MIX
    return h ^ (h >> np.uint64(29))


class Bloom:
    """Phrases of any language, up to false positives."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(h: np.ndarray, mask: np.uint64) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(17)) | np.uint64(1)
        for _ in range(PROBES):
            yield h & mask
            h = h + step

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in self.places(h, self.mask):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _marks(mask: int):
    def run(batches):
        for b in batches:
            langs, phrases = b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()
            h = _hashes([x.encode() for x in langs])
            split = [p.split(b" ") for p in phrases]
            for i in range(max(map(len, split), default=0)):
                rows = [j for j, p in enumerate(split) if len(p) > i]
                h[rows] = _grow(h[rows], _hashes([split[j][i] for j in rows]))
            bits = np.unique(np.concatenate([*Bloom.places(h, np.uint64(mask))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array((bits >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))], names=["at", "word"])
    return run


def bloom(phrases: DataFrame):
    """Broadcast filter of (lang, phrase); at most MOST_BITS bits, 16 a phrase below that."""
    n = phrases.count()
    size = min(MOST_BITS, 1 << max(16, (16 * n).bit_length()))
    words = (phrases.select("lang", "phrase").mapInArrow(_marks(size - 1), "at long, word long")
             .groupBy("at").agg(F.bit_or("word").alias("word")))
    bits = np.zeros(size // 64, np.uint64)
    for b in words.toArrow().to_batches():
        bits[b.column(0).to_numpy()] = b.column(1).to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(bits.astype("<u8").view(np.uint8))


# -- scans -----------------------------------------------------------------------
def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in lower case, pieces divided by BREAK, in parts of about CHUNK bytes
    that end between pieces."""
    begin = 0
    while len(text) - begin > CHUNK and (cut := _PIECE.search(text, begin + CHUNK)):
        yield _PIECE.sub(b" . ", text[begin:cut.start()].lower())
        begin = cut.end()
    yield _PIECE.sub(b" . ", (text[begin:] if begin else text).lower())


def _chunks(batches) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words and breaks) of texts of one language, CHUNK bytes or a bit more."""
    texts: dict[str, list[bytes]] = {}
    held = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            for part in pieces(text.as_py()):
                texts.setdefault(lang, []).append(part)
                held += len(part)
                if held >= CHUNK:
                    for k, v in texts.items():
                        yield k, b" . ".join(v).split()
                    texts, held = {}, 0
    for k, v in texts.items():
        yield k, b" . ".join(v).split()


def _counted(lang: str, words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]).take(pa.array(np.zeros(len(n), np.int32))), words.cast(pa.string()), pa.array(n.astype(np.int64))],
        names=["lang", "phrase", "f"])


def _words(batches):
    for lang, words in _chunks(batches):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        n[[i for i, w in enumerate(coded.dictionary.to_pylist()) if w == BREAK]] = 0
        keep = np.flatnonzero(n)
        yield _counted(lang, coded.dictionary.take(pa.array(keep)), n[keep])


def _phrases(tests: dict[int, list]):
    """Counts of the phrases of each size in ``tests``: a phrase is counted if for some
    list of (position, size, filter) its parts at these positions all pass. That hangs on
    the phrase alone, so of each phrase either every occurrence is counted or none."""
    def run(batches):
        for lang, words in _chunks(batches):
            coded = pa.array(words, pa.binary()).dictionary_encode()
            ids, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            stop = pc.index(vocabulary, pa.scalar(BREAK, pa.binary())).as_py()
            piece = np.cumsum(ids == stop)
            of_word = _hashes(vocabulary.to_pylist())
            single = _grow(np.full(len(of_word), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64), of_word)
            of_word, hashes = of_word[ids], {1: single[ids]}
            for k in range(2, max(tests) + 1):
                m = max(len(ids) - k + 1, 0)
                hashes[k] = _grow(hashes[k - 1][:m], of_word[len(ids) - m:])
            for k, either in tests.items():
                m = len(hashes[k])
                at = np.flatnonzero((piece[:m] == piece[len(ids) - m:]) & (ids[:m] != stop))
                passed = np.zeros(len(at), bool)
                for parts in either:
                    left = np.flatnonzero(~passed)
                    for begin, size, named in parts:
                        named = Bloom(named.value)
                        if size == 1:
                            left = left[named.has(single)[ids[at[left] + begin]]]
                        else:
                            left = left[named.has(hashes[size][at[left] + begin])]
                    passed[left] = True
                at = at[passed]
                if len(at):
                    yield _counted(lang, *_joined(at, ids, vocabulary, k))
    return run


def _joined(at: np.ndarray, ids: np.ndarray, vocabulary: pa.Array, size: int) -> tuple[pa.Array, np.ndarray]:
    """The different phrases that begin at ``at``, and how often each does."""
    key = ids[at]
    for i in range(1, size):
        _, first, key, n = np.unique(key * len(vocabulary) + ids[at + i], return_index=True,
                                     return_inverse=True, return_counts=True)
    words = [vocabulary.take(pa.array(ids[at[first] + i])) for i in range(size)]
    return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())), n


# -- growth ----------------------------------------------------------------------
def _count(texts: DataFrame, scan, name: str) -> DataFrame:
    return materialise(texts.mapInArrow(scan, "lang string, phrase string, f long")
                       .groupBy("lang", "phrase").agg(F.sum("f").alias("f")), name)


def _part(words: str, begin, size) -> Column:
    return F.concat_ws(" ", F.slice(words, begin, size))


def _scored(found: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """The candidates ``found`` that no longer one absorbs, with their lowest cut."""
    d = found.withColumn("words", F.split("phrase", " "))
    cuts = (d.select("lang", "phrase", F.col("f").alias("a"), "words",
                     F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _part("words", 1, F.col("k")).alias("first"),
                    _part("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest")))
    for name, part in (("l", "first"), ("r", "rest")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    cut = F.struct(F.expr("(a19 * n19 * 1000BD) div (l19 * r19)").alias("score"), "k", "l", "r")
    best = (cuts.join(totals, "lang").withColumns({f"{c}19": v for c, v in wide.items()})
            .groupBy("lang", "phrase", "a", "n").agg(F.min(cut).alias("cut")))
    longer = (counts.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 2)
              .select("lang", "f", F.explode(F.array(_part("words", 1, F.size("words") - 1),
                                                     _part("words", 2, F.size("words") - 1))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))
    return (best.join(longer, ["lang", "phrase"], "left").filter("longest IS NULL OR longest < a")
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def _ranked(df: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select("lang", "phrase", "f") for f in frames])


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases (by
    score, then a, both descending, then phrase) of 2 to WORDS words that occur ``least``
    times or more and aren't part of a longer one that occurs as often.

    A null language is ``und``, a null text empty. Texts are read whole, equal rows count
    each; a text without words adds nothing; an empty table gives no rows. Ties in score,
    a and phrase can't be, so ranks are settled. Counts are exact (decimals of 38 digits
    hold their products); columns other than lang and text are not read."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = _count(texts, _words, "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = (words.filter(F.col("f") >= least).join(totals, "lang")
                .withColumn("bound", F.expr("(n * 1000BD) div CAST(f AS decimal(19,0))")))
    waiting = materialise(frequent.select("lang", "phrase", "f", "bound"), "waiting")
    by_size: dict[int, list[DataFrame]] = {1: [waiting]}
    frequent = bloom(waiting)
    best = floors = None
    limit = least * FIRST_WAVE
    while True:
        now = F.col("f") <= limit
        if floors is not None:
            waiting = waiting.join(floors, "lang", "left")
            now = F.when(F.col("floor").isNull(), now).otherwise(F.col("bound") >= F.col("floor"))
        waiting = materialise(waiting.withColumn("now", now), "waiting")
        limit *= max(2, FIRST_WAVE)
        wave, waiting = waiting.filter("now"), waiting.filter("NOT now").drop("now")
        if wave.isEmpty():
            if (waiting if floors is None else waiting.filter("floor IS NULL")).isEmpty():
                break
            waiting = waiting.select("lang", "phrase", "f", "bound")
            continue
        waiting = waiting.select("lang", "phrase", "f", "bound")
        unseen = None if waiting.isEmpty() else bloom(waiting)
        found = _expand(texts, wave, by_size, frequent, unseen, least)
        if found:
            counts = _union([f for level in by_size.values() for f in level])
            if unseen is not None:
                beside = _beside(texts, _union(found), counts, waiting, unseen, least)
                counts = _union([counts, beside]).dropDuplicates(["lang", "phrase"])
            scored = _scored(_union(found), counts, totals)
            if best is not None:
                scored = scored.unionByName(best.drop("rank"))
            best = materialise(_ranked(scored, top), "collocations")
            floors = best.filter(F.col("rank") == top).select("lang", F.col("score").alias("floor"))
    if best is None:
        return _ranked(_scored(words.limit(0), words, totals), top).select(*COLUMNS)
    return best.select(*COLUMNS)


def _expand(texts: DataFrame, wave: DataFrame, by_size: dict, frequent, unseen, least: int) -> list[DataFrame]:
    """The frequent phrases that begin with a word of the wave, by size; kept in ``by_size``.
    An extension counts only if its last word is frequent, and so is its rest, unless that
    begins with a word that isn't expanded yet."""
    found, level = [], wave
    for size in range(2, WORDS + 1):
        grown = [(0, size - 1, bloom(level)), (size - 1, 1, frequent)]
        tests = [grown]
        if size > 2:
            tests = [[*grown, (1, size - 1, bloom(_union(by_size[size - 1])))]]
            if unseen is not None:
                tests.append([*grown, (1, 1, unseen)])
        # What a filter let through wrongly belongs to a later wave: only true extensions stay.
        counted = _count(texts, _phrases({size: tests}), f"phrases{size}").filter(F.col("f") >= least)
        prefixes = level.select("lang", F.col("phrase").alias("prefix"))
        level = materialise(counted.withColumn("prefix", F.substring_index("phrase", " ", size - 1))
                            .join(prefixes, ["lang", "prefix"], "left_semi").drop("prefix"), f"level{size}")
        if level.isEmpty():
            break
        found.append(level)
        by_size.setdefault(size, []).append(level)
    return found


def _beside(texts: DataFrame, found: DataFrame, counts: DataFrame, waiting: DataFrame, unseen, least: int) -> DataFrame:
    """Counts that the phrases of a wave need of phrases that begin with words not expanded
    yet: what is left of a phrase behind a cut, and phrases longer by a first word."""
    d = found.withColumn("words", F.split("phrase", " "))
    rests = (d.filter(F.size("words") > 2)
             .select("lang", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("k"))
             .select("lang", _part("words", F.col("k"), F.size("words")).alias("phrase")).distinct())
    rests = bloom(materialise(rests.join(counts, ["lang", "phrase"], "left_anti"), "rests"))
    ends = bloom(materialise(d.filter(F.size("words") < WORDS).select("lang", "phrase"), "ends"))
    tests: dict[int, list] = {k: [[(0, k, rests)]] for k in range(2, WORDS)}
    for k in range(3, WORDS + 1):
        tests.setdefault(k, []).append([(0, 1, unseen), (1, k - 1, ends)])
    return _count(texts, _phrases(tests), "beside").filter(F.col("f") >= least)
