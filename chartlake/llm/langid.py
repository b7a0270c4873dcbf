"""Language identification by cross-parsing entropy.

A suffix automaton of each language's labelled text finds, at every point of a
document, the longest phrase that occurs in that text. The number of phrases a
document needs, times the bits to name a phrase's place (log2 of the labelled
length), over the document's length, is the cross-entropy; the least wins. A character that a language's text
does not hold is a phrase by itself and costs the bits to name a code point as well.
"""
from __future__ import annotations

import re
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held

FOLDS = 5                # documents whose crc32(doc_id) is divisible by it are held out
SAMPLE_DOCS = 24         # labelled documents a language is learned from, at most
SAMPLE_CHARS = 4_000     # characters of each, at most (of a longer one a piece, placed by a hash)
POINT = log2(0x110000)   # bits to name a character that the language's text does not hold
FILL = 3                 # entries of a transition table for each transition, at least
ROUNDS = 64              # tries to place states before the table grows
UNKNOWN = "und"
TOGETHER = 1024          # documents parsed in step
CHARS = 4 << 20          # characters of them, about
FEW = 16                 # when fewer are left, each is parsed by itself

_LETTERS = re.compile(r"[^\W\d_]+")
LETTER = r"[\p{L}\p{Nl}\p{No}]"        # what they hold, to Spark


def normalise(text: str) -> str:
    """Lower-case words of letters, joined by single spaces."""
    return " ".join(_LETTERS.findall(text.lower()))


class Parser:
    """Suffix automata of the languages, as transition tables."""

    def __init__(self, samples: dict[str, list[str]]):
        texts = {k: [t for t in dict.fromkeys(map(normalise, v)) if t] for k, v in sorted(samples.items())}
        texts = {k: v for k, v in texts.items() if v}
        letters = sorted({c for v in texts.values() for t in v for c in t})
        self.width = len(letters) + 2                          # code 0: unknown, 1: between texts
        self.code_of = np.zeros(0x110000, np.int32)
        self.code_of[[ord(c) for c in letters]] = np.arange(2, self.width)
        self.languages = list(texts)
        self.bits = np.array([log2(sum(map(len, v)) + 1) for v in texts.values()])
        owners, nexts, roots, at = [], [], [], 0
        for v in texts.values():
            owner, to, root = self.automaton([c for t in v for c in (*self.codes(t).tolist(), 1)])
            roots.append(root + at)                            # where each language's table begins
            owners.append(np.where(owner < 0, owner, owner + at).astype(np.int32))
            nexts.append((to + at).astype(np.int32))
            at += len(owner)
        self.root = np.array(roots, np.int32)
        self.owner = np.concatenate(owners) if owners else np.empty(0, np.int32)
        self.next = np.concatenate(nexts) if nexts else np.empty(0, np.int32)
        if roots:
            own = self.root + np.arange(self.width, dtype=np.int32)[:, None]
            self.first = np.where(self.owner[own] == self.root, self.next[own], -1)

    def codes(self, text: str) -> np.ndarray:
        return self.code_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def automaton(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        """(owner, next, root): a state is a number s, and its transition by a code c is
        entry s + c of ``next`` if that of ``owner`` is s; otherwise it has none."""
        link, length, step, last = [-1], [0], [{}], 0
        for c in codes:
            new = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        return self.placed([{c: t for c, t in nexts.items() if c > 1} for nexts in step])

    def placed(self, step: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, int]:
        """States laid over one another so that no two use an entry, those with most
        transitions first, at places drawn until they fit."""
        rng = np.random.default_rng(5)
        room = FILL * (len(step) + sum(map(len, step)))
        taken, named = np.zeros(room + self.width, bool), np.zeros(room, bool)
        base = np.full(len(step), -1, np.int64)
        by_size: dict[int, list[int]] = {}
        for s, nexts in enumerate(step):
            by_size.setdefault(len(nexts), []).append(s)
        for size in sorted(by_size, reverse=True):
            left = np.array(by_size[size])
            codes = np.array([list(step[s]) for s in left], np.int64).reshape(len(left), size)
            tries = 0
            while len(left):
                tries += 1
                if tries % ROUNDS == 0:
                    taken, named = np.append(taken, np.zeros(room, bool)), np.append(named, np.zeros(room, bool))
                    room *= 2
                at = rng.integers(0, room, len(left))
                slots = at[:, None] + codes
                fit = np.flatnonzero(~named[at] & ~taken[slots].any(1))
                claim, name = np.empty(len(taken), np.int32), np.empty(room, np.int32)
                name[at[fit]] = fit
                claim[slots[fit]] = fit[:, None]
                fit = fit[(name[at[fit]] == fit) & (claim[slots[fit]] == fit[:, None]).all(1)]
                named[at[fit]] = True
                taken[slots[fit]] = True
                base[left[fit]] = at[fit]
                rest = np.delete(np.arange(len(left)), fit)
                left, codes = left[rest], codes[rest]
        owner, to = np.full(len(taken), -1, np.int64), np.zeros(len(taken), np.int64)
        for_state = np.repeat(base, list(map(len, step)))
        slots = for_state + np.fromiter((c for n in step for c in n), np.int64, len(for_state))
        owner[slots] = for_state
        to[slots] = base[np.fromiter((t for n in step for t in n.values()), np.int64, len(for_state))]
        return owner, to, int(base[0])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(text, language): phrases of the greedy parse; an unknown character is one by
        itself. The texts, longest first, are parsed in step."""
        sizes = np.array([len(t) for t in texts])
        flat, begin = np.concatenate(texts), np.cumsum(sizes) - sizes
        n = np.zeros((len(texts), len(self.root)), np.int64)
        state = np.tile(self.root, (len(texts), 1))
        open_ = np.zeros(n.shape, bool)
        left, i = len(texts), 0
        while True:
            while left and sizes[left - 1] <= i:
                left -= 1
            if left < FEW:
                break
            c = flat[begin[:left] + i]
            entry = state[:left] + c[:, None]
            to = self.next.take(entry)
            miss = self.owner.take(entry) != state[:left]
            again = self.first[c]
            none = miss & (again < 0)
            n[:left] += (miss & open_[:left]).astype(np.int64) + none
            state[:left] = np.where(none, self.root, np.where(miss, again, to))
            open_[:left] = ~none
            i += 1
        n += open_
        owner, to = memoryview(self.owner), memoryview(self.next)
        for d in range(left):
            rest = texts[d][i:].tolist()
            for k, root in enumerate(self.root.tolist()):
                n[d, k] += self.rest(owner, to, rest, root, int(state[d, k]), bool(open_[d, k]))
        return n

    @staticmethod
    def rest(owner: memoryview, to: memoryview, codes: list[int], root: int, s: int, open_: bool) -> int:
        """Phrases that a text's rest adds, from state ``s``."""
        n = -open_
        for c in codes:
            if owner[s + c] == s:
                s, open_ = to[s + c], True
                continue
            n += open_
            if owner[root + c] == root:
                s, open_ = to[root + c], True
            else:
                n += 1
                s, open_ = root, False
        return n + open_

    def missing(self, codes: np.ndarray) -> np.ndarray:
        """(language): characters of a text that the language's own text does not hold."""
        return (self.first[codes] < 0).sum(0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, margin over the next one in 0..1) of each text."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return out
        words = [(i, w) for i, t in enumerate(texts) if t and (w := normalise(t))]
        words.sort(key=lambda x: -len(x[1]))
        at = 0
        while at < len(words):
            to, held = at, 0
            while to < len(words) and to - at < TOGETHER and held < CHARS:
                held += len(words[to][1])
                to += 1
            coded = [self.codes(w) for _, w in words[at:to]]
            for (i, _), c, n in zip(words[at:to], coded, self.phrases(coded).tolist()):
                cost = sorted(((x * b + m * POINT) / len(c), k) for x, m, b, k in zip(
                    n, self.missing(c).tolist(), self.bits.tolist(), self.languages))
                out[i] = (cost[0][1], 1.0 if len(cost) == 1 else 1.0 - cost[0][0] / cost[1][0])
            at = to
        return out


def _predict(samples: tuple, keep: bool):
    def run(batches):
        model = held(("langid", samples), lambda: Parser({k: list(v) for k, v in samples}))
        for whole in batches:
            for b in _slices(whole):
                out = model.predict(b.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([x for x, _ in out], pa.string()),
                     pa.array([x for _, x in out], pa.float64()), *b.columns[3 - keep:]],
                    names=["row", "held_out", "lang_pred", "score", "text"][:4 + keep])
    return run


def _slices(batch: pa.RecordBatch):
    """``batch`` in stretches of about CHARS bytes of text: only those stand in memory as Python
    strings, and no more goes back to Spark at once."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHARS)))
        yield batch.slice(at, to - at)
        at = to


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def learn_samples(docs: DataFrame) -> tuple:
    """The labelled sample: of each language SAMPLE_DOCS documents that hold a letter
    and are not held out, by the order of a hash of their text; a longer document
    gives a piece of SAMPLE_CHARS characters, placed by the hash (from its first
    letter on if there is none in it). Bounded by the number of languages times
    SAMPLE_DOCS * SAMPLE_CHARS characters."""
    text, n = F.col("text"), F.lit(SAMPLE_CHARS)
    piece = F.substring(text, (F.pmod(F.xxhash64(text), F.length(text) - n + 1) + 1).cast("int"), n)
    from_letter = F.substring(text, F.length(F.split(text, LETTER, 2)[0]) + 1, n)
    d = docs.select("doc_id", F.col("text").cast("string"), "lang").filter(
        ~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & text.rlike(LETTER))
    d = d.select("doc_id", "lang", F.xxhash64(text).alias("_hash"), F.when(F.length(text) <= n, text)
                 .when(piece.rlike(LETTER), piece).otherwise(from_letter).alias("text"))
    order = Window.partitionBy("lang").orderBy("_hash", "doc_id")
    rows = (d.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= SAMPLE_DOCS)
            .select("lang", "_n", "text").collect())
    by: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["_n"])):
        by.setdefault(r["lang"], []).append(r["text"])
    return tuple((k, tuple(v)) for k, v in sorted(by.items()))


def _apply(rows: DataFrame, samples: tuple, keep: bool = False) -> DataFrame:
    """Rows (row, held_out, text) with their predictions, and the text if it is to be kept."""
    schema = T.StructType([rows.schema["row"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           *[T.StructField("text", T.StringType())] * keep])
    return rows.mapInArrow(_predict(samples, keep), schema)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``und`` (score 0) if the text is null, has no letter, or nothing could be
    learned; equal costs go to the language that comes first by name. A row
    without doc_id is not held out and not learned from. Texts are parsed whole;
    repeated rows each give a row; an empty table gives none; columns other than
    doc_id, text and lang are not read, lang only to learn."""
    return _apply(docs.select(F.col("doc_id").alias("row"), held_out().alias("held_out"),
                              F.col("text").cast("string")), learn_samples(docs)).withColumnRenamed("row", "doc_id")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language can't be told (``und``: the text is
    null or holds no letter, or nothing could be learned); ``lang`` of those kept is the
    predicted language, whatever it was. Other columns as they came, texts too (as a string);
    repeated rows stay; an empty table gives none. The text goes to the workers once."""
    rest = [c for c in docs.columns if c not in ("text", "lang")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.lit(False).alias("held_out"),
                       F.col("text").cast("string"))
    found = _apply(rows, learn_samples(docs), keep=True).filter(F.col("lang_pred") != UNKNOWN)
    own = {"text": F.col("text"), "lang": F.col("lang_pred").alias("lang")}
    return found.select(*[own.get(c, F.col(f"row.`{c}`")) for c in docs.columns])
