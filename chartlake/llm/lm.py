"""Language-model scores by a hashed maximum-entropy model.

The model gives the next token's class, then the token within its class, each by a softmax
over weights of hashed history features: the last word, the last two, and the second last
alone (a skip). Classes are stretches of the vocabulary in order of frequency; the
words outside the vocabulary are one class more, inside which a word has its smoothed share
of the counts, so every text has a probability.

Training is by distributed gradient updates. Each round takes the next part of the training
documents; every task goes over its share in mini-batches from the round's weights, and the
weights move by the tasks' changes, averaged for each row by how often the task has used it.
All training documents are used once, whatever their number; the weights' size is fixed.
"""
from __future__ import annotations

from collections import Counter
from itertools import repeat
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 16                # most frequent words, at most, whose counts go to every task
CLASSES, MEMBERS = 32, 32     # the vocabulary: CLASSES * MEMBERS words
VOCABULARY = CLASSES * MEMBERS
CLASS_ROWS, MEMBER_ROWS = 1 << 12, 1 << 13
FEATURES = 3
ROUNDS = 3                    # parts of the training documents
BATCH = 8192                  # tokens of a gradient step
TOGETHER = 1 << 16            # tokens whose features are made together
RATE = 0.5
END = b" "                    # never a word
START = VOCABULARY + 1        # before the first token

_LN10 = np.log(10.0)
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- tokens ----------------------------------------------------------------------
def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _count_words(batches):
    for b in batches:
        counts: Counter = Counter()
        for text in b.column(0).cast(pa.binary()):
            counts.update(tokens(text.as_py() or b""))
        if b.num_rows:
            counts[END] = b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         names=["word", "c"])


def _encode(head):
    """Per document: tokens as vocabulary numbers (VOCABULARY if outside), sums over the
    words in the head, and the words outside it with their counts."""
    def run(batches):
        words, counts = head.value
        number = {w: i for i, w in enumerate(words)}
        logs = np.log10(counts + 1.0)
        for b in batches:
            out = []
            for text in b.column(2).cast(pa.binary()):
                ws = tokens(text.as_py() or b"")
                ws.append(END)
                ids = np.fromiter(map(number.get, ws, repeat(-1)), np.int32, len(ws))
                rest = Counter(ws[i] for i in np.flatnonzero(ids < 0).tolist())
                seen = ids[ids >= 0]
                outside = (ids < 0) | (ids >= VOCABULARY)
                out.append((len(ws), len(seen), int(outside.sum()), logs[seen].sum(), logs[seen[seen >= VOCABULARY]].sum(),
                            np.where(outside, VOCABULARY, ids).astype("<u2").tobytes(), list(rest), list(rest.values())))
            kinds = [*[pa.int64()] * 3, *[pa.float64()] * 2, pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                                             names=["row", "held_out", *_ENCODED])
    return run


_ENCODED = ["n_tokens", "n_head", "n_outside", "head_log", "outside_log", "ids", "rest", "rest_n"]


# -- the model -------------------------------------------------------------------
def _hash(kind: int, a: np.ndarray, rows: int) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(16) + np.uint64(kind)) * _MIX
    return ((h ^ (h >> np.uint64(31))) % np.uint64(rows)).astype(np.int32)


class Model:
    """Weights: ``bias`` of classes and members, and rows of both by hashed features."""

    def __init__(self, class_bias: np.ndarray, member_bias: np.ndarray, class_rows: np.ndarray | None = None,
                 member_rows: np.ndarray | None = None):
        self.class_bias, self.member_bias = class_bias, member_bias      # (CLASSES + 1), (CLASSES, MEMBERS)
        self.rooms: dict = {}
        self.class_rows = np.zeros((CLASS_ROWS, CLASSES + 1), np.float32) if class_rows is None else class_rows
        self.member_rows = np.zeros((MEMBER_ROWS, MEMBERS), np.float32) if member_rows is None else member_rows

    @classmethod
    def of_counts(cls, counts: np.ndarray, outside: float) -> Model:
        """The model that knows the vocabulary's ``counts`` only."""
        c = np.zeros(VOCABULARY)
        c[:len(counts)] = counts
        present = np.arange(VOCABULARY).reshape(CLASSES, MEMBERS) < len(counts)
        c = c.reshape(CLASSES, MEMBERS)
        mass = np.append(c.sum(1), outside)
        with np.errstate(divide="ignore"):
            return cls(np.where(mass > 0, np.log(np.maximum(mass, 1e-9)), -30.0).astype(np.float32),
                       np.where(present, np.log(np.maximum(c, 1e-9)), -30.0).astype(np.float32))

    @staticmethod
    def features(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, (feature, token) values) of whole texts."""
        ids = np.concatenate(texts).astype(np.int64)
        ends = np.cumsum([len(t) for t in texts])
        place = np.arange(len(ids)) - np.repeat(ends - [len(t) for t in texts], [len(t) for t in texts])
        last = []
        for back in (1, 2):
            prior = np.full(len(ids), START, np.int64)
            prior[back:] = ids[:-back] if back < len(ids) else ids[:0]
            last.append(np.where(place >= back, prior, START))
        return ids, np.stack([last[0], last[0] * (START + 1) + last[1], last[1]])

    @staticmethod
    def rows_of(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature, token) rows of the class weights and of the member weights."""
        of_class = np.stack([_hash(k, v, CLASS_ROWS) for k, v in enumerate(values)])
        group = np.minimum(ids // MEMBERS, CLASSES - 1)
        of_member = np.stack([_hash(k + FEATURES, v * CLASSES + group, MEMBER_ROWS) for k, v in enumerate(values)])
        return of_class, of_member

    def _room(self, name: str, n: int, width: int, kind=np.float32) -> np.ndarray:
        """A kept array: fresh ones of this size would be mapped and cleared for each batch."""
        if (name, width) not in self.rooms:
            self.rooms[name, width] = np.empty((BATCH, width), kind)
        return self.rooms[name, width][:n]

    def _take(self, name: str, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of the table's rows."""
        out, more = (self._room(x, rows.shape[1], table.shape[1]) for x in (name, "more"))
        np.take(table, rows[0], axis=0, out=out, mode="clip")
        for r in rows[1:]:
            np.take(table, r, axis=0, out=more, mode="clip")
            out += more
        return out

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        """Makes ``z`` probabilities; the logarithm of their sum before."""
        top = z.max(1, keepdims=True)
        z -= top
        np.exp(z, out=z)
        s = (z @ np.ones(z.shape[1], np.float32))[:, None]
        z /= s
        return (np.log(s) + top)[:, 0]

    def forward(self, ids: np.ndarray, of_class: np.ndarray, of_member: np.ndarray):
        z = self._take("class", self.class_rows, of_class)
        z += self.class_bias
        inside = np.flatnonzero(ids < VOCABULARY)
        y = self._take("member", self.member_rows, of_member[:, inside])
        y += np.take(self.member_bias, ids[inside] // MEMBERS, axis=0,
                     out=self._room("more", len(inside), MEMBERS), mode="clip")
        return z, inside, y

    def log_probability(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Natural logarithm of each token's probability; that of the class alone for
        tokens outside the vocabulary."""
        out = np.empty(len(ids))
        for at in range(0, len(ids), BATCH):
            own = slice(at, at + BATCH)
            w = ids[own]
            z, inside, y = self.forward(w, *self.rows_of(w, values[:, own]))
            p = z[np.arange(len(w)), np.minimum(w // MEMBERS, CLASSES)]
            p -= self._softmax(z)
            of_member = y[np.arange(len(inside)), w[inside] % MEMBERS]
            p[inside] += of_member - self._softmax(y)
            out[own] = p
        return out

    def step(self, ids: np.ndarray, values: np.ndarray, seen: tuple[np.ndarray, np.ndarray]) -> None:
        """One gradient step on tokens; a row's rate falls with the times it was used."""
        of_class, of_member = self.rows_of(ids, values)
        z, inside, y = self.forward(ids, of_class, of_member)
        for g, target, weights, n, rows in (
                (z, np.minimum(ids // MEMBERS, CLASSES), self.class_rows, seen[0], of_class),
                (y, ids[inside] % MEMBERS, self.member_rows, seen[1], of_member[:, inside])):
            self._softmax(g)
            g[np.arange(len(g)), target] -= 1
            self._descend(weights, n, rows, g)

    def _descend(self, weights: np.ndarray, seen: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        length, width = gradient.shape
        total, n = np.zeros(weights.size), np.zeros(len(weights))
        values = self._room("values", length, width, np.float64)
        entries = self._room("entries", length, width, np.int64)
        np.copyto(values, gradient)
        for r in rows:
            np.add((r.astype(np.int64) * width)[:, None], np.arange(width), out=entries)
            total += np.bincount(entries.ravel(), values.ravel(), weights.size)
            n += np.bincount(r, minlength=len(weights))
        own = np.flatnonzero(n)
        n = n[own]
        seen[own] += n
        weights[own] -= (RATE / np.sqrt(seen[own] * n))[:, None] * total.reshape(weights.shape)[own]


def _texts(batches, column: int = 0):
    """Groups of whole texts of about TOGETHER tokens."""
    group, held = [], 0
    for b in batches:
        for x in b.column(column):
            ids = np.frombuffer(x.as_py(), "<u2")
            group.append(ids)
            held += len(ids)
            if held >= TOGETHER:
                yield group
                group, held = [], 0
    if group:
        yield group


SLAB = 256                    # rows of weights that travel together


def _train(model):
    def run(batches):
        own = Model(*[x.copy() for x in model.value])
        seen = np.zeros(CLASS_ROWS), np.zeros(MEMBER_ROWS)
        for group in _texts(batches):
            ids, values = Model.features(group)
            for at in range(0, len(ids), BATCH):
                own.step(ids[at:at + BATCH], values[:, at:at + BATCH], seen)
        for table, (new, old, n) in enumerate(zip((own.class_rows, own.member_rows), model.value[2:], seen)):
            for at in range(0, len(n), SLAB):
                if n[at:at + SLAB].any():
                    change = (new[at:at + SLAB] - old[at:at + SLAB]) * n[at:at + SLAB, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([table]), pa.array([at]), pa.array([n[at:at + SLAB].astype("<f8").tobytes()]),
                         pa.array([change.astype("<f4").tobytes()])], names=["tab", "at", "n", "change"])
    return run


def _sum(batches):
    """Sums of each slab's changes; a task keeps one array for each slab."""
    held: dict = {}
    for b in batches:
        for table, at, n, change in zip(*[c.to_pylist() for c in b.columns]):
            n, change = np.frombuffer(n, "<f8"), np.frombuffer(change, "<f4").astype(np.float64)
            if (table, at) in held:
                held[table, at][0] += n
                held[table, at][1] += change
            else:
                held[table, at] = [n.copy(), change]
    for (table, at), (n, change) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([table]), pa.array([at]), pa.array([n.tobytes()]), pa.array([change.tobytes()])],
            names=["tab", "at", "n", "change"])


_CHANGE = "tab long, at long, n binary, change binary"


def train(encoded: DataFrame, model: Model) -> Model:
    """``model`` after ROUNDS parts of ``encoded`` (column ids, part)."""
    sc = encoded.sparkSession.sparkContext
    for part in range(ROUNDS):
        now = sc.broadcast((model.class_bias, model.member_bias, model.class_rows, model.member_rows))
        changes = (encoded.filter(F.col("part") == part).select("ids").mapInArrow(_train(now), _CHANGE)
                   .repartition("tab", "at").mapInArrow(_sum, _CHANGE))
        rows = [model.class_rows.copy(), model.member_rows.copy()]
        for r in changes.toLocalIterator():
            n = np.frombuffer(r.n, "<f8")
            change = np.frombuffer(r.change, "<f8").reshape(len(n), -1)
            rows[r.tab][r.at:r.at + len(n)] += (change / np.maximum(n, 1)[:, None]).astype(np.float32)
        model = Model(model.class_bias, model.member_bias, *rows)
    return model


def _score(model):
    def run(batches):
        own = Model(*model.value)
        for b in batches:
            texts = [np.frombuffer(x.as_py(), "<u2") for x in b.column(1)]
            scores = np.zeros(len(texts))
            at = 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and held < TOGETHER:
                    held += len(texts[to])
                    to += 1
                ids, values = Model.features(texts[at:to])
                sizes = [len(t) for t in texts[at:to]]
                p = own.log_probability(ids, values)
                scores[at:to] = np.add.reduceat(p, np.cumsum([0, *sizes[:-1]])) / _LN10
                at = to
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=["uid", "inside"])
    return run


# -- the operator ----------------------------------------------------------------
def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the text and its end).

    A null text is empty: its only token is the end. A row without doc_id isn't held out.
    Equal rows each count and each give a row. With nothing to learn from, N and V are 0
    and both scores are those of words never seen. An empty table gives none. Texts are
    read whole; columns other than doc_id and text are not read. Weights, and so scores,
    can differ in the last digits when the input is split into other tasks."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(F.col("doc_id")).alias("row"), held_out().alias("held_out"), F.col("text").cast("string"))
    counts = materialise(rows.filter("NOT held_out").select("text").mapInArrow(_count_words, "word binary, c long")
                         .groupBy("word").agg(F.sum("c").alias("c")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("c") * 16)             # words are taken from the most frequent on, by levels that fit whole
    least, room = None, HEAD
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    top = counts.filter((F.col("word") == F.lit(END)) | (level >= F.lit(least))).collect()
    top.sort(key=lambda r: (bytes(r.word) != END, -r.c, bytes(r.word)))       # the end is always in the vocabulary
    words, c = [bytes(r.word) for r in top], np.array([r.c for r in top], np.float64)
    outside = n - c[:VOCABULARY].sum()
    room = outside + v - min(len(words), VOCABULARY) + 1                      # counts of words outside, each and a new one plus 1
    head = spark.sparkContext.broadcast((words, c))
    encoded = materialise(
        rows.mapInArrow(_encode(head), "row struct<doc_id:" + docs.schema["doc_id"].dataType.simpleString() + ">, held_out boolean, "
                        "n_tokens long, n_head long, n_outside long, head_log double, outside_log double, ids binary, rest array<binary>, rest_n array<long>")
        .withColumns({"uid": F.monotonically_increasing_id(),
                      "part": F.pmod(F.xxhash64("ids"), F.lit(ROUNDS)).cast("int")}), "encoded")
    model = train(encoded.filter("NOT held_out"), Model.of_counts(c[:VOCABULARY], room))
    now = spark.sparkContext.broadcast((model.class_bias, model.member_bias, model.class_rows, model.member_rows))
    inside = encoded.select("uid", "ids").mapInArrow(_score(now), "uid long, inside double")
    rest = (encoded.select("uid", F.explode(F.arrays_zip("rest", "rest_n")).alias("x"))
            .select("uid", F.col("x.rest").alias("word"), F.col("x.rest_n").alias("k")))
    rest = (rest.join(counts, "word").groupBy("uid")
            .agg(F.sum("k").alias("rest_known"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("rest_log")))
    out = encoded.drop("ids", "rest", "rest_n", "part").join(inside, "uid").join(rest, "uid", "left")
    more = F.coalesce("rest_log", F.lit(0.0))
    return out.select(
        "row.doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("head_log") + more - F.col("n_tokens") * log10(n + v + 1)).alias("base_score"),
        (F.col("inside") + F.col("outside_log") + more - F.col("n_outside") * log10(room)).alias("score"))
