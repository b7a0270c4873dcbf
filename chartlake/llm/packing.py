"""Best-fit packing of tokenised documents with swap-based local search.

Piece lengths are small integers, so all of the corpus packs as a histogram: a
bin type is a multiset of lengths and the number of sequences filled like that.
Best-fit decreasing and the local search (moves, one-for-one and two-for-one
exchanges that raise the sum of squared fills, until a sequence is empty) work on
types; the histogram has at most 2,048 entries whatever the input. Pieces then
find their places by their number among the pieces of their length.
"""
from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_index, held, materialise

CAPACITY = 2048
END = 0                       # id after each document
CACHE = 200_000               # words of a generation; a worker keeps the ids of two
SLICE = 300_000               # characters tokenised at a time

_SAFE = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s\s")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for
    themselves, the others for the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids as little-endian 32-bit numbers. The byte-level pre-tokenizer always cuts
    before a single space between two other characters, so a text's ids are
    those of its parts, and parts that recur are looked up. New parts are merged by
    tiktoken from the same file's vocabulary (its ids are in the order of the merges),
    several times as fast as by the tokenizer itself; parts that hold one of its special
    tokens are left to the tokenizer."""

    def __init__(self, path: str):
        from public_tokenizers import PATTERN
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        byte = byte_letters()
        ranks = {bytes(byte[c] for c in t): i
                 for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t not in special}
        self.merger = Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(1 + max(ranks.values()), np.int64)          # bytes of each token
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = []
        for t in texts:
            if t[:1] == " " or t[-1:] == " " or _RUN.search(t):
                parts.append(_SAFE.split(t))
            else:
                parts.append(t.split(" "))
        if len(self.known) > CACHE:                      # words in use move on to the new generation
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new: set[str] = set()
        for p in parts:
            new.update(set(p[1:]).difference(known))     # a part's ids are those after a space
        fresh = []
        for x in new:
            if x in older:
                known[x] = older[x]
            else:
                fresh.append(x)
        known.update(zip(fresh, self.after_space(fresh)))
        get = known.__getitem__
        return [self.ids(p[0]) + b"".join(map(get, p[1:])) for p in parts]

    def after_space(self, words: list[str]) -> list[bytes]:
        """Ids of each word after a space. All are merged as one text, which is cut
        before every such space, and told apart by the bytes of their tokens."""
        text = "".join([" " + w for w in words])
        if not words or self.special.search(text):
            return [self.ids(" " + w) for w in words]
        ids = np.array(self.merger.encode_ordinary(text), np.uint32)
        last = np.cumsum(self.sizes[ids])
        sizes = map(len, words) if text.isascii() else (len(w.encode()) for w in words)
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(words)) + 1)
        to = np.searchsorted(last, ends) + 1
        if not np.array_equal(last[to - 1], ends):
            return [self.ids(" " + w) for w in words]
        raw, to = ids.astype("<u4").tobytes(), (4 * to).tolist()
        return [raw[a:b] for a, b in zip([0, *to], to)]

    def ids(self, part: str) -> bytes:
        if self.special.search(part):
            return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        return array("I", self.merger.encode_ordinary(part)).tobytes()


def _encoder(path: str) -> Encoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(("packing", path), lambda: Encoder(path))


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids (its end id included):
    all pieces are full but the first, which takes the rest."""
    n = len(ids) // 4
    ends = list(range(n % capacity or capacity, n + 1, capacity))
    return [(i, max(0, e - capacity) if i else 0, e - (max(0, e - capacity) if i else 0),
             zlib.crc32(ids[4 * (e - capacity if i else 0):4 * e])) for i, e in enumerate(ends)]


def _pieces(path: str, capacity: int):
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        enc = _encoder(path)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            at = 0
            while at < len(ids):
                part, size, first = [], 0, at
                while at < len(ids) and size < SLICE:
                    part.append(texts[at].as_py() or "")
                    size += len(part[-1])
                    at += 1
                rows = [(d, *p) for d, e in zip(ids[first:at], enc.encode(part)) for p in cut(e + end, capacity)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32())]
                    + [pa.array(c, pa.int64()) for c in cols[2:]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing over a histogram of lengths: bin type -> bins."""
    room: dict[int, dict[tuple, int]] = {}                   # free space -> types
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = min((r for r in room if r >= length), default=capacity)
            types = room.get(free)
            kind, bins = types.popitem() if types else ((), -(-left // (capacity // length)))
            if types is not None and not types:
                del room[free]
            fit = free // length
            full = min(bins, left // fit)
            rest = left - full * fit if full < bins else 0

            def put(k, n, r):
                if n:
                    t = room.setdefault(r, {})
                    t[k] = t.get(k, 0) + n
            put(kind + (length,) * fit, full, free - fit * length)
            if rest:
                put(kind + (length,) * rest, 1, free - rest * length)
            if kind:
                put(kind, bins - full - bool(rest), free)
            left -= full * fit + rest
    out: dict[tuple[int, ...], int] = {}
    for types in room.values():
        for k, n in types.items():
            out[k] = out.get(k, 0) + n
    return out


def local_search(types: dict[tuple[int, ...], int], capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    """Empty one underfull bin after the other, the emptiest first. A step moves a
    piece of it to a fuller bin, exchanges it for a shorter one there, or gives
    two for one (or one for two), so that the fuller bin gains: the sum of squared
    fills rises. Steps are kept when the bin can't be emptied, and the next type
    is tried. All the steps of a bin are repeated for as many bins as there are of
    the same types. Ends at the lower bound or when no underfull type has a step left."""
    types = dict(types)
    least = -(-sum(sum(k) * n for k, n in types.items()) // capacity)

    # Of each type one row for each length it can give back (none, one piece or two):
    # (number of the type, length, pieces), the first ``used`` rows. A type that
    # comes again gets a new number, so a bin that failed is compared with later ones.
    number: dict[tuple[int, ...], int] = {}
    kinds: list[tuple[int, ...]] = []
    rows, used = np.zeros((3, 1024), np.int64), 0
    there, size = np.zeros(1024, bool), np.zeros(1024, np.int64)

    def pairs(k):
        return {x + y: (x, y) for i, x in enumerate(k) for y in k[i + 1:]}

    def know(k):
        nonlocal rows, used, there, size
        number[k] = len(kinds)
        kinds.append(k)
        backs = [(0, 0), *((x, 1) for x in sorted(set(k))), *((x, 2) for x in sorted(pairs(k)))]
        if used + len(backs) > rows.shape[1]:
            rows = np.concatenate((rows[:, :used], np.zeros((3, used + len(backs)), np.int64)), axis=1)
        rows[:, used:used + len(backs)] = np.array([(number[k], *b) for b in backs]).T
        used += len(backs)
        if len(kinds) > len(there):
            there, size = np.concatenate((there, np.zeros_like(there))), np.concatenate((size, np.zeros_like(size)))
        size[number[k]] = sum(k)

    def put(k, n):
        if k not in number:
            know(k)
        types[k] = types.get(k, 0) + n
        there[number[k]] = types[k] > 0
        if not types[k]:
            del types[k], number[k]

    def ordered(k):
        return tuple(sorted(k, reverse=True))

    def less(k, *xs):
        k = list(k)
        for x in xs:
            k.remove(x)
        return tuple(k)

    def gain(donor, since=0):
        """The best step for the donor with the types numbered from ``since`` on:
        (gain, other, its new pieces, donor's)."""
        if since == len(kinds):
            return None
        low = np.searchsorted(rows[0, :used], since)
        best, fits = None, there & (size >= sum(donor)) & (size < capacity)
        kind, back, pieces = rows[:, low:used][:, fits[rows[0, low:used]]]
        free = capacity - size[kind]
        one = pieces < 2
        twos = pairs(donor)
        for given, parts in [*((x, (x,)) for x in sorted(set(donor))), *sorted(twos.items())]:
            g = given - back
            g[(g > free) | ~(one | (len(parts) == 1))] = 0
            i = int(g.argmax()) if len(g) else 0
            if len(g) and g[i] > 0 and (best is None or g[i] > best[0]):
                other = kinds[kind[i]]
                took = ((), (int(back[i]),), pairs(other).get(int(back[i])))[pieces[i]]
                best = (int(g[i]), other, less(other, *took) + parts, less(donor, *parts) + took)
        return best

    for k in types:
        know(k)
        there[number[k]] = True
    bins, failed = sum(types.values()), {}                       # failed: how many types one was compared with
    queue: list = []
    rose = True
    while bins > least:
        if not queue:
            if not rose:                                         # a round over all types without a step
                break
            queue = sorted((k for k in types if sum(k) < capacity), key=lambda k: (-sum(k), k))
            rose = False
            alive = there[rows[0, :used]]
            rows, used = rows[:, :used][:, alive], int(alive.sum())
        donor = queue.pop()
        if donor not in types:
            continue
        alone = types[donor] == 1                                # it is no other bin to itself
        there[number[donor]] = not alone
        step = gain(donor, failed.get((donor, alone), 0))
        there[number[donor]] = True
        if not step:
            failed[donor, alone] = len(kinds)
            continue
        rose = True
        put(donor, -1)
        change = {donor: -1}                                     # of the numbers of types, by one bin's steps
        while step:
            _, other, fuller, donor = step
            for k, n in ((other, -1), (ordered(fuller), 1)):
                put(k, n)
                change[k] = change.get(k, 0) + n
            step = gain(donor) if donor else None
        if donor:
            donor = ordered(donor)
            put(donor, 1)
            change[donor] = change.get(donor, 0) + 1
        saved = not donor
        bins -= saved
        more = min(types.get(k, 0) // -n for k, n in change.items() if n < 0)
        if saved:
            more = min(more, bins - least)
        for k, n in change.items():
            if n and more:
                put(k, n * more)
        bins -= saved * more
    return types


def slots(types: dict[tuple[int, ...], int]) -> dict[int, np.ndarray]:
    """length -> rows (first number, copies in a bin, first sequence, offset)."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for kind, bins in sorted(types.items(), reverse=True):
        offset = 0
        for length in sorted(set(kind), reverse=True):
            copies = kind.count(length)
            out.setdefault(length, []).append((taken.get(length, 0), copies, sequence, offset))
            taken[length] = taken.get(length, 0) + copies * bins
            offset += copies * length
        sequence += bins
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _place(table: dict[int, np.ndarray]):
    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                            for c in ("length", "_rank"))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                t = table[int(v)]
                row = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
                i = rank[at] - row[:, 0]
                seq[at] = row[:, 2] + i // row[:, 1]
                off[at] = row[:, 3] + i % row[:, 1] * v
            keep = [b.column(b.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(keep + [pa.array(seq), pa.array(off)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def default_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. The tokenizer file must be at the same path on every executor.

    A null text counts as empty: such documents are one piece, the end id alone.
    Repeated rows are packed each; an empty table gives none; other columns are
    not read. Documents over ``capacity`` tokens are cut, the first piece short."""
    path = vocabulary or default_vocabulary()
    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    ranked = gapless_index(pieces, "length", ["doc_id", "piece"], "_rank")
    ranked = materialise(ranked, "ranked-pieces")
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(local_search(best_fit(counts, capacity), capacity))    # at most `capacity` counts
    return ranked.mapInArrow(_place(table), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                            "sequence_id long, offset long")
