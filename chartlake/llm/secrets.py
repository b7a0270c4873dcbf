"""Secret scan: fixed patterns plus sliding-window Shannon entropy.

Entropy spans come from candidate strings (runs of key characters): of a URL each path
segment, name, value and what stands before its ``@`` is a candidate by itself and the host
none; what the patterns found is cut out, and the rest is judged. A window
slides over each, without the names, values and fillings that mark samples, and over
the runs of hex digits between its separators; the symbol counts and the sum of c*log2(c) are updated by the
character that enters and the one that leaves, so a string of n characters costs
n steps. Windows over the limit of the string's character class are joined to a
span. An allow-list keeps words, identifiers and well-known samples out.
"""
from __future__ import annotations

import hashlib
import re
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
# bits per character over which a window counts, by character class
LIMITS = {"entropy_hex": 3.0, "entropy_base64": 3.8}
KINDS = ("assign", "access", "hex", *LIMITS)

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
_HEXADECIMAL = re.compile(r"[0-9A-Fa-f]+\Z")
ALLOWED = tuple(re.compile(p) for p in (
    r"[0-9_=/+-]*\Z",                                        # no letter: a number
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z",  # UUID
    r"[A-Za-z]+([/_-][A-Za-z]*[0-9]{0,4})+\Z",               # path or snake_case name
))
_URL = re.compile(r"://[^\x00-\x20\x7F\"'<>`()\[\]{}|\\^,;]+")      # a URL from behind its scheme on
_SEGMENT = re.compile(r"[^/?#&:@.]+")
_LETTERS = re.compile(r"[^0-9]*\Z")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")        # a part of a camelCase or snake_case name
NAME_PART = 3.5      # letters a part, on average, from which a run of letters is names and not a key
_SAMPLE = re.compile(r"(example|sample|placeholder|changeme)|x{4,}", re.IGNORECASE)
_HEX_RUN = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{%d,}(?![0-9A-Za-z])" % WINDOW)
_CLOG = [0.0, 0.0] + [c * log2(c) for c in range(2, WINDOW + 1)]     # at most WINDOW of one character


def entropy_spans(s: str, limit: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal unions of windows whose entropy is over ``limit``."""
    counts: dict[str, int] = {}
    total, spans, need = 0.0, [], log2(window) - limit
    for i, ch in enumerate(s):
        if i >= window:                                      # one leaves, then one enters
            out = s[i - window]
            c = counts[out]
            counts[out] = c - 1
            total += _CLOG[c - 1] - _CLOG[c]
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += _CLOG[c + 1] - _CLOG[c]
        if i >= window - 1 and total / window < need:        # H = log2(w) - total/w
            a = i - window + 1
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((a, i + 1))
    return spans


def samples(s: str) -> list[tuple[int, int]]:
    """(start, end) of the names and values that hold a sample's word, and of filling."""
    out: list[tuple[int, int]] = []
    for m in _SAMPLE.finditer(s):
        if not out or m.end() > out[-1][1]:
            a, b = m.span()
            if m.group(1):
                a, b = s.rfind("=", 0, a) + 1, s.find("=", b) % (len(s) + 1)
            out.append((a if not out else max(a, out[-1][1]), b))
    return out


def allowed(s: str) -> bool:
    """Whether a piece is a well-known harmless form. A piece without a digit is harmless if
    it is of one case, or if its parts, as camelCase divides it, are as long as words
    (random letters of both cases change case at every second one)."""
    if _LETTERS.match(s):
        if s == s.lower() or s == s.upper():
            return True
        parts = _NAME.findall(s)
        return sum(map(len, parts)) >= NAME_PART * len(parts)
    return any(p.match(s) for p in ALLOWED)


def url_pieces(url: str) -> list[tuple[int, int]]:
    """The parts of a URL that are judged, each by itself: what stands before an ``@``, the
    path's segments, and names and values behind it; not the host."""
    start = 3
    end = min([i for c in "/?#" if (i := url.find(c, start)) >= 0], default=len(url))
    at = url.rfind("@", start, end)
    judged = [(start, at)] if at >= 0 else []
    judged.append((end, len(url)))
    return [(m.start(), m.end()) for a, b in judged for m in _SEGMENT.finditer(url, a, b)]


def merged(spans) -> list[tuple[int, int]]:
    """Spans that overlap or touch, joined; by start."""
    out: list[tuple[int, int]] = []
    for a, b, _ in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces(text: str, base) -> list[tuple[int, int]]:
    """The stretches of ``text`` that candidates are looked for in: URLs' judged parts and the
    text between URLs, without the stretches ``base`` (by start, apart)."""
    found, at = [], 0
    for m in _URL.finditer(text):
        found.append((at, m.start()))
        found += [(m.start() + a, m.start() + b) for a, b in url_pieces(m.group())]
        at = m.end()
    found.append((at, len(text)))
    out, i = [], 0
    for a, b in found:
        while i < len(base) and base[i][1] <= a:
            i += 1
        while i < len(base) and base[i][0] < b:
            x, y = base[i]
            if x > a:
                out.append((a, x))
            a = max(a, y)
            if y > b:                                        # goes on into the next piece
                break
            i += 1
        if a < b:
            out.append((a, b))
    return out


def candidate_spans(s: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the entropy spans of a candidate. A span over the
    base64 limit that has no window outside the hex runs' spans is not named again."""
    out, at = [], 0
    for a, b in [*samples(s), (len(s), len(s))]:
        part = s[at:a]
        if len(part) >= WINDOW and not allowed(part):
            runs = [(m.start() + x, m.start() + y) for m in _HEX_RUN.finditer(part)
                    if not allowed(m.group())
                    for x, y in entropy_spans(m.group(), LIMITS["entropy_hex"])]
            out += [(at + x, at + y, 3) for x, y in runs]
            if not _HEXADECIMAL.match(part):
                out += [(at + x, at + y, 4) for x, y in entropy_spans(part, LIMITS["entropy_base64"])
                        if not (inside := [r for r in runs if r[0] < y and x < r[1]])
                        or y - x - sum(min(y, d) - max(x, c) for c, d in inside) >= WINDOW]
        at = b
    return out


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of one text, by start and then kind as in KINDS."""
    if not text:
        return []
    found = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    for a, b in pieces(text, merged(found)):
        for m in _CANDIDATE.finditer(text, a, b):
            found += [(m.start() + x, m.start() + y, k) for x, y, k in candidate_spans(m.group())]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def join_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scan(batches):
    for b in batches:
        out = []
        for t in b.column(1):
            spans = scan(t.as_py())
            base = [s for s in spans if s[2] in KINDS[:3]]
            n = [sum(s[2] == k for s in base) for k in KINDS[:3]]
            out.append((*n, hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans),
                        [{"start": x, "end": y, "kind": k} for x, y, k in spans]))
        cols = list(zip(*out)) if out else [()] * 6
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [span]
        yield pa.RecordBatch.from_arrays(
            [b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the pattern spans, all
    spans as text and as an array ``found`` of (start, end, kind), in code points.

    A null text counts as empty. Texts of any length are read whole; repeated
    rows each give a row; an empty table gives none; other columns are not read."""
    return docs.select("doc_id", F.col("text")).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
               "spans string, found array<struct<start: long, end: long, kind: string>>")
