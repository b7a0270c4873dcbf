"""Merkle manifest, LM scoring and phrase collocations against brute force on small
fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""
from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from chartlake.llm import collocations, lm, merkle

# extra columns that carry the names the operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, idx long, "
          "uid long, phrase string, f long, _part int, row string")


def rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 5))) for _ in range(60)]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for _ in range(n))

    texts = [None, "", " \t\n", "A B a b A b.a b", "Ab\x0bCd\x0cEf\rgh", "é É", prose(4000), prose(1), "x\x85y z . .. !"]
    texts += [prose(rng.randint(1, 80)) + " kappa  Lambda MU nu " for _ in range(80)]
    texts += ["one two three"] * 3
    out = [(i, t, ["de", "en", "en", None, "z é"][i % 5], "s" if i % 4 else None, len(t) if t and i % 3 else None,
            "k", 1, 2, "p", 3, 4, "r") for i, t in enumerate(texts)]
    lonely = (500, "Only", "aa", "s", 4, *out[0][5:])
    no_id = (None, "No Id", "en", "s", 5, *out[0][5:])
    return [*out, out[9], out[9], lonely, no_id]


@pytest.fixture(scope="module")
def table():
    return rows()


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame(table, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


# -- Merkle manifest -----------------------------------------------------------------
def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(nodes):
    """Root, and every node's siblings per level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            a = p - p % 8
            paths[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + 8])))
        nodes, at = [digest(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [p // 8 for p in at]
    return nodes[0], paths


def plain_manifest(table):
    langs: dict = {}
    for r in table:
        langs.setdefault(r[2], []).append(r[:5])
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for k in order:
        langs[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[k] = plain_tree([plain_leaf(*r) for r in langs[k]])
    root, ups = plain_tree([trees[k][0] for k in order])
    out = []
    for k, up in zip(order, ups):
        for r, path in zip(langs[k], trees[k][1]):
            leaf = new = plain_leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                new = plain_leaf(r[0], ascii_lower(r[1]), *r[2:])
            folded, version = new, [new]
            for a, b in path + up:
                folded = digest(a, folded, b)
                version.append(folded)
            out.append((r[0], leaf, trees[k][0], root, digest(*[a + b for a, b in path + up]), folded, folded == root,
                        version if new != leaf else []))
    return out


@pytest.mark.parametrize("height", [1, 3])
def test_merkle_manifest(docs, table, height):
    found = merkle.manifest(docs, merkle.tampered(), height).collect()      # blocks of 8 leaves have upper levels here
    assert sorted(map(tuple, found), key=repr) == sorted(plain_manifest(table), key=repr)
    assert len({r.root for r in found}) == 1 and {r.verified for r in found} == {True, False}
    assert all(bool(r.version) != r.verified for r in found)


def test_merkle_untouched_one_row_and_empty(docs, none):
    assert all(r.verified for r in merkle.manifest(docs).collect())
    one = merkle.manifest(docs.filter("doc_id = 500")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha256(b"").hexdigest()
    assert merkle.manifest(none, merkle.tampered()).collect() == []


def test_copied_path_shares_the_rest():
    leaves = [digest(str(i)) for i in range(512)]
    levels = merkle.block_tree(leaves, False)
    assert [len(x) for x in levels] == [512, 64, 8, 1]
    copied = merkle.copy_path(digest("new"), merkle._siblings(levels, 77))
    changed = merkle.block_tree([*leaves[:77], digest("new"), *leaves[78:]], False)
    assert copied == [level[77 // 8 ** i] for i, level in enumerate(changed)]
    assert sum(a != b for x, y in zip(levels, changed) for a, b in zip(x, y)) == len(copied)


# -- collocations --------------------------------------------------------------------
def plain_collocations(table, top, least):
    f: dict = {}
    for r in table:
        c = f.setdefault("und" if r[2] is None else r[2], Counter())
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(r[1] or "")):
            w = re.findall("[^ \t]+", piece)
            c.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n, kept = sum(v for k, v in c.items() if len(k) == 1), []
        cand = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        for p, a in cand.items():
            if any(v >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, v in cand.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((score, a, " ".join(p), l, r))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(kept[:top])]
    return sorted(out)


@pytest.mark.parametrize("top, least, wave", [(2000, 2, 64), (7, 2, 2)])
def test_collocations(docs, table, monkeypatch, top, least, wave):
    monkeypatch.setattr(collocations, "FIRST_WAVE", wave)  # few words a wave: rests and longer phrases are counted beside
    found = collocations.collocations(docs, top, least)
    assert found.columns == collocations.COLUMNS
    assert sorted(map(tuple, found.collect())) == plain_collocations(table, top, least)


def test_collocations_stop_early(docs, table, monkeypatch):
    """Words whose bound is below the language's last score are never expanded."""
    monkeypatch.setattr(collocations, "FIRST_WAVE", 2)
    seen = []
    expand = collocations._expand

    def spy(texts, wave, *rest):
        seen.extend((r.lang, r.phrase) for r in wave.collect())
        return expand(texts, wave, *rest)

    monkeypatch.setattr(collocations, "_expand", spy)
    assert sorted(map(tuple, collocations.collocations(docs, 1, 4).collect())) == plain_collocations(table, 1, 4)
    words = Counter((r[2] or "und", w) for r in table for p in re.split("[.,;:!?\n-\r]", ascii_lower(r[1] or "")) for w in re.findall("[^ \t]+", p))
    assert 0 < len(seen) == len(set(seen)) < sum(v >= 4 for v in words.values())


def test_collocations_empty_full_filter_and_long_texts(spark, docs, table, none, monkeypatch):
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(docs.filter("doc_id < 3")).collect() == []
    monkeypatch.setattr(collocations, "MOST_BITS", 64)     # a full filter lets everything through
    assert sorted(map(tuple, collocations.collocations(docs, 7, 2).collect())) == plain_collocations(table, 7, 2)
    monkeypatch.setattr(collocations, "CHUNK", 50)
    parts = list(collocations.pieces(b"Ab cd, ef " * 40))
    assert len(parts) > 3 and b" . ".join(parts).split() == b"ab cd . ef ".split() * 40


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counts = spark.createDataFrame([("x", "a", 10 ** 9), ("x", "b", big - 1), ("x", "a b", 10 ** 9 - 7)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("x", 10 ** 14)], "lang string, n long")
    r = collocations._scored(counts.filter("phrase = 'a b'"), counts, totals).first()
    assert r.score == 1000 * (10 ** 9 - 7) * 10 ** 14 // (10 ** 9 * (big - 1))


# -- LM scoring ----------------------------------------------------------------------
def plain_base(table):
    def toks(t):
        return [w for w in re.split("[ \t-\r]+", ascii_lower(t or "")) if w] + [" "]

    def out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    c = Counter(w for r in table if not out(r[0]) for w in toks(r[1]))
    n, v = sum(c.values()), len(c)
    return sorted(((r[0], out(r[0]), len(toks(r[1])), sum(c[w] > 0 for w in toks(r[1])), n,
                    sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in toks(r[1]))) for r in table), key=repr)


@pytest.mark.parametrize("head", [lm.HEAD, 20])
def test_lm_base(docs, table, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)                  # words outside the head come by the join
    found = sorted((tuple(r)[:6] for r in lm.score_documents(docs).collect()), key=repr)
    want = plain_base(table)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in found], [r[5] for r in want])


def test_lm_empty_and_untrained(spark, docs, none):
    assert lm.score_documents(none).collect() == []
    r = lm.score_documents(docs.filter(lm.held_out())).first()
    assert r.train_tokens == r.n_known == 0 and r.base_score == 0 and abs(r.score) < 1e-3


def chain(spark, n):
    """Texts in which the next word hangs on the last: a model that reads it does far better."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    after = {w: rng.sample(words, 3) for w in words}
    out = []
    for i in range(n):
        w, text = rng.choice(words), []
        for _ in range(60):
            text.append(w)
            w = rng.choice(after[w]) if rng.random() < 0.9 else rng.choice(words)
        out.append((i, " ".join(text)))
    return spark.createDataFrame(out, "doc_id long, text string").repartition(4)


def test_lm_learns_on_held_out_documents(spark):
    found = lm.score_documents(chain(spark, 3000)).filter("held_out").collect()
    tokens = sum(r.n_tokens for r in found)
    base, model = (sum(r[k] for r in found) / tokens for k in ("base_score", "score"))
    assert -2.4 < base < -2.2 and model > base + 0.5


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    n = lm.VOCABULARY - 5                                  # the vocabulary isn't full
    m = lm.Model.of_counts(rng.integers(1, 50, n).astype(float), 7.0)
    m.class_rows += rng.normal(0, 0.3, m.class_rows.shape).astype(np.float32)
    m.member_rows += rng.normal(0, 0.3, m.member_rows.shape).astype(np.float32)
    every = np.append(np.arange(n), lm.VOCABULARY)
    texts = [np.array([5, 9, w], "<u2") for w in every]
    ids, values = lm.Model.features(texts)
    p = np.exp(m.log_probability(ids, values).reshape(-1, 3))
    assert np.allclose(p[:, :2], p[0, :2]) and abs(p[:, 2].sum() - 1) < 1e-3


def test_lm_step_is_the_gradient():
    """A step moves the weights against the numeric gradient of the loss."""
    rng = np.random.default_rng(4)
    m = lm.Model.of_counts(rng.integers(1, 9, lm.VOCABULARY).astype(float), 3.0)
    ids, values = lm.Model.features([rng.integers(0, 40, 50).astype("<u2"), np.array([1024, 3], "<u2")])
    of_class, of_member = m.rows_of(ids, values)
    table = m.class_rows, m.member_rows
    before = [t.copy() for t in table]
    m.step(ids, values, (np.zeros(lm.CLASS_ROWS), np.zeros(lm.MEMBER_ROWS)))
    moved = [t - b for t, b in zip(table, before)]
    for t, b in zip(table, before):
        t[:] = b
    for t, d, r in ((0, moved[0], of_class[0, 7]), (1, moved[1], of_member[0, 7])):
        col, eps, n = int(np.abs(d[r]).argmax()), 0.01, ((of_class, of_member[:, ids < lm.VOCABULARY])[t] == r).sum()
        table[t][r, col] += eps
        up = -m.log_probability(ids, values).sum()
        table[t][r, col] -= 2 * eps
        down = -m.log_probability(ids, values).sum()
        table[t][r, col] += eps
        assert abs(d[r, col] + lm.RATE / n * (up - down) / (2 * eps)) < 2e-3
