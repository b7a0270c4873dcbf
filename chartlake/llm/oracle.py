"""DuckDB SQL for the rows of those queries that SQL can express."""
from __future__ import annotations

LEVELS = 8            # levels of a language's tree that the SQL goes up: 8^8 documents
LANGUAGE_LEVELS = 3


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _climb(level: int) -> str:
    """Nodes of the next level: a key's only node stays, runs of eight get a parent."""
    return f"""
n{level + 1} AS (SELECT key, pos // 8 AS pos,
                        CASE WHEN any_value(cnt) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node
                 FROM (SELECT *, count(*) OVER (PARTITION BY key) AS cnt FROM n{level}) GROUP BY key, pos // 8),
f{level + 1} AS (SELECT rid, any_value(key) AS key, any_value(place) // 8 AS place, any_value(proof) || coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos <> place), '') AS proof,
                        CASE WHEN any_value(cnt) > 1 THEN sha256(string_agg(CASE WHEN pos = place THEN folded ELSE node END, '' ORDER BY pos)) ELSE any_value(folded) END AS folded
                 FROM f{level} JOIN (SELECT *, count(*) OVER (PARTITION BY key) AS cnt FROM n{level}) USING (key)
                 WHERE pos // 8 = place // 8 GROUP BY rid)"""


def _merkle() -> str:
    crc = ("list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c))), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))")
    top = LEVELS
    levels = ",".join(_climb(i) for i in range(top))
    langs = ",".join(_climb(i) for i in range(top + 1, top + 1 + LANGUAGE_LEVELS))
    end = top + 1 + LANGUAGE_LEVELS
    return f"""
WITH d AS (SELECT *, coalesce('=' || lang, '') AS key, {_leaf('text')} AS leaf,
                  CASE WHEN text IS NOT NULL AND doc_id IS NOT NULL AND xor({crc}, 4294967295) % 3 = 0
                       THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                       ELSE {_leaf('text')} END AS changed FROM documents),
p AS (SELECT *, row_number() OVER () AS rid,
             row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
n0 AS (SELECT key, pos, leaf AS node FROM p),
f0 AS (SELECT rid, key, pos AS place, '' AS proof, changed AS folded FROM p),{levels},
s AS (SELECT key, node AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos FROM n{top}),
n{top + 1} AS (SELECT '' AS key, pos, subroot AS node FROM s),
f{top + 1} AS (SELECT rid, '' AS key, s.pos AS place, proof, folded FROM f{top} JOIN s USING (key)),{langs}
SELECT doc_id, leaf, subroot, n{end}.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = n{end}.node AS verified
FROM f{end} JOIN p USING (rid) JOIN s ON s.key = p.key, n{end}"""


# Phrases of up to five words are counted in full; the operator's bounds only save work.
COLLOCATIONS = """
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM piece),
g AS (SELECT lang, size, unnest(list_transform(range(1, greatest(len(words) - size + 2, 1)), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
      FROM w, range(1, 6) t(size)),
c AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING f >= 100 OR size = 1),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM c WHERE size = 1 GROUP BY lang),
k AS (SELECT *, string_split(phrase, ' ') AS words FROM c WHERE size > 1),
parts AS (SELECT lang, phrase, f AS a, j, array_to_string(words[1:j], ' ') AS first, array_to_string(words[j + 1:size], ' ') AS rest
          FROM k, range(1, 5) t(j) WHERE j < size),
cut AS (SELECT p.lang, p.phrase, a, n, j, l.f AS l, r.f AS r, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
        FROM parts p JOIN n USING (lang) JOIN c l ON l.lang = p.lang AND l.phrase = first JOIN c r ON r.lang = p.lang AND r.phrase = rest),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT DISTINCT lang, shorter AS phrase, f FROM (
             SELECT lang, f, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS shorter
             FROM k, range(2, 5) t(m) WHERE m < size)),
kept AS (SELECT lang, phrase, a, l, r, n, score FROM best b
         WHERE NOT EXISTS (FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.f * 100 >= b.a * 100))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000"""


ORACLE_SQL: dict[str, str] = {"op11_merkle_manifest": _merkle(), "op13_collocations": COLLOCATIONS}
