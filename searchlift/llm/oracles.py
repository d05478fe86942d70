"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

_WORDS = "[x FOR x IN regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+') IF x <> '']"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _shingles(table: str, key: str) -> str:
    """Distinct runs of five words, or the whole of a shorter text."""
    return f"""
  SELECT DISTINCT {key}, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT {key}, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i
        FROM (SELECT {key}, {_WORDS.format(text=_LOWER)} AS ws FROM {table}) WHERE len(ws) > 0)"""


OP7 = f"""
WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1)
SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n
"""

_STOP = (
    "the of and to in that is for it as was with be by on not this are from or have an they which you were all "
    "der die das und ist nicht ein eine zu den mit von für auf im dem des sich als auch werden "
    "le la les et de un une est que qui dans pour pas sur au avec ce il par plus "
    "el los las y del en con para su al lo como más o no"
)
_STOP_LIST = ", ".join(f"'{w}', '{w[0].upper()}{w[1:]}'" for w in _STOP.split())

OP9 = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
runs AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS run FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM runs GROUP BY doc_id, run HAVING count(*) >= 2),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
full_lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
    sum(CASE WHEN substr(ltrim(line, ' '), 1, 1) IN ('-', '*', '•') THEN 1 ELSE 0 END) AS bullets
  FROM lines WHERE translate(line, {_BLANK}, '') <> '' GROUP BY 1),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(translate(t, {_BLANK}, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words,
    coalesce(l.n, 0) AS n_lines, coalesce(l.bullets, 0) AS bullets, len(list_intersect(ws, [{_STOP_LIST}])) AS stops
  FROM w LEFT JOIN full_lines l USING (doc_id) LEFT JOIN again a USING (doc_id)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 3 * n_words AND word_chars <= 10 * n_words AND 10 * n_symbols <= n_words AND stops >= 2
    AND 2 * n_dup_lines <= n_lines AND 10 * bullets <= 9 * n_lines AS kept
FROM j
"""

OP12 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
runs AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS run
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first FROM runs) WHERE doc_id > first),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM late, range(0, 13) r(k) GROUP BY 1),
kept AS (SELECT doc_id, len(ws) AS n, coalesce(len(places), 0) AS n_gone,
    CASE WHEN places IS NULL THEN ws ELSE [x[1] FOR x IN list_zip(ws, range(1, len(ws) + 1)) IF NOT list_contains(places, x[2])] END AS rest
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_gone AS BIGINT) AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
"""

OP13 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

ORACLES = {"op7_decontamination": OP7, "op9_quality_rules": OP9, "op12_substring_dedup": OP12, "op13_hard_negatives": OP13}
