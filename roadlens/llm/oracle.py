"""DuckDB SQL of the queries that SQL can express."""

from roadlens.llm.common import UPPER

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_HITS = f"""
d AS (SELECT doc_id, {_WORDS} AS w FROM {{docs}}),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
hits AS (SELECT doc_id, i, n, win FROM
           (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM
             (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n))
         WHERE win IN (SELECT win FROM bw))"""

WINNOWING = f"""
WITH {_HITS.format(docs="documents")},
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
which AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits JOIN bw USING (win)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN which USING (doc_id)"""

_SPACE = r"[ \t\n\x0B\f\r]"
_NOSPACE = r"[^ \t\n\x0B\f\r]"
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"


def _constant(tokens: str) -> str:
    return f"len(list_filter({tokens}, lambda x: x <> '<*>'))"


_OUTSIDE = "t[:3 + s * j] || t[4 + s * (j + 1):]"
LINE_TEMPLATES = f"""
WITH lines AS (SELECT doc_id, i - 1 AS line, parts[i] AS body
          FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
                FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
tokens AS (SELECT doc_id, line, regexp_replace(body, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS exact,
                  string_split_regex(regexp_replace(regexp_replace(regexp_replace(body, '({_UNSPACED})', ' \1 ', 'g'),
                  '{_NOSPACE}*[0-9]{_NOSPACE}*', '<*>', 'g'), '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_SPACE}+') AS t FROM lines),
cut AS (SELECT doc_id, line, exact, t, len(t) AS n, CAST(ceil((len(t) - 3) / 4.0) AS BIGINT) AS s FROM tokens WHERE exact <> ''),
keys AS (SELECT doc_id, line, unnest(CASE
           WHEN n < 5 OR 2 * {_constant("t")} < n THEN [{{'j': -2, 'n': 0, 't': [exact]}}]
           WHEN n >= 12 THEN [{{'j': -1, 'n': n, 't': t}}] || list_transform(
             list_filter([0, 1, 2, 3], lambda j: 2 * {_constant(_OUTSIDE)} >= len({_OUTSIDE})),
             lambda j: {{'j': j, 'n': n, 't': t[:3 + s * j] || ['<block>'] || t[4 + s * (j + 1):]}})
           ELSE [{{'j': -1, 'n': n, 't': t}}] END) AS k FROM cut),
firsts AS (SELECT k, min(doc_id) AS first_id FROM keys GROUP BY k),
gone AS (SELECT DISTINCT doc_id, line FROM keys JOIN firsts USING (k) WHERE first_id < doc_id)
SELECT doc_id, count(*) AS n_lines, count(gone.line) AS n_dropped,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY lines.line) FILTER (gone.line IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id"""

_LINKED = f"""
words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {{docs}}),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
reach AS (SELECT doc_id, doc_id AS r FROM words UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)"""

SET_RELATIONS = f"""
WITH RECURSIVE {_LINKED.format(docs="documents")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""

HARD_NEGATIVES = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
              FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                  CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
           FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5"""
