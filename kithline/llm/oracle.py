"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

#: Upper and lower case of the letters that the contracts fold.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """SQL for the list of words of a text (null: none)."""
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"


def lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def shingles(words_: str, width: int = 5) -> str:
    """SQL for the distinct shingles of a list of words; fewer words than a shingle are one."""
    return (f"CASE WHEN len({words_}) >= {width} THEN list_distinct(list_transform(range(1, len({words_}) - {width - 2}), "
            f"lambda i: array_to_string({words_}[i:i + {width - 1}], ' '))) WHEN len({words_}) > 0 "
            f"THEN [array_to_string({words_}, ' ')] ELSE [] END")


def components(docs: str = "documents", doc_columns: str = "doc_id, text") -> str:
    """CTEs up to ``component(doc_id, n, component_id)`` of the five-word Jaccard join over ``docs``."""
    return f"""
w AS (SELECT doc_id, {words(lower('text'))} AS w FROM (SELECT {doc_columns} FROM {docs})),
sets AS (SELECT doc_id, {shingles('w')} AS s FROM w),
s AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
component AS (SELECT s.doc_id, len(s.s) AS n, r.c AS component_id FROM sets s
  JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = s.doc_id)"""


REPEATED_PASSAGES = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
twice AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM win SEMI JOIN twice USING (g), range(35) AS t(k)),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM w)),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)"""


def contaminated(docs: str = "documents") -> str:
    """SQL for (doc_id, item_id, n_shingles, n_shared, containment) of all contaminated documents."""
    plain = "regexp_replace(" + lower("coalesce(text, '')") + ", '[^\\pL\\pN]+', ' ', 'g')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words(plain)} AS w FROM {docs}),
ds AS (SELECT r, doc_id, unnest({shingles('w')}) AS g FROM d),
b AS (SELECT DISTINCT item_id, {words(plain)} AS w FROM benchmark),
bs AS (SELECT item_id, len({shingles('w')}) AS n, unnest({shingles('w')}) AS g FROM b)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n AS containment
FROM ds JOIN bs USING (g) GROUP BY r, doc_id, item_id, n HAVING 100 * count(*) >= 75 * n"""


def collocations(least: int = 100, top: int = 2000) -> str:
    """SQL for the best phrases of 2 to 5 words of each language."""
    plain = lower("coalesce(text, '')")
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({plain}, '[.,;:!?\n\x0B\f\r]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
gram AS (SELECT lang, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS t(k))),
f AS (SELECT lang, g, count(*)::HUGEINT AS a FROM gram GROUP BY lang, g HAVING count(*) >= {least}),
inner_ AS (SELECT DISTINCT lang, a, g[i:j] AS g FROM (SELECT lang, a, g, i, unnest(range(i + 1, len(g) + 1)) AS j FROM
  (SELECT lang, a, g, unnest(range(1, len(g))) AS i FROM f)) WHERE j - i + 1 < len(g)),
kept AS (SELECT lang, g, a FROM f WHERE len(g) > 1 AND NOT EXISTS (SELECT 1 FROM inner_ x WHERE x.lang = f.lang AND x.g = f.g AND 100 * x.a >= 100 * f.a)),
cut AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept),
scored AS (SELECT c.lang, c.g, c.a, c.k, h.a AS l, t.a AS r, n, (1000::HUGEINT * c.a * n) // (h.a * t.a) AS score FROM cut c JOIN total USING (lang)
  JOIN f h ON h.lang = c.lang AND h.g = c.g[:c.k] JOIN f t ON t.lang = c.lang AND t.g = c.g[c.k + 1:]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= {top}"""


HARD_NEGATIVES = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) <= 5)
SELECT anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id, n.r))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN (SELECT ar, r, vec_id, score FROM s WHERE NOT same) n ON n.ar = p.ar AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_ngram_jaccard_join": f"WITH RECURSIVE {components()} SELECT doc_id, n AS n_shingles, component_id FROM component",
        "op5_decontamination": contaminated(),
        "op7_substring_dedup": REPEATED_PASSAGES,
        "op11_collocations": collocations(),
        "op12_hard_negatives": HARD_NEGATIVES,
    }
