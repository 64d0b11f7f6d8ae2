"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from fieldweave.llm.licenses import COVERED, LONGER, PHRASES, SLACK, TEMPLATES, telling_words

WORD = r"[^\x20\x09-\x0D]+"

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

# The level at which targets stop: a source is capped if its weight at that level asks for more than twice its size.
SOURCE_MIX = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size, md5(CAST(doc_id AS VARCHAR)) AS draw
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY encode(k)) - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS weight
      FROM d GROUP BY k),
total AS (SELECT CAST(sum(source_size) AS BIGINT) AS n, CAST(sum(weight) AS BIGINT) AS w FROM s),
fill AS (
  SELECT 0 AS round, 3 * n AS spare, w AS weights FROM total
  UNION ALL
  SELECT round + 1,
         (SELECT 3 * total.n - 4 * CAST(coalesce(sum(source_size), 0) AS BIGINT) FROM s, total WHERE weight * spare > source_size * 4 * weights GROUP BY total.n
          UNION ALL SELECT 3 * total.n FROM total WHERE NOT EXISTS (SELECT 1 FROM s WHERE weight * spare > source_size * 4 * weights)),
         (SELECT CAST(coalesce(sum(weight), 0) AS BIGINT) FROM s WHERE NOT weight * spare > source_size * 4 * weights)
  FROM fill WHERE round < 40 AND weights > 0),
level AS (SELECT spare, weights FROM fill WHERE weights > 0 ORDER BY round DESC LIMIT 1),
goal AS (
  SELECT k, source_size, CASE WHEN weight * spare > source_size * 4 * weights THEN CAST(source_size * 2 AS DOUBLE)
         ELSE CAST(weight * spare AS DOUBLE) / CAST(2 * weights AS DOUBLE) END AS target
  FROM s, level),
p AS (SELECT doc_id, k, size,
             coalesce(CAST(sum(size) OVER (PARTITION BY k ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
      FROM d)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         CAST(floor(target) AS BIGINT) // source_size * size
         + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - before)) END AS taken
FROM p JOIN goal USING (k)
"""

PREFERENCE_PAIRS = r"""
WITH c AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
cut AS (SELECT conv_id, arg_min(turn, md5(conv_id || ':' || turn)) AS spot FROM c WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id),
answer AS (SELECT cut.conv_id, cut.spot, min(text) AS text FROM cut JOIN cut o ON o.conv_id = xor(cut.conv_id, 1)
           JOIN c ON c.conv_id = o.conv_id AND c.turn = o.spot AND role = 'assistant' GROUP BY ALL),
t AS (SELECT conv_id AS pair_id, true AS chosen, turn, role, text FROM c
      UNION ALL SELECT c.conv_id, false, turn, role, text FROM c JOIN cut USING (conv_id) WHERE turn < spot
      UNION ALL SELECT conv_id, false, spot, 'assistant', text FROM answer),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, chosen ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM t),
paired AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.k, b.k) AS k,
         a.k IS NOT NULL AND b.k IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM (SELECT * FROM n WHERE chosen) a FULL JOIN (SELECT * FROM n WHERE NOT chosen) b ON a.pair_id = b.pair_id AND a.k = b.k),
p AS (SELECT pair_id, coalesce(min(k) FILTER (WHERE NOT same) - 1, max(k)) AS n_prompt FROM paired GROUP BY pair_id),
s AS (SELECT *, '<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10) AS head,
             replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS body,
             CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS train
      FROM n JOIN p USING (pair_id))
SELECT pair_id, any_value(n_prompt) AS n_prompt_turns,
       count(*) FILTER (WHERE chosen AND k > n_prompt) AS n_chosen_turns,
       count(*) FILTER (WHERE NOT chosen AND k > n_prompt) AS n_rejected_turns,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE chosen AND k <= n_prompt), '') AS prompt,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE chosen AND k > n_prompt), '') AS chosen_text,
       coalesce(string_agg(length(head) || ':0 ' || length(body) || ':' || train, ' ' ORDER BY k) FILTER (WHERE chosen AND k > n_prompt), '') AS chosen_mask,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE NOT chosen AND k > n_prompt), '') AS rejected_text,
       coalesce(string_agg(length(head) || ':0 ' || length(body) || ':' || train, ' ' ORDER BY k) FILTER (WHERE NOT chosen AND k > n_prompt), '') AS rejected_mask
FROM s GROUP BY pair_id
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS item
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.item = b.item GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.vec_id, (SELECT count(*) FROM links WHERE a = r.vec_id) AS n_links, min(other) AS component_id, r.vec_id = min(other) AS kept
FROM reach r GROUP BY r.vec_id
"""

SHARED_PASSAGES = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
x AS (SELECT doc_id, p, w[p] AS word, CASE WHEN p + 12 <= len(w) THEN array_to_string(w[p:p + 12], ' ') END AS span
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
f AS (SELECT doc_id, p, word, span IS NOT NULL AND min(doc_id) OVER (PARTITION BY span) < doc_id AS repeated FROM x),
c AS (SELECT doc_id, p, word, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

def _phrases() -> str:
    rows = [(text, label, "true", [], []) for text, label in PHRASES]
    rows += [(text, label, "false", *words) for (text, label), words in zip(TEMPLATES, telling_words())]
    return ", ".join(f"({n}, '{text}', '{label}', {base}, {needed}::VARCHAR[], {barred}::VARCHAR[])"
                     for n, (text, label, base, needed, barred) in enumerate(rows))


LICENSE_SCAN = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT n, label, base, needed, barred, string_split(t, ' ') AS w FROM (VALUES {_phrases()}) v(n, t, label, base, needed, barred)),
t AS (SELECT n, label, base, len(w) - 1 AS grams, place, w[place] AS x, w[place + 1] AS y FROM (SELECT *, unnest(range(1, len(w))) AS place FROM k)),
g AS (SELECT doc_id, p, w[p] AS x, w[p + 1] AS y FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM d)),
v AS (SELECT doc_id, n, label, base, grams, p, place, p - place AS diagonal FROM g JOIN t USING (x, y)),
e AS (SELECT DISTINCT doc_id, n, base, diagonal FROM v),
r AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, n ORDER BY diagonal) > {SLACK}, true) THEN 1 ELSE 0 END AS apart FROM e),
q AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, n ORDER BY diagonal) AS run FROM r),
m AS (SELECT v.doc_id, v.n, label, v.base, grams, count(DISTINCT place) AS votes, list(place ORDER BY p, place) AS places, min(p) AS b, max(p) + 1 AS e
      FROM v JOIN q ON q.doc_id = v.doc_id AND q.n = v.n AND q.diagonal = v.diagonal GROUP BY v.doc_id, v.n, label, v.base, grams, run),
u AS (SELECT m.doc_id, m.label, m.base, grams, votes, b - 1 AS start,
             m.base AND votes = grams OR NOT m.base AND votes >= {COVERED} * grams AND list_sort(places) = places
               AND e - b + 1 <= grams + 1 + {LONGER} AND list_has_all(d.w[b:e], k.needed) AND NOT list_has_any(d.w[b:e], k.barred) AS held
      FROM m JOIN d ON d.doc_id = m.doc_id JOIN k ON k.n = m.n)
SELECT d.doc_id, len(w) AS n_words, count(*) FILTER (WHERE base AND votes = grams) AS n_base,
       min(start) FILTER (WHERE base AND votes = grams) AS first_word, max(start) FILTER (WHERE base AND votes = grams) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base AND votes = grams), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE held), '') AS labels,
       coalesce(max(votes / grams), 0) AS score
FROM d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.doc_id, w
"""

COLLOCATIONS = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
x AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n FROM x, (VALUES (1), (2), (3)) v(m)
      WHERE i + m - 1 <= len(w) GROUP BY ALL),
c AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 10),
cut AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c),
s AS (SELECT t.lang, t.phrase, t.a, t.k, l.n AS l, r.n AS r,
             CAST(1000000::HUGEINT * t.a * t.a // (l.n::HUGEINT * r.n) AS BIGINT) AS score
      FROM cut t JOIN f l ON l.lang = t.lang AND l.phrase = array_to_string(t.w[1:t.k], ' ')
      JOIN f r ON r.lang = t.lang AND r.phrase = array_to_string(t.w[t.k + 1:t.m], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE m = 3),
kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 50 * b.a)),
n AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n.n AS n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

SQL = {
    "op5_license_scan": LICENSE_SCAN,
    "op2_preference_pairs": PREFERENCE_PAIRS,
    "op6_exact_dedup": EXACT_DEDUP,
    "op7_source_mix": SOURCE_MIX,
    "op8_near_dedup": NEAR_DEDUP,
    "op9_near_vectors": NEAR_VECTORS,
    "op10_shared_passages": SHARED_PASSAGES,
    "op13_collocations": COLLOCATIONS,
}
