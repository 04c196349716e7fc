"""SQL that checks the queries which SQL can express."""

from __future__ import annotations

_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"''']?\x20*[:=]\x20*[\"''']?([A-Za-z0-9+/_.=-]+)".replace("'''", "''")


def _found(rank: int, pattern: str, group: int, least: int) -> str:
    return (f"SELECT rid, {rank} AS rank, {least} AS least, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}', 0) AS w,"
            f" regexp_extract_all(t, '{pattern}', {group}) AS v FROM d WHERE regexp_matches(t, '{pattern}')")


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
k AS ({_found(0, _ASSIGN, 1, 6)} UNION ALL {_found(1, 'AKIA[A-Z0-9]+', 0, 20)} UNION ALL
      {_found(2, '[0-9a-f]+', 0, 24)} UNION ALL {_found(3, '[A-Za-z0-9+/_=-]{20,}', 0, 20)}),
e AS (SELECT *, unnest(generate_series(1, len(w))) AS i FROM k),
s AS (SELECT rid, rank, v[i] AS value, length(w[i]) AS size,
        list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) AS a
      FROM e WHERE length(v[i]) >= least),
base AS (SELECT rid, rank, value, CAST(a AS BIGINT) AS a, CAST(a + size AS BIGINT) AS z FROM s WHERE rank < 3),
more AS (SELECT rid, rank, value, CAST(a AS BIGINT) AS a, CAST(a + size AS BIGINT) AS z FROM s WHERE rank = 3
         AND len(regexp_extract_all(value, '[A-Za-z][0-9]|[0-9][A-Za-z]')) >= 3 AND len(list_distinct(string_split(value, ''))) >= 10),
spans AS (SELECT * FROM base UNION ALL SELECT m.* FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = m.rid AND b.a < m.z AND m.a < b.z)),
held AS (SELECT value, count(DISTINCT owner) AS owners FROM spans JOIN d USING (rid) GROUP BY value),
judged AS (SELECT rid, rank, a, owners < 2 AS live, (['assign', 'access', 'hex', 'owned'])[rank + 1] || ':' || a || ':' || z AS s
           FROM spans JOIN held USING (value) WHERE rank < 3 OR owners < 2),
per AS (SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
        string_agg(s, ',' ORDER BY a, rank) FILTER (rank < 3) AS base, string_agg(s, ',' ORDER BY a, rank) AS spans, count(*) FILTER (live) AS n_live
        FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN per USING (rid)
"""

_JS = """sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0))"""
_CLASSES = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", "[.,;:!?''\"()-]", r"[#*$%&|<>@/\\_=+~^{}`\[\]]"]
_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in _CLASSES)

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, [{_COUNTS}] AS c FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w) x),
again AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM win JOIN again USING (rid, g)) x GROUP BY rid),
word AS (SELECT rid, lang, unnest(ws) AS word FROM w),
n AS (SELECT lang, word, count(*) AS n FROM word WHERE lang IS NOT NULL GROUP BY lang, word
      UNION ALL SELECT '(all)' AS lang, word, count(*) AS n FROM word GROUP BY word),
tot AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang HAVING sum(n) >= 20000),
top AS (SELECT lang, word, n / total AS q FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM n) x JOIN tot USING (lang) WHERE k <= 24),
ref AS (SELECT rid, coalesce(o.lang, p.lang) AS ref FROM d LEFT JOIN tot o ON o.lang = d.lang LEFT JOIN tot p ON p.lang = '(all)'),
have AS (SELECT rid, word, count(*) AS n FROM word GROUP BY rid, word),
bins AS (SELECT r.rid, t.q, coalesce(h.n, 0) / len(w.ws) AS p FROM ref r JOIN w USING (rid) JOIN top t ON t.lang = r.ref LEFT JOIN have h ON h.rid = r.rid AND h.word = t.word
         WHERE len(w.ws) >= 50),
rest AS (SELECT rid, 1 - sum(q) AS q, 1 - sum(p) AS p FROM bins GROUP BY rid),
wjs AS (SELECT rid, {_JS} AS js FROM (SELECT rid, q, p FROM bins UNION ALL SELECT rid, greatest(q, 0), CASE WHEN p < 1e-12 THEN 0 ELSE p END FROM rest) x GROUP BY rid),
full_c AS (SELECT rid, lang, list_append(c, length(t) - list_sum(c)) AS c, length(t) AS chars FROM w),
cell AS (SELECT rid, lang, chars, unnest(generate_series(1, 7)) AS k, unnest(c) AS c FROM full_c),
share AS (SELECT lang, k, sum(c) / sum(chars) AS q FROM cell WHERE lang IS NOT NULL GROUP BY lang, k
          UNION ALL SELECT '(all)', k, sum(c) / sum(chars) FROM cell GROUP BY k),
cjs AS (SELECT rid, {_JS} AS js FROM (SELECT c.rid, c.c / c.chars AS p, s.q FROM cell c JOIN ref r USING (rid) JOIN share s ON s.lang = r.ref AND s.k = c.k WHERE c.chars >= 200) x GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(t) - c[4] AS BIGINT) AS word_chars,
      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words, cjs.js AS class_js, wjs.js AS word_js
      FROM w LEFT JOIN cover USING (rid) LEFT JOIN cjs USING (rid) LEFT JOIN wjs USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(class_js, 0) > 0.32 OR coalesce(word_js, 0) > 0.18 + 2.3 / sqrt(greatest(n_words, 1))) AS kept,
  round(class_js, 6) AS class_js, round(word_js, 6) AS word_js
FROM f
"""

#: scores of all pairs of an item and a document with a common term, the best 50
SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, total GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total GROUP BY item_id, doc_id
), ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
