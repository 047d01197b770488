"""DuckDB SQL for the queries of this subpackage that SQL can express; it shares no code with the operators."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op2_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS phrase
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM p),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM d, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
),
hits AS (SELECT doc_id, places.n, i, item_id FROM places JOIN p ON places.n = p.n AND places.phrase = p.phrase),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM hits, LATERAL (SELECT unnest(range(i, i + n)) AS j) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_chat": r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
e AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_size,
    length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_size,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS begins
  FROM r
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_size + CASE WHEN begins THEN 15 + role_size ELSE 7 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op6_url_filter": f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
),
rules (rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, action, row_number() OVER (
    PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM p JOIN rules ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
)
SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN fits ON p.page_id = fits.page_id AND k = 1""",
    "op7_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)""",
}
