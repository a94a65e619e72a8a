"""DuckDB SQL for the queries that SQL can express."""

from talkmill.llm.license_scan import TEMPLATES

_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.doc_id, pos, line, s.key IS NOT NULL AND k.doc_id <> s.first_doc AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

URLS = r"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
hits AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS k
         FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND h.k = 1
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

PASSAGES = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths WHERE len(w) >= k)),
found AS (SELECT p.doc_id, p.i, p.k, w.item_id FROM places p JOIN windows w ON p.k = w.k AND p.g = w.g),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_UNIT_WORDS = _WORDS.replace("coalesce(text, '')", "text")
_TEMPLATES = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))

LICENSES = f"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, 0 AS unit, text FROM lines UNION ALL SELECT doc_id, unnest(range(1, len(l) + 1)) AS unit, unnest(l) AS text FROM lines WHERE len(l) > 1),
w AS (SELECT doc_id, unit, {_UNIT_WORDS} AS w FROM u),
b AS (SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, unit, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) >= 2)),
n AS (SELECT doc_id, unit, count(*) AS n FROM b GROUP BY ALL),
t AS (SELECT template, license, {_UNIT_WORDS} AS w FROM (VALUES {_TEMPLATES}) AS x(template, license, text)),
tb AS (SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS g FROM (SELECT template, license, w, unnest(range(1, len(w))) AS i FROM t)),
m AS (SELECT template, count(*) AS m FROM tb GROUP BY ALL),
c AS (SELECT doc_id, unit, template, license, count(*) AS c FROM b JOIN tb USING (g) GROUP BY ALL),
s AS (SELECT doc_id, unit, license, 2 * c / (n + m) AS dice FROM c JOIN n USING (doc_id, unit) JOIN m USING (template) WHERE 200 * c >= 80 * (n + m)),
best AS (SELECT doc_id, unit, license, dice, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license) AS k FROM s),
by_doc AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, arg_min(license, (-dice, license)) AS license, max(dice) AS dice FROM best WHERE k = 1 GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, license, round(dice, 6) AS dice FROM documents d LEFT JOIN by_doc USING (doc_id)
"""

_UNITS = r"regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"

MIDDLES = f"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT doc_id, text, {_UNITS} AS w, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h FROM h),
c AS (SELECT *, len(w) AS n, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a, greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

_CRC32 = "xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length(k) + 1), lambda i: list_transform(range(8), lambda j: (ascii(substr(k, i, 1)) >> j) & 1)))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"

REPAIRS = rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
keyed AS (SELECT *, {_CRC32} % 20 AS d FROM raw),
rows AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text
         FROM keyed, (VALUES (1), (2)) AS copies(copy) WHERE d <> 0 AND (copy = 1 OR d = 3)),
placed AS (SELECT *, left(role, 1) AS r, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM rows),
seen AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS pr FROM placed),
judged AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
-- v: for each state (nothing yet, after s, u, a) the cost, audit and lines of what follows row i
dp(conv_id, i, v) AS (
  SELECT conv_id, max(i), [{{'c': 0, 'a': '', 'l': ''}}, {{'c': 10, 'a': 'II', 'l': chr(10) || 'user:' || chr(10) || 'assistant:'}}, {{'c': 5, 'a': 'I', 'l': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 'l': ''}}] FROM judged GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, list_transform([1, 2, 3, 4], lambda q: list_min([w[q],
      {{'c': w[nx[q]].c + 5, 'a': 'I' || w[nx[q]].a, 'l': chr(10) || nr[q] || ':' || w[nx[q]].l}},
      {{'c': w[nx[nx[q]]].c + 10, 'a': 'II' || w[nx[nx[q]]].a, 'l': chr(10) || nr[q] || ':' || chr(10) || nr[nx[q]] || ':' || w[nx[nx[q]]].l}}]))
  FROM (SELECT conv_id, i, nx, nr, list_transform([1, 2, 3, 4], lambda q: list_min([{{'c': v[q].c + 2, 'a': 'D' || v[q].a, 'l': v[q].l}},
          {{'c': v[nx[q]].c + 1 + e, 'a': 'R' || v[nx[q]].a, 'l': chr(10) || nr[q] || ':' || text || v[nx[q]].l}},
          CASE WHEN r = 's' AND q = 1 THEN {{'c': v[2].c + e, 'a': 'K' || v[2].a, 'l': chr(10) || role || ':' || text || v[2].l}}
               WHEN r = left(nr[q], 1) THEN {{'c': v[nx[q]].c + e, 'a': 'K' || v[nx[q]].a, 'l': chr(10) || role || ':' || text || v[nx[q]].l}} END])) AS w
        FROM (SELECT dp.conv_id, dp.i, v, role, r, text, [3, 3, 4, 3] AS nx, ['user', 'user', 'assistant', 'user'] AS nr, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000 END AS e
              FROM dp JOIN judged j ON dp.conv_id IS NOT DISTINCT FROM j.conv_id AND dp.i = j.i))),
found AS (SELECT conv_id, v[1] AS best FROM dp WHERE i = 0),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pr IS NOT NULL AND pr || r NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id LEFT JOIN found b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLES = {"op7_license_scan": LICENSES, "op10_decontam": PASSAGES, "op2_line_dedup": LINES, "op6_url_filter": URLS, "op11_conversation_repair": REPAIRS, "op13_fill_middle": MIDDLES}
