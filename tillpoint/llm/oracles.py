"""DuckDB statements for the numbered operators that SQL can express."""

_WORDS = "list_filter(regexp_split_to_array(lower(coalesce({t}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"

OP1 = rf"""
WITH item_words AS (SELECT DISTINCT item_id, {_WORDS.format(t='text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
doc_words AS (SELECT doc_id, {_WORDS.format(t='text')} AS w FROM documents WHERE doc_id IS NOT NULL),
-- an item of fewer than five words is one run of its own length, wherever it stands
item_grams AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
               FROM item_words WHERE len(w) > 0),
doc_grams AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
              FROM doc_words, (SELECT DISTINCT k FROM item_grams) WHERE len(w) >= k),
sizes AS (SELECT item_id, count(*) AS n FROM item_grams GROUP BY item_id)
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_found,
       CAST(count(*) AS DOUBLE) / any_value(n) AS containment
FROM item_grams JOIN doc_grams USING (k, g) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n)
"""

OP2 = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT row_number() OVER () AS r, vec_id, e FROM (SELECT DISTINCT vec_id, e FROM vectors)),
good AS (SELECT r, e FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
reach AS (SELECT r AS node, r AS seen FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen),
component AS (SELECT node, min(vec_id) AS component_id FROM reach JOIN v ON v.r = seen GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, component_id, coalesce(v.vec_id = component_id, FALSE) AS kept
FROM vectors x JOIN v ON v.vec_id IS NOT DISTINCT FROM x.vec_id AND v.e IS NOT DISTINCT FROM x.e JOIN component ON node = v.r
"""

OP3 = """
WITH rows AS (SELECT page_id, format('warc-{:06d}', CAST(floor(coalesce(page_id, 0) / 1000.0) AS INTEGER)) AS file,
              'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
              || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
              || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS a FROM pages),
placed AS (SELECT *, coalesce(sum(strlen(a)) OVER (PARTITION BY file ORDER BY page_id, strlen(a) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
           left(a, 19) || '#' || substr(a, 21) AS b, coalesce(page_id, 0) * 7919 AS mark FROM rows)
SELECT file, CAST(pos AS BIGINT) AS "offset", CASE WHEN mark % 211 = 1 THEN 'missing' ELSE 'changed' END AS status,
       strlen(a) || ':' || sha256(a) AS digest, CASE WHEN mark % 211 <> 1 THEN strlen(b) || ':' || sha256(b) END AS replica_digest
FROM placed WHERE mark % 211 = 1 OR (mark % 97 = 0 AND a <> b)
"""

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d WHERE doc_id IS NOT NULL)),
m AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s),
dup AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new
        FROM (SELECT DISTINCT doc_id, p FROM g JOIN m USING (s) WHERE doc_id > first_doc)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z
         FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM dup) GROUP BY doc_id, run),
edges AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM runs
          UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(substr(h, CAST(2 * e.a + 1 AS BIGINT), CAST(2 * (coalesce(b, len(h) // 2) - e.a) AS BIGINT)), '' ORDER BY e.a) AS k
         FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(z - a) AS n, count(*) AS c FROM runs GROUP BY doc_id) r USING (doc_id)
"""

OP6 = r"""
WITH parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (SELECT host, path, arg_max(h || p, len(h || p)) AS rule, arg_max(verdict, len(h || p)) AS verdict
         FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (SELECT r, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM w)),
again AS (SELECT r, p FROM windows JOIN (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
repeated AS (SELECT r, count(DISTINCT p + k) AS n FROM again, range(0, 8) AS x(k) GROUP BY r),
lines AS (SELECT r, host, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS own
          FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
normal AS (SELECT r, host, line, len(own) AS n, translate(array_to_string(own, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM lines),
frequent AS (SELECT host, x FROM normal GROUP BY host, x HAVING count(DISTINCT r) > 30),
lost AS (SELECT r, sum(n) AS n FROM normal JOIN frequent USING (host, x) GROUP BY r),
twice AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
counts AS (SELECT doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(twice.n, 0) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
           FROM d JOIN w USING (r) LEFT JOIN twice USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lost USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * n_removed_words > n_words OR n_words - n_removed_words < 20) AS kept
FROM counts
"""

# places of the role grammar: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 may end it
OP13 = r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, strlen(k)), lambda i: CAST(ascii(k[i + 1]) AS BIGINT))),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 20 AS fault
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations)),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM base, range(0, CASE WHEN fault = 3 THEN 2 ELSE 1 END) WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS c,
                  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM placed),
judged AS (SELECT *, z = '' AS blank, z <> '' AND again AS duplicate, z <> '' AND NOT again AND z NOT IN ('.', '!', '?') AS truncated FROM seen),
step(f, symbol, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserted(f, t, cost, audit) AS (SELECT f, f, 0, '' FROM range(0, 4) AS x(f) UNION ALL SELECT f, t, 3, 'I' FROM step WHERE symbol <> 's'),
edit(symbol, f, t, cost, audit) AS (
  SELECT x.s, f, f, 4, 'D' FROM range(0, 4) AS y(f), (VALUES ('s'), ('u'), ('a'), ('x'), ('d')) AS x(s)
  UNION ALL SELECT symbol, f, t, 0, 'K' FROM step
  UNION ALL SELECT x.s, f, t, 3, 'R' FROM step, (VALUES ('s'), ('u'), ('a'), ('x')) AS x(s) WHERE symbol <> 's'),
moves AS (SELECT symbol, n.f, e.t, n.cost + e.cost AS cost, n.audit || e.audit AS audit FROM edit e JOIN inserted n ON n.t = e.f),
kinds AS (SELECT conv_id, i, CASE WHEN blank OR duplicate THEN 'd' WHEN c IN ('s', 'u', 'a') THEN c ELSE 'x' END AS symbol, CASE WHEN truncated THEN 3 ELSE 0 END AS more FROM judged),
parse AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS place, 0 AS cost, '' AS audit FROM (SELECT DISTINCT conv_id FROM damaged)
  UNION ALL
  SELECT conv_id, i, place, least.cost, least.audit
  FROM (SELECT p.conv_id, p.i + 1 AS i, m.t AS place, min(struct_pack(cost := p.cost + m.cost + CASE WHEN m.audit LIKE '%D' THEN 0 ELSE k.more END, audit := p.audit || m.audit)) AS least
        FROM parse p JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.i = p.i + 1 JOIN moves m ON m.f = p.place AND m.symbol = k.symbol GROUP BY 1, 2, 3)),
last AS (SELECT conv_id, max(i) AS n FROM parse GROUP BY conv_id),
ends(place, cost, audit) AS (VALUES (0, 0, ''), (3, 0, ''), (2, 3, 'I'), (1, 6, 'II')),
least AS (SELECT p.conv_id, min(struct_pack(cost := p.cost + e.cost, audit := p.audit || e.audit)) AS least
          FROM parse p JOIN last l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.n = p.i JOIN ends e ON e.place = p.place GROUP BY p.conv_id),
edits AS (SELECT conv_id, audit, j, audit[j] AS e, len(replace(audit, 'D', '')) % 2 AS lead, len(replace(left(audit, j), 'D', '')) AS nth, len(replace(left(audit, j), 'I', '')) AS nrow
          FROM (SELECT conv_id, least.audit AS audit, unnest(range(1, len(least.audit) + 1)) AS j FROM least)),
repaired AS (SELECT e.conv_id, sha256(string_agg(CASE WHEN e.e = 'K' THEN role WHEN (nth - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e.e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS h
             FROM edits e LEFT JOIN placed p ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.i = e.nrow AND e.e <> 'I' WHERE e.e <> 'D' GROUP BY e.conv_id),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
                  count_if(next IS NOT NULL AND c || next NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(least.cost, 0) AS BIGINT) AS cost,
       coalesce(least.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN least l ON l.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLES = {"op1_decontaminate": OP1, "op2_embedding_dedup": OP2, "op3_merkle_audit": OP3, "op5_suffix_dedup": OP5, "op6_url_filter": OP6,
           "op12_quality_rules": OP12, "op13_conversation_repair": OP13}
