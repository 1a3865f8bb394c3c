"""DuckDB SQL for the corpus queries that SQL can express."""

LINE_FREQUENCY = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT uid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d
), win AS (
  SELECT uid, unnest(range(1, len(ws) - 1)) AS p, ws FROM w WHERE len(ws) >= 3
), tri AS (
  SELECT uid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g FROM win
), rep AS (
  SELECT uid, p FROM (SELECT uid, p, count(*) OVER (PARTITION BY uid, g) AS n FROM tri) WHERE n > 1
), cov AS (
  SELECT uid, count(DISTINCT q) AS n_repeat_words FROM (SELECT uid, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY uid
), l AS (
  SELECT uid, source, unnest(string_split(t, chr(10))) AS line FROM d
), lw AS (
  SELECT uid, source, line,
         trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT uid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY uid
), hosts AS (
  SELECT source, greatest(5, 0.05 * count(DISTINCT t)) AS most FROM d GROUP BY source
), freq AS (
  SELECT lw.source, norm FROM lw JOIN d USING (uid) JOIN hosts ON lw.source IS NOT DISTINCT FROM hosts.source
  GROUP BY lw.source, norm, most HAVING count(DISTINCT t) > most
), lost AS (
  SELECT lw.uid, sum(length(lw.norm) - length(replace(lw.norm, ' ', '')) + 1) AS n_removed_words
  FROM lw JOIN freq ON lw.norm = freq.norm AND lw.source IS NOT DISTINCT FROM freq.source GROUP BY lw.uid
), s AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (uid) LEFT JOIN dup USING (uid) LEFT JOIN cov USING (uid) LEFT JOIN lost USING (uid)
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s
)
SELECT *, (NOT base_failed AND NOT n_removed_words * 10 > n_words * 7) AS kept FROM b
"""

EXACT_DEDUP = """
WITH n AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM n
"""

WARC_RECORDS = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), r AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS FIRST) AS k,
         first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS FIRST) AS least
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN least END AS refers_to
FROM r
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS us,
         ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
         ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4
  FROM d
), f AS (
  SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), c AS (
  SELECT *, array_to_string(us[1:a], '') AS p, array_to_string(us[a + 1:b], '') AS m, array_to_string(us[b + 1:], '') AS x FROM f
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
                        ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""

#: The first part computes CRC-32 from its polynomial: the table of 256 remainders, then a fold over the bytes.
SPELLING = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w
  FROM documents
), own AS (
  SELECT id, w, count(*) AS k FROM runs GROUP BY id, w
), hashed AS (
  SELECT w, k, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(strlen(id || ':' || w)), lambda i: ('0x' || hex(encode(id || ':' || w))[2 * i + 1:2 * i + 2])::BIGINT)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM own, tab
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, sum(k)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING n >= 3 AND length(word) >= 5
), cut AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM cut
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN m END AS form_n,
         CASE WHEN m >= 2 * w.n THEN (SELECT min(other) FROM near WHERE near.word = w.word AND near.m = best.m) END AS form
  FROM words w LEFT JOIN best ON w.word = best.word
), walk AS (
  SELECT word, coalesce(form, word) AS upto FROM told
  UNION SELECT walk.word, told.form FROM walk JOIN told ON told.word = walk.upto WHERE told.form IS NOT NULL
), roots AS (
  SELECT walk.word, upto AS root FROM walk JOIN told ON told.word = walk.upto WHERE told.form IS NULL
)
SELECT told.word, form, root, n, n_near, form_n FROM told JOIN roots ON roots.word = told.word
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS uid, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT uid, doc_id, list_sort(list_distinct(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS members FROM w
), sets AS (
  SELECT min(uid) AS sid, members, len(members) AS n FROM s WHERE len(members) > 0 GROUP BY members
), one AS (
  SELECT sid, n, unnest(members) AS g FROM sets
), link AS (
  SELECT a.sid AS a, b.sid AS b FROM one a JOIN one b ON a.g = b.g AND a.sid <> b.sid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.sid, b.sid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT sid AS a, sid AS b FROM sets
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (
  SELECT sets.sid, sets.members, min(s.doc_id) AS component_id
  FROM sets JOIN reach ON reach.a = sets.sid JOIN sets o ON o.sid = reach.b JOIN s ON s.members = o.members GROUP BY sets.sid, sets.members
)
SELECT s.doc_id, len(s.members)::BIGINT AS n_shingles, coalesce(least.component_id, s.doc_id) AS component_id,
       s.doc_id IS NOT DISTINCT FROM coalesce(least.component_id, s.doc_id) AS kept
FROM s LEFT JOIN least ON s.members = least.members
"""
