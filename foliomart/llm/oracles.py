"""DuckDB SQL for the registered queries that SQL can express.

Not here: nearest neighbours (approximate; tests measure recall against brute force), packing and the
pipeline (token ids are not SQL; tests compare with the tokenizer itself and with plain best fit).
"""

from __future__ import annotations

from foliomart.llm import urlrules

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{_WORD}')"


OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_words("coalesce(text, '')")}) AS size,
    (length(text) - (length(text) - length(translate(text, '0123456789#*$%&|<>{{}}[]_=+~^\/@!', ''))) + 1.0::DOUBLE)
      / (length(text) + 1.0::DOUBLE) AS q,
    md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(length(text)::VARCHAR, '') || chr(31) || coalesce(md5(text), '')) AS h
  FROM documents
), k AS (
  SELECT *, -ln((('0x' || substr(h, 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / coalesce(q, 1.0::DOUBLE) AS key
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS stop,
    sum(source_size) OVER ()::BIGINT AS total FROM s
), o AS (
  SELECT *, total - coalesce(sum(stop) OVER p, 0) AS free, sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS heavy
  FROM w WINDOW p AS (ORDER BY stop::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, free * weight >= stop * heavy AS stopped FROM o
), r AS (
  SELECT *, total - sum(CASE WHEN stopped THEN stop ELSE 0 END) OVER () AS rest,
    sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS share FROM t
), g AS (
  SELECT source, source_size,
    CASE WHEN stopped THEN stop::DOUBLE ELSE least(rest::DOUBLE * weight / share, stop::DOUBLE) END AS target FROM r
), x AS (
  SELECT k.*, g.source_size, g.target,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 1 END AS epochs
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  (size * least(epochs + CASE WHEN size > 0 AND upto - size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM x
"""

OP2 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS owner
  FROM (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d))
), hit AS (SELECT doc_id, p FROM w WHERE owner < doc_id),
ends AS (
  SELECT doc_id, p, CASE WHEN lag(p) OVER o >= p - 50 THEN 0 ELSE 1 END AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM ends) GROUP BY doc_id, n
), kept AS (
  SELECT doc_id, sum(b - a) AS gone, count(*) AS n FROM spans GROUP BY doc_id
), gaps AS (
  SELECT doc_id, a AS stop, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start FROM spans
  UNION ALL SELECT doc_id, NULL, max(b) FROM spans GROUP BY doc_id
), left_over AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * start + 1, CASE WHEN stop IS NULL THEN length(h) ELSE 2 * (stop - start) END), '' ORDER BY start) AS h
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(l.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""

OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(role) + length(text) + len(regexp_extract_all(role, '[\\#<:]')) + len(regexp_extract_all(text, '[\\#<]')))::BIGINT
    AS formatted_chars
FROM t GROUP BY conv_id
"""


def _op4() -> str:
    sites = ", ".join(f"('{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}', '{r.name}', '{r.verdict}')" for r in urlrules.SITES)
    bad = "|".join(f"(?:{urlrules.expression(r.pattern)})" for r in urlrules.PAGES)
    return rf"""
WITH u AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), r(rule_host, rule_path, rule, verdict) AS (VALUES {sites}),
f AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n
)
SELECT page_id, host, path, f.rule,
  coalesce(f.verdict, CASE WHEN regexp_matches(host || path, '{bad}', 's') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN f USING (n)
"""


OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, {_words("text")} AS ws FROM d)
), tri AS (
  SELECT doc_id, i, word || chr(31) || lead(word) OVER o || chr(31) || lead(word, 2) OVER o AS t FROM w
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), seen AS (
  SELECT doc_id, i, CASE WHEN t IS NOT NULL THEN count(*) OVER (PARTITION BY doc_id, t) ELSE 0 END AS c FROM tri
), marked AS (
  SELECT doc_id, greatest(c, coalesce(lag(c) OVER o, 0), coalesce(lag(c, 2) OVER o, 0)) > 1 AS again FROM seen
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (SELECT doc_id, count(*) FILTER (again) AS n_repeat_words FROM marked GROUP BY doc_id),
size AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
l AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS host, line, i,
    array_to_string({_words("translate(line, '" + _UPPER + "123456789', '" + _LOWER + "000000000')")}, ' ') AS norm,
    len({_words("line")}) AS n
  FROM (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM d))
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE norm <> '' GROUP BY doc_id
), near AS (
  SELECT *, coalesce(lag(norm) OVER o, chr(31)) AS before, coalesce(lead(norm) OVER o, chr(31)) AS after FROM l
  WHERE norm <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), often AS (SELECT host, norm FROM l WHERE norm <> '' GROUP BY host, norm HAVING count(DISTINCT doc_id) > 10),
side AS (
  SELECT host, norm, 'b' AS side, before AS next, count(DISTINCT doc_id) AS n FROM near JOIN often USING (host, norm) GROUP BY ALL
  UNION ALL SELECT host, norm, 'a', after, count(DISTINCT doc_id) FROM near JOIN often USING (host, norm) GROUP BY ALL
), flag AS (
  SELECT host, norm, bool_and(fixed) FILTER (side = 'b') AS fixed_before, bool_and(fixed) FILTER (side = 'a') AS fixed_after,
    bool_and(line) FILTER (side = 'b') AS line_before, bool_and(line) FILTER (side = 'a') AS line_after
  FROM (SELECT host, norm, side, 2 * max(n) >= sum(n) AS fixed,
      coalesce(2 * max(n) FILTER (next <> chr(31)) >= sum(n), false) AS line FROM side GROUP BY ALL) GROUP BY ALL
), whose AS (
  SELECT DISTINCT host, norm, doc_id FROM near JOIN flag USING (host, norm) WHERE fixed_before AND fixed_after
), own AS (
  SELECT doc_id, norm, fixed_before, last_value(line_after IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS above,
    last_value(line_before IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i DESC) AS below
  FROM near LEFT JOIN flag USING (host, norm) WHERE doc_id IN (SELECT doc_id FROM whose)
), said AS (
  SELECT doc_id, string_agg(norm, chr(10) ORDER BY norm) AS said FROM own
  WHERE fixed_before IS NULL AND NOT coalesce(above, false) AND NOT coalesce(below, false) GROUP BY doc_id
), silent AS (
  SELECT doc_id, list(word ORDER BY i) AS w FROM (
    SELECT doc_id, i, translate(word, '{_UPPER}', '{_LOWER}') AS word FROM w
    WHERE doc_id IN (SELECT doc_id FROM whose) AND doc_id NOT IN (SELECT doc_id FROM said)) GROUP BY doc_id
), same AS (SELECT *, min(doc_id) OVER (PARTITION BY w) AS alike FROM silent),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM same WHERE doc_id = alike)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * k >= 80 * (u.n + v.n - k)
), reach AS (
  SELECT a AS doc_id, b AS other FROM link UNION SELECT r.doc_id, e.b FROM reach r JOIN link e ON r.other = e.a
), told AS (
  SELECT doc_id, said AS as_text, NULL AS as_copy FROM said
  UNION ALL SELECT same.doc_id, NULL, least(alike, min(other)) FROM same LEFT JOIN reach ON reach.doc_id = alike GROUP BY same.doc_id, alike
), bad AS (
  SELECT host, norm FROM flag WHERE NOT (fixed_before AND fixed_after)
  UNION ALL SELECT host, norm FROM whose JOIN told USING (doc_id) GROUP BY host, norm HAVING count(DISTINCT (as_text, as_copy)) > 10
), gone AS (SELECT doc_id, sum(n) AS gone FROM l JOIN bad USING (host, norm) GROUP BY doc_id),
m AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(gone, 0) AS gone
  FROM d LEFT JOIN size USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN gone USING (doc_id)
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, (n_words - gone)::BIGINT AS left_words FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, left_words,
  NOT base_failed AND NOT (gone > 0 AND (left_words < 25 OR left_words < 0.3 * n_words)) AS kept
FROM v
"""

OP7 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p
"""

OP8 = r"""
WITH d AS (SELECT DISTINCT source, lang, coalesce(text, '') AS text FROM documents)
SELECT source, lang, 'words-2' AS tokenizer, count(*)::BIGINT AS n_docs,
  sum(len(regexp_extract_all(text, '[A-Za-z0-9\x{C0}-\x{24F}]+|[^A-Za-z0-9\x{C0}-\x{24F}\x20\x09-\x0D]')))::BIGINT AS n_tokens
FROM d GROUP BY source, lang
"""

OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_words("translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "')")} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
near AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM near JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT a AS doc_id, b AS other FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a
), c AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, c.other) AS component_id,
  d.doc_id = least(d.doc_id, c.other) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h,
    row_number() OVER () AS r
  FROM documents
), k AS (
  SELECT *, count(*) OVER (PARTITION BY h) AS size, first_value(doc_id) OVER o AS keep_id, first_value(r) OVER o AS keep_r FROM d
  WINDOW o AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST, r)
)
SELECT doc_id, keep_id, size::BIGINT AS group_size, r = keep_r AS kept, h AS text_sha256 FROM k
"""

#: crc32 bit by bit, over the bytes of an ASCII text.
_CRC = """xor(4294967295::BIGINT, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT)),
  lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384::BIGINT))))"""

OP12 = rf"""
WITH RECURSIVE x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(key="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), y AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM x
), t AS (
  SELECT *, coalesce('c' || conv_id, 'n') AS c, substr(role, 1, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail
  FROM y
), f AS (
  SELECT *, CASE WHEN tail = '' THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
    WHEN tail NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
    lag(ini) OVER (PARTITION BY c ORDER BY i) || ini AS pair
  FROM t
), size AS (SELECT c, max(i) AS n FROM f GROUP BY c),
-- inserts from state to state: 0 nothing yet, 1 after s, 2 after u, 3 after a
ins(q, z, letters, added, paid) AS (VALUES
  (0, 0, '', [], 0), (0, 2, 'I', ['user:'], 5), (0, 3, 'II', ['user:', 'assistant:'], 10),
  (1, 1, '', [], 0), (1, 2, 'I', ['user:'], 5), (1, 3, 'II', ['user:', 'assistant:'], 10),
  (2, 2, '', [], 0), (2, 3, 'I', ['assistant:'], 5), (3, 3, '', [], 0), (3, 2, 'I', ['user:'], 5)
), step(q, ini, z, letter, role, paid) AS (
  SELECT q, NULL::VARCHAR, q, 'D', NULL::VARCHAR, 2 FROM range(4) r(q)
  UNION ALL VALUES (0, 's', 1, 'K', NULL, 0), (0, 'u', 2, 'K', NULL, 0), (1, 'u', 2, 'K', NULL, 0), (2, 'a', 3, 'K', NULL, 0), (3, 'u', 2, 'K', NULL, 0),
    (0, NULL, 2, 'R', 'user', 1), (1, NULL, 2, 'R', 'user', 1), (2, NULL, 3, 'R', 'assistant', 1), (3, NULL, 2, 'R', 'user', 1)
), walk(c, i, q, cost, audit, lines) AS (
  SELECT c, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM size
  UNION ALL
  SELECT c, i, q, cost, audit, lines FROM (
    SELECT w.c, w.i + 1 AS i, s.z::INTEGER AS q, w.cost + n.paid + s.paid + CASE WHEN fault = 't' AND letter <> 'D' THEN 5 ELSE 0 END AS cost,
      w.audit || n.letters || s.letter AS audit,
      w.lines || n.added::VARCHAR[] || CASE WHEN letter = 'D' THEN []::VARCHAR[] ELSE [coalesce(s.role, f.role) || ':' || f.text] END AS lines
    FROM walk w JOIN f ON f.c = w.c AND f.i = w.i + 1 JOIN ins n ON n.q = w.q
    JOIN step s ON s.q = n.z AND (s.ini IS NULL OR s.ini = f.ini) AND (s.letter = 'D' OR fault NOT IN ('b', 'd'))
  ) QUALIFY row_number() OVER (PARTITION BY c, q ORDER BY cost, audit) = 1
), done AS (
  SELECT w.c, w.cost + n.paid AS cost, w.audit || n.letters AS audit, array_to_string(w.lines || n.added::VARCHAR[], chr(10)) AS body
  FROM walk w JOIN size USING (c) JOIN ins n ON n.q = w.q AND n.z IN (0, 3) WHERE w.i = size.n
  QUALIFY row_number() OVER (PARTITION BY w.c ORDER BY w.cost + n.paid, w.audit || n.letters) = 1
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('c' || conv_id, 'n') AS c FROM conversations) LEFT JOIN counts USING (c) LEFT JOIN done USING (c)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"


OP13 = rf"""
WITH i AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_terms("text")}) AS t FROM benchmark)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS ts FROM documents),
s AS (SELECT count(*) AS big_n, sum(len(ts))::BIGINT AS big_l FROM d WHERE len(ts) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY r, t),
w AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s
), m AS (SELECT r, doc_id, 10 + (90 * len(ts) * big_n) // big_l AS m FROM d, s),
found AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN p USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM found JOIN m USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {
    "op1_mixture": OP1,
    "op2_repeats": OP2,
    "op3_chat": OP3,
    "op4_url_rules": _op4(),
    "op5_quality": OP5,
    "op7_warc": OP7,
    "op8_token_counts": OP8,
    "op9_near_duplicates": OP9,
    "op11_exact_duplicates": OP11,
    "op12_repair": OP12,
    "op13_lexical_search": OP13,
}
