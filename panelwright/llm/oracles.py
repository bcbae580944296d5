"""DuckDB SQL for the numbered queries that SQL can express, over the same tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}')"


# Host and path of a url column; rules by length, the longest first.
PARTS = f"""CASE WHEN contains({{0}}, '://') THEN {LOWER.format("regexp_extract(regexp_replace({0}, '(?s)^.*?://', ''), '^[^/?#]*')")}
     ELSE '' END AS host, CASE WHEN contains({{0}}, '://')
     THEN regexp_extract(regexp_replace({{0}}, '(?s)^.*?://', ''), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path"""
RULES = """rules(rule, host, path, verdict) AS (VALUES ('com/', 'com', '/', 'allow'),
  ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block'))"""
ADDRESS = f"{LOWER.format("regexp_extract(regexp_replace({0}, '(?s)^.*?://', ''), '^[^/?#]*')")} || regexp_extract({{0}}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
# A declared target as an absolute url, and its path without dot segments.
HTML = "regexp_replace(coalesce(html, ''), '(?s)<!--.*?(?:-->|$)', '', 'g')"
FRONT = f"""'http://' || {LOWER.format("regexp_extract(regexp_replace({0}, '(?s)^.*?://', ''), '^[^/?#]*')")}"""
INNER = "regexp_extract(regexp_replace({0}, '(?s)^.*?://', ''), '(?s)^[^/?#]*([^?#]*)', 1)"


def resolved(target: str, base: str) -> str:
    front, inner = FRONT.format(base), INNER.format(base)
    folder = f"coalesce(nullif(regexp_extract({inner}, '(?s)^(.*/)', 1), ''), '/')"
    return f"""CASE WHEN regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {target} WHEN starts_with({target}, '//') THEN 'http:' || {target}
    WHEN starts_with({target}, '/') THEN {front} || {target} WHEN starts_with({target}, '?') THEN {front} || coalesce(nullif({inner}, ''), '/') || {target}
    ELSE {front} || {folder} || {target} END"""


def dotless(whole: str) -> str:
    inner = f"regexp_extract({whole}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    steps = f"string_split(regexp_replace({inner}, '(/\\.{{1,2}})$', '\\1/'), '/')"
    return f"""regexp_extract({whole}, '(?s)^(.*?://[^/?#]*)', 1) || CASE WHEN contains({inner}, '/.') THEN array_to_string(list_reduce(
      list_transform({steps}, lambda s: [s]), lambda done, s: CASE WHEN s[1] = '..' THEN done[1:greatest(len(done) - 1, 1)] WHEN s[1] = '.' THEN done
      ELSE list_concat(done, s) END), '/') ELSE {inner} END || regexp_extract({whole}, '(?s)^.*?://[^?#]*(.*)$', 1)"""


URL_FILTER = f"""WITH RECURSIVE {RULES},
p AS (SELECT row_number() OVER () AS rid, page_id, url, {HTML} AS html, {PARTS.format('url')} FROM pages),
based AS (SELECT *, replace(regexp_extract(html, '(?is)<base\\b[^>]*?\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), '&amp;', '&') AS named FROM p WHERE contains(url, '://')),
rooted AS (SELECT rid, url, html, CASE WHEN named = '' THEN url ELSE {resolved('named', 'url')} END AS base FROM based),
tags AS (SELECT rid, url, base, regexp_extract(unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>')),
           '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS t FROM rooted
  UNION ALL SELECT rid, url, base, regexp_extract(unnest(regexp_extract_all(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>')),
           '(?is)\\burl\\s*=\\s*[''"]?([^"''\\s>]+)', 1) FROM rooted),
aim AS (SELECT url, base, regexp_replace(t, '(?i)&amp;', '&', 'g') AS t FROM tags WHERE t <> '' AND NOT starts_with(t, '#')),
whole AS (SELECT url, {resolved('t', 'base')} AS t FROM aim),
straight AS (SELECT url, {dotless('t')} AS t FROM whole),
one AS (SELECT {ADDRESS.format('url')} AS a, {ADDRESS.format('t')} AS b FROM straight),
edges AS (SELECT a, b FROM one WHERE a <> b UNION SELECT b, a FROM one WHERE a <> b),
nodes AS (SELECT DISTINCT a, {PARTS.format("('://' || a)")} FROM edges),
judged AS (SELECT a, first(verdict ORDER BY length(rule) DESC) AS verdict FROM nodes n JOIN rules r
  ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path) GROUP BY a),
bad(a) AS (SELECT a FROM judged WHERE verdict = 'block' UNION SELECT e.b FROM bad JOIN edges e USING (a)),
own AS (SELECT rid, first(rule ORDER BY length(rule) DESC) AS rule, first(verdict ORDER BY length(rule) DESC) AS verdict FROM p JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN contains(url, '://') AND {ADDRESS.format('url')} IN (SELECT a FROM bad)
    THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN own USING (rid)"""

MIXING = f"""WITH d AS (SELECT doc_id, source, len({words("coalesce(text, '')")})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * 3.0::DOUBLE AS cap FROM s),
w AS (SELECT *, [1, 2, 3][place % 3 + 1]::DOUBLE AS weight FROM p),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS remaining,
             sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS shared
      FROM w WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CASE WHEN remaining / shared * weight <= cap THEN remaining / shared END AS level FROM o),
f AS (SELECT *, first_value(level IGNORE NULLS) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final FROM l),
t AS (SELECT source, source_size, coalesce(final * weight, cap) AS target,
             ('0x' || substr(md5('17:' || coalesce('s' || source, 'n')), 1, 4))::INTEGER / 65536.0::DOUBLE AS u FROM f),
k AS (SELECT d.doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
             (row_number() OVER (PARTITION BY d.source ORDER BY size, d.doc_id NULLS FIRST) - 1)::DOUBLE AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * least(floor(rate * (k + 1) + u) - floor(rate * k + u), 3))::BIGINT AS taken FROM k"""

NEAR_DUP = f"""WITH RECURSIVE t AS (SELECT doc_id, {words(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM t),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
meet AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM meet JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {1 + 10 * i}, 10))::BIGINT >> {35 - 5 * j}) & 31)::INTEGER + 1, 1)"
    for i in range(4) for j in range(8))
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {DIGITS} AS payload_digest,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to FROM p JOIN m USING (h)"""

RULES_OF_QUALITY = f"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM rep, range(5) AS r(j) GROUP BY rid),
raw AS (SELECT rid, source, md5(text) AS digest, len(w) AS total, unnest(string_split(text, chr(10))) AS x FROM t),
ln AS (SELECT *, array_to_string({words(LOWER.format('x'))}, ' ') AS line, len({words('x')}) AS n FROM raw WHERE len({words('x')}) > 0),
dup AS (SELECT rid, count(*) - count(DISTINCT x) AS n FROM ln GROUP BY rid),
lw AS (SELECT rid, source, digest, total, line, sum(n) AS n FROM ln GROUP BY ALL),
u AS (SELECT DISTINCT source, digest, total, line, n FROM lw),
bad AS (SELECT source, line FROM u GROUP BY ALL HAVING count(*) > 50),
lost AS (SELECT rid, sum(n) AS n FROM lw JOIN bad b ON lw.source IS NOT DISTINCT FROM b.source AND lw.line = b.line GROUP BY rid),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, lost.n AS lost, (len(w) - coalesce(lost.n, 0))::BIGINT AS left_words
      FROM t LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (lost IS NULL OR (100 * left_words >= 30 * n_words AND left_words >= 5)) AS kept, left_words FROM v"""

# Unsigned crc32 of a short ASCII text, bit by bit.
CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""
PREFIX_TRIE = f"""WITH t AS (SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    octet_length(encode(coalesce(text, '')))::BIGINT AS nb FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS pos FROM t),
n AS (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id),
h AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base, {CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM n),
k AS (SELECT h.conv_id, base, h, least(h, coalesce(b.n, 0)) AS k, least(h, coalesce(b.n, 0)) + greatest(h.n - h, 0) AS size FROM h LEFT JOIN n b ON b.conv_id = h.base),
r AS (SELECT k.conv_id, size, pos AS depth, mark, nb FROM k JOIN o ON o.conv_id = k.base AND pos <= k.k
  UNION ALL SELECT k.conv_id, size, pos - h + k.k, mark, nb FROM k JOIN o ON o.conv_id = k.conv_id AND pos > h),
m AS (SELECT conv_id, size, depth, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path, nb FROM r
  UNION ALL SELECT conv_id, size, 0, '', 0 FROM k),
g AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(nb) AS nb,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256 FROM m GROUP BY depth, path),
c AS (SELECT depth - 1 AS depth, left(path, 32 * (depth - 1)::INTEGER) AS path, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
x AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN c USING (depth, path)),
u AS (SELECT e AS depth, left(path, 32 * e::INTEGER) AS path, sum((n_children = 0)::INTEGER) AS n_leaves, sum((n_convs - 1) * nb) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM x) GROUP BY ALL)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM x JOIN u USING (depth, path) LEFT JOIN g p ON p.depth = x.depth - 1 AND p.path = left(x.path, 32 * (x.depth - 1)::INTEGER)"""

UNITS = "array_to_string(w[{0}:{1}], '')"
FILL_IN_MIDDLE = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(x, i, 8))::BIGINT) AS h FROM d),
n AS (SELECT *, len(w) AS n, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a, greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
         WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, {UNITS.format("1", "a")} AS prefix, {UNITS.format("a + 1", "b")} AS middle, {UNITS.format("b + 1", "n")} AS suffix FROM n)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""

ORACLES = {
    "op1_url_filter": URL_FILTER,
    "op4_mixing": MIXING,
    "op7_near_dup": NEAR_DUP,
    "op8_warc": WARC,
    "op10_quality_rules": RULES_OF_QUALITY,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
