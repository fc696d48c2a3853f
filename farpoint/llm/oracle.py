"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from farpoint.llm import lexical, mixing, quality, rotation, urls

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
u AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
best AS (
  SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.host, p.path
           ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) AS k
  FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON p.host = b.host AND p.path = b.path
"""


def _rotation_sql() -> str:
    r = rotation
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '{r.UNKNOWN}') AS speaker, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '{r.UNKNOWN}'),
                       coalesce(text, '')) - 1 AS rank FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{r.SYSTEM}'),
m AS (SELECT t.conv_id, w.perspective, rank // {r.PART_TURNS} AS part, rank,
    speaker = w.perspective AS mine,
    '{r.START}' || CASE WHEN speaker = w.perspective THEN 'assistant'
      WHEN speaker = '{r.SYSTEM}' THEN '{r.SYSTEM}' ELSE 'user name=' || speaker END || chr(10) AS head,
    text || '{r.END}' AS body
  FROM t JOIN who w ON t.conv_id IS NOT DISTINCT FROM w.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS body_at FROM m)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (mine) AS n_assistant,
  string_agg(head || body || chr(10), '' ORDER BY rank) AS text,
  coalesce(string_agg(
    body_at::BIGINT::VARCHAR || ':' || (body_at + length(body))::BIGINT::VARCHAR, ',' ORDER BY rank)
    FILTER (mine), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""


def mix_sql(docs: str = "documents") -> str:
    w = ", ".join(f"{x}::DOUBLE" for x in mixing.WEIGHTS)
    m = mixing
    return f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM {docs}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM per),
wt AS (SELECT *, [{w}][(src % {len(m.WEIGHTS)}) + 1] AS w,
         (source_size * {m.MAX_PASSES})::DOUBLE AS cap FROM num),
run AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS s_all, sum(w) OVER () AS w_all,
         coalesce(sum(cap) OVER b, 0) AS c_before, coalesce(sum(w) OVER b, 0) AS w_before FROM wt
       WINDOW b AS (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
st AS (SELECT *, cap * (w_all - w_before) <= w * (s_all - c_before) AS stopped FROM run),
tg AS (SELECT *, CASE WHEN stopped THEN cap ELSE w * (s_all
         - coalesce(sum(cap) FILTER (stopped) OVER (), 0))
         / sum(w) FILTER (NOT stopped) OVER () END AS target FROM st),
sh AS (SELECT src, source, source_size, target, s_all::BIGINT AS total,
         sum(target) OVER (ORDER BY src) / nullif(sum(target) OVER (), 0) AS hi FROM tg),
src AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY src), 0) AS lo,
          {m.BLOCK_WORDS}::BIGINT AS bw FROM sh),
slots AS (SELECT i AS slot, ((i * {m.GOLDEN}) % 4294967296) / 4294967296 AS point
  FROM (SELECT unnest(range((total + bw - 1) // bw)) AS i
        FROM (SELECT max(total) AS total, max(bw) AS bw FROM src))),
ranked AS (SELECT src, slot, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS rank,
    (source_size + bw - 1) // bw AS nb
  FROM slots JOIN src ON point >= lo AND point < hi),
times AS (SELECT src, rank % nb AS block, count(*) AS times
  FROM ranked WHERE rank // nb < {m.MAX_PASSES} GROUP BY 1, 2),
placed AS (SELECT d.doc_id, d.size, s.src, s.source_size, s.target, s.bw,
    row_number() OVER () AS row_id,
    coalesce(sum(d.size) OVER (PARTITION BY s.src
      ORDER BY md5('{m.SEED}/' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes d JOIN src s ON d.source IS NOT DISTINCT FROM s.source),
pieces AS (SELECT row_id, src, start, size, bw,
    unnest(range(start // bw, (start + size - 1) // bw + 1)) AS block
  FROM placed WHERE size > 0),
taken AS (SELECT p.row_id, sum((least(p.start + p.size, (p.block + 1) * bw)
    - greatest(p.start, p.block * bw)) * t.times)::BIGINT AS taken
  FROM pieces p JOIN times t ON p.src = t.src AND p.block = t.block GROUP BY 1)
SELECT p.doc_id, p.size, p.source_size, round(p.target, 6) AS target,
       coalesce(t.taken, 0) AS taken
FROM placed p LEFT JOIN taken t ON p.row_id = t.row_id
"""


def quality_sql(docs: str = "documents") -> str:
    q = quality
    margin = " ".join(f"WHEN measure = '{k}' THEN {v}" for k, v in q.MARGIN.items())

    def fences(keys, name):
        by = "".join(f"{k}, " for k in keys)
        return f"""
{name}_m AS (SELECT {by}measure, bucket, sum(n) AS n FROM sketch GROUP BY {by}measure, bucket),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY {by}measure) AS al FROM {name}_m),
{name}_q AS (SELECT {by}measure, max(al) AS n, min(bucket) FILTER (upto * 4 >= al) AS q1,
               min(bucket) FILTER (upto * 4 >= al * 3) AS q3 FROM {name}_c GROUP BY {by}measure),
{name}_f AS (SELECT {by}measure, n, q3 + greatest({q.FENCE} * (q3 - q1),
               CASE {margin} END) AS fence FROM {name}_q)"""

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text
  FROM {docs}),
t AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w FROM d),
lines AS (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY row_id),
gram AS (SELECT row_id, unnest(range(1, len(w) - 1)) AS i, w FROM t WHERE len(w) >= 3),
cnt AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w[i], w[i+1], w[i+2]) AS c FROM gram),
rep AS (SELECT row_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS j FROM cnt WHERE c >= 2) GROUP BY row_id),
base AS (SELECT t.row_id, doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN dup USING (row_id) LEFT JOIN rep USING (row_id)),
m AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words
      AS base_failed,
    CASE WHEN word_chars > 0 THEN (1000 * n_symbols) // word_chars ELSE 0 END AS symbol_ratio,
    CASE WHEN n_lines > 0 THEN (1000 * n_dup_lines) // n_lines ELSE 0 END AS dup_line_ratio FROM base),
sketch AS (SELECT lang, source, measure, bucket, count(*) AS n FROM (
    SELECT lang, source, 'symbol_ratio' AS measure, symbol_ratio AS bucket FROM m WHERE NOT base_failed
    UNION ALL SELECT lang, source, 'dup_line_ratio', dup_line_ratio FROM m WHERE NOT base_failed)
  GROUP BY ALL),{fences(["lang", "source"], "own")},{fences(["lang"], "lng")},{fences([], "al")},
lim AS (SELECT o.lang, o.source, o.measure, CASE WHEN o.n >= {q.MIN_GROUP} THEN o.fence
    WHEN l.n >= {q.MIN_GROUP} THEN l.fence ELSE a.fence END AS fence
  FROM own_f o JOIN lng_f l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure
  JOIN al_f a ON o.measure = a.measure)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND symbol_ratio <= coalesce(s.fence, symbol_ratio)
    AND dup_line_ratio <= coalesce(u.fence, dup_line_ratio) AS kept
FROM m
LEFT JOIN lim s ON m.lang IS NOT DISTINCT FROM s.lang AND m.source IS NOT DISTINCT FROM s.source
  AND s.measure = 'symbol_ratio'
LEFT JOIN lim u ON m.lang IS NOT DISTINCT FROM u.lang AND m.source IS NOT DISTINCT FROM u.source
  AND u.measure = 'dup_line_ratio'
"""


def _trie_sql() -> str:
    return f"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS rank
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT conv_id, count(*) AS n, conv_id::VARCHAR AS s FROM t GROUP BY conv_id),
crc(conv_id, s, i, c) AS (
  SELECT conv_id, s, 0, 4294967295::BIGINT FROM size
  UNION ALL
  SELECT conv_id, s, i + 1, xor(b >> 1, 3988292384 * (b & 1)) FROM (
    SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, ord(s[i // 8 + 1])::BIGINT) ELSE c END AS b
    FROM crc WHERE i < 8 * length(s))),
convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 20 AS head, xor(c.c, 4294967295) % 4 AS k,
    least(xor(c.c, 4294967295) % 4, coalesce(h.n, 0)) AS taken
  FROM crc c LEFT JOIN size h ON h.conv_id = c.conv_id - c.conv_id % 20 WHERE c.i = 8 * length(c.s)),
turns AS (
  SELECT t.conv_id, rank - k + taken AS pos, role, text FROM t JOIN convs USING (conv_id) WHERE rank >= k
  UNION ALL
  SELECT c.conv_id, rank, role, text FROM convs c JOIN t ON t.conv_id = c.head WHERE rank < k),
prefix AS (
  SELECT conv_id, pos + 1 AS depth, list(md5(length(role) || ':' || role || text)) OVER (
      PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path,
    len(regexp_extract_all(text, '{WORD}')) AS words FROM turns
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
deep AS (SELECT conv_id, max(depth) AS depth FROM prefix GROUP BY conv_id),
nodes AS (
  SELECT p.path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)
      FILTER (p.depth = d.depth), '')) AS ends_sha256
  FROM prefix p JOIN deep d USING (conv_id) GROUP BY p.path, p.depth),
kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k
  ON n.path = k.path AND n.depth = k.depth),
below AS (
  SELECT path[1:d] AS path, d AS depth, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON n.path = b.path AND n.depth = b.depth
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1] AND p.depth = n.depth - 1
"""


def _search_sql() -> str:
    x = lexical
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all({lower}, '{TERM}')) AS terms
  FROM benchmark),
asked AS (SELECT q, item_id, unnest(terms) AS term FROM items),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{TERM}') AS terms FROM documents),
having_terms AS (SELECT *, len(terms) AS n FROM d WHERE len(terms) > 0),
al AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM having_terms),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM having_terms)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
wt AS (SELECT term, floor({x.WEIGHT_SCALE} * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), al),
part AS (SELECT r, term, w * (({x.PART_SCALE} * tf) // ({x.TF_SCALE} * tf + {x.LENGTH_SCALE} *
    (100 - {x.LENGTH_PART} + ({x.LENGTH_PART} * n * n_docs) // n_terms))) AS gain
  FROM tf JOIN having_terms USING (r) JOIN wt USING (term), al),
scored AS (SELECT q, item_id, r, sum(gain)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY q, item_id, r),
ranked AS (SELECT q, item_id, doc_id, score, row_number() OVER (
    PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN having_terms USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


ORACLE_SQL: dict[str, str] = {
    "op3_perspective_rotation": _rotation_sql(),
    "op4_url_filters": _url_sql(),
    "op7_mix_sources": mix_sql(),
    "op10_quality_rules": quality_sql(),
    "op12_prefix_trie": _trie_sql(),
    "op13_lexical_search": _search_sql(),
}
