"""Independent DuckDB SQL for the registered queries.

The views ``events orders documents embeddings part ...`` are the driver's
parquet tables.  Queries without an entry get a rows-only check.
"""

from __future__ import annotations

from farpoint.plans import params as P

# lines of each document (one final newline ends the last line), then tokens
# with Java split(" ") rules: trailing empty tokens dropped, "" -> [""],
# all-space line -> []
_LINES = """
lines AS (
  SELECT doc_id, UNNEST(string_split(
           CASE WHEN ends_with(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END,
           chr(10))) AS line
  FROM documents
)"""

_TOKENS = _LINES + """,
toks AS (
  SELECT doc_id, UNNEST(CASE WHEN length(line) > 0 AND rtrim(line, ' ') = ''
                             THEN []::VARCHAR[]
                             ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines
)"""

_WORD_COUNT = "WITH" + _TOKENS + """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM toks GROUP BY word"""

ORACLE_SQL: dict[str, str] = {
    "class_count": """
SELECT event_type AS class, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY event_type ORDER BY class""",

    "class_count_two_round": f"""
WITH h AS (
  SELECT CAST(o_orderkey % {P.K_PARTS} AS INTEGER) AS part, o_orderpriority AS class, count(*) AS n
  FROM orders GROUP BY 1, 2)
SELECT class, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY class ORDER BY class""",

    "class_histogram_by_part": f"""
SELECT CAST(((o_orderkey % {P.K_PARTS}) + {P.K_PARTS}) % {P.K_PARTS} AS INTEGER) AS part,
       o_orderpriority AS class, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1, 2""",

    "class_record_parse": """
SELECT CAST(event_id AS BIGINT) AS idx, event_type AS class FROM events""",

    "max_partition_deterministic": f"""
SELECT CAST(coalesce(max(n), 0) AS BIGINT) AS max_partition_size
FROM (SELECT ((o_orderkey % {P.K_PARTS}) + {P.K_PARTS}) % {P.K_PARTS} AS part, count(*) AS n
      FROM orders GROUP BY 1)""",

    "most_frequent_class": """
SELECT lang AS class, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY lang ORDER BY n DESC, class LIMIT 1""",

    "row_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM documents",

    "line_count": "WITH" + _LINES + "\nSELECT CAST(count(*) AS BIGINT) AS n FROM lines",

    "doc_term_count": "WITH" + _TOKENS + """
SELECT doc_id, word, CAST(count(*) AS BIGINT) AS n FROM toks GROUP BY doc_id, word""",

    "word_count": _WORD_COUNT,

    "word_count_salted": _WORD_COUNT,

    "distinct_words": "WITH" + _TOKENS + """
SELECT CAST(count(DISTINCT word) AS BIGINT) AS n_distinct FROM toks""",

    "avg_distinct_word_length": "WITH" + _TOKENS + """,
wc AS (SELECT DISTINCT word FROM toks)
SELECT CAST(CASE WHEN count(*) > 0 THEN
         sum(length(word) + length(regexp_replace(word, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))
         // count(*) END AS BIGINT) AS avg_len
FROM wc""",
}

# ---- points ------------------------------------------------------------------

_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

_SAMPLE = f"""sample AS (
  SELECT vec_id AS id FROM embeddings
  ORDER BY md5(concat_ws(':', '{P.SAMPLE_SEED}', CAST(vec_id AS VARCHAR))), vec_id
  LIMIT {P.SAMPLE_K})"""

# farthest-first from the smallest id (or a given start); stop when every
# point is a center's duplicate


def _ff(start: str = "SELECT min(id) AS id FROM pts") -> str:
    return f"""ff(step, id, ids) AS (
  SELECT 0, s.id, [s.id] FROM ({start}) s
  UNION ALL
  SELECT ff.step + 1, nx.id, list_append(ff.ids, nx.id)
  FROM ff, LATERAL (
    SELECT p.id, min(list_distance(p.v, c.v)) AS md
    FROM pts p, pts c
    WHERE list_contains(ff.ids, c.id)
    GROUP BY p.id
    ORDER BY md DESC, p.id
    LIMIT 1) nx
  WHERE ff.step + 1 < {P.CENTERS_K} AND nx.md > 0
),
cen AS (SELECT ff.step, p.id, p.v FROM ff JOIN pts p ON p.id = ff.id)"""


_FF = _ff()


def _coreset(k: int, l_parts: int) -> str:
    return f"""ppts AS (SELECT CAST(((id % {l_parts}) + {l_parts}) % {l_parts} AS INTEGER) AS part, id, v FROM pts),
cs(part, step, id, ids) AS (
  SELECT part, 0, min(id), [min(id)] FROM ppts GROUP BY part
  UNION ALL
  SELECT cs.part, cs.step + 1, nx.id, list_append(cs.ids, nx.id)
  FROM cs, LATERAL (
    SELECT p.id, min(list_distance(p.v, c.v)) AS md
    FROM ppts p JOIN ppts c ON c.part = p.part
    WHERE p.part = cs.part AND list_contains(cs.ids, c.id)
    GROUP BY p.id
    ORDER BY md DESC, p.id
    LIMIT 1) nx
  WHERE cs.step + 1 < {k} AND nx.md > 0
)"""


def _greedy(src: str, k: int) -> str:
    """Greedy farthest pairs over the view ``src(id, v)``, picks in ``picks``."""
    return f"""g(t, i, j, used) AS (
  SELECT 0, NULL::BIGINT, NULL::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT g.t + 1, b.i, b.j, list_concat(g.used, [b.i, b.j])
  FROM g, LATERAL (
    SELECT a.id AS i, c.id AS j
    FROM {src} a JOIN {src} c ON a.id < c.id
    WHERE NOT list_contains(g.used, a.id) AND NOT list_contains(g.used, c.id)
    ORDER BY list_distance(a.v, c.v) DESC, i, j
    LIMIT 1) b
  WHERE g.t < {k // 2}
),
last_used AS (SELECT used FROM g ORDER BY t DESC LIMIT 1),
picks AS (
  SELECT 2 * t - 1 AS pick, i AS id FROM g WHERE t > 0
  UNION ALL
  SELECT 2 * t AS pick, j AS id FROM g WHERE t > 0
  UNION ALL
  SELECT {k} AS pick, min(s.id) AS id FROM {src} s, last_used u
  WHERE {k % 2} = 1 AND NOT list_contains(u.used, s.id)
  HAVING min(s.id) IS NOT NULL
)"""


ORACLE_SQL.update({
    "point_parse": """
SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x0, CAST(p_retailprice AS DOUBLE) AS x1 FROM part""",

    "max_pairwise_distance": f"""
WITH {_PTS}
SELECT round(coalesce(max(list_distance(a.v, b.v)), 0), 6) AS max_dist
FROM pts a JOIN pts b ON a.id < b.id
WHERE NOT isnan(list_distance(a.v, b.v))""",

    "avg_pairwise_distance": f"""
WITH {_PTS}
SELECT round(avg(list_distance(a.v, b.v)), 6) AS avg_dist
FROM pts a JOIN pts b ON a.id < b.id""",

    "random_sample_k": f"WITH {_SAMPLE}\nSELECT id FROM sample",

    "sample_complement": f"""
WITH {_SAMPLE}
SELECT vec_id AS id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM sample)""",

    "sample_max_distance": f"""
WITH {_PTS}, {_SAMPLE}
SELECT round(coalesce(max(list_distance(r.v, s.v)), 0), 6) AS max_dist
FROM pts r, pts s
WHERE s.id IN (SELECT id FROM sample) AND r.id NOT IN (SELECT id FROM sample)""",

    "farthest_first_centers": f"""
WITH RECURSIVE {_PTS}, {_FF}
SELECT CAST(step AS INTEGER) AS step, CAST(id AS BIGINT) AS id FROM ff""",

    "nearest_center": f"""
WITH RECURSIVE {_PTS}, {_FF},
ranked AS (
  SELECT p.id, c.id AS center_id, list_distance(p.v, c.v) AS dist,
         row_number() OVER (PARTITION BY p.id ORDER BY list_distance(p.v, c.v), c.step) AS rn
  FROM pts p, cen c)
SELECT id, center_id, round(dist, 6) AS dist FROM ranked WHERE rn = 1""",

    "nearest_center_sizes": f"""
WITH RECURSIVE {_PTS}, {_FF},
ranked AS (
  SELECT p.id, c.id AS center_id,
         row_number() OVER (PARTITION BY p.id ORDER BY list_distance(p.v, c.v), c.step) AS rn
  FROM pts p, cen c)
SELECT center_id, CAST(count(*) AS BIGINT) AS n FROM ranked WHERE rn = 1 GROUP BY center_id""",

    "farthest_first_random_start": f"""
WITH RECURSIVE {_PTS}, {_SAMPLE.replace(f"LIMIT {P.SAMPLE_K}", "LIMIT 1")},
{_ff("SELECT id FROM sample")}
SELECT CAST(step AS INTEGER) AS step, CAST(id AS BIGINT) AS id FROM ff""",

    "kcenter_max_distance": f"""
WITH RECURSIVE {_PTS}, {_FF}
SELECT round(coalesce(max(list_distance(a.v, b.v)), 0), 6) AS max_dist
FROM cen a JOIN cen b ON a.id < b.id""",

    "partition_coreset": f"""
WITH RECURSIVE {_PTS}, {_coreset(P.DIVERSITY_K, P.DIVERSITY_L)}
SELECT part, CAST(step AS INTEGER) AS step, CAST(id AS BIGINT) AS id FROM cs""",

    "greedy_pairs": f"""
WITH RECURSIVE {_PTS}, {_greedy("pts", P.GREEDY_K)}
SELECT CAST(pick AS INTEGER) AS pick, CAST(id AS BIGINT) AS id FROM picks""",

    "diversity_two_round": f"""
WITH RECURSIVE {_PTS}, {_coreset(P.DIVERSITY_K, P.DIVERSITY_L)},
core AS (SELECT p.id, p.v FROM pts p WHERE p.id IN (SELECT id FROM cs)),
{_greedy("core", P.DIVERSITY_K)}
SELECT CAST(pick AS INTEGER) AS pick, CAST(id AS BIGINT) AS id FROM picks""",

    "diversity_score": f"""
WITH RECURSIVE {_PTS}, {_coreset(P.DIVERSITY_K, P.DIVERSITY_L)},
core AS (SELECT p.id, p.v FROM pts p WHERE p.id IN (SELECT id FROM cs)),
{_greedy("core", P.DIVERSITY_K)},
sol AS (SELECT p.id, p.v FROM pts p WHERE p.id IN (SELECT id FROM picks))
SELECT round(avg(list_distance(a.v, b.v)), 6) AS avg_dist
FROM sol a JOIN sol b ON a.id < b.id""",
})


_ORDERS_PTS = "pts AS (SELECT o_orderkey AS id, [CAST(o_custkey AS DOUBLE), o_totalprice] AS v FROM orders)"

ORACLE_SQL.update({
    "max_pairwise_distance_orders": f"""
WITH {_ORDERS_PTS}
SELECT round(coalesce(max(list_distance(a.v, b.v)), 0), 6) AS max_dist
FROM pts a JOIN pts b ON a.id < b.id""",

    "diversity_orders": f"""
WITH RECURSIVE {_ORDERS_PTS}, {_coreset(P.ORDERS_DIV_K, P.ORDERS_DIV_L)},
core AS (SELECT p.id, p.v FROM pts p WHERE p.id IN (SELECT id FROM cs)),
{_greedy("core", P.ORDERS_DIV_K)}
SELECT CAST(pick AS INTEGER) AS pick, CAST(id AS BIGINT) AS id FROM picks""",
    # diversity_baseline_config: no SQL -- the recursive form takes minutes at
    # k=100, L=16; tests check the operator against a brute-force model.
})

# the plans for large inputs must give what the others give
for _name, _same in [("max_pairwise_distance_tiled", "max_pairwise_distance"),
                     ("avg_pairwise_distance_tiled", "avg_pairwise_distance"),
                     ("partition_coreset_lockstep", "partition_coreset"),
                     ("greedy_pairs_rounds", "greedy_pairs"),
                     ("greedy_pairs_steps", "greedy_pairs")]:
    ORACLE_SQL[_name] = ORACLE_SQL[_same]

ORACLE_SQL["kcenter_random_start"] = f"""
WITH RECURSIVE {_PTS}, {_SAMPLE.replace(f"LIMIT {P.SAMPLE_K}", "LIMIT 1")},
{_ff("SELECT id FROM sample")}
SELECT round(coalesce(max(list_distance(a.v, b.v)), 0), 6) AS max_dist
FROM cen a JOIN cen b ON a.id < b.id"""

ORACLE_SQL["max_partition_spark"] = f"""
SELECT count(*) AS n, CAST({P.K_PARTS} AS BIGINT) AS n_parts, true AS within_bounds FROM orders"""


def _tree_level(i: int, src: str, k: int) -> str:
    """Coreset of every part of the view ``src(part, id, v)``, as ``c<i>(part, step, id, ids)``."""
    return f"""c{i}(part, step, id, ids) AS (
  SELECT part, 0, min(id), [min(id)] FROM {src} GROUP BY part
  UNION ALL
  SELECT c{i}.part, c{i}.step + 1, nx.id, list_append(c{i}.ids, nx.id)
  FROM c{i}, LATERAL (
    SELECT p.id, min(list_distance(p.v, c.v)) AS md
    FROM {src} p JOIN {src} c ON c.part = p.part
    WHERE p.part = c{i}.part AND list_contains(c{i}.ids, c.id)
    GROUP BY p.id
    ORDER BY md DESC, p.id
    LIMIT 1) nx
  WHERE c{i}.step + 1 < {k} AND nx.md > 0
)"""


def _tree() -> tuple[str, str]:
    """(the rounds as CTEs, name of the last): as many as leave at most TREE_ROWS points."""
    ctes = [f"r0 AS (SELECT CAST(id % {P.TREE_L} AS INTEGER) AS part, id, v FROM pts)"]
    i, parts = 0, P.TREE_L
    while True:
        ctes.append(_tree_level(i, f"r{i}", P.DIVERSITY_K))
        if parts == 1 or parts * P.DIVERSITY_K <= P.TREE_ROWS:      # every part has k points here
            return ", ".join(ctes), f"c{i}"
        parts = -(-parts // P.TREE_FAN_IN)
        ctes.append(f"r{i + 1} AS (SELECT CAST(c.part // {P.TREE_FAN_IN} AS INTEGER) AS part, p.id, p.v "
                    f"FROM c{i} c JOIN pts p ON p.id = c.id)")
        i += 1


_TREE, _LAST = _tree()

ORACLE_SQL.update({
    "coreset_tree": f"""
WITH RECURSIVE {_PTS}, {_TREE}
SELECT part, CAST(step AS INTEGER) AS step, CAST(id AS BIGINT) AS id FROM {_LAST}""",

    "diversity_tree": f"""
WITH RECURSIVE {_PTS}, {_TREE},
core AS (SELECT p.id, p.v FROM pts p WHERE p.id IN (SELECT id FROM {_LAST})),
{_greedy("core", P.DIVERSITY_K)}
SELECT CAST(pick AS INTEGER) AS pick, CAST(id AS BIGINT) AS id FROM picks""",

    "farthest_first_lazy": f"""
WITH RECURSIVE {_ORDERS_PTS}, {_FF}
SELECT CAST(step AS INTEGER) AS step, CAST(id AS BIGINT) AS id FROM ff""",

    "max_pairwise_distance_balls": ORACLE_SQL["max_pairwise_distance"],

    "nearest_center_many": f"""
WITH {_ORDERS_PTS},
cen AS (SELECT id, v FROM pts
  ORDER BY md5(concat_ws(':', '{P.SAMPLE_SEED}', CAST(id AS VARCHAR))), id LIMIT {P.MANY_CENTERS}),
best AS (SELECT p.id, min(struct_pack(d := list_distance(p.v, c.v), c := c.id)) AS b FROM pts p, cen c GROUP BY p.id)
SELECT CAST(id AS BIGINT) AS id, CAST(b.c AS BIGINT) AS center_id, round(b.d, 6) AS dist FROM best""",
})
