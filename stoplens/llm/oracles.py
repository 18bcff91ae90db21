"""DuckDB SQL with the same result, where SQL can express a query on whole tables."""

from __future__ import annotations

from .merkle import FANOUT, FIELDS
from .mixing import MAX_EPOCHS, SEED, SHARE, WEIGHTS
from .quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS_FROM, stop_words

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _within(rule) -> str:
    bounds = [f"{rule.measure} >= {rule.low!r}"] if rule.low is not None else []
    bounds += [f"{rule.measure} <= {rule.high!r}"] if rule.high is not None else []
    return f"coalesce({' AND '.join(bounds)}, true)"


QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
),
g AS (
  SELECT r, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM s)
),
c AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
n AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM c) GROUP BY r
),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(list_aggregate(w, 'string_agg', '')), 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({", ".join(f"'{x}'" for x in stop_words())}))) AS stops,
    len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(trim(x, {BLANK}), '^[-*•]'))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(trim(x, {BLANK}), '(\.\.\.|…)$'))) AS ellipses
  FROM s LEFT JOIN n USING (r)
),
v AS (
  SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars,
    n_symbols / nullif(n_words, 0) AS symbols_per_word,
    CASE WHEN n_words >= {STOP_WORDS_FROM} THEN stops / n_words END AS stop_word_share,
    n_dup_lines / nullif(n_lines, 0) AS dup_line_share,
    bullets / nullif(n_lines, 0) AS bullet_line_share,
    ellipses / nullif(n_lines, 0) AS ellipsis_line_share,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_within(r) for r in RULES)} AS kept
FROM v
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM f
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c AS (SELECT r, vec_id, unnest(range(len(v))) AS d, unnest(v) AS x FROM v),
s AS (
  SELECT q.r, c.r AS other, q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.d = c.d AND q.r <> c.r
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# CRC-32 by bytes; an id's decimal digits are ASCII.
CRC = """
crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))
),
crc AS (
  SELECT doc_id AS crc_id, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) CROSS JOIN crc_table
)"""


def _framed(column: str) -> str:
    return f"coalesce(concat(octet_length(encode(CAST({column} AS VARCHAR))), ':', CAST({column} AS VARCHAR)), '-')"


def _leaf(**changed: str) -> str:
    return f"sha256(concat({', '.join(_framed(changed.get(c, c)) for c in FIELDS)}))"


def _steps(nodes: str) -> str:
    """Per node of a tree with several, its siblings' digests on both sides of a star."""
    run = f"PARTITION BY level, tree, i // {FANOUT} ORDER BY i ROWS BETWEEN"
    return f"""SELECT level, tree, i, concat(
    coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), ''), '*',
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')) AS step
  FROM {nodes} WHERE n > 1"""


def _levels(base: str, name: str) -> str:
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT level + 1, tree, (n + {FANOUT - 1}) // {FANOUT}, i // {FANOUT}, sha256(string_agg(h, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY level, tree, n, i // {FANOUT}
)"""


def _path(row: str, steps: str) -> str:
    """Steps of the rows of ``row`` (r, tree, i) upward."""
    return f"""SELECT r, list(step ORDER BY level) AS path FROM {row}
  JOIN {steps} AS s ON s.tree = {row}.tree AND s.i = {row}.i // CAST({FANOUT} ** s.level AS BIGINT) GROUP BY r"""


MERKLE = f"""
WITH RECURSIVE {CRC.lstrip()},
d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf()} AS leaf,
    CASE WHEN h % 2 = 0 THEN {_leaf(text="replace(text, chr(10), '')")} ELSE {_leaf()} END AS claimed
  FROM documents LEFT JOIN crc ON crc_id = doc_id
),
g AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d GROUP BY source),
l AS (
  SELECT r, d.doc_id, leaf, claimed, tree, n,
    row_number() OVER (PARTITION BY tree ORDER BY d.doc_id NULLS FIRST, leaf) - 1 AS i
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
),
{_levels("SELECT 0 AS level, tree, n, i, leaf AS h FROM l", "low")},
sub AS (SELECT tree, h AS subroot FROM low WHERE n = 1),
{_levels("SELECT 0 AS level, 0 AS tree, (SELECT count(*) FROM g) AS n, tree AS i, subroot AS h FROM sub", "high")},
low_steps AS ({_steps("low")}),
high_steps AS ({_steps("high")}),
low_paths AS ({_path("l", "low_steps")}),
tops AS (SELECT tree AS r, 0 AS tree, tree AS i FROM sub),
high_paths AS ({_path("tops", "high_steps")}),
p AS (
  SELECT doc_id, leaf, claimed, subroot, (SELECT h FROM high WHERE n = 1) AS root,
    list_concat(coalesce(lp.path, CAST([] AS VARCHAR[])), coalesce(hp.path, CAST([] AS VARCHAR[]))) AS path
  FROM l JOIN sub USING (tree) LEFT JOIN low_paths AS lp ON lp.r = l.r LEFT JOIN high_paths AS hp ON hp.r = l.tree
),
f AS (SELECT *, list_reduce(list_concat([claimed], path), lambda h, s: sha256(replace(s, '*', h))) AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '*', '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM f
"""

MIX = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST({MAX_EPOCHS} * sum(size) AS BIGINT) AS most,
    [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM d GROUP BY source
),
goal AS (SELECT {SHARE!r}::DOUBLE * sum(source_size) AS goal FROM s),
rounds AS (
  SELECT 0 AS turn, goal, goal AS rest, CAST(sum(weight) AS DOUBLE) AS weights FROM s CROSS JOIN goal GROUP BY goal
  UNION ALL
  SELECT turn + 1, goal, goal - spent, least_weights FROM (
    SELECT turn, goal, rest, weights, CAST(coalesce(sum(most) FILTER (most < rest * weight / weights), 0) AS DOUBLE) AS spent,
      CAST(sum(weight) FILTER (NOT most < rest * weight / weights) AS DOUBLE) AS least_weights
    FROM rounds CROSS JOIN s GROUP BY turn, goal, rest, weights)
  WHERE goal - spent <> rest OR least_weights <> weights
),
last_round AS (SELECT rest, weights FROM rounds ORDER BY turn DESC LIMIT 1),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), rest * weight / weights) AS target FROM s CROSS JOIN last_round),
b AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source
      ORDER BY sha256(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), '-'))), doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
  budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS taken
FROM b
"""

ORACLES = {
    "op1_exact_top_k": TOP_K,
    "op4_warc": WARC,
    "op6_quality_rules": QUALITY_RULES,
    "op12_merkle_manifest": MERKLE,
    "op13_source_mix": MIX,
}
