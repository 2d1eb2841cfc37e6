"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

from gridloom.llm.licenses import NOTICES, PHRASES, THRESHOLD, _needed
from gridloom.llm.mixing import SLOPES, WEIGHTS

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _licenses() -> str:
    starts = [
        (label, " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split()))) for label, phrase in PHRASES
    ]
    found = ", ".join(f"[i FOR i IN range(len(w)) IF {c}] AS s{n}" for n, (_, c) in enumerate(starts))
    base = ", ".join(f"CASE WHEN len(s{n}) > 0 THEN '{label}' END" for n, (label, _) in enumerate(starts))
    places = " || ".join(f"s{n}" for n in range(len(starts)))
    notices = ", ".join(
        f"({n}, '{label}', {sorted(set(t.split()))}, {_needed(len(set(t.split())), THRESHOLD)})" for n, (label, t) in enumerate(NOTICES)
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (SELECT r, doc_id, regexp_extract_all(t, '{_WORD}') AS w FROM d
), p AS (SELECT r, doc_id, len(w) AS n_words, {found} FROM w
), q AS (SELECT r, doc_id, n_words, {places} AS s, [x FOR x IN [{base}] IF x IS NOT NULL] AS b FROM p
), notices(n, label, tokens, k) AS (VALUES {notices}
), lines AS (
  SELECT r, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{_WORD}')) AS l FROM d
), hits AS (
  SELECT r, label, len(list_intersect(l, tokens)) / len(tokens) AS share
  FROM lines JOIN notices ON len(list_intersect(l, tokens)) >= k
), h AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM hits GROUP BY r)
SELECT doc_id, n_words, len(s) AS n_base, list_min(s) AS first_word, list_max(s) AS last_word,
  array_to_string(list_sort(list_distinct(b)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(b || coalesce(labels, []))), ',') AS labels,
  CASE WHEN len(s) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM q LEFT JOIN h USING (r)
"""


_MIX = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), k AS (
  SELECT *, {list(map(float, WEIGHTS))}[rank % {len(WEIGHTS)} + 1]::DOUBLE AS weight,
    {list(map(float, SLOPES))}[rank % {len(SLOPES)} + 1]::DOUBLE AS slope FROM s
), level AS (
  SELECT 0 AS step, 0.0::DOUBLE AS level, -1::BIGINT AS capped
  UNION ALL
  SELECT step + 1, (1.5 * total - 2.0 * fixed)::DOUBLE / weights, now
  FROM (
    SELECT step, capped, sum(source_size)::DOUBLE AS total,
      sum(CASE WHEN source_size * 2.0 <= level * weight THEN source_size ELSE 0 END)::DOUBLE AS fixed,
      sum(CASE WHEN source_size * 2.0 <= level * weight THEN 0 ELSE weight END) AS weights,
      count(*) FILTER (source_size * 2.0 <= level * weight) AS now
    FROM level, k GROUP BY step, capped
  ) WHERE weights > 0 AND now <> capped
), t AS (
  SELECT k.*, least((source_size * 2.0)::DOUBLE, (SELECT arg_max(level, step) FROM level) * weight) AS target FROM k
), c AS (
  SELECT doc_id, size, source_size::BIGINT AS source_size, target, slope, floor(target + 0.5)::BIGINT AS due,
    (sum(size) OVER (PARTITION BY rank ORDER BY md5(doc_id::VARCHAR) NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS f
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  greatest(0, least(f + size, due) - f) + greatest(0, least(f + source_size + size, due) - f - source_size) AS taken,
  CASE WHEN least(f + size, due) > f THEN
    CASE WHEN slope = 0 THEN f::DOUBLE / target
    ELSE ((slope - 1) + sqrt((1 - slope) * (1 - slope) + 4 * slope * (f::DOUBLE / target))) / (2 * slope) END
  END AS position
FROM c
"""


_LEAKS = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM documents
), i AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM benchmark
), il AS (SELECT i, item_id, w, len(w) AS L, least(5, len(w)) AS k FROM i WHERE len(w) > 0
), ds AS (
  SELECT r, k, p, array_to_string(w[p + 1 : p + k], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM il))
), ist AS (
  SELECT i, L, k, o, array_to_string(w[o + 1 : o + k], ' ') AS s
  FROM (SELECT i, w, L, k, unnest(range(L - k + 1)) AS o FROM il)
), windows AS (
  SELECT DISTINCT r, L, k, greatest(0, least(p - o, len(w) - L)) AS start FROM ds JOIN ist USING (k, s) JOIN d USING (r)
), ws AS (
  SELECT r, L, k, start, s, count(*) AS n FROM windows JOIN ds USING (r, k) WHERE p BETWEEN start AND start + L - k GROUP BY ALL
), wn AS (SELECT r, L, start, sum(n) AS n FROM ws GROUP BY ALL
), isn AS (SELECT i, L, k, s, count(*) AS n FROM ist GROUP BY ALL
), shared AS (
  SELECT r, L, k, start, i, sum(least(ws.n, isn.n)) AS shared FROM ws JOIN isn USING (L, k, s) GROUP BY ALL
), pairs AS (
  SELECT r, i, start, shared::DOUBLE / (n + L - k + 1 - shared)::DOUBLE AS similarity FROM shared JOIN wn USING (r, L, start)
)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_min(start, (-similarity, start))::BIGINT AS first_word
FROM pairs JOIN d USING (r) JOIN il USING (i) WHERE similarity >= 0.8 GROUP BY r, i, doc_id, item_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS w
  FROM documents
), i AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS w
  FROM benchmark
), corpus AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0
), it AS (SELECT i, item_id, term, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS term FROM i) GROUP BY ALL
), tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY ALL
), df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term
), gain AS (
  SELECT r, doc_id, term,
    floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))) AS gain
  FROM tf JOIN df USING (term), corpus
), total AS (
  SELECT i, item_id, r, doc_id, sum(times * gain)::BIGINT AS score FROM gain JOIN it USING (term) GROUP BY ALL HAVING sum(times * gain) > 0
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM total QUALIFY rank <= 20
"""

_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id AS id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda k: a.q[k] * b.q[k])), 0)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (
  SELECT anchor, anchor_id, r, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.id, s.r))::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""

SQL: dict[str, str] = {
    "op1_license_scan": _licenses(),
    "op2_benchmark_decontamination": _LEAKS,
    "op3_source_mix": _MIX,
    "op12_ranked_search": _SEARCH,
    "op13_hard_negatives": _NEGATIVES,
}
