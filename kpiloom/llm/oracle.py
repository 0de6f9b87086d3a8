"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from kpiloom.llm.line_rules import BOILERPLATE

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_VISIBLE = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_VISIBLE}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common.n >= 90 * (p.n + q.n - common.n)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(id, other) AS (
  SELECT x, x FROM edges UNION SELECT reach.id, edges.y FROM reach JOIN edges ON reach.other = edges.x
), smallest AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM (SELECT doc_id FROM documents) LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON id = doc_id
"""

OP5 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark
), windows AS (
  SELECT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + 9), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (
  SELECT DISTINCT doc_id, size, i, item_id FROM places JOIN windows USING (size, s)
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
  FROM pages
)
"""

OP9 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_VISIBLE}') AS w FROM documents
), lines AS (
  SELECT doc_id, i, l, len(regexp_extract_all(l, '{_VISIBLE}')) AS n,
    row_number() OVER (PARTITION BY doc_id, l ORDER BY i) > 1 AS again
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)
), judged AS (
  SELECT doc_id, n, again,
    10 * len(regexp_extract_all(l, '[#*$%&|<>]')) > n
    OR (len(regexp_extract_all(l, '[|>»·•]')) >= 2 AND 3 * len(regexp_extract_all(l, '[|>»·•]')) > n)
    OR (n >= 3 AND 2 * len(list_filter(regexp_extract_all(l, '{_VISIBLE}'), lambda x: ends_with(x, '!!'))) > n)
    OR (NOT regexp_matches(l, '[.!?]') AND n < 3)
    OR (n <= 50 AND regexp_matches(l, '(?i){"|".join(BOILERPLATE)}'))
    OR again AS failed
  FROM lines WHERE n > 0
), by_line AS (
  SELECT doc_id, count_if(again) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE NOT failed), 0)::BIGINT AS kept_words
  FROM judged GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS j
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS times FROM windows) WHERE times > 1
  ) GROUP BY doc_id
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(kept_words, 0) AS kept_words
  FROM d LEFT JOIN by_line USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * kept_words > n_words AS kept
FROM base
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(_LOWER_, '_TERM_') AS t FROM documents
), totals AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS docs, coalesce(sum(len(t)), 0)::BIGINT AS terms FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(_LOWER_, '_TERM_')) AS term FROM benchmark
), wanted AS (
  SELECT DISTINCT term FROM q
), tf AS (
  SELECT row, doc_id, term, count(*) AS tf, n FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d) SEMI JOIN wanted USING (term)
  GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, docs
), impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS impact
  FROM tf JOIN weights USING (term), totals
), scores AS (
  SELECT item_id, row, doc_id, sum(impact)::BIGINT AS score FROM q JOIN impacts USING (term) GROUP BY item_id, row, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
""".replace("_LOWER_", _LOWER).replace("_TERM_", _ALNUM)


def _nearest(entries: str) -> str:
    """The nearest entry of every part: distance and entry in one number, the smallest wins."""
    return f"""
  SELECT r, p, x, best % 256 AS e, best // 256 AS distance FROM (
    SELECT r, parts.p, any_value(x) AS x,
      min(256 * list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT + e) AS best
    FROM parts JOIN {entries} AS book ON parts.p = book.p GROUP BY r, parts.p
  )"""


def _moved(chosen: str, entries: str) -> str:
    """Each entry moves to the floored mean of its parts; unused ones stay."""
    return f"""
  SELECT p, e, coalesce(mean, c) AS c FROM {entries} LEFT JOIN (
    SELECT p, e, list((total - (total % n + n) % n) // n ORDER BY i) AS mean FROM (
      SELECT p, e, i, sum(x[i])::BIGINT AS total, count(*) AS n
      FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM {chosen}) GROUP BY p, e, i
    ) GROUP BY p, e
  ) USING (p, e)"""


_ROUNDS = ", ".join(
    f"chosen{k} AS MATERIALIZED ({_nearest(f'book{k}')}), book{k + 1} AS MATERIALIZED ({_moved(f'chosen{k}', f'book{k}')})" for k in range(4)
)

OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS x FROM kept, range(4) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 256
), {_ROUNDS}, final AS MATERIALIZED ({_nearest("book4")}
), coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error FROM final GROUP BY r
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book4) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

ORACLE: dict[str, str] = {
    "op3_ngram_jaccard_join": OP3,
    "op5_benchmark_decontamination": OP5,
    "op6_warc": OP6,
    "op9_quality_rules": OP9,
    "op11_ranked_search": OP11,
    "op12_vector_codes": OP12,
}
