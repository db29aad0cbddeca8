"""DuckDB SQL that gives the same rows as the queries, for those that SQL can express."""

from __future__ import annotations

from .quality_rules import RULES, STOP_WORDS

SQL: dict[str, str] = {}

_RULES = """
  CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
  CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
  CASE WHEN n_words > 0 THEN stop_words / n_words ELSE 0 END AS stop_word_ratio,
  CASE WHEN len(lines) > 0 THEN n_dup_lines / len(lines) ELSE 0 END AS duplicate_line_ratio,
  CASE WHEN letters > 0 THEN capitals / letters ELSE 0 END AS capital_ratio,
  CASE WHEN n_words > 0 THEN exclamations / n_words ELSE 0 END AS exclamations_per_word
"""
_BOUNDS = " AND ".join(
    f"(n_words < {r.from_words} OR ({r.name} >= {-1e300 if r.low is None else r.low} AND {r.name} <= {1e300 if r.high is None else r.high}))" for r in RULES
)

SQL["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), often AS (
  SELECT r, i FROM d, unnest(range(0, len(w) - 4)) AS x(i) WHERE len(w) >= 5
  QUALIFY count(*) OVER (PARTITION BY r, array_to_string(w[i + 1 : i + 5], ' ')) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM often, unnest(range(i, i + 5)) AS x(p) GROUP BY r
), figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, lines,
         len(list_filter(w, lambda x: list_contains({list(dict.fromkeys(STOP_WORDS))}, lower(x)))) AS stop_words,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
         length(t) - length(translate(t, '!', '')) AS exclamations
  FROM d LEFT JOIN covered USING (r)
), ratios AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {_RULES} FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_BOUNDS} AS kept,
       {", ".join(r.name for r in RULES)}
FROM ratios
"""

SQL["op11_hard_negatives"] = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""

SQL["op12_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS g
  FROM b, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
  SELECT r, m, i, array_to_string(w[i + 1 : i + m], ' ') AS g
  FROM (SELECT r, w, m FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m), unnest(range(0, len(w) - m + 1)) AS t(i)
), hits AS (
  SELECT r, i, m, item_id FROM dw JOIN iw USING (m, g)
), counts AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, i, m FROM hits), unnest(range(i, i + m)) AS t(p) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counts USING (r) LEFT JOIN items USING (r)
"""


def _leaf(n_chars: str) -> str:
    fields = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")]
    return f"sha256({' || '.join(fields)})"


_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)), "
    "lambda a, x: list_reduce(list_prepend(xor(a, x), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda z, k: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384::UBIGINT) ELSE z >> 1 END)), 4294967295::UBIGINT)"
)

SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE base AS (
  SELECT *, row_number() OVER () AS r, coalesce('=' || lang, '') AS t, {_leaf('n_chars')} AS leaf,
         {_leaf(f'n_chars + CASE WHEN {_CRC32} % 7 = 0 THEN 1 ELSE 0 END')} AS claimed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM base
), nodes AS (
  SELECT t, 0 AS lv, i, n, leaf AS d FROM placed
  UNION ALL
  SELECT t, lv + 1, i // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY t, lv, i // 2
), subroots AS (
  SELECT t, d AS subroot, row_number() OVER (ORDER BY encode(t)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lv, i, n, subroot AS d FROM subroots
  UNION ALL
  SELECT lv + 1, i // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lv, i // 2
), steps AS (
  SELECT r, lv AS k, CASE WHEN p.i >> lv & 1 = 1 THEN coalesce(s.d, '') ELSE '' END || '|' || CASE WHEN p.i >> lv & 1 = 0 THEN coalesce(s.d, '') ELSE '' END AS pair
  FROM placed p JOIN nodes v ON v.t = p.t AND v.i = p.i >> v.lv AND v.n > 1 LEFT JOIN (SELECT t, lv AS slv, i AS si, d FROM nodes) s ON s.t = p.t AND s.slv = v.lv AND s.si = xor(v.i, 1)
  UNION ALL
  SELECT r, 1000 + lv, CASE WHEN u.i >> lv & 1 = 1 THEN coalesce(s.d, '') ELSE '' END || '|' || CASE WHEN u.i >> lv & 1 = 0 THEN coalesce(s.d, '') ELSE '' END
  FROM placed p JOIN subroots u ON u.t = p.t JOIN tops v ON v.i = u.i >> v.lv AND v.n > 1 LEFT JOIN (SELECT lv AS slv, i AS si, d FROM tops) s ON s.slv = v.lv AND s.si = xor(v.i, 1)
), proofs AS (
  SELECT r, list(pair ORDER BY k) AS pairs FROM steps GROUP BY r
), folded AS (
  SELECT doc_id, leaf, subroot, (SELECT d FROM tops WHERE n = 1) AS root, sha256(replace(array_to_string(coalesce(pairs, []), ''), '|', '')) AS proof_sha256,
         list_reduce(list_prepend(claimed, coalesce(pairs, [])), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed JOIN subroots USING (t) LEFT JOIN proofs USING (r)
)
SELECT *, folded_root = root AS verified FROM folded
"""
