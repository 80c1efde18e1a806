"""DuckDB SQL twins of the llm queries, where SQL can express them."""

from __future__ import annotations

from cohortcraft.llm import quality_rules as rules


def _quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in rules._stop_list())
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT r, i, list_aggregate(list_slice(w, i, i + 2), 'string_agg', ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 1, 1))) AS u(i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c >= 2),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, unnest([0, 1, 2]) AS o(k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(DISTINCT l) AS n_distinct
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(replace(t, '!', '')) AS n_shouts,
         coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.n_distinct, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words
  FROM d LEFT JOIN covered c USING (r) LEFT JOIN lines l USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words
        AND coalesce(chars, 0) >= 2 * n_words AND coalesce(chars, 0) <= 12 * n_words
        AND 10 * n_symbols <= n_words AND 10 * n_shouts <= n_words AND 100 * n_stop_words >= 8 * n_words
        AND 2 * n_dup_lines <= n_lines) AS kept,
       n_stop_words::BIGINT AS n_stop_words
FROM m
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
phrases AS (
  SELECT DISTINCT item, m, list_aggregate(list_slice(w, i, i + m - 1), 'string_agg', ' ') AS g
  FROM sized, unnest(range(1, len(w) - m + 2)) AS u(i)),
windows AS (
  SELECT r, i, m, list_aggregate(list_slice(w, i, i + m - 1), 'string_agg', ' ') AS g
  FROM d, (SELECT DISTINCT m FROM sized) AS l, unnest(range(1, greatest(len(w) - m + 2, 1))) AS u(i)),
found AS (SELECT r, i, m, item FROM windows JOIN phrases USING (m, g)),
hits AS (SELECT r, count(DISTINCT k) AS n FROM found, unnest(range(i, i + m)) AS u(k) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(x.n, 0)::BIGINT AS n_items,
       sha256(coalesce(x.s, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits h USING (r) LEFT JOIN items x USING (r)
"""

_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"  # of lower-cased text

_RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
posting AS (
  SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY r, doc_id, term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weighted AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM posting, size WHERE term IN (SELECT term FROM asked) GROUP BY term, big_n),
scored AS (
  SELECT item_id, r, doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weighted USING (term) JOIN posting USING (term), size GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


ORACLE: dict[str, str] = {
    "op1_benchmark_decontamination": _DECONTAMINATION,
    "op4_quality_rules": _quality_rules(),
    "op13_ranked_search": _RANKED_SEARCH,
}
