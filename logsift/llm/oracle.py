"""SQL (DuckDB) of the training-data queries that SQL can express, written from
their contracts; nothing of the operators is used but the rules' grid."""

from __future__ import annotations

from logsift.llm.quality_rules import RULES

#: Word patterns and A-Z folding.
NOT_SPACE = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), {NOT_SPACE}) AS ws FROM documents),
token AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT rid, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + j AS p FROM rep, range(0, 35) t(j)),
left_over AS (SELECT rid, string_agg(word, ' ' ORDER BY p) FILTER (WHERE g.p IS NULL) AS kept, count(g.p) AS n_removed
  FROM token LEFT JOIN gone g USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (rid)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({FOLD}, {ALNUM}) AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({FOLD}, {ALNUM}) AS ws FROM benchmark),
long_win AS (SELECT item, 13 AS n, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS k FROM b WHERE len(ws) >= 13),
item_win AS (SELECT * FROM long_win UNION SELECT item, len(ws), array_to_string(ws, ' ') FROM b WHERE len(ws) BETWEEN 1 AND 12),
doc_win AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item_win) WHERE len(ws) >= n)),
met AS (SELECT rid, n, i, item FROM doc_win JOIN item_win USING (n, k)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM met) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT rid, item FROM met) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({FOLD}, {NOT_SPACE}) AS ws FROM documents),
s AS (SELECT doc_id, rid, list_sort(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS grams FROM w),
class AS (SELECT *, min(rid) OVER (PARTITION BY grams) AS node, min(doc_id) OVER (PARTITION BY grams) AS class_id FROM s),
gram AS (SELECT node, len(grams) AS n, unnest(grams) AS g FROM class WHERE rid = node),
pair AS (SELECT a.node AS a, b.node AS b FROM gram a JOIN gram b USING (g) WHERE a.node < b.node GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edge AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(a, b) AS (SELECT node, node FROM (SELECT DISTINCT node FROM gram) UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
least AS (SELECT r.a AS node, min(c.doc_id) AS component_id FROM reach r JOIN class c ON c.node = r.b GROUP BY r.a)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, CASE WHEN len(grams) = 0 THEN doc_id ELSE class_id END AS class_id,
  CASE WHEN len(grams) = 0 THEN doc_id ELSE component_id END AS component_id
FROM class LEFT JOIN least USING (node)
"""

_GRID = ", ".join(f"('{rule}', {step}, {cutoff}::DOUBLE)" for rule, (_, _, cutoffs) in RULES.items() for step, cutoff in enumerate(cutoffs))
_RATIO = "CASE rule " + " ".join(f"WHEN '{rule}' THEN {top} / greatest({bottom}, 1)::DOUBLE" for rule, (top, bottom, _) in RULES.items()) + " END"
_ALPHA = f"(0.05 / {len(RULES)})"

QUALITY_RULES = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), {NOT_SPACE}) AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {NOT_SPACE})) AS ls FROM documents),
gram AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) >= 3)),
again AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM gram WHERE c > 1) GROUP BY rid),
f AS (SELECT rid, doc_id, stratum, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals FROM t LEFT JOIN again USING (rid)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
ratio AS (SELECT rid, doc_id, stratum, base_failed, rule, {_RATIO} AS ratio FROM j, (SELECT DISTINCT rule FROM (VALUES {_GRID}) v(rule, step, cutoff))),
clean AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT * FROM ratio SEMI JOIN clean USING (doc_id) WHERE NOT base_failed),
cell AS (SELECT stratum, g.rule, step, cutoff, count(*) AS n, count(*) FILTER (WHERE ratio >= cutoff) AS k
  FROM held JOIN (VALUES {_GRID}) g(rule, step, cutoff) USING (rule) GROUP BY ALL),
tail AS (SELECT *, CASE WHEN k >= n * {_ALPHA} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
  lambda x: exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({_ALPHA}) + (n - x) * ln(1 - {_ALPHA})))) END
  <= 0.05 / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM held)) AS ok FROM cell),
passed AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM (
  SELECT *, bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY step) AS good FROM tail) WHERE good GROUP BY stratum, rule),
bad AS (SELECT DISTINCT rid FROM ratio JOIN passed USING (stratum, rule) WHERE ratio >= cutoff)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND bad.rid IS NULL AS kept
FROM j LEFT JOIN bad USING (rid)
"""

ORACLE_SQL = {
    "op1_quality_rules": QUALITY_RULES,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op4_ngram_jaccard_join": JACCARD_JOIN,
    "op7_substring_dedup": SUBSTRING_DEDUP,
}
