"""op2: quality measures and verdicts of all ``documents``."""

from panelcast.llm.common import table
from panelcast.llm.quality import quality_verdicts
from panelcast.llm.registry import register

SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
tri AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c >= 2),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, len(d.w) AS n_words, length(array_to_string(d.w, '')) AS word_chars,
         length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(d.l) - len(list_distinct(d.l)) AS n_dup_lines, len(d.l) AS n_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols * 100 > n_words * 300 AS symbols_failed, n_dup_lines * 100 > n_lines * 90 AS lines_failed FROM m),
h AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS base, sum(symbols_failed::BIGINT) AS symbols, sum(lines_failed::BIGINT) AS lines
  FROM f WHERE source IS NOT NULL GROUP BY source),
long AS (
  SELECT source, n, 'base' AS rule, base AS bad FROM h UNION ALL SELECT source, n, 'symbols', symbols FROM h UNION ALL SELECT source, n, 'lines', lines FROM h),
mom AS (
  SELECT rule, (sum(bad) + 0.5) / (sum(n) + 1.0) AS mu, var_pop(bad / n) AS v, avg(1.0 / n) AS inv FROM long GROUP BY rule),
prior AS (
  SELECT rule, mu, least(greatest(mu * (1 - mu) / greatest(v - mu * (1 - mu) * inv, 1e-4 * mu * (1 - mu)) - 1, 2.0), 1e4) AS k FROM mom),
bad AS (SELECT DISTINCT source FROM long JOIN prior USING (rule) WHERE (bad + mu * k) / (n + k) > 0.5 AND bad > 0.5 * n)
SELECT f.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       bad.source IS NOT NULL AS host_rejected, NOT base_failed AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad ON f.source = bad.source
"""


@register("op2_quality_rules", SQL)
def op2(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))
