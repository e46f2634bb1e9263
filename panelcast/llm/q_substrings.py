"""op6: repeated 13-word windows of all ``documents``."""

from panelcast.llm.common import table
from panelcast.llm.registry import register
from panelcast.llm.substrings import substring_digests

SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS s FROM d WHERE len(w) >= 13)),
gone AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY t) AS least FROM win) WHERE doc_id > least),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 12)) AS p FROM gone),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN pos ON words.doc_id = pos.doc_id AND words.p = pos.p WHERE pos.p IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@register("op6_substring_dedup", SQL)
def op6(spark, sf_dir):
    return substring_digests(table(spark, sf_dir, "documents"))
