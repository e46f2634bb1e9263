"""op1: contaminated documents, against whole ``documents`` and ``benchmark``."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.decontaminate import contamination
from panelcast.llm.registry import register

SQL = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, w, len(w) AS n FROM (
    SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark) WHERE len(w) > 0),
wins AS (
  SELECT item_id, least(n, 10) AS sz, array_to_string(w[s:s + least(n, 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, n - least(n, 10) + 1)) AS s FROM items)),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT sz FROM wins),
dwin AS (
  SELECT doc_id, s, sz, array_to_string(w[s:s + sz - 1], ' ') AS win
  FROM (SELECT doc_id, w, sz, unnest(generate_series(1, len(w) - sz + 1)) AS s FROM docs, sizes WHERE len(w) >= sz)),
hits AS (SELECT d.doc_id, d.s, d.sz, i.item_id FROM dwin d JOIN (SELECT DISTINCT item_id, sz, win FROM wins) i ON d.win = i.win AND d.sz = i.sz),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + sz - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named.ids, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@register("op1_decontaminate", SQL)
def op1(spark, sf_dir):
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
