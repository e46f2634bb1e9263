"""op11: hard negatives of every hundredth vector among all ``embeddings``."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.hard_negatives import mine
from panelcast.llm.registry import register

SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS aid, b.vec_id AS bid, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT aid, bid, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, bid) <= 5),
n AS (
  SELECT p.aid, p.bid AS pid, p.score AS ps, s.bid AS nid, s.score AS ns,
         row_number() OVER (PARTITION BY p.aid, p.bid ORDER BY s.score DESC, s.bid) AS rk
  FROM p JOIN s ON s.aid = p.aid AND NOT s.same WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT aid AS anchor_id, pid AS positive_id, CAST(rk AS INTEGER) AS rank, nid AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rk <= 10
"""


@register("op11_hard_negatives", SQL)
def op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
