"""op13: ``conversations`` damaged by rule, then reported and repaired."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.registry import register
from panelcast.llm.turns import repair_report

SQL = r"""
WITH RECURSIVE
tbl AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hit AS (
  SELECT raw.*, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS d FROM raw, tbl),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS inner_text,
         CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS ini
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
r AS (
  SELECT *, CASE WHEN inner_text = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(inner_text, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini AS pair FROM placed),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
ins(st, j, st2, roles) AS (VALUES
  (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
  (0, 1, 2, ['user']), (1, 1, 2, ['user']), (2, 1, 3, ['assistant']), (3, 1, 2, ['user']),
  (0, 2, 3, ['user', 'assistant']), (1, 2, 3, ['user', 'assistant']), (2, 2, 2, ['assistant', 'user']), (3, 2, 3, ['user', 'assistant'])),
edit(st, e, ini, st2) AS (VALUES
  (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3),
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
  (0, 'R', '', 2), (1, 'R', '', 2), (2, 'R', '', 3), (3, 'R', '', 2)),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS st, {'c': CAST(0 AS BIGINT), 'a': '', 'l': CAST([] AS VARCHAR[])} AS best FROM raw
  UNION ALL
  SELECT dp.conv_id, dp.pos + 1, edit.st2,
         min({'c': best.c + 3 * ins.j + CASE e WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END + CASE WHEN e <> 'D' AND fault = 3 THEN 3 ELSE 0 END,
              'a': best.a || repeat('I', ins.j) || e,
              'l': list_concat(best.l, list_transform(ins.roles, lambda x: x || ':'),
                   CASE e WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE ins.st2 WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END)})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos JOIN ins ON ins.st = dp.st JOIN edit ON edit.st = ins.st2
  WHERE e = 'D' OR (fault NOT IN (1, 2) AND (e = 'R' OR edit.ini = r.ini))
  GROUP BY ALL),
done AS (
  SELECT dp.conv_id, min({'c': best.c + 3 * ins.j, 'a': best.a || repeat('I', ins.j), 'l': list_concat(best.l, list_transform(ins.roles, lambda x: x || ':'))}) AS best
  FROM dp LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM dp.conv_id JOIN ins ON ins.st = dp.st AND ins.st2 IN (0, 3)
  WHERE dp.pos = coalesce(n, 0) GROUP BY dp.conv_id)
SELECT done.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(array_to_string(best.l, chr(10))) AS repaired_sha256
FROM done LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM done.conv_id
"""


def damage(turns):
    """The rule's damage as (conv_id, turn, role, text, copies); a dropped turn has no copies."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce(F.col("text"), F.lit(" "))
    d = F.col("d")
    return (turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("d"))
            .select("conv_id", "turn", F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(d == 1, F.lit("")).when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.when(d == 0, 0).when(d == 3, 2).otherwise(1).alias("copies")))


@register("op13_conversation_repair", SQL)
def op13(spark, sf_dir):
    return repair_report(damage(table(spark, sf_dir, "conversations")), F.col("copies"))
