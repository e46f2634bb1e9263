"""op9: every capture of ``pages`` against a dated block list.

``pages`` has neither fetch dates nor a list, so both are derived from it by
rule: a page's fetch day from its id; list entries from the hosts and first
path segments seen, with dates from a checksum of the name.
"""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.registry import register
from panelcast.llm.url_filter import capture_verdicts, url_host, url_segment

SQL = r"""
WITH cap AS (
  SELECT page_id, url, CAST(DATE '2022-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS DATE) AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS seg
  FROM pages),
names AS (
  SELECT DISTINCT unnest([host, CASE WHEN seg <> '' THEN host || '/' || seg END, regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$')]) AS key FROM cap WHERE host IS NOT NULL),
sums AS (SELECT key, CAST('0x' || substr(md5(key), 1, 7) AS BIGINT) AS h FROM names WHERE key IS NOT NULL AND key <> ''),
entries AS (
  SELECT key, 'add' AS action, CAST(DATE '2022-01-01' + CAST(h % 500 AS INTEGER) AS DATE) AS dt FROM sums WHERE h % 4 = 0
  UNION ALL SELECT key, 'remove', CAST(DATE '2022-01-01' + CAST(h % 500 + 30 + h % 97 AS INTEGER) AS DATE) FROM sums WHERE h % 8 = 0
  UNION ALL SELECT key, 'add', CAST(DATE '2022-01-01' + CAST(h % 500 + 200 AS INTEGER) AS DATE) FROM sums WHERE h % 16 = 0),
iv AS (
  SELECT key, action, dt AS valid_from, lead(dt) OVER (PARTITION BY key ORDER BY dt) AS valid_to FROM (
    SELECT key, dt, max(action) AS action FROM entries GROUP BY key, dt)),
asked AS (SELECT DISTINCT host, seg, fetched, string_split(host, '.') AS l FROM cap WHERE host IS NOT NULL),
hk AS (SELECT host, seg, fetched, array_to_string(l[i:], '.') AS name FROM (SELECT *, unnest(generate_series(1, greatest(len(l) - 1, 1))) AS i FROM asked)),
keyed AS (SELECT host, seg, fetched, name AS key FROM hk UNION ALL SELECT host, seg, fetched, name || '/' || seg FROM hk WHERE seg <> ''),
act AS (
  SELECT host, seg, fetched, count(*) AS n FROM keyed JOIN iv USING (key)
  WHERE action = 'add' AND fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to) GROUP BY host, seg, fetched)
SELECT c.page_id, c.url, c.fetched, c.host, CAST(coalesce(act.n, 0) AS BIGINT) AS n_active, coalesce(act.n, 0) > 0 AS blocked
FROM cap c LEFT JOIN act ON c.host = act.host AND c.seg = act.seg AND c.fetched = act.fetched
"""


def captures(pages):
    return pages.select("page_id", "url", F.date_add(F.lit("2022-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int")).alias("fetched"))


def list_entries(pages):
    """Dated entries: about a quarter of all names is listed, half of those delisted later, and some listed again."""
    host = url_host(F.col("url"))
    seg = url_segment(F.col("url"))
    names = F.array(host, F.when(seg != "", F.concat_ws("/", host, seg)), F.regexp_extract(host, r"[^.]+\.[^.]+\.[^.]+$", 0))
    keys = (pages.filter(host.isNotNull()).select(F.explode(names).alias("key")).distinct().filter("key <> ''")
            .withColumn("h", F.conv(F.substring(F.md5("key"), 1, 7), 16, 10).cast("long")))
    day = lambda c: F.date_add(F.lit("2022-01-01").cast("date"), c.cast("int"))
    h = F.col("h")
    events = F.array(
        F.when(h % 4 == 0, F.struct(F.lit("add").alias("action"), day(h % 500).alias("at"))),
        F.when(h % 8 == 0, F.struct(F.lit("remove").alias("action"), day(h % 500 + 30 + h % 97).alias("at"))),
        F.when(h % 16 == 0, F.struct(F.lit("add").alias("action"), day(h % 500 + 200).alias("at"))))
    return keys.select("key", F.explode(events).alias("e")).filter("e IS NOT NULL").select("key", "e.action", "e.at")


@register("op9_url_filter", SQL)
def op9(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    out = capture_verdicts(captures(pages), list_entries(pages))
    return out.select("page_id", "url", "fetched", "host", "n_active", "blocked")
