"""op7: secrets in all ``documents``."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.registry import register
from panelcast.llm.secrets import ALPHABETS, KINDS, find_secrets, joined


def _sql() -> str:
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = (("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("random", "[A-Za-z0-9+/_=-]{20,}", 0, 20))
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, {least} AS least, string_split_regex(t, '{pat}') AS gaps, "
        f"regexp_extract_all(t, '{pat}', 0) AS whole, regexp_extract_all(t, '{pat}', {group}) AS val FROM d WHERE regexp_matches(t, '{pat}')"
        for rank, (kind, pat, group, least) in enumerate(kinds))
    alpha = " ".join(f"WHEN translate(body, '{a}', '') = '' THEN '{a}'" for _, a in ALPHABETS)
    tail = lambda z: f"(1 / (1 + exp(1.5976 * greatest(least({z}, 20.0), -20.0) + 0.070566 * greatest(least({z}, 20.0), -20.0) ** 3)))"
    logs = lambda *ps: "-(" + " + ".join(f"ln(greatest({x}, 1e-30))" for x in ps) + ")"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
e AS (SELECT *, unnest(generate_series(1, len(whole))) AS i FROM m),
p AS (
  SELECT doc_id, kind, rank, val[i] AS v, length(whole[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s
  FROM e WHERE length(val[i]) >= least),
spans AS (SELECT doc_id, kind, rank, v, CAST(s AS BIGINT) AS s, CAST(s + size AS BIGINT) AS f FROM p),
cand AS (
  SELECT * FROM spans c WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM spans b WHERE b.doc_id = c.doc_id AND b.rank < 3 AND b.s < c.f AND c.s < b.f)),
tok AS (
  SELECT v, body, greatest(length(body), 2)::DOUBLE AS n, CASE {alpha} ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=' END AS alpha
  FROM (SELECT DISTINCT v, regexp_replace(v, '=+$', '') AS body FROM cand)),
ch AS (
  SELECT v, n, length(alpha)::DOUBLE AS k, i, body[i] AS c, strpos(alpha, body[i])::DOUBLE AS ix,
         CASE WHEN regexp_matches(body[i], '[0-9]') THEN 0 WHEN regexp_matches(body[i], '[a-z]') THEN 1 WHEN regexp_matches(body[i], '[A-Z]') THEN 2 ELSE 3 END AS cls
  FROM (SELECT *, unnest(generate_series(1, length(body))) AS i FROM tok)),
sq AS (SELECT v, sum(c2 * c2)::DOUBLE AS squares FROM (SELECT v, c, count(*) AS c2 FROM ch GROUP BY v, c) GROUP BY v),
dv AS (SELECT *, ix - sum(ix) OVER (PARTITION BY v) / n AS dev, ix > k / 2 AS hi FROM ch),
nx AS (SELECT *, lead(dev) OVER w AS dev2, lead(hi) OVER w AS hi2, lead(cls) OVER w AS cls2 FROM dv WINDOW w AS (PARTITION BY v ORDER BY i)),
st AS (
  SELECT v, any_value(n) AS n, any_value(k) AS k, sum(dev * dev) AS var, sum(dev * coalesce(dev2, 0)) AS lagged, count(*) FILTER (WHERE hi)::DOUBLE AS n1,
         count(*) FILTER (WHERE hi <> hi2) + 1.0 AS runs, count(*) FILTER (WHERE cls <> cls2)::DOUBLE AS changes FROM nx GROUP BY v),
z AS (
  SELECT v, n, k, changes, k / n * squares - n AS chi, sqrt(2 * (k - 1)) AS sd, CASE WHEN var > 0 THEN lagged / var ELSE 1.0 END AS r,
         CASE WHEN n1 > 0 AND n1 < n THEN abs(runs - mu) / sqrt(greatest((mu - 1) * (mu - 2) / (n - 1), 1e-9)) ELSE 20.0 END AS zr
  FROM (SELECT *, 2 * n1 * (n - n1) / n + 1 AS mu FROM st) JOIN sq USING (v)),
ps AS (
  SELECT v, n, {tail('(chi - (k - 1)) / sd')} AS pu, least(1.0, 2 * {tail('zr')}) AS pr, least(1.0, 2 * {tail('(abs(r + 1 / n) * sqrt(n))')}) AS pc,
         {tail('((n * (k * 0.066 - 1) + (k - 1) * (1 - 0.066)) - chi) / sd')} AS pf, {tail('(changes - 0.1 * n) / sqrt(0.1 * (1 - 0.1) * n)')} AS pg FROM z),
fi AS (SELECT v, n, {logs('pu', 'pr', 'pc')} AS h, {logs('pf', 'pg')} AS g FROM ps),
te AS (
  SELECT v, exp(-h) * (1 + h + h * h / 2) AS p_random, CAST(least(floor(-4 * log2(greatest(exp(-g) * (1 + g), 1e-40))), 400) AS INTEGER) AS bin,
         CASE WHEN n >= 128 THEN 5 WHEN n >= 64 THEN 4 WHEN n >= 48 THEN 3 WHEN n >= 32 THEN 2 WHEN n >= 24 THEN 1 ELSE 0 END AS stratum FROM fi),
bh AS (
  SELECT stratum, min(bin) AS least FROM (
    SELECT stratum, bin, sum(c) OVER (PARTITION BY stratum) AS total, sum(c) OVER (PARTITION BY stratum ORDER BY bin DESC) AS so_far
    FROM (SELECT stratum, bin, count(*) AS c FROM te GROUP BY stratum, bin)) WHERE pow(2.0, -bin / 4.0) * total <= 0.01 * so_far GROUP BY stratum),
hit AS (SELECT te.v FROM te JOIN bh USING (stratum) WHERE p_random >= 1e-4 AND bin >= least),
al AS (SELECT doc_id, kind, rank, s, f FROM spans WHERE rank < 3 UNION ALL SELECT doc_id, kind, rank, s, f FROM cand WHERE v IN (SELECT v FROM hit)),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS b, count(*) FILTER (WHERE rank = 2) AS c,
         string_agg(kind || ':' || s || ':' || f, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base, string_agg(kind || ':' || s || ':' || f, ',' ORDER BY s, rank) AS spans
  FROM al GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


def _count(kind):
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


@register("op7_secret_scan", _sql())
def op7(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"))
    counts = [_count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
