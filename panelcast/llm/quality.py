"""Host-level quality rules, native.

Every document is measured over its whole text and tested against a few rules;
failures are counted per host (``source``) and rule; each host's failure rate
is shrunk with a beta prior fitted to all hosts by moments (empirical Bayes),
and a host whose shrunk rate and own rate pass ``max_host_rate`` for some rule
is rejected. A document is kept if it passes the base rules and its host is not
rejected.

Measures use array functions inside a row; repeated three-word windows are
found by sorting a document's windows (n log n in its words, nothing is
exploded). Only measures leave the rows' partition: host counts are partial
sums, so a host with a third of all documents sends a row per task. The host
table is joined plainly (Spark broadcasts it while small; a hot host on a
shuffle is split by AQE).

Cases: a null or empty text has no words and fails; a null host is never
judged; a host with few documents is drawn to the mean of all; equal rows are
counted and returned each; an empty table gives no rows; other columns are
kept by ``apply_quality_rules`` and ignored by ``quality_verdicts``.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SPACE_WORD, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 300
MAX_DUP_LINES_PERCENT = 90
MAX_HOST_RATE = 0.5
#: Rules counted per host; the first is the base rule.
RULES = ("base", "symbols", "lines")


def _repeat_words(words: Column) -> list[tuple[str, Column]]:
    """Steps that end in ``n_repeat_words``; each column is used several times by the next, so Spark keeps it apart."""
    w, s, p = F.col("__w"), F.col("__s"), F.col("__p")
    n = F.size(w)
    windows = F.when(n >= 3, F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(1))),
        lambda x, i: F.struct(F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i"))))
    repeated = F.filter(s, lambda x, j: (x["t"] == F.get(s, j + 1)["t"]) | (x["t"] == F.get(s, j - 1)["t"]))
    covered = F.aggregate(
        F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return [("__w", words), ("__s", F.sort_array(windows)), ("__p", F.sort_array(F.transform(repeated, lambda x: x["i"]))),
            ("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for name, col in _repeat_words(F.regexp_extract_all(body, F.lit(SPACE_WORD), F.lit(0))):
        out = out.withColumn(name, col)
    out = out.withColumn("__l", F.filter(F.split(body, "\n", -1), lambda x: x.rlike(SPACE_WORD)))
    symbols = F.array_join(F.regexp_extract_all(body, F.lit("[#*$%&|<>]+"), F.lit(0)), "")
    n_words = F.size("__w").cast("long")
    failed = (n_words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n_words * MAX_REPEAT_PERCENT)
    found = F.struct(
        n_words.alias("n_words"), F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"), F.char_length(symbols).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words"), failed.alias("base_failed"))
    # a generator of one row: else a filter on a measure would be pushed below and the arrays built again for each element
    return out.select(*docs.columns, F.inline(F.array(found)))


def _failures() -> dict[str, Column]:
    return {
        "base": F.col("base_failed"),
        "symbols": F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOL_PERCENT,
        "lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINES_PERCENT,
    }


def host_counts(measured: DataFrame, host: str = "source") -> DataFrame:
    """``(host, n, base, symbols, lines)``: documents and failures of each host."""
    return (measured.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in _failures().items()]))


def beta_prior(counts: DataFrame) -> dict[str, tuple[float, float]]:
    """Per rule the (alpha, beta) that match mean and variance of the hosts' rates: one row comes back.

    The mean weighs hosts by documents. Sampling variance is taken off the
    spread of the rates; hosts that differ by no more than chance give a strong prior.
    """
    rate = lambda r: F.col(r) / F.col("n")
    aggs = [F.sum("n").alias("docs"), F.count(F.lit(1)).alias("hosts"), F.avg(1 / F.col("n")).alias("inv")]
    for r in RULES:
        aggs += [F.sum(r).alias(f"f_{r}"), F.avg(rate(r)).alias(f"m_{r}"), F.var_pop(rate(r)).alias(f"v_{r}")]
    row = counts.agg(*aggs).first()
    prior = {}
    for r in RULES:
        if not row["docs"]:
            prior[r] = (1.0, 1.0)
            continue
        mu = (row[f"f_{r}"] + 0.5) / (row["docs"] + 1.0)
        spread = max(row[f"v_{r}"] - mu * (1 - mu) * row["inv"], 1e-4 * mu * (1 - mu))
        strength = min(max(mu * (1 - mu) / spread - 1, 2.0), 1e4)
        prior[r] = (mu * strength, (1 - mu) * strength)
    return prior


def host_verdicts(measured: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``(host, n, rate_<rule>.., rejected)``: shrunk failure rates of each host and its verdict."""
    counts = stored(host_counts(measured, host), "host-counts")
    prior = beta_prior(counts)
    rates = [((F.col(r) + prior[r][0]) / (F.col("n") + prior[r][0] + prior[r][1])).alias(f"rate_{r}") for r in RULES]
    shrunk = counts.select("host", "n", *RULES, *rates)
    # the prior alone condemns nobody: the host's own rate must be as bad
    over = [(F.col(f"rate_{r}") > max_host_rate) & (F.col(r) > max_host_rate * F.col("n")) for r in RULES]
    return shrunk.withColumn("rejected", functools.reduce(operator.or_, over)).drop(*RULES)


def quality_verdicts(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per document: doc_id, its measures, base_failed, host_rejected, kept."""
    slim = docs.select("doc_id", F.col(host).alias("source"), F.col("text"))
    measured = stored(measures(slim).drop("text"), "measures")
    hosts = host_verdicts(measured, "source", max_host_rate).select(F.col("host").alias("source"), "rejected")
    out = measured.join(hosts, "source", "left")
    rejected = F.coalesce("rejected", F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      rejected.alias("host_rejected"), (~F.col("base_failed") & ~rejected).alias("kept"))


def apply_quality_rules(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept. Measures stay in the row, so no text is shuffled."""
    wide = docs.select(F.struct("*").alias("__row"), F.col(host).alias("__host"), F.col("text").alias("__text"))
    measured = measures(wide, "__text")
    verdicts = host_verdicts(stored(measured.drop("__row", "__text"), "measures"), "__host", max_host_rate)
    bad = stored(verdicts.filter("rejected").select(F.col("host").alias("__host")), "rejected-hosts")
    return measured.filter("NOT base_failed").join(bad, "__host", "left_anti").select("__row.*")
