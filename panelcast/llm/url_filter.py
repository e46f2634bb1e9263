"""URL filtering by a temporal list join.

Dated list entries (``key``, ``action`` add or remove, ``at``) become validity
intervals ``[valid_from, valid_to)`` per key, and an as-of join evaluates every
capture against the entries active when it was fetched. A key is a host or one
of its parent domains, or such a name followed by ``/`` and the first path
segment.

A verdict depends only on (host, first segment, fetch day), so captures are
reduced to those distinct triples before the join (a host with a third of all
captures sends one row per task, segment and day), and verdicts are joined
back on the triple, which spreads a hot host over its days.

Cases: a null or unparsable URL has no key and is never blocked; entries with
a null key, action or date never apply; of several entries with equal key and
date a removal comes last; equal captures are each returned; an entry takes
effect at its own date; empty tables give no rows or no blocks; other columns
of captures are ignored by the query and kept by ``filter_captures``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import stored


def url_host(url: Column) -> Column:
    """Lower-case host of an http(s) URL, without user, port and a final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def url_segment(url: Column) -> Column:
    """First path segment, empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def host_keys(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``(key, valid_from, valid_to)``: when each key is listed; ``valid_to`` is null while it still is."""
    good = entries.filter("key IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')").select("key", "at", "action")
    # one state per key and date: 'remove' sorts after 'add'
    state = good.groupBy("key", "at").agg(F.max("action").alias("action"))
    by = Window.partitionBy("key").orderBy("at")
    changes = state.withColumn("prev", F.lag("action").over(by)).filter("prev IS NULL OR prev <> action")
    return (changes.withColumn("valid_to", F.lead("at").over(by)).filter("action = 'add'")
            .select("key", F.col("at").alias("valid_from"), "valid_to"))


def _judged(captures: DataFrame, entries: DataFrame, url: str, fetched: str) -> DataFrame:
    """``captures`` with ``__host`` and ``__n``, the number of its keys listed when it was fetched."""
    asked = captures.withColumn("__host", url_host(F.col(url))).withColumn("__seg", url_segment(F.col(url))).withColumn("__at", F.col(fetched))
    triple = ["__host", "__seg", "__at"]
    distinct = asked.filter("__host IS NOT NULL AND __at IS NOT NULL").select(*triple).distinct()
    names = host_keys(F.col("__host"))
    with_path = F.when(F.col("__seg") != "", F.transform(names, lambda x: F.concat_ws("/", x, F.col("__seg")))).otherwise(F.array().cast("array<string>"))
    keyed = distinct.withColumn("key", F.explode(F.concat(names, with_path)))
    valid = stored(intervals(entries), "list-intervals")
    active = keyed.join(valid, "key").filter((F.col("__at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to"))))
    verdict = active.groupBy(*triple).agg(F.count(F.lit(1)).alias("__n"))
    return asked.join(verdict, triple, "left").withColumn("__n", F.coalesce("__n", F.lit(0)).cast("long"))


def capture_verdicts(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with host, blocked and n_active (keys of its URL that were listed when it was fetched).

    A column of ``captures`` with one of these names is replaced.
    """
    own = [c for c in captures.columns if c not in ("host", "n_active", "blocked")]
    return _judged(captures, entries, url, fetched).select(*own, F.col("__host").alias("host"), F.col("__n").alias("n_active"), (F.col("__n") > 0).alias("blocked"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """The captures no active entry blocks, with their own columns."""
    return _judged(captures, entries, url, fetched).filter("__n = 0").select(*captures.columns)
