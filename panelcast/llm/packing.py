"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words and packed into
bins of that capacity. Bins are kept ordered by residual and carry a bitmap of
the sources and one of the duplicate clusters they hold. A piece goes to the
bin with the least residual that is large enough (the successor of its length)
and whose bitmaps have neither of its bits; the search goes on to the next
residual until such a bin is found, and opens a bin only if there is none.
Pieces of one document share a source, so they never meet in a bin either.

Packing runs in shards of about ``SHARD`` pieces, dealt by a hash of the row's
number in the stored pieces table, so any source, cluster or repeated row is
spread over all shards and a shard is bounded at every size; each shard is
packed whole by one grouped function that holds lengths and ids, never texts.
Longest pieces go first.

Cases: a null or empty text has no words and makes one empty piece; a null
source or cluster conflicts with nothing; equal rows have the same cluster and
so share no bin; ties go by document, piece and key; a document longer than a
bin fills several; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SPACE_WORD, row_key, stored

CAPACITY = 2048
SHARD = 4096


def text_cluster(text: str = "text") -> Column:
    """Key of a text's exact copies: its words, ASCII case and spacing aside; null for a text without words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(SPACE_WORD), F.lit(0))
    return F.when(F.size(words) > 0, F.hex(F.xxhash64(words)))


def pieces(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None) -> DataFrame:
    """``(doc_id, k, source, cluster, n_words, piece, first_word, length)``: every word of every document once."""
    n = F.size(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACE_WORD), F.lit(0))).cast("long")
    slim = docs.select("doc_id", row_key("doc_id", "text").alias("k"), F.col("source").cast("string").alias("source"),
                       (text_cluster() if cluster is None else cluster).cast("string").alias("cluster"), n.alias("n_words"))
    count = F.greatest(F.ceil(F.col("n_words") / capacity), F.lit(1)).cast("int")
    cut = slim.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    first = F.col("piece").cast("long") * capacity
    return cut.withColumn("first_word", first).withColumn("length", F.least(F.lit(capacity), F.col("n_words") - F.col("first_word")))


class ResidualBins:
    """Bins ordered by (residual, number); each with a source and a cluster bitmap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into the tightest compatible bin; returns the bin and the residual before."""
        order, sources, clusters = self.order, self.sources, self.clusters
        for at in range(bisect_left(order, (length, -1)), len(order)):
            residual, b = order[at]
            if not (sources[b] & source or clusters[b] & cluster):
                del order[at]
                break
        else:
            b, residual = len(sources), self.capacity
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        insort(order, (residual - length, b))
        return b, residual


def _bits(values: pd.Series) -> list[int]:
    """One bit for each value that occurs twice or more in the shard, none for others and nulls."""
    codes, _ = pd.factorize(values)
    seen = pd.Series(codes[codes >= 0]).value_counts()
    bit = {c: 1 << i for i, c in enumerate(sorted(seen.index[seen > 1]))}
    return [bit.get(c, 0) for c in codes]


def _pack(capacity: int):
    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "doc_id", "piece", "k"], ascending=[False, True, True, True]).reset_index(drop=True)
        bins, out = ResidualBins(capacity), []
        for length, s, c in zip(shard["length"].tolist(), _bits(shard["source"]), _bits(shard["cluster"])):
            b, residual = bins.place(length, s, c)
            out.append((b, capacity - residual))
        shard["bin"] = [b for b, _ in out]
        shard["bin_offset"] = [o for _, o in out]
        return shard[["doc_id", "piece", "first_word", "length", "shard", "bin", "bin_offset"]]
    return pack


SCHEMA = "doc_id string, piece int, first_word long, length long, shard long, bin long, bin_offset long"


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD, cluster: Column | None = None) -> DataFrame:
    """One row per piece: its document, words, shard, bin and offset in the bin. (shard, bin) names a bin."""
    cut = stored(pieces(docs, capacity, cluster).withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))
    # ids travel as text: pandas would make integers with nulls floats
    dealt = cut.select(F.col("doc_id").cast("string").alias("doc_id"), "k", "source", "cluster", "piece", "first_word", "length",
                       F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
    packed = dealt.groupBy("shard").applyInPandas(_pack(capacity), SCHEMA)
    return packed.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
