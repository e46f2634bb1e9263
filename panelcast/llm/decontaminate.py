"""Benchmark decontamination by a distributed positional inverted index.

Postings ``(term, k, pos)`` of the training documents are written once, for
every term some test item holds (no other term's list is ever read); ``k`` is
the key of a document row. A phrase is found as an index does it: from the
list of the window's rarest term, each posting fixes the alignment
``delta = pos - j`` of an item in a document, below 0 where the document starts
inside the item; the second rarest term's list,
shifted by its offset, is intersected with it on ``(k, pos, term)``, a key no
document makes hot; what survives is intersected with the lists of all terms
of the item, and stretches of matched offsets are the exact phrase matches.
``proximity_matches`` intersects the same lists within a distance.

All of it is DataFrame code. The vocabulary, rarity and window tables have the
size of the test set, are stored, and are broadcast only while their stored
size is under Spark's threshold.

Cases: a null or empty text has no words and is clean; an item without words
has no window; items with equal id and text count once, one with a null id
marks words but is not counted or named; repeated document rows each get the
same result; an empty documents or benchmark table gives no rows or no hits;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import ascii_lower, stored

WINDOW = 10
#: Words of the lower-cased text, ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, taken before lower-casing. Said positively: Java
#: matches the negated class about twenty times slower.
RAW_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def row_key(*cols: str) -> Column:
    """64-bit key of a row's content. One stands in every posting, so it is short: among 1e10 documents of which 1e7 hold a
    test passage, the odds that one clean document shares a key with them, and is marked, are about 1 in 200."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in cols])


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RAW_WORD), F.lit(0))


def item_terms(items: DataFrame) -> DataFrame:
    """``(iid, item_id, n, j, term)``: the words of every item that has some."""
    return (items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
            .select(row_key("item_id", "text").alias("iid"), "item_id", _words(F.col("text")).alias("w"))
            .select("iid", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("j", "word"))
            .select("iid", "item_id", "n", "j", ascii_lower(F.col("word")).alias("term")))


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(tid, k, pos)`` of all words of all documents that are in ``vocabulary (term, tid)``."""
    words = docs.select(row_key("doc_id", "text").alias("k"), F.posexplode(_words(F.col("text"))).alias("pos", "word"))
    return words.withColumn("term", ascii_lower(F.col("word"))).join(vocabulary, "term").select("tid", "k", "pos")


class PositionalIndex:
    """Stored postings of ``docs`` for the terms of ``items``, with corpus counts per term."""

    def __init__(self, docs: DataFrame, items: DataFrame):
        terms = item_terms(items)
        vocabulary = stored(terms.select("term").distinct().select("term", F.xxhash64("term").alias("tid")), "vocabulary")
        self.lists = stored(postings(docs, vocabulary), "postings")
        counts = self.lists.groupBy("tid").agg(F.count(F.lit(1)).alias("cnt"))
        # a term without postings keeps a count of 0: its windows occur nowhere
        self.terms = stored(terms.withColumn("tid", F.xxhash64("term")).drop("term").join(counts, "tid", "left")
                            .fillna(0, ["cnt"]), "item-terms")

    def window_terms(self, window: int) -> DataFrame:
        """Terms of each window of an item, rarest first (``r`` = 1); windows with an unseen term left out."""
        size = F.least(F.col("n"), F.lit(window))
        starts = F.explode(F.sequence(F.greatest(F.col("j") - size + 1, F.lit(0)), F.least(F.col("j"), F.col("n") - size)))
        by = Window.partitionBy("iid", "s")
        return (self.terms.withColumn("s", starts)
                .withColumn("least", F.min("cnt").over(by)).filter("least > 0")
                .withColumn("r", F.row_number().over(by.orderBy("cnt", "j"))))

    def alignments(self, window: int) -> DataFrame:
        """``(k, iid, delta)`` where the rarest and second rarest terms of some window both fall in place."""
        wt = self.window_terms(window)
        first = wt.filter("r = 1").select("iid", "s", "j", "tid")
        second = wt.filter("r = 2").select("iid", "s", F.col("j").alias("j2"), F.col("tid").alias("tid2"))
        seeds = stored(first.join(second, ["iid", "s"], "left").select("iid", "j", "tid", "j2", "tid2").distinct(), "seeds")
        cand = (self.lists.join(seeds, "tid")
                .select("k", "iid", (F.col("pos") - F.col("j")).alias("delta"), "tid2", (F.col("pos") - F.col("j") + F.col("j2")).alias("pos2")))
        wanted = seeds.select(F.col("tid2").alias("tid")).distinct()
        shifted = self.lists.join(wanted, "tid", "left_semi").select("k", F.col("tid").alias("tid2"), F.col("pos").alias("pos2"))
        both = cand.filter("tid2 IS NOT NULL").join(shifted, ["k", "tid2", "pos2"], "left_semi")
        alone = cand.filter("tid2 IS NULL")  # items of one word
        return both.unionByName(alone).select("k", "iid", "delta").distinct()

    def phrase_matches(self, window: int = WINDOW) -> DataFrame:
        """``(k, iid, item_id, n, delta, starts)``: item offsets whose window occurs in the document at ``delta + start``."""
        found = stored(self.alignments(window), "alignments")
        near = self.lists.join(stored(found.select("k").distinct(), "aligned-docs"), "k", "left_semi")
        expected = found.join(self.terms, "iid").select("k", "iid", "item_id", "n", "delta", "j", "tid", (F.col("delta") + F.col("j")).alias("pos"))
        matched = (expected.join(near, ["k", "pos", "tid"], "left_semi").groupBy("k", "iid", "item_id", "n", "delta")
                   .agg(F.sort_array(F.collect_set("j")).alias("js")))
        size = F.least(F.col("n"), F.lit(window))
        starts = F.filter(F.col("js"), lambda x, i: F.get(F.col("js"), i + size - 1) == x + size - 1)
        return matched.withColumn("starts", starts).filter(F.size("starts") > 0).drop("js")

    def proximity_matches(self, slop: int) -> DataFrame:
        """``(k, iid, item_id, pos)``: places of an item's rarest term with all its other terms at most ``slop`` words away.

        Lists are matched in blocks of ``slop + 1`` positions and the two blocks beside them.
        """
        by = Window.partitionBy("iid")
        uniq = self.terms.groupBy("iid", "item_id", "tid").agg(F.max("cnt").alias("cnt"))
        ranked = (uniq.withColumn("least", F.min("cnt").over(by)).filter("least > 0")
                  .withColumn("need", F.count(F.lit(1)).over(by))
                  .withColumn("r", F.row_number().over(by.orderBy("cnt", "tid"))))
        block = slop + 1
        seeds = self.lists.join(ranked.filter("r = 1").select("iid", "item_id", "tid", "need"), "tid").drop("tid")
        others = ranked.filter("r > 1").select("iid", F.col("tid").alias("tid2"))
        probes = (seeds.join(others, "iid", "left")
                  .withColumn("b", F.explode(F.array(*[F.floor(F.col("pos") / block) + d for d in (-1, 0, 1)]))))
        lists = self.lists.select("k", F.col("tid").alias("tid2"), F.col("pos").alias("pos2"), F.floor(F.col("pos") / block).alias("b"))
        hit = probes.join(lists, ["k", "tid2", "b"]).filter(F.abs(F.col("pos2") - F.col("pos")) <= slop)
        full = (hit.groupBy("k", "iid", "item_id", "pos", "need").agg(F.count_distinct("tid2").alias("found"))
                .filter("found = need - 1").select("k", "iid", "item_id", "pos"))
        return full.unionByName(seeds.filter("need = 1").select("k", "iid", "item_id", "pos"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, n_items, items (array), contaminated``."""
    matches = PositionalIndex(docs, items).phrase_matches(window)
    size = F.least(F.col("n"), F.lit(window))
    spans = matches.select("k", "item_id", "delta", F.explode("starts").alias("s"), size.alias("size"))
    hit = (spans.select("k", F.explode(F.sequence(F.col("delta") + F.col("s"), F.col("delta") + F.col("s") + F.col("size") - 1)).alias("pos"))
           .distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n_hit")))
    named = matches.groupBy("k").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    base = docs.select("doc_id", row_key("doc_id", "text").alias("k"), F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    out = base.join(stored(hit.join(named, "k"), "contaminated"), "k", "left")
    items_col = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_col).cast("long").alias("n_items"),
                      items_col.alias("items"), (n_hit > 0).alias("contaminated"), "k")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of any item."""
    bad = contamination(docs, items, window).filter("contaminated").select(F.col("k").alias("__k")).distinct()
    return docs.join(stored(bad, "contaminated-keys"), row_key("doc_id", "text") == F.col("__k"), "left_anti")
