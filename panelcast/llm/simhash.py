"""SimHash near-duplicates through vantage-point trees.

A text's fingerprint takes, per bit, the majority of the XXH64 values of its
``SHINGLE``-word shingles. Fingerprints at most ``max_bits`` apart are linked,
and a component of links is a group of near-duplicates.

Close pairs are searched exactly among distinct fingerprints. Two of them that
differ in at most ``max_bits`` bits differ in at most ``max_bits // SEGMENTS``
bits of some segment, so each segment has a vantage-point tree in its own
Hamming metric with that small radius, where the triangle bounds still prune
(in all 64 bits every distance lies near 32 and nothing would). The top of
each tree is fitted to a bounded sample (``SAMPLE`` distinct fingerprints, the
smallest by hash); its leaves are shards. Every fingerprint is stored in one
shard per segment and asked in all shards whose bounds its ball overlaps.
Inside a shard the tree goes on: inner nodes are built from the shard's own
fingerprints, branches are pruned by the same bounds, and leaves compare all
64 bits. A shard is cut into blocks of ``STORED`` x ``ASKED`` fingerprints, so
a dense cluster becomes more tasks, not a larger one. A block returns a
spanning forest of its links, never all pairs.

Components are found by alternating large and small stars on the forest edges
until nothing changes; joins are on minima, no neighbour list is collected.

Cases: a null or empty text has fingerprint zero and links like any other;
copies have distance zero; a component's id is its smallest non-null doc_id,
null if it has none; equal rows are in one component; an empty table gives no
rows; other columns are kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import row_key, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
SAMPLE = 16384
SHARD = 8192
MAX_DEPTH = 12
STORED, ASKED = 32768, 262144
_LEAF = 64
_CELLS = 1 << 21
_ROWS = 1 << 16


# ---- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority fingerprint, unsigned; a bit is 1 if set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    end = np.cumsum(sizes) - 1
    start = end - sizes + 1
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(body[a:b], SEED) for a, b in zip(start[:len(words) - k + 1].tolist(), end[k - 1:].tolist())], dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        bits = np.unpackbits(hashes[at:at + _ROWS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, shingle: int = SHINGLE) -> Column:
    """Fingerprint as a long (the unsigned value's bits)."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64), index=texts.index)
    return run(F.col(text))


# ---- vantage-point trees ----------------------------------------------------------------------

def _segment(fp: np.ndarray, s: int) -> np.ndarray:
    first, bits = SEGMENTS[s]
    return (fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)


def _distance(x: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(x ^ v)


@dataclass
class Node:
    """Inside: distance to ``vantage`` up to ``bound``; outside: beyond it. A leaf has a shard number instead."""

    shard: int = -1
    vantage: int = 0
    bound: int = 0
    inside: "Node | None" = None
    outside: "Node | None" = None


def _split(seg: np.ndarray, rng: np.random.Generator) -> tuple[int, int] | None:
    """A vantage point and a bound that leave something on both sides; the best balanced of a few."""
    best = None
    for v in rng.choice(seg, size=min(4, len(seg)), replace=False):
        d = _distance(seg, v)
        bound = int(np.median(d))
        if bound == d.max():
            bound -= 1
        share = abs(np.count_nonzero(d <= bound) / len(d) - 0.5)
        if d.max() > d.min() and (best is None or share < best[0]):
            best = share, int(v), bound
    return best and best[1:]


def top_trees(sample: np.ndarray, depth: int) -> list[Node]:
    """One tree per segment; leaves are numbered through."""
    rng, shards = np.random.default_rng(SEED), iter(range(1 << 62))

    def build(seg: np.ndarray, left: int) -> Node:
        found = _split(seg, rng) if left and len(seg) >= 8 else None
        if found is None:
            return Node(shard=next(shards))
        d = _distance(seg, np.uint64(found[0]))
        return Node(-1, found[0], found[1], build(seg[d <= found[1]], left - 1), build(seg[d > found[1]], left - 1))

    return [build(_segment(sample, s), depth) for s in range(len(SEGMENTS))]


def route(trees: list[Node], fp: np.ndarray, radius: int) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(shard, stored, fingerprints): where each fingerprint is stored, and where its ball has to be asked."""
    def down(node: Node, seg: np.ndarray, own: np.ndarray, r: int) -> Iterator[tuple[int, np.ndarray]]:
        if not len(own):
            return
        if node.shard >= 0:
            yield node.shard, own
            return
        d = _distance(seg, np.uint64(node.vantage)).astype(np.int64)
        left, right = d - r <= node.bound, d + r > node.bound
        yield from down(node.inside, seg[left], own[left], r)
        yield from down(node.outside, seg[right], own[right], r)

    for s, tree in enumerate(trees):
        seg = _segment(fp, s)
        for is_stored, r in ((True, 0), (False, radius)):
            for shard, own in down(tree, seg, fp, r):
                yield shard, is_stored, own


class Forest:
    """Union-find over numbered points, many unions at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            p = self.parent[x]
            if np.array_equal(p, x):
                return x
            x = p

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def search(kept: np.ndarray, asked: np.ndarray, s: int, max_bits: int, link) -> None:
    """Call ``link(i, j)`` for every pair of ``kept[i]``, ``asked[j]`` at most ``max_bits`` apart whose segment is near enough."""
    radius = max_bits // len(SEGMENTS)
    kseg, aseg = _segment(kept, s), _segment(asked, s)
    rng = np.random.default_rng(SEED)

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        step = max(1, _CELLS // max(1, len(i)))
        for at in range(0, len(j), step):
            part = j[at:at + step]
            near = _distance(kept[i][:, None], asked[part][None, :]) <= max_bits
            x, y = np.nonzero(near)
            if len(x):
                link(i[x], part[y])

    def down(i: np.ndarray, j: np.ndarray) -> None:
        if not len(i) or not len(j):
            return
        found = _split(kseg[i], rng) if len(i) > _LEAF else None
        if found is None:
            compare(i, j)
            return
        v, bound = np.uint64(found[0]), found[1]
        di, dj = _distance(kseg[i], v).astype(np.int64), _distance(aseg[j], v).astype(np.int64)
        down(i[di <= bound], j[dj - radius <= bound])
        down(i[di > bound], j[dj + radius > bound])

    down(np.arange(len(kept)), np.arange(len(asked)))


def _links(first_shard: list[int], max_bits: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        s = int(np.searchsorted(first_shard, block["shard"].iloc[0], side="right")) - 1
        fp, is_stored = block["fp"].to_numpy().view(np.uint64), block["stored"].to_numpy()
        points, at = np.unique(fp, return_inverse=True)
        forest = Forest(len(points))
        kept, asked = np.unique(at[is_stored]), np.unique(at[~is_stored])
        search(points[kept], points[asked], s, max_bits, lambda i, j: forest.union(kept[i], asked[j]))
        root = forest.find(np.arange(len(points)))
        child = np.flatnonzero(root != np.arange(len(points)))
        return pd.DataFrame({"a": points[child].view(np.int64), "b": points[root[child]].view(np.int64)})
    return run


def _first_shards(trees: list[Node]) -> list[int]:
    def least(node: Node) -> int:
        return node.shard if node.shard >= 0 else least(node.inside)
    return [least(t) for t in trees]


def close_pairs(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints ``fp`` (distinct) that links connect."""
    sample = points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(1, points.count() / SHARD))))))
    trees = top_trees(sample, depth)
    radius = max_bits // len(SEGMENTS)

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard, is_stored, own in route(trees, b["fp"].to_numpy(dtype=np.int64).view(np.uint64), radius):
                yield pd.DataFrame({"shard": shard, "stored": is_stored, "fp": own.view(np.int64)})

    rows = points.select("fp").mapInPandas(routed, "shard int, stored boolean, fp long")
    # blocks per shard: at most one row for each leaf of the top trees, 2 ** MAX_DEPTH a segment
    sizes = rows.groupBy("shard").agg(
        F.ceil(F.count_if("stored") / STORED).cast("int").alias("rows"), F.ceil(F.count_if(~F.col("stored")) / ASKED).cast("int").alias("cols"))
    cut = rows.join(F.broadcast(stored(sizes, "shard-sizes")), "shard")
    mine = F.pmod(F.xxhash64("fp"), F.when(F.col("stored"), F.col("rows")).otherwise(F.col("cols"))).cast("int")
    others = F.when(F.col("stored"), F.col("cols")).otherwise(F.col("rows"))
    spread = cut.withColumn("mine", mine).filter(others > 0).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    block = spread.select("shard", "stored", "fp", F.when(F.col("stored"), F.col("mine")).otherwise(F.col("other")).alias("row"),
                          F.when(F.col("stored"), F.col("other")).otherwise(F.col("mine")).alias("col"))
    return block.groupBy("shard", "row", "col").applyInPandas(_links(_first_shards(trees), max_bits), "a long, b long")


# ---- components -------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the smallest node it is connected to."""
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: larger neighbours go to the smallest
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root")).distinct()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, k, fp)`` per row, stored."""
    return stored(docs.select("doc_id", row_key("doc_id", "text").alias("k"), fingerprint_column("text", shingle).alias("fp")), "fingerprints")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, k, fp, component_id."""
    marked = fingerprints(docs, shingle)
    points = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    roots = stored(components(close_pairs(points, max_bits)), "components").withColumnRenamed("node", "fp")
    label = F.coalesce("root", "fp")
    named = points.join(roots, "fp", "left").select("fp", "first", label.alias("label"))
    ids = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = stored(named.join(ids, "label").select("fp", "component_id"), "component-ids")
    return marked.join(of, "fp").select("doc_id", "k", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component with all columns: the smallest doc_id's (a component without ids: the smallest key's)."""
    found = near_duplicates(docs, shingle, max_bits)
    # without an id the components are told apart by nothing in component_id, so by fingerprint: such rows stay one per fingerprint
    group = F.when(F.col("component_id").isNull(), F.col("fp"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("k"))
    best = found.groupBy("component_id", group.alias("g")).agg(F.min(order).alias("o")).select(F.col("o.k").alias("__k"))
    kept = docs.withColumn("__k", row_key("doc_id", "text")).join(stored(best, "kept-keys"), "__k", "left_semi")
    return kept.dropDuplicates(["__k"]).select(*docs.columns)
