"""Hard-negative mining with angular triangle filtering.

Components become whole numbers floor(256 * x), so scores (inner products) are
exact. For every row the angles to ``REFERENCES`` directions are known. For an
anchor at angle s and a row at angle t from a direction, their own angle lies
in [|s - t|, min(s + t, 2 pi - s - t)]; the narrowest interval over all
directions, as cosines and times both norms, bounds the score. Angles are
widened by ``SLACK`` and bounds rounded outwards, so no row is lost.

* Rows are range-partitioned by (label, nearest direction, angle, id) and cut
  into windows of up to ``WINDOW`` rows of one label, which store their
  vectors, the least and greatest angle to each direction and of the norms.
* Anchors meet windows in cells of ``GROUP`` anchors and about ``SLICE`` rows;
  a cell holds both packed. Per anchor, windows whose bounds cannot reach the
  wanted scores or the best found so far are left out; the rest get one exact
  matrix product. A cell gives its own best rows only, and a ranked window
  merges the cells.
* Two passes: the best rows of the anchor's label are its positives, then the
  best rows of other labels within each positive's score range its negatives.

The search is exact: directions are fitted on ``SAMPLE`` rows (the least by a
hash of the id), which only decides how much is left out. The work is a set of
stated queries against all rows, in blocks: each row goes to every anchor
group once, each anchor to every slice.

Cases: rows with a null id, label or vector, or any null or non-finite
component (also after the factor 256) take no part; shorter vectors count as
filled up with zeros, an empty one as all zeros; equal scores go by the
smaller id; a repeated row is a candidate each time, and an anchor that
stands several times is taken once, with its least (label, vector); rows with
the anchor's id are never its candidates; an anchor without positives or
negatives gives no rows; scores beyond 64 bits count as the nearest 64-bit
number; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import stored

SCALE = 256
REFERENCES = 16
SAMPLE = 2048
WINDOW = 256
SLICE = 16_384
GROUP = 65_536
CHUNK = 1024
SLACK = 1e-5
EXACT = 2.0 ** 53
LEAST = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part; components are scaled, not yet floored."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad))


def directions(sample: np.ndarray, count: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Unit directions by spherical k-means from farthest-first starts."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def angles(vectors: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angle to each direction); a zero vector is at a right angle to all."""
    largest = np.maximum(np.abs(vectors).max(1, initial=0), 1e-300)
    scaled = vectors / largest[:, None]
    size = np.linalg.norm(scaled, axis=1)
    unit = scaled / np.maximum(size, 1e-300)[:, None]
    return size * largest, np.arccos(np.clip(unit @ refs.T, -1, 1))


def _matrix(vectors, dim: int) -> np.ndarray:
    """Floored components, filled up with zeros to ``dim``."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.floor(v)
    return out


def _located(refs: np.ndarray, dim: int):
    """Vectors as bytes, with the nearest direction and its angle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = _matrix(b["vector"], dim)
            _, angle = angles(m, refs)
            near = angle.argmin(1)
            yield pd.DataFrame({"vec_id": b["vec_id"], "label": b["label"], "near": near, "angle": angle[np.arange(len(m)), near],
                                "packed": [row.tobytes() for row in m]})
    return run


def _cut(refs: np.ndarray, dim: int, rows: int):
    """Windows of a sorted partition: of one label and nearest direction, ``rows`` at most."""
    def window(part: pd.DataFrame) -> dict:
        m = np.frombuffer(b"".join(part["packed"]), np.float64).reshape(len(part), dim)
        norm, angle = angles(m, refs)
        narrow = np.abs(m).max(initial=0) <= 2 ** 24
        return {"label": part["label"].iloc[0], "n": len(part), "ids": part["vec_id"].to_numpy(np.int64).tobytes(), "narrow": narrow,
                "vectors": m.astype(np.float32 if narrow else np.float64).tobytes(),
                "bounds": np.concatenate([[norm.min(), norm.max()], angle.min(0), angle.max(0)]).tobytes()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            change = np.flatnonzero((b["label"].to_numpy()[1:] != b["label"].to_numpy()[:-1]) | (b["near"].to_numpy()[1:] != b["near"].to_numpy()[:-1])) + 1
            edges = [0, *change.tolist(), len(b)]
            out = []
            for a, z in zip(edges, edges[1:]):
                last = z == len(b)
                while z - a >= rows or (a < z and not last):
                    out.append(window(b.iloc[a:min(a + rows, z)]))
                    a = min(a + rows, z)
                rest = b.iloc[a:z]
            if out:
                yield pd.DataFrame(out)
        if rest is not None and len(rest):
            yield pd.DataFrame([window(rest)])
    return run


WINDOWS = "label long, n long, ids binary, narrow boolean, vectors binary, bounds binary"


class Best:
    """The best ``k`` (score, id) of each row, higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k, self.score, self.id = k, np.full((rows, k), LEAST), np.full((rows, k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """One row for each of ``row``, of ``score`` (rows x ids); a score of LEAST is none."""
        if score.shape[1] > self.k:
            kth = np.partition(score, -self.k, axis=1)[:, -self.k]
        else:
            kth = np.full(len(row), LEAST)
        floor, floor_id = np.maximum(self.score[row, -1], kth), self.id[row, -1]
        good = (score > LEAST) & (score >= floor[:, None])
        good &= ~((score == self.score[row, -1][:, None]) & (ids[None, :] >= floor_id[:, None]))
        at, col = np.nonzero(good)
        if not len(at):
            return
        touched = np.unique(at)
        r = np.concatenate([at, np.repeat(touched, self.k)])
        s = np.concatenate([score[at, col], self.score[row[touched]].ravel()])
        i = np.concatenate([ids[col], self.id[row[touched]].ravel()])
        order = np.lexsort((i, ~s, r))
        r, s, i = r[order], s[order], i[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        keep = rank < self.k
        self.score[row[touched]] = s[keep].reshape(-1, self.k)
        self.id[row[touched]] = i[keep].reshape(-1, self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(self.score > LEAST)


def exact_scores(a: np.ndarray, a_norm: np.ndarray, b: np.ndarray, b_norm: float) -> np.ndarray:
    """Integer inner products: sums below 2^53 are exact in doubles, larger ones go through Python's integers."""
    if (a_norm.max(initial=0) * 1.001 + 1) * (b_norm * 1.001 + 1) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    product = np.dot(whole(a), whole(b).T)
    return np.clip(product, -(2 ** 63) + 1, 2 ** 63 - 1).astype(np.int64)


def score_bounds(norm: np.ndarray, angle: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) possible score of each anchor with each window, rounded outwards."""
    m = angle.shape[1]
    low_norm, high_norm, low, high = bounds[:, 0], bounds[:, 1], bounds[:, 2:2 + m], bounds[:, 2 + m:]
    near = np.zeros((len(norm), len(bounds)))
    far = np.full((len(norm), len(bounds)), np.pi)
    for j in range(m):
        s = angle[:, j:j + 1]
        near = np.maximum(near, np.maximum(s - high[:, j], low[:, j] - s))
        far = np.minimum(far, np.minimum(s + high[:, j], 2 * np.pi - s - low[:, j]))
    top, bottom = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    highest = norm[:, None] * np.where(top > 0, high_norm, low_norm) * top
    lowest = norm[:, None] * np.where(bottom > 0, low_norm, high_norm) * bottom
    return lowest - np.abs(lowest) * 1e-9 - 1, highest + np.abs(highest) * 1e-9 + 1


def _unpack(windows: pd.DataFrame, dim: int):
    ids = [np.frombuffer(x, np.int64) for x in windows["ids"]]
    vectors = [np.frombuffer(v, np.float32 if narrow else np.float64).reshape(-1, dim) for v, narrow in zip(windows["vectors"], windows["narrow"])]
    bounds = np.stack([np.frombuffer(x, np.float64) for x in windows["bounds"]])
    return ids, vectors, windows["label"].to_numpy(np.int64), bounds


def _cell(refs: np.ndarray, dim: int, positives: int, negatives: int, low: int, high: int, second: bool):
    """The best rows of a cell: of the anchors' own label, or of other labels within each positive's range."""
    names = ["anchor_id", "place", "positive_id", "positive_score", "found_id", "score"]

    def first_pass(best, own, own_label, m, norm, ids, vectors, label, bounds):
        lowest, highest = score_bounds(norm, angles(m, refs)[1], bounds)
        for w in np.argsort(-highest.mean(0), kind="stable").tolist():
            rows = np.flatnonzero((own_label == label[w]) & (highest[:, w] >= best.score[:, -1]))
            if len(rows):
                score = exact_scores(m[rows], norm[rows], vectors[w].astype(np.float64), bounds[w, 1])
                score[own[rows][:, None] == ids[w][None, :]] = LEAST
                best.add(rows, score, ids[w])

    def second_pass(best, own_label, floor, ceiling, m, norm, ids, vectors, label, bounds):
        lowest, highest = score_bounds(norm, angles(m, refs)[1], bounds)
        k = floor.shape[1]
        for w in np.argsort(-highest.mean(0), kind="stable").tolist():
            reach = np.maximum(floor, best.score[:, -1].reshape(-1, k))
            wanted = (highest[:, w][:, None] >= reach) & (lowest[:, w][:, None] <= ceiling) & (floor <= ceiling)
            rows = np.flatnonzero((own_label != label[w]) & wanted.any(1))
            if len(rows):
                score = exact_scores(m[rows], norm[rows], vectors[w].astype(np.float64), bounds[w, 1])
                for p in range(k):
                    mine = np.flatnonzero(wanted[rows, p])
                    part, r = score[mine], rows[mine]
                    part = np.where((part >= floor[r, p][:, None]) & (part <= ceiling[r, p][:, None]), part, LEAST)
                    best.add(r * k + p, part, ids[w])

    def run(key, windows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(windows) or not len(anchors):
            return pd.DataFrame([], columns=names)
        unpacked = _unpack(windows, dim)
        out = []
        for a in range(0, len(anchors), CHUNK):
            part = anchors.iloc[a:a + CHUNK]
            own, own_label = part["vec_id"].to_numpy(np.int64), part["label"].to_numpy(np.int64)
            m = np.frombuffer(b"".join(part["packed"]), np.float64).reshape(-1, dim)
            norm = angles(m, refs)[0]
            if not second:
                best = Best(len(part), positives)
                first_pass(best, own, own_label, m, norm, *unpacked)
                at, k = best.found()
                out.append(pd.DataFrame({"anchor_id": own[at], "place": 0, "positive_id": 0, "positive_score": 0, "found_id": best.id[at, k], "score": best.score[at, k]}))
            else:
                ids = np.zeros((len(part), positives), np.int64)
                scores, floor, ceiling = ids.copy(), np.ones_like(ids), np.zeros_like(ids)
                for i, found in enumerate(part["found"]):
                    for p, x in enumerate(found):
                        ids[i, p], scores[i, p] = x["id"], x["score"]
                        floor[i, p], ceiling[i, p] = -(-low * int(x["score"]) // 100), high * int(x["score"]) // 100
                best = Best(len(part) * positives, negatives)
                second_pass(best, own_label, floor, ceiling, m, norm, *unpacked)
                at, k = best.found()
                i, p = at // positives, at % positives
                out.append(pd.DataFrame({"anchor_id": own[i], "place": p, "positive_id": ids[i, p], "positive_score": scores[i, p], "found_id": best.id[at, k], "score": best.score[at, k]}))
        return pd.concat(out, ignore_index=True)
    return run


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition on vec_id. Negatives score ``low`` to ``high`` percent of their positive.
    """
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).select("vector").toPandas()["vector"]
    dim = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    refs = directions(_matrix(sample, dim)) if len(sample) else np.eye(1, dim)
    located = rows.mapInPandas(_located(refs, dim), "vec_id long, label long, near int, angle double, packed binary")
    order = ["label", "near", "angle", "vec_id"]
    cut = located.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_cut(refs, dim, WINDOW), WINDOWS)
    windows = stored(cut.withColumn("no", F.monotonically_increasing_id()), "windows")
    anchors = stored(located.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "packed")).alias("x")).select("vec_id", "x.label", "x.packed"), "anchors")
    slices = max(1, -(-(windows.agg(F.sum("n")).first()[0] or 0) // SLICE))
    groups = max(1, -(-anchors.count() // GROUP))
    dealt = windows.withColumn("s", F.pmod(F.xxhash64("no"), F.lit(slices))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).drop("no", "n")
    named = "anchor_id long, place long, positive_id long, positive_score long, found_id long, score long"

    def cells(asked: DataFrame, second: bool) -> DataFrame:
        asked = (asked.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
                 .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>"))))
        run = _cell(refs, dim, positives, negatives, low, high, second)
        return dealt.groupBy("g", "s").cogroup(asked.groupBy("g", "s")).applyInPandas(run, named)

    first = _ranked(cells(anchors, False), ["anchor_id"], positives)
    listed = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct(F.col("found_id").alias("id"), "score")).alias("found"))
    second = stored(anchors.join(listed, "vec_id"), "positives")
    best = _ranked(cells(second, True), ["anchor_id", "place"], negatives)  # by place: a repeated positive is two
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
