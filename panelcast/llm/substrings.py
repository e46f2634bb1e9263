"""Exact substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the least hash of
the ``MER``-word runs inside it; consecutive windows with one minimiser travel
as one packed string (a super-k-mer) to the minimiser's bucket, where all
occurrences of a window meet. There windows are sorted by a 64-bit hash and
document; every window that would be removed is compared word for word with
the first of its hash, and hashes that hold several windows are told apart by
their text, so counts are exact. A window is removed where a document with a
smaller id has it too; neighbouring removed windows go back as one range to
their document, whose kept words are then cut out.

Packing: a map task writes one compressed blob per bucket and batch. Equal
super-k-mers of a batch travel once with the places they came from, so copies
and common passages shrink before the shuffle. A place is the document (as a
difference to the place before), 32 bits of a hash of the text, which tell
different texts of one doc_id apart, and the number of its first word. The number of buckets follows
the size of all texts (about ``BUCKET_BYTES`` packed bytes each). Texts longer
than ``CHUNK`` bytes are cut into segments that overlap by ``window - 1`` words.

Cases: a null or empty text has no words; a text shorter than a window stays
whole; a row with a null doc_id is neither searched nor cut; rows with equal
doc_id do not remove from each other; equal rows are cut alike; an empty table
gives no rows; other columns are kept by ``dedup_substrings``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import stored

WINDOW = 13
MER = 3
CHUNK = 1 << 20
BUCKET_BYTES = 8 << 20
MAX_RUN = 256  # windows in a packed string, so that a range fits RANGE
FLUSH = 20 << 20
ZSTD_LEVEL = 5
RANGE = 512
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_P**i and _P**-i modulo 2**64, i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + (1 << 16))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)])) for base in (_P, _PINV)]
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ``buf[start:end]`` from prefix sums; equal bytes, equal hash."""
    power, inverse = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], out=total[1:])
    return _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def _word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``_span_hash`` of sorted word spans, in chunks of the buffer."""
    out, at = np.empty(len(start), dtype=np.uint64), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, int(start[at]) + CHUNK, side="right")))
        lo, hi = int(start[at]), int(end[to - 1])
        out[at:to] = _span_hash(buf[lo:hi], start[at:to] - lo, end[at:to] - lo)
        at = to
    return out


def single_spaced(text: str) -> bytes:
    """The words of a text joined by one space."""
    a = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    space = _SPACE[a]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    out = np.where(space, np.uint8(0x20), a)[keep]
    return out.tobytes().strip(b" ")


def _segments(body: bytes, window: int) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, bytes) of pieces of about CHUNK bytes that overlap by window - 1 words."""
    if len(body) <= CHUNK:
        yield 0, body
        return
    starts = np.concatenate([[0], np.flatnonzero(np.frombuffer(body, dtype=np.uint8) == 0x20) + 1])
    at = 0
    while True:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK)))
        last = min(to + window - 1, len(starts))
        yield at, body[starts[at]:(len(body) if last == len(starts) else starts[last] - 1)]
        if last == len(starts):
            return
        at = to


def _words_of(buf: np.ndarray, breaks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, line) of the words of a buffer of single-spaced lines that end in ``breaks``."""
    gap = np.flatnonzero((buf == 0x20) | (buf == breaks))
    start = np.concatenate([[0], gap[:-1] + 1]) if len(gap) else np.zeros(0, dtype=np.int64)
    line = np.cumsum(np.concatenate([[0], (buf[gap[:-1]] == breaks)])) if len(gap) else np.zeros(0, dtype=np.int64)
    return start, gap, line


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    size, low = 1, g
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


class _Packer:
    """Collects packed strings per bucket and writes them as blobs."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.held: dict[int, list] = {}
        self.size = 0
        self.zstd = zstandard.ZstdCompressor(level=ZSTD_LEVEL)

    def add(self, lines: list[bytes], doc: list[int], key: list[int], first: list[int]) -> None:
        """One buffer of lines; each is a document or segment, with its id, row key and first word."""
        window = self.window
        raw = b"\n".join(lines) + b"\n"
        buf = np.frombuffer(raw, dtype=np.uint8)
        start, end, line = _words_of(buf, 0x0A)
        if len(start) < window:
            return
        h = _word_hashes(buf, start, end)
        mer = h[:len(h) - MER + 1].copy()
        for j in range(1, MER):
            mer = mer * _P + h[j:len(h) - MER + 1 + j]
        low = _sliding_min(_mix(mer), window - MER + 1)
        whole = np.flatnonzero(line[:len(line) - window + 1] == line[window - 1:])  # windows inside one line
        if not len(whole):
            return
        low = low[whole]
        new = np.ones(len(whole), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (whole[1:] != whole[:-1] + 1)
        run = np.flatnonzero(new)
        length = np.diff(np.append(run, len(whole)))
        if length.max() > MAX_RUN:  # cut long runs
            parts = -(-length // MAX_RUN)
            offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            run, length = np.repeat(run, parts) + offset * MAX_RUN, np.minimum(np.repeat(length, parts) - offset * MAX_RUN, MAX_RUN)
        head = whole[run]
        lo, hi = start[head], end[head + length - 1 + window - 1]
        where = line[head]
        doc_of, key_of = np.array(doc, dtype=np.int64)[where], np.array(key, dtype=np.int32)[where]
        word = head - np.searchsorted(line, where) + np.array(first, dtype=np.int64)[where]  # number in the document
        bucket = (_mix(low[run] ^ _P) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            held = self.held.setdefault(int(bucket[part[0]]), ([], [], [], []))
            held[0].extend([raw[a:b] for a, b in zip(lo[part].tolist(), hi[part].tolist())])
            for into, x in zip(held[1:], (doc_of, key_of, word)):
                into.append(x[part])
        self.size += int((hi - lo).sum()) + 20 * len(run)

    def flush(self) -> pd.DataFrame:
        rows = []
        for bucket, (texts, doc, key, word) in sorted(self.held.items()):
            index: dict[bytes, int] = {}
            which = np.fromiter((index.setdefault(t, len(index)) for t in texts), dtype=np.int64, count=len(texts))
            columns = np.diff(which, prepend=-1).astype(np.int32), np.diff(np.concatenate(doc), prepend=0), np.concatenate(key), np.concatenate(word).astype(np.int32)
            packed = b"".join((np.int64(len(which)).tobytes(), *(x.tobytes() for x in columns), b"\n".join(index), b"\n"))
            rows.append((bucket, self.zstd.compress(packed)))
        self.held, self.size = {}, 0
        return pd.DataFrame(rows, columns=["bucket", "blob"])


def _pack(window: int, buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = _Packer(window, buckets)
        lines, doc, key, first, size = [], [], [], [], 0
        for batch in batches:
            for d, k, text in zip(batch["doc_id"].tolist(), batch["k"].tolist(), batch["text"]):
                for at, body in _segments(single_spaced(text), window):
                    lines.append(body), doc.append(d), key.append(k), first.append(at)
                    size += len(body) + 1
                    if size >= CHUNK:
                        packer.add(lines, doc, key, first)
                        lines, doc, key, first, size = [], [], [], [], 0
                        if packer.size >= FLUSH:
                            yield packer.flush()
        if lines:
            packer.add(lines, doc, key, first)
        if packer.held:
            yield packer.flush()
    return run


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(number of the string, doc_id, key, first word) of each place, and the strings."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
    out = []
    for kind in (np.int32, np.int64, np.int32, np.int32):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    which, doc, key, word = out
    return np.cumsum(which, dtype=np.int64) - 1, np.cumsum(doc), key, word.astype(np.int64), raw[at:]


def _equal_spans(raw: bytes, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Whether each ``raw[a:b]`` is ``raw[c:d]``, some at a time."""
    out = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = [raw[w:x] == raw[y:z] for w, x, y, z in zip(a[part].tolist(), b[part].tolist(), c[part].tolist(), d[part].tolist())]
    return out


def removed_windows(blobs: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, key, first window, windows) ranges of one bucket to remove."""
    texts, which, doc, key, word, count = [], [], [], [], [], 0
    for blob in blobs:
        w, d, k, p, body = _unpack(blob)
        which.append(w + count), doc.append(d), key.append(k), word.append(p), texts.append(body)
        count += int(w.max()) + 1
    which, doc, key, word = (np.concatenate(x) for x in (which, doc, key, word))
    raw = b"".join(texts)
    buf = np.frombuffer(raw, dtype=np.uint8)
    start, end, line = _words_of(buf, 0x0A)
    least = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc)
    h = _word_hashes(buf, start, end)
    n = len(h) - window + 1
    wh = h[:n].copy()
    for j in range(1, window):
        wh *= _P
        wh += h[j:n + j]
    at = np.flatnonzero(line[:n] == line[window - 1:])
    wh, of = _mix(wh[at]), line[at]
    order = np.lexsort((least[of], wh))
    sorted_hash = wh[order]
    group = np.cumsum(np.concatenate([[0], sorted_hash[1:] != sorted_hash[:-1]]))
    leader = order[np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0))][group]
    remove = np.zeros(len(at), dtype=bool)
    # word for word: a window that follows a smaller document's must be the same words as that one
    cand = np.flatnonzero(least[of[order]] > least[of[leader]])
    lo, hi = start[at], end[at + window - 1]
    same = _equal_spans(raw, lo[order[cand]], hi[order[cand]], lo[leader[cand]], hi[leader[cand]])
    remove[order[cand[same]]] = True
    for g in np.unique(group[cand[~same]]):  # several windows under one hash
        seen: dict[bytes, int] = {}
        for i in order[group == g].tolist():
            t = raw[lo[i]:hi[i]]
            seen[t] = min(seen.get(t, least[of[i]]), least[of[i]])
        for i in order[group == g].tolist():
            remove[i] = least[of[i]] > seen[raw[lo[i]:hi[i]]]
    # ranges of neighbouring removed windows of each string
    line_first = np.searchsorted(line, np.arange(count))
    line_words = np.diff(np.append(line_first, len(line)))
    gone = np.flatnonzero(remove)
    begin = np.ones(len(gone), dtype=bool)
    begin[1:] = (np.diff(at[gone]) != 1) | (of[gone][1:] != of[gone][:-1])
    heads = np.flatnonzero(begin)
    range_len = np.diff(np.append(heads, len(gone)))
    range_line = of[gone[heads]]
    range_at = at[gone[heads]] - line_first[range_line]
    # places in the string's own smallest document lose those ranges, all other places the whole string
    own = np.flatnonzero(doc == least[which])
    by_line = np.searchsorted(range_line, which[own]), np.searchsorted(range_line, which[own], side="right")
    times = by_line[1] - by_line[0]
    place = np.repeat(own, times)
    pick = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(by_line[0], times)
    rest = np.flatnonzero(doc > least[which])
    return (np.concatenate([doc[place], doc[rest]]), np.concatenate([key[place], key[rest]]), np.concatenate([word[place] + range_at[pick], word[rest]]),
            np.concatenate([range_len[pick], line_words[which[rest]] - window + 1]))


def _count(window: int):
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        doc, key, first, n = removed_windows(bucket["blob"].tolist(), window)
        return pd.DataFrame({"doc_id": doc, "k": key, "r": first * RANGE + n}).drop_duplicates()
    return run


def _text_bits() -> Column:
    return F.shiftright(F.xxhash64("text"), 32).cast("int")


def removed_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, k, ranges)`` of rows that lose windows; k is 32 bits of the text's hash, a range ``first window * RANGE + windows``."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    overlap = 1 + (window - 1) * 2 / (window - MER + 2)
    buckets = max(1, int(size * overlap) // BUCKET_BYTES + 1)
    searched = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_bits().alias("k"))
    blobs = searched.mapInPandas(_pack(window, buckets), "bucket long, blob binary")
    found = blobs.groupBy("bucket").applyInPandas(_count(window), "doc_id long, k int, r long")
    return found.groupBy("doc_id", "k").agg(F.collect_set("r").alias("ranges"))


def kept_words(text: str | None, ranges, window: int) -> tuple[list[bytes], int]:
    """The words left of a text, and how many went."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if ranges is None or not len(ranges):
        return words, 0
    r = np.asarray(ranges, dtype=np.int64)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, r // RANGE, 1)
    np.add.at(edge, r // RANGE + r % RANGE + window - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())


def _digest(window: int):
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def run(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        out = []
        for t, r in zip(texts, ranges):
            kept, gone = kept_words(t, r, window)
            out.append((len(kept) + gone, gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"])
    return run


def _cut(window: int):
    @F.pandas_udf("string")
    def run(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(kept_words(t, r, window)[0]).decode("utf-8", "surrogatepass") if r is not None else t for t, r in zip(texts, ranges)], dtype=object)
    return run


def _with_ranges(docs: DataFrame, window: int) -> DataFrame:
    ranges = removed_ranges(docs, window).select(F.col("doc_id").alias("__d"), F.col("k").alias("__k"), F.col("ranges").alias("__ranges"))
    return docs.join(stored(ranges, "ranges"), (F.col("doc_id") == F.col("__d")) & (_text_bits() == F.col("__k")), "left").drop("__d", "__k")


def substring_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    out = _with_ranges(docs.select("doc_id", "text"), window)
    return out.select("doc_id", _digest(window)("text", "__ranges").alias("d")).select("doc_id", "d.*")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with removed words cut from ``text``; a text that loses nothing stays as it is."""
    return _with_ranges(docs, window).withColumn("text", _cut(window)("text", "__ranges")).select(*docs.columns)
