"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes its normalised form (a leading ``▁``, spaces as ``▁``), one
symbol a character, and neighbours whose joined string is a piece are merged,
best score first and leftmost among equals, until none is left; characters
that are no piece become their UTF-8 byte pieces.

* Words: no merge crosses a place whose two characters stand together in no
  piece, so the text falls apart there and equal words are encoded once a batch.
* A round finds, for every word at once, the least pair rank by a segmented
  minimum, merges its occurrences from the left, and compacts the arrays. One
  round may take several occurrences in a word as long as no merge makes a
  pair as good or better; the first one that does ends the word's round. So
  the order is the library's.
* A word over ``LONG`` symbols would need as many passes over itself as it has
  ranks. There each round touches the symbols of one rank only, kept in
  buckets, and merges are links instead of compactions; the rule is the same.

Texts are handled in blocks of about ``BLOCK_CHARS`` characters inside a task,
one long text being a block of its own, so memory follows the longest text.

Cases: a null or empty text has no ids and decodes to the empty text; a space
alone is one piece; control strings of the model in a text are ordinary text;
texts of any length are encoded whole; equal rows give equal rows; an empty
table gives no rows; columns other than doc_id and text are ignored. A model
with another normaliser, with user-defined or unused pieces or without byte
pieces is refused. Ids outside the model are an error; in decoding, control
ids give nothing and bytes that are no UTF-8 give U+FFFD each.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LONG = 2048
BLOCK_CHARS = 400_000
#: Rank of a pair that is no piece.
NEVER = np.int32(2**31 - 1)
_CODES = 0x110000


class PieceModel:
    """A model as arrays: symbols of characters, ranks and results of pairs, bytes of ids.

    Its size follows the vocabulary; it is broadcast once (a few MB for 32,000 pieces).
    """

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        spec = proto.ModelProto.FromString(sp.serialized_model_proto())
        norm, kinds = spec.normalizer_spec, proto.ModelProto.SentencePiece
        if (spec.trainer_spec.model_type != proto.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or not norm.add_dummy_prefix or spec.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with the identity normaliser and a leading space")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        normal = {p.piece: (i, p.score) for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        self.byte_id = np.full(256, -1, np.int32)
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("a model without byte pieces")
        self.size = len(spec.pieces)
        # symbols: piece ids, and size + code point for characters that are no piece
        self.char_symbol = np.arange(_CODES, dtype=np.int32) + self.size
        for piece, (i, _) in normal.items():
            if len(piece) == 1:
                self.char_symbol[ord(piece)] = i
        scores = sorted({-s for _, s in normal.values()})
        rank = {s: r for r, s in enumerate(scores)}
        pairs = {}
        joints = set()
        for piece, (i, score) in normal.items():
            joints.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                left, right = self._symbol(normal, piece[:cut]), self._symbol(normal, piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank[-score], i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key = keys
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()] + [NEVER], np.int32)
        self.pair_new = np.array([pairs[k][1] for k in keys.tolist()] + [-1], np.int32)
        self.joint = np.array(sorted(ord(a) << 32 | ord(b) for a, b in joints), np.int64)
        # a space starts a word wherever no piece has a space after another character: then equal words can be found by plain search
        self.words_start_with_space = not any(b == SPACE != a for a, b in joints)
        out = [b""] * self.size
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.NORMAL:
                out[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kinds.BYTE:
                out[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == kinds.UNKNOWN:
                out[i] = spec.trainer_spec.unk_surface.encode()
        self.has_prefix = np.array([p.type == kinds.NORMAL for p in spec.pieces])
        self.is_control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        self.out = out
        self.out_len = np.array([len(b) for b in out], np.int64)
        self.out_start = np.concatenate([[0], np.cumsum(self.out_len)])[:-1]
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        # pairs by an open-addressed table: one or two probes instead of a binary search
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift = 64 - bits
        self.slot = np.full(1 << bits, len(keys), np.int32)
        self._fill()

    def _symbol(self, normal: dict, s: str) -> int | None:
        return normal[s][0] if s in normal else int(self.char_symbol[ord(s)]) if len(s) == 1 else None

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _fill(self) -> None:
        empty, mask = len(self.pair_key), len(self.slot) - 1
        self.probes = 1
        for k, h in enumerate(self._hash(self.pair_key).tolist()):
            probe = 1
            while self.slot[h] != empty:
                h, probe = (h + 1) & mask, probe + 1
            self.slot[h] = k
            self.probes = max(self.probes, probe)
        self.pair_key = np.append(self.pair_key, np.int64(-1))

    @cached_property
    def pair_at(self) -> dict[int, int]:
        return {k: i for i, k in enumerate(self.pair_key[:-1].tolist())}

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ``pair_rank`` and ``pair_new``; the last one where it is no piece."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        h, none = self._hash(key), len(self.pair_key) - 1
        at = self.slot[h].astype(np.int64)
        open_ = np.flatnonzero((self.pair_key[at] != key) & (at != none))
        step = 1
        while len(open_):
            if step >= self.probes:
                at[open_] = none
                break
            found = self.slot[(h[open_] + step) & (len(self.slot) - 1)]
            at[open_] = found
            open_ = open_[(self.pair_key[found] != key[open_]) & (found != none)]
            step += 1
        return at

    # --- encoding -------------------------------------------------------------------------------------------------

    def split_words(self, text: str) -> list[str]:
        """The normalised text in pieces that no merge crosses, as far as a plain search finds them."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text) if self.words_start_with_space else [text]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count per word) of normalised words."""
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        length = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), length)
        joint = code[:-1] << 32 | code[1:]
        at = np.searchsorted(self.joint, joint)
        together = np.zeros(len(code), bool)
        if len(self.joint):
            together[1:] = (self.joint[np.minimum(at, len(self.joint) - 1)] == joint) & (word[1:] == word[:-1])
        part = np.cumsum(~together) - 1
        sym, part = self._merge(self.char_symbol[code], part)
        word = word[np.flatnonzero(~together)][part] if len(part) else part
        return self._ids(sym, word, len(words))

    def _ids(self, sym: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        raw = sym >= self.size
        if raw.any():
            code = sym[raw] - self.size
            size = np.ones(len(sym), np.int64)
            size[raw] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
            utf8 = np.frombuffer("".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
            out = np.repeat(sym, size)
            out[np.repeat(raw, size)] = self.byte_id[utf8]
            sym, word = out, np.repeat(word, size)
        return sym.astype(np.int32), np.bincount(word, minlength=words)

    def _merge(self, sym: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols; ``part`` numbers the parts from 0 without gaps, in order."""
        if not len(sym):
            return sym, part
        count = np.bincount(part)
        long_parts = np.flatnonzero(count > LONG)
        done_sym, done_part = [], []
        if len(long_parts):
            bound = np.concatenate([[0], np.cumsum(count)])
            keep = np.ones(len(sym), bool)
            for p in long_parts.tolist():
                keep[bound[p]:bound[p + 1]] = False
                out = self._merge_long(sym[bound[p]:bound[p + 1]])
                done_sym.append(out)
                done_part.append(np.full(len(out), p))
            sym, part = sym[keep], part[keep]
        inside = np.append(part[1:] == part[:-1], np.zeros(min(1, len(sym)), bool))
        pair = np.full(len(sym), len(self.pair_key) - 1)
        pair[inside] = self.pair(sym[:-1][inside[:-1]], sym[1:][inside[:-1]])
        while len(sym):
            rank = self.pair_rank[pair]
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            if (least == NEVER).any():
                over = np.repeat(least == NEVER, size)
                done_sym.append(sym[over])
                done_part.append(part[over])
                live = ~over
                sym, part, pair, rank = sym[live], part[live], pair[live], rank[live]
                size, least = size[least != NEVER], least[least != NEVER]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, size))
            hits = self._safe(sym, part, pair, rank, _leftmost(hits))
            sym[hits] = self.pair_new[pair[hits]]
            stay = np.ones(len(sym), bool)
            stay[hits + 1] = False
            at = hits - np.arange(len(hits))  # places after compaction
            sym, part, pair = sym[stay], part[stay], pair[stay]
            self._renew(sym, part, pair, at)
        sym, part = np.concatenate(done_sym), np.concatenate(done_part)
        order = np.argsort(part, kind="stable")
        return sym[order], part[order]

    def _safe(self, sym, part, pair, rank, hits):
        """Of each part's merges, those up to the first that makes a pair as good as the merged one or better."""
        n, none = len(sym), len(self.pair_key) - 1
        made, r, own = self.pair_new[pair[hits]], rank[hits], part[hits]
        before = np.maximum(hits - 1, 0)
        has_left = (hits > 0) & (part[before] == own)
        left = sym[before]
        chained = np.append(False, hits[1:] == hits[:-1] + 2)  # the left neighbour has just been merged
        left[chained] = made[np.flatnonzero(chained) - 1]
        after = np.minimum(hits + 2, n - 1)
        has_right = (hits + 2 < n) & (part[after] == own)
        worse = np.ones(len(hits), bool)
        for has, a, b in ((has_left, left, made), (has_right, made, sym[after])):
            found = np.full(len(hits), none)
            found[has] = self.pair(a[has], b[has])
            worse &= self.pair_rank[found] > r
        if worse.all():
            return hits
        bad = np.cumsum(~worse)
        start = np.append(True, own[1:] != own[:-1])
        base = np.maximum.accumulate(np.where(start, bad - ~worse, 0))
        return hits[(bad - ~worse) == base]

    def _renew(self, sym, part, pair, at):
        n, none = len(sym), len(self.pair_key) - 1
        left = at[(at > 0)] - 1
        spots = np.unique(np.concatenate([at, left]))
        inside = (spots + 1 < n) & (part[np.minimum(spots + 1, n - 1)] == part[spots])
        pair[spots] = none
        spots = spots[inside]
        pair[spots] = self.pair(sym[spots], sym[spots + 1])

    def _merge_long(self, sym: np.ndarray) -> np.ndarray:
        """The same order for one long part: symbols linked, pairs in buckets by rank."""
        n = len(sym)
        sym, none = sym.copy(), len(self.pair_key) - 1
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)  # n: the end
        pair = np.append(self.pair(sym[:-1], sym[1:]), none)
        rank = self.pair_rank[pair]
        buckets: dict[int, list[np.ndarray]] = defaultdict(list)
        order = np.argsort(rank, kind="stable")
        order = order[rank[order] != NEVER]
        for run in np.split(order, np.flatnonzero(np.diff(rank[order])) + 1) if len(order) else []:
            buckets[int(rank[run[0]])].append(run)
        heap = sorted(buckets)
        while heap:
            r = heap[0]
            hits = np.unique(np.concatenate(buckets[r])) if buckets.get(r) else np.empty(0, np.int64)
            hits = hits[rank[hits] == r]
            if not len(hits):
                heapq.heappop(heap)
                buckets.pop(r, None)
                continue
            chain = np.append(False, nxt[hits[:-1]] == hits[1:])
            group = np.maximum.accumulate(np.where(~chain, np.arange(len(hits)), 0))
            chosen = hits[(np.arange(len(hits)) - group) % 2 == 0]
            made, second = self.pair_new[pair[chosen]], nxt[chosen]
            right, left = nxt[second], prv[chosen]
            touching = np.append(False, right[:-1] == chosen[1:])
            left_sym = sym[left]
            left_sym[touching] = made[np.flatnonzero(touching) - 1]
            worse = np.ones(len(chosen), bool)
            for has, a, b in ((left >= 0, left_sym, made), (right < n, made, sym[np.minimum(right, n - 1)])):
                worse[has] &= self.pair_rank[self.pair(a[has], b[has])] > r
            buckets[r] = []
            if worse.all():
                sym[chosen] = made
                nxt[chosen] = right
                prv[right[right < n]] = chosen[right < n]
                rank[second] = NEVER
                spots = np.unique(np.concatenate([chosen, left[(left >= 0) & ~touching]]))
                ends = nxt[spots] >= n
                pair[spots[ends]] = none
                inner = spots[~ends]
                pair[inner] = self.pair(sym[inner], sym[nxt[inner]])
                rank[spots] = self.pair_rank[pair[spots]]
            else:
                spots = self._follow(hits, r, sym, nxt, prv, pair, rank)
            for q, x in zip(rank[spots].tolist(), spots.tolist()):
                if q != NEVER:
                    if q not in buckets:
                        heapq.heappush(heap, q)
                    buckets[q].append(np.array([x]))
        at, out = 0, []
        while at < n:
            out.append(at)
            at = int(nxt[at])
        return sym[out]

    def _follow(self, hits, r, sym, nxt, prv, pair, rank) -> np.ndarray:
        """All merges of rank ``r`` from the left; one whose new pair is as good or better is followed there at once.

        Everything elsewhere is of rank ``r``, and further right, or worse, so the order stays the library's.
        """
        n, none, touched = len(sym), len(self.pair_key) - 1, set()
        for p in hits.tolist():
            while p >= 0 and rank[p] <= r:
                q = int(nxt[p])
                x, left = int(nxt[q]), int(prv[p])
                sym[p], nxt[p], rank[q] = self.pair_new[pair[p]], x, NEVER
                if x < n:
                    prv[x] = p
                for a in (left, p):
                    if a >= 0:
                        b = int(nxt[a])
                        pair[a] = none if b >= n else self.pair_at.get(int(sym[a]) << 32 | int(sym[b]), none)
                        rank[a] = self.pair_rank[pair[a]]
                        touched.add(a)
                if left >= 0 and rank[left] <= rank[p]:
                    p = left
        return np.array(sorted(touched), np.int64)

    # --- decoding -------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids: the leading space goes, byte pieces join to characters."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("id outside the model")
        breaks = np.flatnonzero(self.is_control[ids])
        if len(breaks):  # they end a run of byte pieces
            runs = [run[~self.is_control[run]] for run in np.split(ids, breaks)]
            text = "".join(self._decode_run(run) for run in runs)
            first = next((run[0] for run in runs if len(run)), None)
        else:
            text, first = self._decode_run(ids), ids[0] if len(ids) else None
        return text[1:] if first is not None and self.has_prefix[first] and text.startswith(" ") else text

    def _decode_run(self, ids: np.ndarray) -> str:
        size = self.out_len[ids]
        total = int(size.sum())
        begin = np.cumsum(size) - size
        flat = self.out_bytes[np.repeat(self.out_start[ids] - begin, size) + np.arange(total)].tobytes()
        try:
            return flat.decode()
        except UnicodeDecodeError:
            return re.sub("[\udc80-\udcff]", "�", flat.decode("utf-8", "surrogateescape"))


def _leftmost(hits: np.ndarray) -> np.ndarray:
    """Of places that overlap their neighbours, every second one of each run, the first included."""
    chain = np.append(False, hits[1:] == hits[:-1] + 1)
    group = np.maximum.accumulate(np.where(~chain, np.arange(len(hits)), 0))
    return hits[(np.arange(len(hits)) - group) % 2 == 0]


def encode_texts(model: PieceModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, count per text); equal words are merged once."""
    split = [model.split_words(t) for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    if not counts.sum():
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    code, words = pd.factorize(np.array([w for s in split for w in s], dtype=object))
    ids, size = model.encode_words(list(words))
    start = np.cumsum(size) - size
    each = size[code]
    begin = np.cumsum(each) - each
    flat = ids[np.repeat(start[code] - begin, each) + np.arange(int(each.sum()))]
    return flat, np.bincount(np.repeat(np.arange(len(texts)), counts), weights=each, minlength=len(texts)).astype(np.int64)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``BLOCK_CHARS`` characters."""
    first, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > BLOCK_CHARS:
            yield first, i
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        yield first, len(texts)


def _per_text(model: PieceModel, texts: list[str]) -> Iterator[np.ndarray]:
    for a, b in _blocks(texts):
        flat, counts = encode_texts(model, texts[a:b])
        yield from np.split(flat, np.cumsum(counts)[:-1])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_file))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": list(_per_text(shared.value, b["text"].tolist()))})
    return _mapped(docs, run, "ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, text)`` of rows with ``ids``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(PieceModel(model_file))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [None if x is None else shared.value.decode(x) for x in b["ids"]]})
    return _mapped(encoded, run, "text string", F.col("ids"))


def piece_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: n_tokens, the digest of its ids and of the text they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_file))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in batches:
            out = []
            for ids in _per_text(model, b["text"].tolist()):
                text = model.decode(ids).encode("utf-8", "surrogatepass")
                listed = ",".join(map(str, ids.tolist())).encode()
                out.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(doc_id=b["doc_id"].values)[
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]]
    return _mapped(docs, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _mapped(df: DataFrame, run, columns: str, value=None) -> DataFrame:
    """``run`` over (doc_id, text or ``value``); ids travel as text, as pandas would make integers with nulls floats."""
    value = F.coalesce(F.col("text"), F.lit("")).alias("text") if value is None else value
    out = df.select(F.col("doc_id").cast("string").alias("doc_id"), value).mapInPandas(run, f"doc_id string, {columns}")
    return out.withColumn("doc_id", F.col("doc_id").cast(df.schema["doc_id"].dataType))
