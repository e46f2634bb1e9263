"""Language identification by prediction by partial matching.

Per language, a byte context tree of order 3 down to 0 holds how often each
symbol followed each context in a bounded training sample. Statistics are then
frozen. A symbol not seen in a context is reached by an escape (method C, with
exclusion), so every context gives a proper distribution and the code length
of a text is the exact sum of minus log2 of its symbols' probabilities. The
language with the shortest code wins; the score is its posterior under equal
priors.

Symbols: A-Z and a-z (case folded), one for a run of anything else in ASCII,
every byte 0x80 to 0xF4, and one for the bytes UTF-8 never uses. A tree is
sorted arrays of the contexts and symbols it holds, per order; the distinct
grams of a batch are looked up in them from order 3 downwards. Counting and
scoring run in Arrow batches on the executors.

Only the fit is bounded: about ``SAMPLE_DOCS`` whole documents per language,
picked by a hash. Every language value is learned and every text is scored
whole, against blocks of languages of about ``BLOCK_GRAMS`` counts, of which a
worker holds one at a time. The driver holds 12 bytes a count.

Cases: null text or one without a letter is ``und`` with score 0; so is every
text if nothing could be learned; a null language is not learned; a null
doc_id is neither held out nor learned from; equal rows are scored alike; ties
go to the language that sorts first; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import stored

ORDER = 3
HIGH = range(0x80, 0xF5)  # bytes of UTF-8 above ASCII
SYMBOLS = 27 + len(HIGH) + 1
OTHER_BYTES = 256 - (SYMBOLS - 1)
SAMPLE_DOCS = 500
BLOCK_GRAMS = 1 << 21
UNDETERMINED = "und"
FOLDS = 5
_BLOCK = 1 << 20  # symbols looked up at once
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def folded(text: str) -> np.ndarray:
    """Bytes of the lower-cased text with every run of ASCII non-letters as one space, after ORDER spaces."""
    a = np.frombuffer((" " + text).lower().encode("utf-8", "surrogatepass").translate(_FOLD), dtype=np.uint8)
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = (a[1:] != 0x20) | (a[:-1] != 0x20)
    return np.concatenate([np.full(ORDER - 1, 0x20, dtype=np.uint8), a[keep]])


def _grams(a: np.ndarray) -> np.ndarray:
    """ORDER + 1 consecutive bytes packed, for every byte that has ORDER before it."""
    w = a.astype(np.int64)
    out = w[ORDER:].copy()
    for back in range(1, ORDER + 1):
        out |= w[ORDER - back:len(w) - back] << (8 * back)
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lang, texts in b.groupby("lang")["text"]:
            gram, n = np.unique(np.concatenate([_grams(folded(t)) for t in texts]), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": gram, "n": n.astype(np.int64)})


#: Of one order: sorted (context, symbol) keys, their bits, sorted contexts, bits of an escape from each.
Level = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _gram_bits(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """Bits of each gram's last symbol: in the longest context that holds it, after the escapes to there."""
    bits, left = np.zeros(len(grams)), np.arange(len(grams))
    for order in range(len(levels) - 1, -1, -1):
        keys, lengths, contexts, escapes = levels[order]
        wanted = grams[left] % SYMBOLS ** (order + 1)
        at, seen = _find(keys, wanted)
        bits[left[seen]] += lengths[at[seen]]
        left, wanted = left[~seen], wanted[~seen] // SYMBOLS
        at, known = _find(contexts, wanted)
        bits[left[known]] += escapes[at[known]]
    bits[left] += np.log2(SYMBOLS)
    bits[grams % SYMBOLS == SYMBOLS - 1] += np.log2(OTHER_BYTES)  # which byte it was
    return bits


@dataclass
class PpmModel:
    """Languages, the symbol of each byte, and sorted counts ``(gram of symbols, n)`` per language."""

    langs: list[str]
    symbol: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray]]
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)

    def levels(self, which: int) -> list[Level]:
        """The tree of a language by order, computed from order 0 upwards."""
        index, n = self.counts[which]
        out = []
        for order in range(ORDER + 1):
            keys, inverse = np.unique(index % SYMBOLS ** (order + 1), return_inverse=True)
            c = np.bincount(inverse, weights=n)
            contexts, first, distinct = np.unique(keys // SYMBOLS, return_index=True, return_counts=True)
            # a symbol seen in a context was seen in every shorter one
            lower = np.exp2(-out[-1][1][np.searchsorted(out[-1][0], keys % SYMBOLS ** order)]) if order else np.full(len(keys), 1.0 / SYMBOLS)
            unseen = 1.0 - np.add.reduceat(lower, first)
            escape = np.where(distinct < SYMBOLS, distinct, 0)  # nothing to escape to once every symbol was seen
            weight = np.add.reduceat(c, first) + escape
            with np.errstate(divide="ignore", invalid="ignore"):
                escapes = -np.log2(escape / weight / unseen)
            out.append((keys, np.log2(np.repeat(weight, distinct) / c), contexts, escapes))
        return out

    def code_lengths(self, which: int) -> np.ndarray:
        """Bits of every symbol after every context of full order that was seen, flat."""
        levels = self.levels(which)
        grams = levels[ORDER][2].astype(np.int64)[:, None] * SYMBOLS + np.arange(SYMBOLS)
        return _gram_bits(levels, grams.reshape(-1))

    def blocks(self) -> list[PpmModel]:
        """The model cut into models of fewer languages, in order."""
        cuts = _cut([len(index) for index, _ in self.counts])
        return [PpmModel(self.langs[a:b], self.symbol, self.counts[a:b]) for a, b in cuts]


def _cut(sizes: list[int]) -> list[tuple[int, int]]:
    """Runs of ``sizes`` of at most BLOCK_GRAMS together, or of one."""
    cuts, start, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > BLOCK_GRAMS:
            cuts.append((start, i))
            start, total = i, 0
        total += n
    return [*cuts, (start, len(sizes))] if sizes else []


def build_model(grams: pd.DataFrame) -> PpmModel:
    """``grams``: (lang, gram of bytes, n)."""
    symbol = np.full(256, SYMBOLS - 1, dtype=np.int64)
    symbol[0x20] = 0
    symbol[np.arange(0x61, 0x7B)] = np.arange(1, 27)
    symbol[HIGH.start:HIGH.stop] = np.arange(27, SYMBOLS - 1)
    langs, counts = [], []
    for lang, own in grams.groupby("lang", sort=True):
        langs.append(lang)
        g, index = own["gram"].to_numpy(), 0
        for back in range(ORDER, -1, -1):
            index = index * SYMBOLS + symbol[(g >> (8 * back)) & 0xFF]
        index, inverse = np.unique(index.astype(np.int32), return_inverse=True)
        counts.append((index, np.bincount(inverse, weights=own["n"].to_numpy())))
    return PpmModel(langs, symbol, counts)


def fit(learn: DataFrame, sample_docs: int = SAMPLE_DOCS) -> PpmModel:
    """Fit on about ``sample_docs`` documents of each language of ``learn`` (doc_id, text, lang; all non-null)."""
    # stored, so that the join is a broadcast while the languages are few
    shares = stored(learn.groupBy("lang").agg((F.lit(float(sample_docs)) / F.count(F.lit(1))).alias("share")), "languages")
    picked = (learn.select("doc_id", "text", "lang").join(shares, "lang")
              .filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < F.col("share") * (1 << 30)))
    grams = stored(picked.select("lang", "text").mapInPandas(_count, "lang string, gram long, n long")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = sorted((r["lang"], r["n"]) for r in grams.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    parts = []
    for a, b in _cut([n for _, n in sizes]):
        block = [lang for lang, _ in sizes[a:b]]
        parts.append(build_model(grams.filter(F.col("lang").isin(block)).toArrow().to_pandas()))
    empty = build_model(pd.DataFrame({"lang": [], "gram": [], "n": []}, dtype="int64"))
    return PpmModel([x for p in parts for x in p.langs], empty.symbol, [c for p in parts for c in p.counts])


_TREES: dict[str, list[list[Level]]] = {}


def _trees(model: PpmModel) -> list[list[Level]]:
    """The model's trees, made once per worker process."""
    if model.uid not in _TREES:
        _TREES.clear()
        _TREES[model.uid] = [model.levels(i) for i in range(len(model.langs))]
    return _TREES[model.uid]


def text_bits(model: PpmModel, texts: list[str]) -> np.ndarray:
    """Code length in bits of each text under each language; texts x languages."""
    trees, out = _trees(model), np.zeros((len(texts), len(model.langs)))
    at = 0
    while at < len(texts):
        parts, size, first = [], 0, at
        while at < len(texts) and (not parts or size < _BLOCK):
            parts.append(model.symbol[folded(texts[at])].astype(np.int32))
            size += len(parts[-1])
            at += 1
        s = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        real = np.ones(len(s), dtype=bool)
        for start in np.concatenate([[0], ends[:-1]]):
            real[start:start + ORDER] = False
        for lo in range(ORDER, len(s), _BLOCK):
            hi = min(lo + _BLOCK, len(s))
            index = s[lo:hi].copy()
            for back in range(1, ORDER + 1):
                index += s[lo - back:hi - back] * SYMBOLS ** back
            own = doc[lo:hi][real[lo:hi]]
            grams, index = np.unique(index[real[lo:hi]], return_inverse=True)
            if not len(own):
                continue
            begins = np.flatnonzero(np.diff(own, prepend=-1))
            for k, tree in enumerate(trees):
                out[first + own[begins], k] += np.add.reduceat(_gram_bits(tree, grams)[index], begins)
    return out


def _values(shared: list[Broadcast]) -> Iterator[PpmModel]:
    """The blocks; if there are several, each is read anew and not kept (with encryption Spark keeps them)."""
    for b in shared:
        yield b.value if len(shared) == 1 or not hasattr(b, "_path") else b.load_from_path(b._path)


def classify(models: Iterable[PpmModel], texts: pd.Series) -> pd.DataFrame:
    """Best language and its posterior over the languages of all ``models``."""
    found = pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0}, index=texts.index)
    has = np.array([t is not None and _LETTER.search(t) is not None for t in texts], dtype=bool)
    if not len(texts) or not has.any():
        return found
    asked = texts[has].tolist()
    least, total, best = np.full(len(asked), np.inf), np.zeros(len(asked)), np.full(len(asked), UNDETERMINED, dtype=object)
    for model in models:
        bits = text_bits(model, asked)
        low = np.minimum(least, bits.min(1))
        # total: sum of 2 ** (least - bits) over the languages so far
        total = total * np.exp2(np.maximum(low - least, -1000.0)) + np.exp2(np.maximum(low[:, None] - bits, -1000.0)).sum(1)
        better = low < least
        best[better] = np.array(model.langs, dtype=object)[bits.argmin(1)[better]]
        least = low
    found.loc[has, "lang_pred"] = best
    found.loc[has, "score"] = np.divide(1.0, total, out=np.zeros(len(asked)), where=total > 0)
    return found


def identify(docs: DataFrame, model: PpmModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = [docs.sparkSession.sparkContext.broadcast(b) for b in model.blocks()]  # counts only, no text

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return classify(_values(shared), texts)

    return docs.withColumn("__p", predict(F.col(text))).select("*", "__p.lang_pred", "__p.score").drop("__p")
