"""Secret scan by a randomness test battery, native.

Base kinds are patterns: assignments, access keys and long hex runs. The
battery looks at every other run of 20 or more key characters. Its encoding is
inferred (hex, base 32, lower-case base 36, base 62, base 64), its characters
become numbers of that alphabet, and four tests follow: chi-squared uniformity
of the alphabet, a runs test about the alphabet's middle, serial correlation,
and the number of changes between character classes.

A run is reported if

* the first three tests, combined by Fisher, do not reject a uniform random
  string (``min_random``), and
* prose is rejected: uniformity and class changes, scored against the index of
  coincidence and change rate of written words and combined by Fisher, pass a
  Benjamini-Hochberg threshold at ``fdr``. The threshold is found per length
  stratum over the candidates of all documents, as short runs test weakly.

P-values are counted in quarter-bit bins, so the threshold table has at most
``len(STRATA) * (MAX_BIN + 1)`` rows whatever the corpus; its outcome, one bin
per stratum, is all that reaches the driver. Positions are sums over the
pieces around the matches, within the row: the scan shuffles nothing.

Cases: null and empty texts have no spans; runs overlapping a base span are
not added; repeated rows are scanned each; an empty table has no candidates
and reports base spans only; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import row_key, stored

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # maximal runs, so the same as filtering [0-9a-f]+ by length
KINDS = ("assign", "access", "hex")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
STRATA = (20, 24, 32, 48, 64, 128)
MAX_BIN = 400
FDR = 0.01
MIN_RANDOM = 1e-4
PLACEHOLDER = "[SECRET]"

#: Alphabets by encoding; a run takes the first that holds all its characters (padding aside).
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Written words: index of coincidence over letters, changes of character class per step.
PROSE_IC = 0.066
PROSE_CHANGE = 0.1


#: Array steps copy what they have so far; in runs of this many the copies stay short.
CHUNK = 512


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, out of a generator of one row: lambdas then read their values and do not evaluate them for each element."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _pieces(text: Column, pattern: str, group: int = 0) -> Column:
    """The gaps before the leftmost matches, the matches and their ``group``, in order; empty if there is none."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    return F.when(text.rlike(pattern), pieces).otherwise(F.array().cast("array<struct<gap:string,whole:string,value:string>>"))


def _runs(array: Column) -> Column:
    """``array`` (a column that is held) in runs of ``CHUNK``; not for an empty one."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / CHUNK).cast("int")), lambda b: F.slice(array, b * CHUNK + 1, CHUNK))


def _matches(pieces: Column) -> Column:
    """Array of (start, end, value) of the matches in held ``pieces``. Code points, end exclusive; time in proportion to their number."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["whole"]), F.lit(0))
        added = F.when(x["whole"].isNotNull(), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))))
        return F.struct(end.alias("at"), added.otherwise(acc["out"]).alias("out"))

    def join(acc: Column, run: Column) -> Column:
        moved = F.transform(run["out"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["value"].alias("value")))
        return F.struct((acc["at"] + run["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    runs = F.transform(_runs(pieces), lambda run: F.aggregate(run, F.struct(F.lit(0).alias("at"), empty.alias("out")), step))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,value:string>>>").alias("out"))
    return F.when(F.size(pieces) > 0, F.aggregate(runs, start, join, lambda a: F.flatten(a["out"]))).otherwise(empty)


def _apart(cand: Column, base: Column) -> Column:
    """Of held ``cand``, in order, those that overlap none of held ``base``; a run looks only at the spans near it."""
    def clear(run: Column) -> Column:
        near = F.filter(base, lambda b: (b["start"] < F.element_at(run, -1)["end"]) & (b["end"] > run[0]["start"]))
        # arrays of one element bind what the inner lambda reads
        return F.transform(F.array(near), lambda spans: F.filter(run, lambda x: ~F.exists(spans, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))[0]

    return F.when((F.size(cand) > 0) & (F.size(base) > 0), F.flatten(F.transform(_runs(cand), clear))).otherwise(cand)


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind) if kind in KINDS else len(KINDS)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _upper_tail(z: Column) -> Column:
    """Normal P(Z > z) by a logistic of z + z**3 (fixed constants, error under 2e-4)."""
    c = F.greatest(F.least(z, F.lit(20.0)), F.lit(-20.0))
    return 1 / (1 + F.exp(1.5976 * c + 0.070566 * c * c * c))


def _fisher(*ps: Column) -> Column:
    """Combined p-value: upper tail of chi-squared with 2 per test, closed form for even degrees."""
    half = -sum((F.ln(F.greatest(p, F.lit(1e-30))) for p in ps), F.lit(0.0))
    terms, term = F.lit(1.0), F.lit(1.0)
    for i in range(1, len(ps)):
        term = term * half / i
        terms = terms + term
    return F.exp(-half) * terms


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (a column ``value``) with encoding, n, p_uniform, p_runs, p_serial, p_random, p_prose."""
    enc, alpha = F.lit("mixed"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=")
    for name, letters in reversed(ALPHABETS):
        fits = F.translate(F.col("__body"), letters, "") == ""
        enc, alpha = F.when(fits, name).otherwise(enc), F.when(fits, letters).otherwise(alpha)
    df = _held(tokens, __body=F.regexp_replace("value", "=+$", ""))
    df = _held(df, encoding=enc, __alpha=alpha, __ch=F.split("__body", ""), n=F.greatest(F.char_length("__body"), F.lit(2)))
    kind = F.transform("__ch", lambda c: F.when(c.rlike("[0-9]"), 0).when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2).otherwise(3))
    df = _held(df, __k=F.char_length("__alpha").cast("double"), __ix=F.transform("__ch", lambda c: F.instr(F.col("__alpha"), c).cast("double")), __kind=kind)
    k, n = F.col("__k"), F.col("n").cast("double")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    after = lambda a: F.slice(a, F.lit(2), F.size(a))

    def count(letter: Column) -> Column:
        return F.when(letter == "", 1).otherwise(F.char_length("__body") - F.char_length(F.replace(F.col("__body"), letter, F.lit(""))))

    squares = F.aggregate(F.array_distinct("__ch"), F.lit(0.0),
                          lambda a, d: a + F.pow(count(d).cast("double"), F.lit(2.0)))
    df = _held(df, __chi=k / n * squares - n, __mean=total("__ix") / n, __hi=F.transform("__ix", lambda x: x > k / 2))
    df = _held(df, __dev=F.transform("__ix", lambda x: x - F.col("__mean")))
    lagged = total(F.zip_with("__dev", after("__dev"), lambda x, y: x * F.coalesce(y, F.lit(0.0))))
    df = _held(df, __var=F.aggregate("__dev", F.lit(0.0), lambda a, x: a + x * x), __lagged=lagged)
    differ = lambda a: F.size(F.filter(F.zip_with(a, after(a), lambda x, y: x != y), lambda x: x)).cast("double")
    df = _held(df, __r=F.when(F.col("__var") > 0, F.col("__lagged") / F.col("__var")).otherwise(F.lit(1.0)),
               __n1=F.size(F.filter("__hi", lambda x: x)).cast("double"), __runs=differ("__hi") + 1, __changes=differ("__kind"))
    n1, changes = F.col("__n1"), F.col("__changes")
    mu = 2 * n1 * (n - n1) / n + 1
    sd = F.sqrt(F.greatest((mu - 1) * (mu - 2) / (n - 1), F.lit(1e-9)))
    df = df.withColumn("__zr", F.when((n1 > 0) & (n1 < n), F.abs(F.col("__runs") - mu) / sd).otherwise(F.lit(20.0)))
    chi_sd = F.sqrt(2 * (k - 1))
    df = (df.withColumn("p_uniform", _upper_tail((F.col("__chi") - (k - 1)) / chi_sd))
          .withColumn("p_runs", F.least(F.lit(1.0), 2 * _upper_tail(F.col("__zr"))))
          .withColumn("p_serial", F.least(F.lit(1.0), 2 * _upper_tail(F.abs(F.col("__r") + 1 / n) * F.sqrt(n)))))
    prose_chi = (n * (k * PROSE_IC - 1) + (k - 1) * (1 - PROSE_IC))
    p_flat = _upper_tail((prose_chi - F.col("__chi")) / chi_sd)
    p_change = _upper_tail((changes - PROSE_CHANGE * n) / F.sqrt(PROSE_CHANGE * (1 - PROSE_CHANGE) * n))
    df = df.withColumn("p_random", _fisher(F.col("p_uniform"), F.col("p_runs"), F.col("p_serial"))).withColumn("p_prose", _fisher(p_flat, p_change))
    return df.select(*[c for c in df.columns if not c.startswith("__")])


def _stratum(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(STRATA):
        out = F.when(n >= least, i).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.floor(-4 * F.log2(F.greatest(p, F.lit(1e-40)))), F.lit(MAX_BIN)).cast("int")


def fdr_bins(tested: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length stratum the least p-value bin that Benjamini-Hochberg accepts over all of ``tested`` (n, p_prose)."""
    counts = (tested.groupBy(_stratum(F.col("n")).alias("stratum"), _bin(F.col("p_prose")).alias("bin"))
              .agg(F.count(F.lit(1)).alias("c")).collect())  # at most len(STRATA) * (MAX_BIN + 1) rows
    out = {}
    for s in {r["stratum"] for r in counts}:
        own = sorted(((r["bin"], r["c"]) for r in counts if r["stratum"] == s), reverse=True)
        total, so_far = sum(c for _, c in own), 0
        for b, c in own:
            so_far += c
            if 2.0 ** (-b / 4) * total <= fdr * so_far:
                out[s] = b
    return out


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (start, rank, end, kind by start) and ``cand`` (start, end, value): in-row, no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    kinds = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
    out = _held(docs, __cand=_pieces(t, CANDIDATE), **{f"__{kind}": _pieces(t, pattern, group) for kind, pattern, group, _ in kinds})

    def long_enough(least: int):
        return lambda x: F.char_length(x["value"]) >= least

    found = [_tagged(F.filter(_matches(F.col(f"__{kind}")), long_enough(least)), kind) for kind, _, _, least in kinds]
    out = _held(out, base=F.array_sort(F.concat(*found)), __runs=_matches(F.col("__cand")))
    return out.withColumn("cand", _apart(F.col("__runs"), F.col("base"))).drop("__cand", "__runs", *[f"__{k}" for k, *_ in kinds])


def find_secrets(docs: DataFrame, fdr: float = FDR, min_random: float = MIN_RANDOM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, the row's key ``k``, ``base`` and ``spans``.

    Both are arrays of (start, rank, end, kind) sorted by start; spans adds kind
    ``random``. The texts are read once; what is stored has no text.
    """
    slim = docs.select("doc_id", "text", row_key("doc_id", "text").alias("k"))
    scanned = stored(scan(slim).drop("text"), "scanned")
    runs = scanned.select("k", F.explode("cand").alias("c"))
    tested = stored(battery(runs.select(F.col("c.value").alias("value"), F.lit(1).alias("one")).groupBy("value").agg(F.sum("one").alias("times"))), "tested-runs")
    least = F.lit(MAX_BIN + 1)
    for s, b in fdr_bins(tested, fdr).items():
        least = F.when(_stratum(F.col("n")) == s, b).otherwise(least)
    secret = stored(tested.filter((F.col("p_random") >= min_random) & (_bin(F.col("p_prose")) >= least)).select("value"), "random-runs")
    extra = (runs.join(secret, F.col("c.value") == F.col("value"), "left_semi").groupBy("k")
             .agg(F.collect_set(F.struct(F.col("c.start").alias("start"), F.lit(len(KINDS)).alias("rank"), F.col("c.end").alias("end"), F.lit("random").alias("kind"))).alias("extra")))
    none = F.array().cast(scanned.schema["base"].dataType)
    spans = F.array_sort(F.concat("base", F.coalesce(F.col("extra").cast(scanned.schema["base"].dataType), none)))
    return scanned.join(stored(extra, "random-spans"), "k", "left").select("doc_id", "k", "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by a placeholder, overlapping spans by one.

    ``n_chars`` follows where it is a column. Only the spans of texts that have
    some are joined to the documents, by row key.
    """
    spans = find_secrets(docs).filter(F.size("spans") > 0).select(F.col("k").alias("__k"), F.col("spans").alias("__spans")).dropDuplicates(["__k"])
    found = docs.join(stored(spans, "spans"), row_key("doc_id", "text") == F.col("__k"), "left")
    t = F.col("text")

    def step(acc: Column, x: Column) -> Column:
        start = F.greatest(acc["at"], x["start"])
        fresh = F.concat(acc["out"], F.substring(t, acc["at"] + 1, start - acc["at"]), F.lit(PLACEHOLDER))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] < acc["at"], acc["out"]).otherwise(fresh).alias("out"))

    clean = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.char_length(t) - a["at"])))
    hit = F.col("__spans").isNotNull()
    out = found.withColumn("text", F.when(hit, clean).otherwise(t))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length(F.col("text"))).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
