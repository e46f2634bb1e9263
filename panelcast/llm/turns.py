"""Conversation structure repair by block tables (the method of the Four Russians).

Role initials of a repaired conversation read ``(s?(ua)+)?``: an automaton of
four states. Each turn is one of nine symbols (its role's initial or another,
whole or truncated, or a turn that has to go), and edits have costs: keep 0,
rerole to user or assistant 3, delete 4, insert an empty user or assistant
turn 3, and 3 more for a truncated turn that stays. From the end of a
conversation backwards, the cheapest costs of the four states, less their
minimum, take only a few dozen values, so the tables hold, for each such
vector and each block of ``BLOCK`` symbols, the vector before the block and
the cost added. A conversation is read by one lookup a block. Each block is
then expanded backwards from the vector at its end, and its edits are read off
from the left: among the cheapest the first initial in ASCII order, which
gives the ASCII-least audit of all, as different edits have different initials.

As jobs: turns are reduced to (conversation, turn, role, digest of the text,
faults, copies) with partial sums; the first of equal (role, text) is found by
an aggregate; the symbols then go in order through one task a conversation, at
one byte a turn (as its audit has), and Spark's sort spills. The audits meet
the texts in a second sorted stream that digests the repaired turns one by
one, so the texts of a conversation are never held together.

Cases: null roles and texts are one space (so such a text is blank and such a
role is none of s, u, a); a null conversation is one of its own; null turns
come first; turns of the same number go by role, then by the SHA-256 of the
text; equal rows are each a turn, the first of them no duplicate; an empty
role has no initial and matches nothing; texts of any length are digested
whole; a conversation without turns has zeros, an empty audit and the digest
of the empty text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4
SPACES = "\x20\t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Automaton: 0 nothing yet, 1 after s, 2 after u, 3 after a; the conversation may end in 0 or 3.
START, ENDS = 0, (0, 3)
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The state after a turn of the only role that may come next, and that role.
NEXT = (2, 2, 3, 2)
NEXT_ROLE = ("user", "user", "assistant", "user")
#: Faults: 0 none, 1 blank, 2 duplicate, 3 truncated.
INITIALS = "suao"
#: Symbols: 0 has to go; 1-4 initials s, u, a, other; 5-8 the same, truncated.
SYMBOLS = 9


def _symbol(code: int) -> int:
    """Of 4 * initial + fault."""
    initial, fault = divmod(code, 4)
    return 0 if fault in (1, 2) else 1 + initial + (4 if fault == 3 else 0)


def _edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits that take a turn of this symbol, in ASCII order."""
    yield "D", DELETE, state
    if symbol:
        initial, extra = INITIALS[(symbol - 1) % 4], TRUNCATED * (symbol > 4)
        if state in MOVES.get(initial, ()):
            yield "K", extra, MOVES[initial][state]
        yield "R", REROLE + extra, NEXT[state]


def _relaxed(costs: list[int]) -> list[int]:
    """With insertions before the turn; two in a row reach every state that insertions can reach."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return costs


class BlockTables:
    """Vectors of normalised costs to the end, and their transitions over one symbol and over a block."""

    def __init__(self, block: int = BLOCK):
        far = 1000  # more than any insertions cost
        end = tuple(_relaxed([0 if s in ENDS else far for s in range(4)]))
        self.block, self.vectors, number = block, [end], {end: 0}
        step, add = [], []
        for v in self.vectors:  # grows while new vectors turn up
            row, cost = [], []
            for symbol in range(SYMBOLS):
                before = _relaxed([min(c + v[t] for _, c, t in _edits(symbol, s)) for s in range(4)])
                least = min(before)
                key = tuple(c - least for c in before)
                if key not in number:
                    number[key] = len(self.vectors)
                    self.vectors.append(key)
                row.append(number[key])
                cost.append(least)
            step.append(row)
            add.append(cost)
        self.step, self.add = step, add
        # blocks as numbers in base SYMBOLS, the leftmost symbol the highest digit
        s, a = np.array(step), np.array(add)
        over, cost = s, a
        for _ in range(block - 1):
            cost = (cost[:, None, :] + a[over].transpose(0, 2, 1)).reshape(len(s), -1)
            over = s[over].transpose(0, 2, 1).reshape(len(s), -1)
        self.over, self.cost = over.astype(np.int32).tolist(), cost.astype(np.int32).tolist()
        self._traced: dict[tuple, tuple[str, int]] = {}

    def solve(self, codes: bytes) -> tuple[int, str]:
        """(cost, audit) of a conversation given as 4 * initial + fault a turn."""
        symbols = np.frombuffer(codes.translate(_TO_SYMBOL), np.uint8).astype(np.int64)
        head = len(symbols) % self.block
        power = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        blocks = (symbols[head:].reshape(-1, self.block) @ power).tolist()
        at, total, ends = 0, 0, [0] * len(blocks)
        for i in range(len(blocks) - 1, -1, -1):
            ends[i] = at
            total += self.cost[at][blocks[i]]
            at = self.over[at][blocks[i]]
        first = symbols[:head].tolist()
        after_head = at
        for symbol in reversed(first):
            total += self.add[at][symbol]
            at = self.step[at][symbol]
        total += self.vectors[at][START]
        text, state = self._trace(after_head, tuple(first), START)
        out = [text]
        for block, end in zip(blocks, ends):
            key = (end, block, state)
            if key not in self._traced:
                digits = tuple(block // int(p) % SYMBOLS for p in power)
                self._traced[key] = self._trace(end, digits, state)
            text, state = self._traced[key]
            out.append(text)
        while state not in ENDS:
            out.append("I")
            state = NEXT[state]
        return total, "".join(out)

    def _trace(self, end: int, symbols: tuple[int, ...], state: int) -> tuple[str, int]:
        """Edits of a block and the state after it: expand backwards, then take the least initial on a cheapest way."""
        at = [end]
        for symbol in reversed(symbols):
            at.append(self.step[at[-1]][symbol])
        at.reverse()
        out = []
        for i, symbol in enumerate(symbols):
            here, after = self.vectors[at[i]], self.vectors[at[i + 1]]
            least = self.add[at[i + 1]][symbol]
            while True:
                found = {e: t for e, c, t in _edits(symbol, state) if c + after[t] == here[state] + least}
                if "D" not in found and INSERT + here[NEXT[state]] == here[state]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                edit = min(found)
                out.append(edit)
                state = found[edit]
                break
        return "".join(out), state


_TO_SYMBOL = bytes([_symbol(c) if c < 16 else 0 for c in range(256)])
#: Codes travel as letters from here on.
_LETTER = 65
_FROM_LETTER = bytes([(c - _LETTER) % 256 for c in range(256)])
LEGAL = {(0, 1), (1, 2), (2, 1)}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
COLUMNS = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


class _Conversation:
    """What is known of a conversation while its turns pass in order: one byte a turn and a few counts."""

    def __init__(self):
        self.codes, self.low, self.high, self.turns = bytearray(), None, None, 0

    def add(self, turn: str | None, letters: str | None) -> None:
        if not letters:
            return
        self.codes += letters.encode().translate(_FROM_LETTER)
        if turn is not None:
            number = int(turn)
            if self.high != number:
                self.turns += 1
            self.low, self.high = number if self.low is None else self.low, number

    def row(self, tables: BlockTables) -> tuple:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        fault, initial = codes % 4, codes // 4
        pairs = initial[:-1].astype(int) * 4 + initial[1:]
        illegal = len(pairs) - sum(int((pairs == a * 4 + b).sum()) for a, b in LEGAL)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = tables.solve(bytes(self.codes))
        return (gaps, *(int((fault == k).sum()) for k in (1, 2, 3)), illegal, cost, audit)


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables, names = BlockTables(), ["conv", *COUNTS, "audit"]
    conv, state, out = None, None, []
    for b in batches:
        for c, turn, letters in zip(b["conv"], b["turn"], b["letters"]):
            if state is None or c != conv:
                if state is not None:
                    out.append((conv, *state.row(tables)))
                conv, state = c, _Conversation()
            state.add(turn, letters)
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if state is not None:
        yield pd.DataFrame([(conv, *state.row(tables))], columns=names)


class _Repaired:
    """Reads a conversation's turns in order and gives the repaired ones, as (role, text), by its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield NEXT_ROLE[self.state], ""
            self.state = NEXT[self.state]
            self.at += 1

    def take(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = MOVES[role[0]][self.state]
            yield role, text
        elif edit == "R":
            yield NEXT_ROLE[self.state], text
            self.state = NEXT[self.state]


def _streamed(start, columns: list[str]):
    """A function over the stream of audits and turns. ``start(conv, counts, audit)`` gives an object with
    ``add(role, text)``, which may return a row, and ``end()``, which may return one too."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = sink = None
        for b in batches:
            out = []

            def put(more, final=False):
                out.extend(row for pair in more if (row := sink.add(*pair)) is not None)
                if final and (row := sink.end()) is not None:
                    out.append(row)
            for c, kind, role, text, copies, counts in zip(b["conv"], b["kind"], b["role"], b["text"], b["copies"], b["counts"]):
                if kind == 0:
                    if sink is not None:
                        put(reader.inserted(), final=True)
                    reader, sink = _Repaired(text), start(c, counts, text)
                else:
                    for _ in range(copies):
                        put(reader.take(role, text))
            yield pd.DataFrame(out, columns=columns)
        if sink is not None:
            out = [row for pair in reader.inserted() if (row := sink.add(*pair)) is not None]
            if (row := sink.end()) is not None:
                out.append(row)
            yield pd.DataFrame(out, columns=columns)
    return run


class _Digest:
    def __init__(self, conv: str | None, counts: str, audit: str):
        self.head, self.audit, self.hash, self.lines = (conv, *map(int, counts.split(","))), audit, hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def end(self) -> tuple:
        return (*self.head, self.audit, self.hash.hexdigest())


class _Lines:
    def __init__(self, conv: str | None, counts: str, audit: str):
        self.conv, self.turn = conv, -1

    def add(self, role: str, text: str) -> tuple:
        self.turn += 1
        return self.conv, self.turn, role, text

    def end(self) -> None:
        return None


def _prepared(turns: DataFrame, copies: Column | None) -> DataFrame:
    """Turns without nulls in role and text, ids as text (pandas would make integers with nulls floats), and a digest of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), (F.lit(1) if copies is None else copies).cast("int").alias("copies"))


def audits(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation; ``conv`` is its id as text.

    ``copies`` counts how often a row stands in its conversation; 0 keeps only the conversation's name.
    """
    rows = _prepared(turns, copies)
    inner = F.rtrim(F.col("text"), F.lit(SPACES))
    lead = F.substring("role", 1, 1)
    initial = F.when(lead == "s", 0).when(lead == "u", 1).when(lead == "a", 2).otherwise(3)
    fault = F.when(inner == "", F.lit(1)).when(F.right(inner, F.lit(1)).isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(3))
    slim = (rows.select("conv", "turn", "role", "digest", "copies", (initial * 4).alias("initial"), fault.alias("fault"))
            .groupBy("conv", "turn", "role", "digest").agg(F.sum("copies").alias("n"), F.first("initial").alias("initial"), F.first("fault").alias("fault")))
    # equal (role, text): the first by turn, null turns before others; rows that are equal up to here are told apart by their number
    earliest = slim.filter("n > 0").groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("earliest")).select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest")
    joined = slim.join(earliest, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")

    def letter(code: Column) -> Column:
        return F.char(code + _LETTER)

    n = F.col("n").cast("int")
    own, copy = letter(F.col("initial") + F.col("fault")), letter(F.col("initial") + F.when(F.col("fault") == 1, 1).otherwise(2))
    is_first = F.col("turn").eqNullSafe(F.col("earliest.turn"))
    letters = F.when(n <= 0, F.lit("")).when(is_first, F.concat(own, F.repeat(copy, n - 1))).otherwise(F.repeat(copy, n))
    dealt = (joined.select("conv", "turn", "role", "digest", letters.alias("letters"))
             .repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest"))
    return dealt.select("conv", F.col("turn").cast("string").alias("turn"), "letters").mapInPandas(_solved, f"conv string, {COLUMNS}")


def _with_audits(turns: DataFrame, found: DataFrame, copies: Column | None) -> DataFrame:
    """Each conversation's audit, then its turns in order, in one task's stream."""
    rows = _prepared(turns, copies).filter("copies > 0").withColumns({"kind": F.lit(1), "counts": F.lit("")})
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(1).alias("copies"),
                         F.concat_ws(",", *COUNTS).alias("counts"))
    return (heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
            .select("conv", "kind", "role", "text", "copies", "counts"))


def _back(out: DataFrame, turns: DataFrame) -> DataFrame:
    return out.select(F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), *out.columns[1:])


def repair_report(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and the digest of its repaired turns."""
    run = _streamed(_Digest, ["conv", *COUNTS, "audit", "repaired_sha256"])
    return _back(_with_audits(turns, audits(turns, copies), copies).mapInPandas(run, f"conv string, {COLUMNS}, repaired_sha256 string"), turns)


def repaired_turns(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """``(conv_id, turn, role, text)``: the repaired conversations, turns numbered from 0."""
    run = _streamed(_Lines, ["conv", "turn", "role", "text"])
    return _back(_with_audits(turns, audits(turns, copies), copies).mapInPandas(run, "conv string, turn long, role string, text string"), turns)
