"""Chat formatting with a grammar round trip.

A conversation is rendered as ``turn*`` with

    turn = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

and the rendered text is read back by a deterministic parser, which refuses a
control string inside a role or text, so none stays live there. A turn whose
recovered role or text differs from the source is escaped and read again until
they are identical. Escaping puts one backslash into every ``<`` backslash* ``|``
of the turn; reading takes one out of every such run that has any, so text
that holds control strings, or text that looks escaped, comes back unchanged,
and a turn without conflict is rendered as it is.

Turns are dealt by conversation and sorted by (conversation, turn) inside a
task; Spark's sort spills. Rendering, parsing and the digests run over that
stream, so a conversation with a third of all turns needs the memory of a
batch, not of the conversation.

Cases: a null role or text is empty; a null conversation is one of its own; a
null turn comes first, and equal turns go by role, then text; a text of any
length is rendered whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END, NL = "<|im_start|>", "<|im_end|>", "\n"
TRAINED_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(s: str) -> str:
    return _OPEN.sub(r"<\\\1|", s)


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"<\1|", s)


def render(role: str, text: str) -> str:
    return f"{START}{role}{NL}{text}{END}{NL}"


class Malformed(ValueError):
    """Text outside the grammar."""


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound its raw text in ``rendered``."""
    at = 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise Malformed(f"no turn at {at}")
        role_end = rendered.find(NL, at)
        body = role_end + 1
        stop = rendered.find(END, body)
        if role_end < 0 or stop < 0 or not rendered.startswith(NL, stop + len(END)):
            raise Malformed(f"open turn at {at}")
        role = rendered[at + len(START):role_end]
        if any(c in role or rendered.find(c, body, stop) >= 0 for c in (START, END)):
            raise Malformed(f"control string inside the turn at {at}")
        yield _read_role(unescape(role)), unescape(rendered[body:stop]), body, stop
        at = stop + len(END) + len(NL)


def _read_role(role: str) -> str:
    return re.sub(r"\\([n\\])", lambda m: "\n" if m[1] == "n" else "\\", role)


def format_turn(role: str, text: str) -> str:
    """The rendered turn that reads back as exactly (role, text)."""
    safe_role = role.replace("\\", "\\\\").replace("\n", "\\n")
    for r, t in ((role, text), (role, escape(text)), (escape(safe_role), escape(text))):
        out = render(r, t)
        try:
            if [x[:2] for x in parse(out)] == [(role, text)]:
                return out
        except Malformed:
            pass
    raise Malformed(f"no escape keeps role {role!r}")


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns in order within their conversation's task; ids as text, as pandas would make integers with nulls floats."""
    slim = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.withColumn("conv_id", F.col("conv_id").cast("string")).withColumn("turn", F.col("turn").cast("string"))


def _rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["formatted"] = [format_turn(r, t) for r, t in zip(b["role"], b["text"])]
        yield b[["conv_id", "turn", "role", "formatted"]]


def format_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, formatted)``, in conversation order within a task; a conversation's text is its turns' joined."""
    out = _ordered(turns).mapInPandas(_rendered, "conv_id string, turn string, role string, formatted string")
    return out.withColumns({c: F.col(c).cast(turns.schema[c].dataType) for c in ("conv_id", "turn")})


class _Digest:
    """What one conversation's rendered turns read back as, taken turn by turn."""

    def __init__(self):
        self.turns, self.chars, self.loss = 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == TRAINED_ROLE:
                self.loss += len(text)
                self.masked.update(text.encode("utf-8", "surrogatepass"))

    def row(self, conv) -> dict:
        return {"conv_id": conv, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss,
                "loss_sha256": self.masked.hexdigest(), "formatted_chars": self.chars}


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, state = None, None
    for b in _rendered(batches):
        out = []
        for c, piece in zip(b["conv_id"], b["formatted"]):
            if state is None or c != conv:
                if state is not None:
                    out.append(state.row(conv))
                conv, state = c, _Digest()
            state.add(piece)
        if out:
            yield pd.DataFrame(out)
    if state is not None:
        yield pd.DataFrame([state.row(conv)])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered text: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _ordered(turns).mapInPandas(_digests, schema).withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))
