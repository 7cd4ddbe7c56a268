"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_chats`` turns rows (conv_id, turn, role, text) into one row per conversation with the formatted
string and its segments, each with a loss flag; ``read_chats`` gives roles, texts and loss texts back from
those alone. Control strings inside texts and roles get a backslash behind their first character, and
backslashes are doubled, so nothing inside a text can end its turn and everything comes back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn's role and text, roles whose text is trained on, strings to escape, and the machine.

    ``moves`` maps (state, role) to the next state; a pair that it lacks makes the conversation invalid
    from that turn on, which is reported and never drops a turn.
    """

    turn: str = "<|turn|>"
    said: str = "<|said|>"
    end: str = "<|end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"), ("start", "user", "asked"), ("ready", "user", "asked"), ("asked", "assistant", "told"), ("told", "user", "asked"),
    )

    def __post_init__(self):
        for a in self.controls:
            if "\\" in a or len(a) < 2:
                raise ValueError(f"a control string needs two characters or more and no backslash: {a!r}")
            for b in self.controls:
                if any(a.endswith(b[:k]) for k in range(1, len(b))) and a != b:
                    raise ValueError(f"control strings overlap: {a!r}, {b!r}")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.said, self.end.rstrip("\n"), *self.foreign)

    def escape(self, text: str) -> str:
        rule = "|".join(map(re.escape, sorted(self.controls, key=len, reverse=True)))
        return re.sub(rule, lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


CHAT = Template()
FORMATTED = "conv_id long, formatted string, segments array<struct<start:int,stop:int,loss:boolean>>, valid boolean, broken_at int"
READ = "conv_id long, n_turns long, roles array<string>, texts array<string>, loss array<string>, formatted_chars long, valid boolean, broken_at int"


def _format(template: Template):
    moves = {(a, role): b for a, role, b in template.moves}
    schema = pa.schema(
        [("conv_id", pa.int64()), ("formatted", pa.string()), ("segments", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("loss", pa.bool_())])))]
        + [("valid", pa.bool_()), ("broken_at", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by conversation and turn; only the open conversation is held."""
        conv, parts, segments, at, state, broken, n, open_ = None, [], [], 0, "start", None, 0, False
        done: list[tuple] = []

        def close():
            done.append((conv, "".join(parts), segments, broken is None, broken))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done.clear()
            return out

        def segment(text, loss):
            nonlocal at
            parts.append(text)
            segments.append({"start": at, "stop": at + len(text), "loss": loss})
            at += len(text)

        for b in batches:
            for c, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not open_ or c != conv:
                    if open_:
                        close()
                    conv, parts, segments, at, state, broken, n, open_ = c, [], [], 0, "start", None, 0, True
                state = moves.get((state, role)) if state is not None else None
                if state is None and broken is None:
                    broken = n
                n += 1
                segment(template.turn + template.escape(role or "") + template.said, False)
                segment(template.escape(text or ""), role in template.trained)
                segment(template.end, False)
            if len(done) >= 500:
                yield flush()
        if open_:
            close()
        if done:
            yield flush()

    return run


def format_chats(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, formatted, segments (start, stop, loss; in code points), valid, broken_at (first turn out of order).

    Turns go by (turn, role, text), nulls first. A null text or role is formatted as empty; a null conv_id is
    a conversation of its own. Rows that repeat are turns of their own. Extra columns are ignored. An empty
    table gives no conversations. A conversation is held by one task at a time, as its text is one value.
    """
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    r = r.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return r.mapInArrow(_format(template), FORMATTED)


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, text, segments, valid, broken in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "segments", "valid", "broken_at")), strict=True):
                turns = [t.split(template.said) for t in text.split(template.turn)[1:]]
                for t in turns:
                    if len(t) != 2 or not t[1].endswith(template.end):
                        raise ValueError(f"conversation {conv} does not parse")
                roles = [template.unescape(t[0]) for t in turns]
                texts = [template.unescape(t[1][: -len(template.end)]) for t in turns]
                loss = [template.unescape(text[s["start"] : s["stop"]]) for s in segments if s["loss"]]
                out.append((conv, len(turns), roles, texts, loss, len(text), valid, broken))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.bool_(), pa.int32()]
            names = ["conv_id", "n_turns", "roles", "texts", "loss", "formatted_chars", "valid", "broken_at"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def read_chats(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, n_turns, roles, texts, loss (texts under the mask), formatted_chars, valid, broken_at, parsed from ``format_chats`` output."""
    return formatted.select("conv_id", "formatted", "segments", "valid", "broken_at").mapInArrow(_read(template), READ)


def digests(read: DataFrame) -> DataFrame:
    """The read-back conversations as counts and SHA-256 digests."""
    turns = F.concat_ws("", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))))
    loss = F.concat_ws("", "loss")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select(
        "conv_id", "n_turns", sha(turns).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), sha(loss).alias("loss_sha256"), "formatted_chars", "valid", "broken_at"
    )


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
