"""Chat formatting by a finite-state machine over roles.

A ``Template`` names the marks around a turn, which roles' texts are trained
on, and the transitions between roles. A conversation's rows, in order of turn,
drive the machine; each turn becomes text segments with a loss flag each, and a
state that says whether the order of roles was valid so far. Nothing is
dropped: an invalid conversation is formatted too and marked.

Control strings inside texts and roles are escaped reversibly: every ``<``,
backslashes, ``|`` takes one more backslash, so a text cannot hold a mark.

A null text is empty, a null role is the empty role (never valid). Rows with
equal conv_id and turn are ordered by role, then text; a null turn comes first;
null conv_ids form one conversation. Rows stream in order, so a conversation of
any length needs the memory of one batch only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import bounded_batches

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


@dataclass(frozen=True)
class Template:
    """``{role}`` in ``opens`` stands for the role. ``moves``: the states that
    may follow each state; "start" is before the first turn."""

    opens: str = "<|im_start|>{role}\n"
    closes: str = "<|im_end|>"
    between: str = "\n"
    trained: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.opens.replace("{role}", escape_role(role)), False), (escape(text), role in self.trained),
                (self.closes + self.between, False)]


def ordered_turns(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_chat(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, place (0, 1, .. in the conversation), state (the role, or
    "invalid" from the first turn that the machine refuses on) and segments
    (text, loss), one row per turn."""
    bounded_batches(turns.sparkSession)
    t = template or Template()
    segment = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("state", pa.string()), ("segments", segment)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, state, begun = None, 0, "start", False
        for batch in batches:
            places, states, parts = [], [], []
            ids = batch.column(0).to_pylist()
            for cid, role, text in zip(ids, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not begun or cid != conv:
                    conv, place, state, begun = cid, 0, "start", True
                state = role if role in t.moves.get(state, ()) else "invalid"
                places.append(place)
                states.append(state)
                parts.append([{"text": s, "loss": loss} for s, loss in t.segments(role, text)])
                place += 1
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(states),
                                   pa.array(parts, segment)], schema=schema)

    return ordered_turns(turns).mapInArrow(
        run, "conv_id bigint, place bigint, state string, segments array<struct<text string, loss boolean>>")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What the formatted text says, one row per conversation: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid. The
    text is parsed by the template's marks alone; the mask gives the loss."""
    t = template or Template()
    opens = re.escape(t.opens).replace(re.escape("{role}"), r"([^\n]*?)")
    turn = re.compile(f"{opens}(.*?){re.escape(t.closes + t.between)}", re.DOTALL)
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("valid", pa.bool_())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now = None, None
        for batch in batches:
            done = []
            for cid, state, segments in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if now is None or cid != conv:
                    if now is not None:
                        done.append(now)
                    conv, now = cid, [cid, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                text = "".join(s["text"] for s in segments)
                at = 0
                for m in turn.finditer(text):
                    if m.start() != at:
                        raise ValueError("text between turns")
                    at = m.end()
                    now[1] += 1
                    now[2].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                if at != len(text):
                    raise ValueError("an unfinished turn")
                trained = unescape("".join(s["text"] for s in segments if s["loss"]))
                now[3] += len(trained)
                now[4].update(trained.encode())
                now[5] += len(text)
                now[6] = now[6] and state != "invalid"
            if done:
                yield rows(done)
        if now is not None:
            yield rows([now])

    def rows(done: list) -> pa.RecordBatch:
        cols = list(zip(*[(a, b, c.hexdigest(), d, e.hexdigest(), f, g) for a, b, c, d, e, f, g in done], strict=True))
        return pa.record_batch([pa.array(c, k.type) for c, k in zip(cols, schema, strict=True)], schema=schema)

    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        parse, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
               "formatted_chars bigint, valid boolean")
