"""Chat formatting: a role automaton checks turn order, a template gives segments with loss flags.

A conversation's turns come in the order of turn number (nulls first), then role, then text, so
ties and repeated rows have one order. Null texts and null roles are empty strings. A turn the
automaton does not allow is formatted like the others and flagged; the automaton then goes on
from that turn's role. Rows without a conversation id form one conversation. An empty table
gives an empty result; columns other than the four named are not read.

Turns are streamed through a partition sorted by conversation, with a state of a few values, so
a conversation of any length needs no memory. Its digest is a chain over its turns, which is why
one conversation stays within one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CODES = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class ChatTemplate:
    """Markers, the roles whose text carries loss, and the allowed order of roles.

    ``control`` lists every string that may not occur inside a text; each is replaced by
    ``escape`` and a code, as is ``escape`` itself, and the replacement can be undone.
    """

    open_turn: str = "<|im_start|>"
    after_role: str = "\n"
    close_turn: str = "<|im_end|>\n"
    escape: str = "\\"
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def __post_init__(self):
        if len(self.control) >= len(_CODES) or len(self.escape) != 1:
            raise ValueError("the escape is one character and there is a code for every control string")
        if any(self.escape in c or c[:1] in _CODES + self.after_role or not c for c in self.control):
            raise ValueError("a control string is empty, holds the escape or begins like a code")
        if self.open_turn not in self.control or not any(c in self.close_turn for c in self.control):
            raise ValueError("the markers of a turn must be control strings")

    def _pattern(self, more: tuple[str, ...] = ()) -> re.Pattern:
        longest_first = sorted((self.escape, *self.control, *more), key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest_first)))

    def escaper(self):
        """Two functions: for texts, and for role names, which may not hold ``after_role`` either."""
        code = {c: self.escape + k for c, k in zip((self.escape, *self.control, self.after_role), _CODES)}
        texts, roles = self._pattern(), self._pattern((self.after_role,))

        def put(pattern):
            return lambda s: pattern.sub(lambda m: code[m.group()], s)

        return put(texts), put(roles)

    def unescaper(self):
        plain = dict(zip(_CODES, (self.escape, *self.control, self.after_role)))
        pattern = re.compile(re.escape(self.escape) + "(.)", re.S)
        return lambda s: pattern.sub(lambda m: plain[m.group(1)], s)


def format_chats(
    conversations: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Segments ``conv_id, position, part, segment, loss, in_order``, three of each turn.

    ``position`` counts the turns of a conversation from 0; part 0 opens the turn, part 1 is its
    escaped text and part 2 closes it. The segments of a conversation, concatenated, are its
    formatted text. ``in_order`` says whether the automaton allowed the turn.
    """
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of, role_of = template.escaper()
        conv, position, state, first = None, 0, template.start, True
        for batch in batches:
            out = {k: [] for k in ("conv_id", "position", "part", "segment", "loss", "in_order")}
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for key, role, text in zip(*columns):
                if first or key != conv:
                    conv, position, state, first = key, 0, template.start, False
                fits = role in template.moves.get(state, ())
                parts = (
                    template.open_turn + role_of(role) + template.after_role, text_of(text), template.close_turn,
                )
                out["conv_id"] += (key, key, key)
                out["position"] += (position,) * 3
                out["part"] += (0, 1, 2)
                out["segment"] += parts
                out["loss"] += (False, role in template.loss_roles, False)
                out["in_order"] += (fits,) * 3
                position, state = position + 1, role
            arrays = [pa.array(out["conv_id"], batch.column("conv_id").type), pa.array(out["position"], pa.int64()),
                      pa.array(out["part"], pa.int32()), pa.array(out["segment"], pa.string()),
                      pa.array(out["loss"], pa.bool_()), pa.array(out["in_order"], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=list(out))

    return rows.mapInArrow(
        run, f"conv_id {kind}, position long, part int, segment string, loss boolean, in_order boolean"
    )


class _Reader:
    """Reads one conversation's formatted text back, segment by segment."""

    def __init__(self, template: ChatTemplate):
        self.template, self.unescape = template, template.unescaper()
        self.waiting, self.turns, self.chars, self.loss_chars, self.in_order = "", 0, 0, 0, True
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, loss: bool, in_order: bool) -> None:
        t = self.template
        self.chars += len(segment)
        self.in_order &= in_order
        if loss:
            text = self.unescape(segment)
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode())
        self.waiting += segment
        while (end := self.waiting.find(t.close_turn)) >= 0:
            turn, self.waiting = self.waiting[:end], self.waiting[end + len(t.close_turn) :]
            if not turn.startswith(t.open_turn):
                raise ValueError("a turn does not begin with its marker")
            role, _, text = turn[len(t.open_turn) :].partition(t.after_role)
            self.turn_hash.update(f"{self.unescape(role)}\n{self.unescape(text)}\n".encode())
            self.turns += 1

    def row(self, key) -> tuple:
        if self.waiting:
            raise ValueError("a turn is not closed")
        return (
            key, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(),
            self.chars, self.in_order,
        )


def read_back(segments: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row of digests per conversation, parsed from its formatted segments."""
    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "position", "part")
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, reader, kept, id_type = None, None, [], pa.int64()

        def rows(done: list[tuple]) -> pa.RecordBatch:
            types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            columns = zip(*done) if done else ((),) * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

        for batch in batches:
            id_type = batch.column("conv_id").type
            for key, segment, loss, fits in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss", "in_order"))
            ):
                if reader is None or key != conv:
                    if reader is not None:
                        kept.append(reader.row(conv))
                    conv, reader = key, _Reader(template)
                reader.feed(segment, loss, fits)
            yield rows(kept)
            kept = []
        if reader is not None:
            yield rows([reader.row(conv)])

    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, in_order boolean",
    )
