"""Chat formatting: a finite-state machine over roles and a declarative template give text segments with loss flags.

The template names, for each role, what opens and closes its turns and whether its text is learned; for each state, the
roles that may follow; and which states may end a conversation.  Control strings inside texts are escaped reversibly,
so the formatted output can be cut into turns again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import n_partitions, ship_package


@dataclass(frozen=True)
class Template:
    """``turns``: role to (opening, closing, learned).  A role without an entry is written out between ``other``'s
    three marks and never learned.  ``follow``: state to the roles that may come next; a role's name is its state."""

    turns: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True),
    })
    other: tuple = ("<<TURN>>", "<<TEXT>>", "<</TURN>>")
    follow: dict = field(default_factory=lambda: {
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    final: tuple = ("assistant",)
    escape: str = "⁠"

    def controls(self) -> list[str]:
        return sorted({x for o, c, _ in self.turns.values() for x in (o, c)} | set(self.other))


class Formatter:
    """Escapes, formats and reads back with one template."""

    def __init__(self, template: Template):
        if any(len(c) < 2 or template.escape in c for c in template.controls()):
            raise ValueError("control strings need two characters or more and no escape mark, so that the mark can part them")
        self.t = template
        self._all = template.controls()
        control = "|".join(map(re.escape, template.controls()))
        self._control = re.compile(control)
        # an escaped control string has one escape mark behind its first character
        e = re.escape(template.escape)
        self._escaped = re.compile("|".join(re.escape(c[0]) + e + re.escape(c[1:]) for c in template.controls())
                                   + f"|{e}{e}")

    def escape(self, text: str) -> str:
        e = self.t.escape
        return self._control.sub(lambda m: m[0][0] + e + m[0][1:], text.replace(e, e + e))

    def unescape(self, text: str) -> str:
        e = self.t.escape
        return self._escaped.sub(lambda m: e if m[0] == e + e else m[0][0] + m[0][2:], text)

    def segments(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """The parts of one turn with their loss flags."""
        if role in self.t.turns:
            opening, closing, learned = self.t.turns[role]
            yield opening, False
        else:
            start, middle, closing = self.t.other
            learned = False
            yield start + self.escape(role) + middle, False
        yield self.escape(text), learned
        yield closing, False

    def read(self, parts: Iterator[str]) -> Iterator[tuple[str, str]]:
        """The turns ``(role, text)`` of a formatted conversation that comes in parts of any length."""
        reader = Reader(self)
        for part in parts:
            yield from reader.feed(part)


class Reader:
    """Cuts formatted text into turns as it comes; control strings may be split between parts."""

    def __init__(self, formatter: Formatter):
        self.f = formatter
        self.opens = {o: (r, c) for r, (o, c, _) in formatter.t.turns.items()}
        self.longest = max(map(len, formatter.t.controls()))
        self.rest, self.role, self.closing, self.body = "", "", "", []

    def feed(self, part: str) -> list[tuple[str, str]]:
        start, middle, end = self.f.t.other
        out, at, rest = [], 0, self.rest + part
        for m in self.f._control.finditer(rest):
            self.body.append(rest[at:m.start()])
            at = m.end()
            if m[0] == self.closing:
                out.append((self.role, self.f.unescape("".join(self.body))))
                self.closing = ""
            elif m[0] in self.opens:
                self.role, self.closing = self.opens[m[0]]
            elif m[0] == start:
                self.closing = ""
            elif m[0] == middle:
                self.role, self.closing = self.f.unescape("".join(self.body)), end
            self.body = []
        # the last characters may begin a control string that goes on in the next part
        keep = next((n for n in range(min(len(rest) - at, self.longest - 1), 0, -1)
                     if any(c.startswith(rest[len(rest) - n:]) for c in self.f._all)), 0)
        self.body.append(rest[at:len(rest) - keep])
        self.rest = rest[len(rest) - keep:]
        return out


SEGMENTS = "conv_id long, turn_no long, part int, role string, text string, loss boolean, allowed boolean, may_end boolean"


def format_conversations(conversations: DataFrame, template: Template = Template(), conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments in order: ``(conv_id, turn_no, part, role, text, loss, allowed, may_end)``.

    A conversation's turns come by ``turn``, equal turns by role and text, turns without a number first; joining
    the texts of its segments gives the formatted conversation.  ``allowed`` tells whether the role may follow the
    turn before it, ``may_end`` whether the conversation may end here; turns against the order are formatted all the
    same.  Null texts and roles are empty; rows without ``conv_id`` form one conversation; repeated rows are turns of
    their own; an empty table gives no rows; other columns are not read.

    Each conversation's rows come sorted through one task as a stream, of which only one turn is held at a time.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        f = Formatter(template)
        none = object()
        conv, state, n = none, "", 0
        for batch in batches:
            out: list[tuple] = []
            for c, _, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if conv is none or c != conv:
                    conv, state, n = c, "", 0
                allowed = role in template.follow.get(state, ())
                state = role
                for part, (piece, loss) in enumerate(f.segments(role, text)):
                    out.append((c, n, part, role, piece, loss, allowed, role in template.final))
                n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, kind) for col, kind in zip(zip(*out), _KINDS)] if out else [pa.array([], k) for k in _KINDS],
                names=_NAMES)

    return rows.mapInArrow(run, SEGMENTS)


_NAMES = ["conv_id", "turn_no", "part", "role", "text", "loss", "allowed", "may_end"]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]


class _Digest:
    """What is read back of one conversation, as its segments come."""

    def __init__(self, conv, formatter: Formatter):
        self.conv, self.f = conv, formatter
        self.turns, self.turn_hash = 0, hashlib.sha256()
        self.loss_chars, self.loss_hash, self.chars = 0, hashlib.sha256(), 0
        self.valid, self.may_end = True, False
        self.reader = Reader(formatter)

    def add(self, text: str, loss: bool, allowed: bool, may_end: bool) -> None:
        self.chars += len(text)
        self.valid &= allowed
        self.may_end = may_end
        if loss:
            plain = self.f.unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode())
        for role, body in self.reader.feed(text):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{body}\n".encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars,
                self.valid and self.may_end)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, read from the output of ``format_conversations`` as it comes, without a shuffle:
    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid_order)``."""

    def run(batches):
        f = Formatter(template)
        now: _Digest | None = None

        def rows(done: list[_Digest]) -> pa.RecordBatch:
            cols = list(zip(*(d.row() for d in done))) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _DIGEST_KINDS)], names=_DIGEST_NAMES)

        for batch in batches:
            done: list[_Digest] = []
            for c, _, _, _, text, loss, allowed, may_end in zip(*(x.to_pylist() for x in batch.columns)):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now)
                    now = _Digest(c, f)
                now.add(text, loss, allowed, may_end)
            yield rows(done)
        if now is not None:
            yield rows([now])

    return segments.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long, valid_order boolean")


_DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid_order"]
_DIGEST_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
