"""Conversations formatted by a template that is only ever called.

A template is a function from turns (role, text) to a string.  Nothing is known
of it but what it returns: successive prefixes of a conversation are rendered,
and what a turn adds to the output of the prefix before it is that turn's span.
Where an output does not begin with the one before it, the template has
rewritten history, and the turn is marked with what it kept of it.  Inside a
span the text's place is found by rendering the same prefix with a private-use
character as the last text: what stands before and after that character is the
turn's head and tail.  The text between them is read back with the template's
``unescape`` and compared, so a template that alters texts is marked as well.

Rendering all prefixes of a conversation costs the square of its turns, and a
conversation may hold a third of all rows.  It is therefore rendered in windows
of ``WINDOW`` turns after the last ``LEAD`` turns of the window before: linear
time, and one window in memory.  The last lead turn is rendered in both windows;
if it comes out differently, the template looks farther back than the lead, and
that is marked.  A template that rewrites history over more than a window is so
found where the rewriting reaches into the window, or by its different lead.

Rows are dealt by conversation and sorted by turn, then stream through the tasks:
digests of a whole conversation are sequential, so its rows pass one task, but
never stand in its memory together.

Defined cases: a null text or role is empty; a null conversation id is a
conversation of its own; turns are ordered by turn (null first), then role, then
text, so repeated rows are turns of their own; the turn that rewrites history
counts from the first differing character; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import SLICE_BYTES, text_slices

WINDOW = 32
LEAD = 2
#: Private-use characters, of which one that the output does not hold stands in for a text.
PROBES = [chr(c) for c in range(0xE000, 0xE010)]
REWRITES, LOOKS_BACK, ALTERS = "rewrites history", "looks back beyond the lead", "alters texts"

OPEN, CLOSE = "<turn>", "</turn>"
_CONTROL = re.compile(r"<(/?turn>)")
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """``text`` without control strings: backslashes are doubled, and a single one breaks each control string."""
    return _CONTROL.sub(r"<\\\1", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The inverse of ``escape``: a pair of backslashes is one, a single one goes."""
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[tuple[str, str]]) -> str:
    """The production template: ``<turn>role``, a line break, the text, ``</turn>`` and a line break per turn.  A role
    is escaped as a text is, and its line breaks are written as a broken ``\\n``."""
    return "".join(f"{OPEN}{_escape_role(role)}\n{escape(text)}{CLOSE}\n" for role, text in turns)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "<\\n>")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("<\\n>", "\n"))


def read_turn(piece: str) -> tuple[str, str]:
    """(role, text) of one turn of ``marked_turns``, from its output."""
    role, _, text = piece.removeprefix(OPEN).removesuffix(CLOSE + "\n").partition("\n")
    return _unescape_role(role), unescape(text)


@dataclass
class Span:
    """A turn in the output: its slice, the place of its text inside it, and what is wrong with it."""
    piece: str
    text_from: int | None
    text_to: int | None
    kept: int | None = None
    fault: str | None = None


def turn_span(render: Callable, undo: Callable, turns: list[tuple[str, str]], before: str) -> tuple[str, Span]:
    """The output of ``turns`` and what its last turn adds to ``before``, the output of the turns up to it."""
    output = render(turns)
    role, text = turns[-1]
    if not output.startswith(before):
        kept = len(commonprefix([before, output]))
        return output, Span(output[kept:], None, None, kept, REWRITES)
    piece = output[len(before):]
    for probe in PROBES:
        other = render([*turns[:-1], (role, probe)])
        if other.startswith(before) and other.count(probe, len(before)) == 1:
            head, _, tail = other[len(before):].partition(probe)
            break
    else:
        return output, Span(piece, None, None, None, ALTERS)
    inside = piece[len(head):len(piece) - len(tail)]
    if len(piece) < len(head) + len(tail) or piece != head + inside + tail or undo(inside) != text:
        return output, Span(piece, None, None, None, ALTERS)
    return output, Span(piece, len(head), len(head) + len(inside))


def spans(render: Callable, undo: Callable, turns: Iterator[tuple[str, str]], window: int = WINDOW,
          lead: int = LEAD) -> Iterator[Span]:
    """The span of every turn of one conversation, holding ``lead`` + ``window`` turns at most."""
    held: list[tuple[str, str]] = []
    output, last, fresh = "", None, 0
    for turn in turns:
        if fresh == window:
            held, fresh = held[len(held) - lead:], 0
            output = render(held[:-1])
            output, again = turn_span(render, undo, held, output)
            strange = last.fault is None and again != last
        else:
            strange = False
        held.append(turn)
        fresh += 1
        output, last = turn_span(render, undo, held, output)
        if strange and last.fault is None:
            last.fault = LOOKS_BACK
        yield last


_ROWS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("turn_no", pa.int64()), ("role", pa.string()),
                   ("piece", pa.string()), ("start", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()),
                   ("in_loss", pa.bool_()), ("kept", pa.int64()), ("fault", pa.string())])
_ROWS_DDL = ("conv_id long, turn long, turn_no long, role string, piece string, start long, text_start long, text_end long, "
             "in_loss boolean, kept long, fault string")


def _rows(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], sliced: str) -> Iterator[tuple]:
    for batch in batches:
        for part in text_slices([batch], sliced):
            yield from zip(*[part.column(c).to_pylist() for c in columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about SLICE_BYTES of rows."""
    held, count = [], 0
    for row in rows:
        held.append(row)
        count += size(row)
        if count > SLICE_BYTES:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, count = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def format_turns(conversations: DataFrame, render: Callable = marked_turns, undo: Callable = unescape,
                 loss_roles: tuple[str, ...] = ("assistant",), window: int = WINDOW, lead: int = LEAD) -> DataFrame:
    """(conv_id, turn, turn_no, role, piece, start, text_start, text_end, in_loss, kept, fault) per turn.

    The pieces of a conversation in order of ``turn_no`` are its formatted text; ``start`` is the piece's place in it
    and ``text_start``, ``text_end`` that of the (escaped) text, in code points from 0; ``in_loss`` says whether it
    is trained on.  ``fault`` tells what the template does to this turn that makes spans unusable (then the text's
    place is null and ``in_loss`` false, or for REWRITES ``kept`` says how much of the output before it stayed).
    The rows of a conversation are in one partition, in order."""
    if lead < 2 or window < 1:
        raise ValueError("the lead needs two turns or more, the window one")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        def rows():
            source = _rows(batches, ("conv_id", "turn", "role", "text"), "text")
            for conv, group in groupby(source, key=lambda r: r[0]):
                start, waiting = 0, []

                def fed():
                    for row in group:
                        waiting.append(row)
                        yield row[2], row[3]

                for no, span in enumerate(spans(render, undo, fed(), window, lead)):
                    _, turn, role, _ = waiting.pop(0)
                    sound = span.fault is None
                    yield (conv, turn, no, role, span.piece, start, start + span.text_from if sound else None,
                           start + span.text_to if sound else None, sound and role in loss_roles, span.kept, span.fault)
                    start += len(span.piece)
        yield from _batches(rows(), _ROWS, lambda r: len(r[4]) + 64)

    return dealt.mapInArrow(run, _ROWS_DDL)


@dataclass
class _Reading:
    """What has been read back of a conversation so far."""
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    turns_hash: object = field(default_factory=hashlib.sha256)
    loss_hash: object = field(default_factory=hashlib.sha256)
    fault: str | None = None


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("fault", pa.string())])
_READ_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
             "fault string")


def read_back(formatted: DataFrame, read: Callable = read_turn, undo: Callable = unescape) -> DataFrame:
    """Digests of every conversation, from the output of ``format_turns`` alone: (conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, fault).

    Roles and texts come from the pieces by ``read``, the texts under the loss mask from the marked places by
    ``undo``; ``fault`` is the first one of the conversation.  No shuffle: the rows come as ``format_turns`` leaves
    them."""
    columns = ("conv_id", "piece", "start", "text_start", "text_end", "in_loss", "fault")

    def run(batches):
        def rows():
            for conv, group in groupby(_rows(batches, columns, "piece"), key=lambda r: r[0]):
                so_far = _Reading()
                for _, piece, start, text_start, text_end, in_loss, fault in group:
                    role, text = read(piece)
                    so_far.turns += 1
                    so_far.chars += len(piece)
                    so_far.turns_hash.update(f"{role}\n{text}\n".encode())
                    so_far.fault = so_far.fault or fault
                    if in_loss:
                        learned = undo(piece[text_start - start:text_end - start])
                        so_far.loss_chars += len(learned)
                        so_far.loss_hash.update(learned.encode())
                yield (conv, so_far.turns, so_far.turns_hash.hexdigest(), so_far.loss_chars, so_far.loss_hash.hexdigest(),
                       so_far.chars, so_far.fault)
        yield from _batches(rows(), _READ, lambda r: 256)

    return formatted.select(*columns).mapInArrow(run, _READ_DDL)
