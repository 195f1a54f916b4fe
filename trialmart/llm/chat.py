"""Chat formatting by black-box rendering of growing turn prefixes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A template renders turns (role, text); `first` is the place of the first one given in the
#: conversation, so that a header is rendered only at its start.
Template = Callable[[list[tuple[str, str]], int], str]

# Control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[/ROLE]", "[/TURN]")
_CONTROL = "|".join(map(re.escape, CONTROLS))
_BARE = re.compile(rf"(\\*)({_CONTROL})")


def escape(text: str) -> str:
    """Marks control strings in a text: backslashes before one are doubled and one is added."""
    return _BARE.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str) -> str:
    return _BARE.sub(lambda m: m[1][: (len(m[1]) - 1) // 2] + m[2], text)


def instruct_template(turns: list[tuple[str, str]], first: int = 0) -> str:
    """User, assistant and other turns between control strings, one space on either side of a text."""
    parts = ["<s>"] if first == 0 else []
    for role, text in turns:
        if role == "user":
            parts.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            parts.append(f"[ANS] {escape(text)} </s>")
        else:
            parts.append(f"[ROLE] {escape(role)} [/ROLE] {escape(text)} [/TURN]")
    return "".join(parts)


_TURN = re.compile(
    r"(?:<s>)?(?:\[INST\] (?P<user>.*) \[/INST\]|\[ANS\] (?P<assistant>.*) </s>"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*) \[/TURN\])",
    re.DOTALL,
)


def read_turn(piece: str) -> tuple[str, str, int, int]:
    """Role and text of one rendered turn, and where its escaped text stands in the piece.

    A control string inside a role or text has a backslash before it, so the first ` [/ROLE] ` without
    one ends the role.
    """
    found = _TURN.fullmatch(piece)
    if found is None:
        raise ValueError("a rendered turn cannot be read back")
    kind = next(k for k in ("user", "assistant", "other") if found[k] is not None)
    role = unescape(found["role"]) if kind == "other" else kind
    return role, unescape(found[kind]), *found.span(kind)


@dataclass
class Rendered:
    """A turn's span in the output, what was added there, and whether history was rewritten."""

    start: int
    piece: str
    rewritten: bool


class Renderer:
    """Feeds turns to a template one by one and compares consecutive outputs.

    A template that only appends gives an output that begins with the one before; the rest is the
    turn's piece. If it does not, the template rewrites history: the turn is marked, and its piece is what
    follows the common beginning. Every prefix of the conversation is rendered whole, however long it
    is, since any turn may change any earlier output; time grows with the square of the turns.
    """

    def __init__(self, template: Template):
        self.template = template
        self.turns: list[tuple[str, str]] = []
        self.output = ""

    def add(self, role: str, text: str) -> Rendered:
        self.turns.append((role, text))
        output = self.template(self.turns, 0)
        same = len(self.output)
        rewritten = not output.startswith(self.output)
        if rewritten:
            same = next((i for i, (a, b) in enumerate(zip(output, self.output, strict=False)) if a != b), min(same, len(output)))
        self.output = output
        return Rendered(same, output[same:], rewritten)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation side by side in one partition, in order of turn, role and text."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


_PIECES = "conv_id long, at long, role string, start long, piece string, text_start long, text_end long, loss boolean, rewritten boolean"


def format_turns(conversations: DataFrame, template: Template = instruct_template, read=read_turn) -> DataFrame:
    """One row per turn, in order within each conversation: its piece of the output and span.

    conversations: conv_id, turn, role, text. Turns are ordered by turn (null first), then role and
    text; equal rows are turns of their own. A null role or text is empty; rows without conv_id
    are one conversation. `start` is the code point at which the piece stands in the output;
    text_start and text_end bound the escaped text inside the piece, and loss marks the
    assistant's, which a loss mask covers. `rewritten` marks turns at which the template changed what it
    had written; then spans of earlier turns do not hold. Other columns are ignored.

    Turns of one conversation meet in one task, which holds them and the output so far.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, renderer, at = object(), None, 0
        for batch in batches:
            rows = {k: [] for k in ("conv_id", "at", "role", "start", "piece", "text_start", "text_end", "loss", "rewritten")}
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if conv != current:
                    current, renderer, at = conv, Renderer(template), 0
                done = renderer.add(role, text)
                a = b = None
                if not done.rewritten:
                    role, _, a, b = read(done.piece)
                values = (conv, at, role, done.start, done.piece, a, b, role == "assistant", done.rewritten)
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
                at += 1
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_pydict(rows, pa.schema(list(zip(rows, kinds, strict=True))))

    return _ordered(conversations).mapInArrow(run, _PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from the rendered pieces of its turns.

    n_turns and turns_sha256 (role and text, each followed by a line end) cover all turns; loss_chars
    and loss_sha256 the unescaped text under the loss mask; formatted_chars the output. Where the template
    rewrote a turn, pieces do not add up to the output: rewritten is true, and the digests and loss_chars are null. The rows
    of a conversation must be together and in order, as format_turns leaves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            columns = (batch.column(k).to_pylist() for k in ("conv_id", "piece", "start", "text_start", "text_end", "loss", "rewritten"))
            for conv, piece, start, a, b, loss, rewritten in zip(*columns, strict=True):
                if held is None or held[0] != conv:
                    if held is not None:
                        rows.append(held)
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                held[1] += 1
                held[5] = start + len(piece)
                held[6] |= rewritten
                if held[6]:
                    continue
                role, text, _, _ = read_turn(piece)
                held[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if loss:
                    masked = unescape(piece[a:b])
                    held[3] += len(masked)
                    held[4].update(masked.encode("utf-8", "surrogatepass"))
            if rows:
                yield _digests(rows)
        if held is not None:
            yield _digests([held])

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean"
    return pieces.mapInArrow(run, kinds)


def _digests(rows: list[list]) -> pa.RecordBatch:
    convs, turns, texts, chars, masked, formatted, rewritten = zip(*rows, strict=True)

    def known(values: list, kind: pa.DataType) -> pa.Array:
        return pa.array([None if gone else v for v, gone in zip(values, rewritten, strict=True)], kind)

    columns = {
        "conv_id": pa.array(convs, pa.int64()),
        "n_turns": pa.array(turns, pa.int64()),
        "turns_sha256": known([h.hexdigest() for h in texts], pa.string()),
        "loss_chars": known(chars, pa.int64()),
        "loss_sha256": known([h.hexdigest() for h in masked], pa.string()),
        "formatted_chars": pa.array(formatted, pa.int64()),
        "rewritten": pa.array(rewritten, pa.bool_()),
    }
    return pa.RecordBatch.from_pydict(columns)
