"""Chat formatting with a grammar round trip.

A conversation is rendered as marked turns::

    <|im_start|>ROLE\\n TEXT <|im_end|>\\n      (without the spaces)

``parse`` is a deterministic parser of that grammar. A turn is first rendered
as it is; if the parser does not give exactly the source turn back, the
conflicting control strings in it are escaped, until it does. Escaping is
reversible: ``<|`` followed by bars becomes ``<|`` with one more bar, which no
mark has, and the parser takes that bar away again.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

from creditloom.llm.workers import map_batches

START, END = "<|im_start|>", "<|im_end|>"
ESCAPED_FLAG = "<|im_start||>"  # opens a turn whose role and text are escaped
_CONFLICT = re.compile(r"<\|(?=\|*im_(?:start|end)\|)")
_ESCAPED = re.compile(r"<\|\|(?=\|*im_(?:start|end)\|)")
_LINE = {"\\": "\\\\", "\n": "\\n"}


def _escape(text):
    return _CONFLICT.sub("<||", text)


def _unescape(text):
    return _ESCAPED.sub("<|", text)


def parse(rendered):
    """The turns of a rendered text as (role, text, start, end); start and end bound the text inside ``rendered``.

    Raises ``ValueError`` where the text does not follow the grammar.
    """
    turns, at = [], 0
    while at < len(rendered):
        escaped = rendered.startswith(ESCAPED_FLAG, at)
        if not escaped and not rendered.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        at += len(ESCAPED_FLAG if escaped else START)
        line = rendered.find("\n", at)
        end = rendered.find(END + "\n", line + 1)
        if line < 0 or end < 0:
            raise ValueError(f"the turn at {at} does not end")
        role, text = rendered[at:line], rendered[line + 1:end]
        if START in role or END in role or START in text or END in text:
            raise ValueError(f"a mark inside the turn at {at}")
        if escaped:
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], _unescape(role), flags=re.S)
            text = _unescape(text)
        turns.append((role, text, line + 1, end))
        at = end + len(END) + 1
    return turns


def _reads_back(rendered, role, text):
    try:
        return [t[:2] for t in parse(rendered)] == [(role, text)]
    except ValueError:
        return False


def render_turn(role, text):
    """One turn in the template; plain if that reads back as the source, else escaped."""
    rendered = f"{START}{role}\n{text}{END}\n"
    if not _reads_back(rendered, role, text):
        safe = _escape("".join(_LINE.get(c, c) for c in role))
        rendered = f"{ESCAPED_FLAG}{safe}\n{_escape(text)}{END}\n"
        if not _reads_back(rendered, role, text):
            raise ValueError("a turn cannot be rendered reversibly")
    return rendered


_RENDERED = "conv_id bigint, turn bigint, role string, rendered string, loss boolean"


def format_turns(conversations, conv="conv_id", turn="turn", role="role", text="text", learn=("assistant",)):
    """One row per turn: conv_id, turn, role, ``rendered`` (its part of the formatted conversation) and ``loss``.

    The formatted conversation is the parts of its turns in order, with nothing
    between; every part is closed by its end mark, so parsing the parts one by
    one equals parsing the whole. ``loss`` tells that the text inside the part
    is under the loss mask.

    NULL roles and texts count as empty. Rows of one conversation are ordered by
    turn (NULL first), then role, then part, so ties and repeated rows have a
    defined order; all rows stay. Other columns are ignored.
    """
    learn = set(learn)

    def rendered(batches):
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([render_turn(r, t) for r, t in zip(roles, texts)], pa.string()),
                 pa.array([r in learn for r in roles], pa.bool_())],
                names=["conv_id", "turn", "role", "rendered", "loss"],
            )

    source = conversations.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return map_batches(source, rendered, _RENDERED)


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


class _Reader:
    """What is read back from the parts of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered, loss):
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if loss:
                self.loss_chars += len(text)
                self.learned.update(text.encode())

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars)


def digest_formatted(formatted):
    """Per conversation, read back from ``format_turns``'s parts: turn count, digests, loss and total characters.

    Parts are brought together by conversation and streamed in order, one
    running digest at a time, so memory does not grow with a conversation. A
    digest is sequential by nature: the parts of one conversation pass one task.
    Rows with a NULL conv_id form one conversation.
    """
    names = [f.split()[0] for f in _DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def read(batches):
        open_one, done = None, []
        for batch in batches:
            for conv_id, rendered, loss in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if open_one is None or open_one.conv_id != conv_id:
                    if open_one:
                        done.append(open_one.row())
                    open_one = _Reader(conv_id)
                open_one.add(rendered, loss)
            if len(done) >= 5000:
                yield packed(done)
                done = []
        if open_one:
            done.append(open_one.row())
        if done:
            yield packed(done)

    # The parts order like the turns they were made from, so the same order is restored from role and part.
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "rendered")
    return map_batches(ordered.select("conv_id", "rendered", "loss"), read, _DIGEST)
