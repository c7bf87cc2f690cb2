"""Conversation structure repair by lightest derivations.

The role initials of a repaired conversation match ``(s?(ua)+)?``: nothing, or an
optional system turn and then pairs of a user and an assistant turn. Turns are
kept, given another role or deleted, and empty ones inserted; each edit has a
cost. A repair item [i, state] says that the first i turns are dealt with and the
written roles lead to ``state``; an edit is a deduction from one item to another.
Knuth's agenda pops the item with the least (cost, audit), where the audit spells
the edits. A deduction only adds cost and letters, so it is superior: no popped
item can get lighter later, and the search ends when the goals are popped.

A long conversation is cut into blocks. A block's derivations between any two
states are found apart from the other blocks, and a pass over the blocks, one
short row each, links them.
"""

import functools
import hashlib
import heapq
import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch, small
from creditloom.llm.workers import map_batches

BLOCK_ROWS = 256
BLOCK_CHARS = 1 << 20

# Costs of the edits, and what an undeleted truncated turn adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing written, after the system turn, after a user turn, after an assistant turn.
_STATES = range(4)
_ACCEPTED = (0, 3)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_LEGAL = ("su", "ua", "au")
# From any state, the edits of any other state's continuation are matched for this much more: two
# insertions, and deleting a system turn the other one keeps. A prefix dearer by more is never used.
_LAG = 2 * INSERT + DELETE

SOUND, CUT_OFF, BLANK, REPEATED = range(4)


def _written(state):
    """The role that an inserted or renamed turn must have in ``state``."""
    return "assistant" if state == 2 else "user"


def _deductions(turns, i, state):
    """(cost, letter, turns dealt with, state) of every edit that applies to the item [i, state]."""
    other = _NEXT[state, _written(state)[0]]
    yield INSERT, "I", i, other
    if i < len(turns):
        initial, fault = turns[i]
        yield DELETE, "D", i + 1, state
        if fault in (SOUND, CUT_OFF):
            added = TRUNCATED if fault == CUT_OFF else 0
            yield REROLE + added, "R", i + 1, other
            if (state, initial) in _NEXT:
                yield KEEP + added, "K", i + 1, _NEXT[state, initial]


@functools.lru_cache(4096)
def lightest(turns, start):
    """{state: (cost, audit)} of the lightest derivations over all of ``turns`` from ``start``.

    ``turns``: a tuple of (role initial, fault). Of equally cheap ones the audit that is least in ASCII order counts.
    """
    final, goals = {}, {}
    agenda = [(0, "", 0, start)]
    while agenda and len(goals) < len(_STATES):
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = True
        if i == len(turns):
            goals[state] = cost, audit
        for weight, letter, j, to in _deductions(turns, i, state):
            if (j, to) not in final:
                heapq.heappush(agenda, (cost + weight, audit + letter, j, to))
    return goals


def apply_audit(turns, state, audit):
    """(place of the turn or None, new role or None, letter) of each written turn, from ``state`` on."""
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        role = None if letter == "K" else _written(state)
        out.append((None if letter == "I" else i, role, letter))
        state = _NEXT[state, role[0] if role else turns[i][0]]
        i += letter != "I"
    return out


# Diagnosis

def diagnose(turns, scratch, conv="conv_id", turn="turn", role="role", text="text", present=None):
    """The turns with ``fault``: the first that holds of blank, repeated, cut off; in no order.

    Blank: no character but white space. Repeated: role and text were there earlier in the conversation.
    Cut off: the last character that is no white space is not one of ``.!?``.
    """
    rows = scratch.keep(turns.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"),
        F.monotonically_increasing_id().alias("row"),
    ), "turns")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # The rows that come first with their role and text; row ids are unique, so no hot key meets in the join.
    firsts = rows.where(F.col("present") & ~blank).groupBy("conv_id", "role", F.sha2("text", 256)).agg(
        F.min(F.struct("turn", "row"))["row"].alias("row")
    ).select("row", F.lit(True).alias("first"))
    fault = (
        F.when(blank, BLANK).when(F.col("first").isNull(), REPEATED)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF).otherwise(SOUND)
    )
    return rows.join(firsts, "row", "left").withColumn("fault", fault.cast("int")).drop("first")


_BLOCK = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()),
    ("froms", pa.list_(pa.int32())), ("tos", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string())),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.list_(pa.int32())),
])
_BLOCK_DDL = (
    "conv_id bigint, part int, block bigint, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first string, last string, froms array<int>, tos array<int>, "
    "costs array<bigint>, audits array<string>, roles array<string>, texts array<string>, faults array<int>"
)


class _Block:
    """Consecutive turns of one conversation."""

    def __init__(self, conv_id, starts):
        self.conv_id, self.starts = conv_id, starts
        self.turns, self.roles, self.texts, self.faults, self.chars = [], [], [], [], 0

    def add(self, turn, role, text, present, fault):
        if present:
            self.turns.append(turn)
            self.roles.append(role)
            self.texts.append(text)
            self.faults.append(fault)
            self.chars += len(text)

    def full(self):
        return len(self.turns) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def row(self, part, number):
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        found = tuple(zip(initials, self.faults))
        ways = [(p, q, *way) for p in self.starts for q, way in lightest(found, p).items()]
        froms, tos, costs, audits = zip(*ways)
        return {
            "conv_id": self.conv_id, "part": part, "block": number,
            "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
            "blank": self.faults.count(BLANK), "duplicate": self.faults.count(REPEATED),
            "truncated": self.faults.count(CUT_OFF),
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
            "froms": froms, "tos": tos, "costs": costs, "audits": audits,
            "roles": self.roles, "texts": self.texts, "faults": self.faults,
        }


def _blocks(batches):
    """Blocks of a run of ordered turns, each with its derivations between states.

    Only a run's first conversation may have begun earlier; elsewhere a conversation's first block starts from nothing.
    """
    part, number, block, done, held = TaskContext.get().partitionId(), 0, None, [], 0
    for batch in batches:
        for conv_id, *turn in zip(*(c.to_pylist() for c in batch.columns)):
            if block is None or block.conv_id != conv_id or block.full():
                begun = block is None or block.conv_id == conv_id
                if block is not None:
                    done.append(block.row(part, number))
                    number, held = number + 1, held + block.chars + len(block.turns)
                block = _Block(conv_id, tuple(_STATES) if begun else (0,))
            block.add(*turn)
            if len(done) >= 2000 or held >= 8 * BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(done, schema=_BLOCK)
                done, held = [], 0
    if block is not None:
        done.append(block.row(part, number))
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_BLOCK)


# Linking the blocks

_PATH = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("state", pa.int32()), ("to", pa.int32()), ("report", pa.bool_()),
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
])
_PATH_DDL = (
    "part int, block bigint, state int, to int, report boolean, conv_id bigint, gaps bigint, blank bigint, "
    "duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
_REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


class _Linked:
    """The lightest prefix of a conversation per state, over the blocks seen."""

    def __init__(self, conv_id):
        self.conv_id, self.seen, self.back, self.settled = conv_id, [], [], []
        self.best = {0: (0, "")}
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, b):
        self.seen.append((b["part"], b["block"]))
        best, back = {}, {}
        for p, q, cost, audit in zip(b["froms"], b["tos"], b["costs"], b["audits"]):
            if p in self.best:
                way = self.best[p][0] + cost, self.best[p][1] + audit
                if q not in best or way < best[q]:
                    best[q], back[q] = way, p
        least = min(cost for cost, _ in best.values())
        best = {q: way for q, way in best.items() if way[0] <= least + _LAG}
        # What all of them begin with is settled, so that the audits carried along stay short.
        shared = len(os.path.commonprefix([audit for _, audit in best.values()]))
        self.settled.append(next(iter(best.values()))[1][:shared])
        self.best = {q: (cost, audit[shared:]) for q, (cost, audit) in best.items()}
        self.back.append(back)
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + b[name])
        if self.last is not None and b["first"] is not None:
            self.illegal += self.last + b["first"] not in _LEGAL
        self.last = self.last if b["last"] is None else b["last"]
        if b["turns"]:
            # turns ascend, so two blocks can share one turn at most
            self.turns += b["turns"] - (self.high is not None and self.high == b["low"])
            self.low, self.high = b["low"] if self.low is None else self.low, b["high"]

    def rows(self):
        cost, audit, state = min((*self.best[q], q) for q in _ACCEPTED if q in self.best)
        audit = "".join(self.settled) + audit
        for k in range(len(self.seen) - 1, -1, -1):
            before = self.back[k][state]
            yield {"part": self.seen[k][0], "block": self.seen[k][1], "state": before, "to": state, "report": False}
            state = before
        yield {
            "report": True, "conv_id": self.conv_id, "cost": cost, "audit": audit,
            "gaps": self.high - self.low + 1 - self.turns if self.turns else 0,
            **{n: getattr(self, n) for n in ("blank", "duplicate", "truncated", "illegal")},
        }


def _linked(batches):
    """Chosen states of every block and a report for every conversation, from blocks in order."""
    conversation, out = None, []
    for batch in batches:
        for block in batch.to_pylist():
            if conversation is None or conversation.conv_id != block["conv_id"]:
                if conversation is not None:
                    out.extend(conversation.rows())
                conversation = _Linked(block["conv_id"])
            conversation.add(block)
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=_PATH)
                out = []
    if conversation is not None:
        out.extend(conversation.rows())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PATH)


_TURN = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("place", pa.int32()),
    ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
])


def _rewritten(batches):
    """The turns of repaired blocks."""
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            turns = tuple((r[:1], f) for r, f in zip(b["roles"], b["faults"]))
            audit = lightest(turns, b["state"])[b["to"]][1]
            for place, (i, role, letter) in enumerate(apply_audit(turns, b["state"], audit)):
                out.append({
                    "conv_id": b["conv_id"], "part": b["part"], "block": b["block"], "place": place, "edit": letter,
                    "role": b["roles"][i] if role is None else role, "text": "" if i is None else b["texts"][i],
                })
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=_TURN)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_TURN)


def repair_conversations(turns, conv="conv_id", turn="turn", role="role", text="text", present=None):
    """Two tables: a report for every conversation, and the repaired turns.

    The report has conv_id, ``gaps`` (turn numbers missing between the least and the greatest), the counts ``blank``,
    ``duplicate`` and ``truncated`` (each turn counts for its first fault), ``illegal`` (neighbours whose role
    initials are not su, ua or au), ``cost`` and ``audit`` (the initials of keep, rerole, delete and insert in order).
    The repaired turns have conv_id, role, text, ``edit``, and (``part``, ``block``, ``place``), their order.

    Turns are taken by turn number, NULL first, equal ones by role, then text; repeated rows stay and are repeated
    turns. NULL roles and texts count as empty; an empty role has no initial and is never kept. Rows without conv_id
    form one conversation. ``present`` names a boolean column: rows where it is not true name their conversation but
    are no turns, so a conversation of only such rows is reported, with zeros. Other columns are not read.

    Turns are ordered by ranges and cut into blocks, so a conversation of any length is diagnosed and derived in
    many tasks. Its blocks, without texts, pass one task in order, which keeps four prefixes and four small numbers a block.
    """
    scratch = Scratch(turns.sparkSession, "repair")
    order = ["conv_id", "turn", "role", "text", "row"]
    faulty = diagnose(turns, scratch, conv, turn, role, text, present)
    ordered = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = scratch.keep(map_batches(
        ordered.select("conv_id", "turn", "role", "text", "present", "fault"), _blocks, _BLOCK_DDL
    ), "blocks")
    scratch.drop("turns")
    short = blocks.drop("roles", "texts", "faults")
    paths = scratch.keep(map_batches(
        short.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block"), _linked, _PATH_DDL
    ), "paths")
    chosen = small(paths.where("NOT report").select("part", "block", "state", "to"))
    repaired = map_batches(
        blocks.select("conv_id", "part", "block", "roles", "texts", "faults").join(chosen, ["part", "block"]),
        _rewritten, "conv_id bigint, part int, block bigint, place int, edit string, role string, text string",
    )
    return paths.where("report").select(*_REPORT), repaired


def digest_turns(repaired):
    """conv_id and ``repaired_sha256`` (lowercase hex) of the turns of each conversation as ``role:text`` lines.

    Turns are streamed in order, one running digest at a time. A digest is sequential by nature: the repaired turns
    of one conversation pass one task.
    """
    def digested(batches):
        open_one, digest, done = None, None, []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if digest is None or open_one != conv_id:
                    if digest is not None:
                        done.append((open_one, digest.hexdigest()))
                    open_one, digest = conv_id, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    digest.update(f"\n{role}:{text}".encode())
            if len(done) >= 5000:
                yield packed(done)
                done = []
        if digest is not None:
            done.append((open_one, digest.hexdigest()))
        if done:
            yield packed(done)

    def packed(rows):
        ids, digests = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests)], ["conv_id", "repaired_sha256"])

    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")
    return map_batches(ordered.select("conv_id", "role", "text"), digested, "conv_id bigint, repaired_sha256 string")
