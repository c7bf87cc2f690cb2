"""Conversation repair against plain loops: an exhaustive search over edits, and the whole test table."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from creditloom.llm import queries, repair

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile("(s?(ua)+)?")


def diagnosed(rows):
    """Faults of (role, text) rows in order."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows):
    """Cost, audit and lines by a table over (row, state), written apart from the operator; audits compared whole."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def insertions(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for i in set(step[state]) - {"s"}:
                    way = cost + 3, audit + "I", (*lines, full[i] + ":")
                    if i not in best or way[:2] < best[i][:2]:
                        best[i] = way
        return best

    for (role, text), fault in zip(rows, diagnosed(rows)):
        new = {}

        def offer(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, lines) in insertions(best).items():
            offer(state, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in step[state]:
                    offer(role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for i in set(step[state]) - {"s"}:
                    offer(i, (cost + 3 + more, audit + "R", (*lines, f"{full[i]}:{text}")))
        best = new
    best = insertions(best)
    return min(best[s] for s in ("", "a") if s in best)


def wanted(turns):
    """The row of a conversation from (turn, role, text) rows after damage, in order."""
    rows = [(r, t) for _, r, t in turns]
    faults = collections.Counter(diagnosed(rows))
    initials = [r[:1] for r, _ in rows]
    numbers = {t for t, _, _ in turns if t is not None}
    cost, audit, lines = repaired(rows)
    assert LEGAL.fullmatch("".join(x[0] for x in lines))
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        faults["blank"], faults["duplicate"], faults["truncated"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def result(report, turns):
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digest_turns(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*r[1:], digests.get(r.conv_id, empty)) for r in report.collect()}


def in_order(rows):
    """{conv_id: [(turn, role, text)]}, by turn with NULL first, then role and text."""
    out = collections.defaultdict(list)
    for conv, *turn in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out[conv].append((turn[0], turn[1] or "", turn[2] or ""))
    return out


@pytest.mark.parametrize("turns", [t for n in range(4) for t in itertools.product(
    itertools.product("suax", (repair.SOUND, repair.CUT_OFF, repair.REPEATED)), repeat=n)][::7])
def test_lightest_equals_all_repairs(turns):
    """Every string of edits with up to four insertions."""
    found = {}

    def search(i, written, cost, audit, inserted):
        if i == len(turns) and LEGAL.fullmatch(written):
            found[cost, audit] = True
        if cost > 4 * len(turns):
            return
        if inserted < 4:
            for role in "ua":
                search(i, written + role, cost + 3, audit + "I", inserted + 1)
        if i < len(turns):
            initial, fault = turns[i]
            search(i + 1, written, cost + 4, audit + "D", inserted)
            if fault != repair.REPEATED:
                more = 3 * (fault == repair.CUT_OFF)
                search(i + 1, written + initial, cost + more, audit + "K", inserted)
                for role in "ua":
                    search(i + 1, written + role, cost + 3 + more, audit + "R", inserted)

    search(0, "", 0, "", 0)
    goals = repair.lightest(turns, 0)
    assert min(goals[q] for q in (0, 3) if q in goals) == min(found)


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "hello."), (1, 1, "assistant", "yes."), (1, 1, "assistant", "yes."), (1, 4, "user", "cut"),
        (2, None, "system", "be good."), (2, None, None, None), (2, 5, "tool", "x!"), (None, 1, "user", "a."),
        (None, None, "assistant", "b."), (3, 1, "", "no role."), (4, 2, "user", " \n\t"), (5, 0, "system", "alone."),
        (6, 3, "user", "z" * 300_000 + "."), (6, 4, "umpire", "q."), (7, 9, "assistant", "dot in x.\x0b  "),
    ]
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS audit", "1 AS part", "'y' AS present")
    assert result(*repair.repair_conversations(table)) == {c: wanted(t) for c, t in in_order(rows).items()}


def test_no_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    report, turns = repair.repair_conversations(empty)
    assert not report.count() and not turns.count()


def test_long_conversations_are_derived_in_blocks(spark, monkeypatch):
    """Blocks of seven turns, in many ranges, give what one block gives."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", 7)
    r = random.Random(4)
    rows = [
        (conv, r.randrange(n), r.choice(["user", "assistant", "assistant", "system", "odd"]),
         r.choice(["", f"t{r.random()}.", f"t{r.random()}.", "again.", f"cut {r.random()}"]))
        for conv, n in ((1, 600), (2, 9), (3, 60), (4, 1)) for _ in range(n)
    ]
    rows += [(5, i, "user" if i % 2 == 0 else "assistant", f"fine {i}.") for i in range(100)]
    rows += [(6, 0, "user", "same.")] * 100
    table = spark.createDataFrame(rows, TURNS).repartition(5)
    assert result(*repair.repair_conversations(table)) == {c: wanted(t) for c, t in in_order(rows).items()}


def test_query(spark):
    kept = collections.defaultdict(list)
    for conv, turn, role, text in sorted(spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()):
        draw = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        kept[conv]
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
        if draw:
            kept[conv].extend([(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1))
    df = queries.op11_repair_conversations(spark, FOLDER)
    assert {r.conv_id: tuple(r[1:]) for r in df.collect()} == {c: wanted(t) for c, t in kept.items()}
    assert [k for _, k in df.dtypes] == ["bigint"] * 7 + ["string"] * 2
