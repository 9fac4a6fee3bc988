"""Repair of conversations: against a plain search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import cache

from quayside.llm import turn_repair
from quayside.llm.turn_repair import BLANK, DUPLICATE, SOUND, TRUNCATED

sys.setrecursionlimit(20_000)  # for the plain search
TURNS = "conv_id bigint, turn bigint, role string, text string"
ORDER = re.compile("(s?(ua)+)?")


def plain(initials, faults):
    """Least (cost, audit) of a table filled from the last row to the first."""

    @cache
    def least(i, state, inserts):
        ways = [(0, "")] if i == len(faults) and state in (0, 3) else []
        turn = "uuau"[state]

        def goes(edit, cost, i, state, inserts=0):
            rest = least(i, state, inserts)
            if rest:
                ways.append((cost + rest[0], edit + rest[1]))

        if inserts < 3:
            goes("I", 2, i, 3 if turn == "a" else 2, inserts + 1)
        if i < len(faults):
            goes("D", 3, i + 1, state)
            if faults[i] not in (BLANK, DUPLICATE):
                cut = faults[i] == TRUNCATED
                if initials[i] == turn or (initials[i] == "s" and state == 0):
                    goes("K", cut, i + 1, {"s": 1, "u": 2, "a": 3}[initials[i]])
                goes("R", 2 + cut, i + 1, 3 if turn == "a" else 2)
        return min(ways, default=None)

    return least(0, 0, 0)


def test_costs_and_audits_of_random_conversations():
    pick = random.Random(3)
    for n in [0, 1, 2, 3, *[pick.randrange(1, 14) for _ in range(1500)], 60, 90]:
        initials = "".join(pick.choices("suax", [1, 4, 4, 1], k=n))
        faults = bytes(pick.choices([SOUND, BLANK, DUPLICATE, TRUNCATED], [6, 1, 1, 2], k=n))
        cost, audit = turn_repair.cheapest(turn_repair.Lattice(initials, faults))
        assert (cost, audit) == plain(initials, faults), (initials, faults)
        roles = [r[0] if r else initials[i] for i, r in turn_repair.repaired_roles(audit, initials)]
        assert ORDER.fullmatch("".join(roles))


def test_a_conversation_of_very_many_turns():
    n = 50_001
    initials = ("uau" * n)[:n]
    cost, audit = turn_repair.cheapest(turn_repair.Lattice(initials, bytes(n)))
    assert cost == plain_cost(initials) and len(audit) >= n


def plain_cost(initials):
    far = 10**9
    costs = [0, far, 2, 4]
    for c in initials:
        new = [x + 3 for x in costs]
        for q, (turn, to) in enumerate((("u", 2), ("u", 2), ("a", 3), ("u", 2))):
            new[to] = min(new[to], costs[q] + (0 if c == turn else 2))
        if c == "s":
            new[1] = min(new[1], costs[0])
        costs = [new[0], new[1], min(new[2], new[0] + 2, new[1] + 2, new[3] + 2), 0]
        costs[3] = min(new[3], costs[2] + 2)
    return min(costs[0], costs[3])


def slow(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        kept = convs.setdefault(conv_id, [])
        kept += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = []
    for conv_id, kept in convs.items():
        kept.sort()
        faults, seen = [], set()
        for _, _, role, text in kept:
            body = text.strip(" \t\n\x0b\x0c\r")
            repeated, cut = (role, text) in seen, body and body[-1] not in ".!?"
            faults.append(BLANK if not body else DUPLICATE if repeated else TRUNCATED if cut else SOUND)
            seen.add((role, text))
        initials = "".join(role[:1] or " " for _, _, role, _ in kept)
        turns = {t for known, t, _, _ in kept if known}
        cost, audit = plain(initials, bytes(faults))
        lines, row, state = [], 0, 0
        for edit in audit:
            if edit in "IR":
                role = "assistant" if state == 2 else "user"
            if edit == "I":
                lines.append(f"{role}:")
            elif edit != "D":
                lines.append(f"{role if edit == 'R' else kept[row][2]}:{kept[row][3]}")
            if edit != "D":
                state = {"s": 1, "u": 2, "a": 3}[lines[-1][0]]
            row += edit != "I"
        found.append(
            (
                conv_id,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                faults.count(BLANK),
                faults.count(DUPLICATE),
                faults.count(TRUNCATED),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def answers(turns):
    found = turn_repair.repair(turn_repair.damaged(turns))
    assert found.columns == ["conv_id", *turn_repair.FIELDS, "audit", "repaired_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_random_tables_with_nulls_ties_and_repeated_rows(spark):
    pick = random.Random(11)
    roles = ["user", "assistant", "system", "admin", "", None]
    texts = ["Well. ", "well", "", None, " \t", "\n", "a?\x0b", "é!", " ", "same."]
    rows = []
    for c in [None, *range(-40, 260)]:
        for t in range(pick.randrange(1, 9)):
            turn = None if pick.random() < 0.1 else pick.choice([t, t, t, t * 5, 2])
            rows.append((c, turn, pick.choices(roles, [6, 6, 2, 1, 1, 1])[0], pick.choice(texts) if t else f"own {c}."))
    rows += rows[:40]
    assert answers(spark.createDataFrame(rows, TURNS).repartition(5)) == slow(rows)


def test_long_conversations_long_texts_and_other_columns(spark):
    rows = [(1, t, "ua"[t % 2 :][:1] + "x", f"turn {t}.") for t in range(400)]
    rows += [(2, t, "user", "word " * 100_000 + ".") for t in range(3)]
    turns = spark.createDataFrame(rows, TURNS).selectExpr(
        "conv_id", "turn", "role", "text", "1 AS kind", "2 AS lost", "3 AS copy", "4 AS place", "5 AS plan", "6 AS `a.b`"
    )
    assert answers(turns) == slow(rows)


def test_an_empty_table_and_lost_conversations(spark):
    assert answers(spark.createDataFrame([], TURNS)) == []
    lost = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    found = answers(spark.createDataFrame(lost, TURNS))
    assert lost and found == slow(lost)
    assert {r[1:] for r in found} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_turns_at_the_ends_of_the_range(spark):
    rows = [(5, -(1 << 63), "user", "a."), (5, (1 << 63) - 1, "assistant", "b.")]
    assert len(answers(spark.createDataFrame(rows, TURNS))) == 1
