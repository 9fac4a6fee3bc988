"""Conversations brought into order by the cheapest edits.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``: nothing, or
one system turn at most, then pairs of user and assistant.  A turn can be kept (0), get the
role user or assistant (2) or be deleted (3, required for blank and repeated turns); an empty
turn of user or assistant can be inserted anywhere (2); a truncated turn that stays adds 1.
The audit is the edits' initials D, I, K and R in order; of the cheapest ways that with the
ASCII-least audit is taken.

Rows and role states span a lattice, and its cheapest paths are found by Dijkstra's method
from both ends: a heap goes forward from the start, another backward from the accepted ends,
until no path through what is left can be as cheap as the best one.  Every cheapest path then
has a node that both have reached at its full cost, a crossing.  The audit is read off by
walking from the start along edges that lead to a crossing or on from one, always by the
least edit.  No audit of equal cost through a node is the beginning of another (the longer
one has only more insertions, and they cost), so the least edit at each step is the least
audit of all.

A row's first fault counts: blank (nothing but ASCII white space), duplicate (an earlier row
of the conversation has its role and text), truncated (the last character that is no white
space is none of ``.!?``).

Spark finds the faults, orders the rows and spreads them by conversation; a task reads one
conversation's faults and initials, a few bytes a row, and no texts.  The repaired texts are
then hashed in a stream of rows, each conversation behind its audit.  Null turns come first,
equal turns are ordered by role and text; rows with a null conv_id are one conversation.
Null roles and texts are one space.  Only conv_id, turn, role and text are read.  An empty
table gives no row.  Differences of turns beyond 64 bits wrap around.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.llm.line_dedup import BLANKS
from quayside.llm.turns import turn_digest, turn_key, with_ties
from quayside.session import cut_lineage

# Role states: nothing yet, after system, after user, after assistant; what each may take.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
EXPECTED = ("u", "u", "a", "u")  # of an inserted or renamed turn
NAMES = {"u": "user", "a": "assistant"}
DELETE, INSERT, RENAME, CUT = 3, 2, 2, 1

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

_FAR = 1 << 62


class Lattice:
    """Nodes are 4 * rows read + role state; edges are (edit, node, cost)."""

    def __init__(self, initials: str, faults: bytes):
        self.initials, self.faults = initials, faults
        self.rows = len(faults)
        self.goals = [4 * self.rows + state for state in ACCEPTED]

    def after(self, node: int) -> Iterator[tuple[str, int, int]]:
        i, state = divmod(node, 4)
        turn = EXPECTED[state]
        yield "I", 4 * i + NEXT[state][turn], INSERT
        if i < self.rows:
            yield "D", node + 4, DELETE
            fault = self.faults[i]
            if fault in (SOUND, TRUNCATED):
                extra = CUT * (fault == TRUNCATED)
                kept = NEXT[state].get(self.initials[i])
                if kept is not None:
                    yield "K", 4 * (i + 1) + kept, extra
                yield "R", 4 * (i + 1) + NEXT[state][turn], RENAME + extra

    def before(self, node: int) -> Iterator[tuple[int, int]]:
        """(node, cost) of the edges that lead here."""
        i, state = divmod(node, 4)
        for j in (i, i - 1):
            if j >= 0:
                for earlier in range(4 * j, 4 * j + 4):
                    for _, to, cost in self.after(earlier):
                        if to == node:
                            yield earlier, cost


def cheapest(lattice: Lattice) -> tuple[int, str]:
    """The least cost, and the ASCII-least audit of that cost."""
    size = 4 * lattice.rows + 4
    ahead, back = array("q", [_FAR]) * size, array("q", [_FAR]) * size
    ahead[0] = 0
    forward, backward = [(0, 0)], []
    for goal in lattice.goals:
        back[goal] = 0
        heappush(backward, (0, goal))
    best = min((back[0], *(ahead[g] for g in lattice.goals)))
    while forward and backward and forward[0][0] + backward[0][0] <= best:
        if forward[0][0] <= backward[0][0]:
            cost, node = heappop(forward)
            if cost > ahead[node]:
                continue
            for _, to, step in lattice.after(node):
                if cost + step < ahead[to]:
                    ahead[to] = cost + step
                    heappush(forward, (cost + step, to))
                    best = min(best, cost + step + back[to])
        else:
            cost, node = heappop(backward)
            if cost > back[node]:
                continue
            for earlier, step in lattice.before(node):
                if cost + step < back[earlier]:
                    back[earlier] = cost + step
                    heappush(backward, (cost + step, earlier))
                    best = min(best, cost + step + ahead[earlier])

    # Nodes before the crossings from which a crossing is reached at the full cost.
    leads = bytearray(size)
    todo = [node for node in range(size) if ahead[node] + back[node] == best]
    for node in todo:
        leads[node] = 1
    while todo:
        node = todo.pop()
        for earlier, step in lattice.before(node):
            if not leads[earlier] and ahead[earlier] + step == ahead[node]:
                leads[earlier] = 1
                todo.append(earlier)

    audit: list[str] = []
    at = {0: False}  # whether a crossing lies behind, so that the way back is known to be exact
    while not any(node in lattice.goals for node in at):
        options: dict[str, dict[int, bool]] = {}
        for node, crossed in at.items():
            crossed = crossed or ahead[node] + back[node] == best
            for edit, to, step in lattice.after(node):
                onward = crossed and back[node] == step + back[to]
                if onward or (leads[to] and ahead[node] + step == ahead[to]):
                    to_all = options.setdefault(edit, {})
                    to_all[to] = to_all.get(to, False) or onward
        edit = min(options)
        audit.append(edit)
        at = options[edit]
    return best, "".join(audit)


def repaired_roles(audit: str, initials: str) -> Iterator[tuple[int | None, str | None]]:
    """(row or None for an inserted turn, its new role or None if kept) of each turn that stays."""
    row = state = 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        turn = initials[row] if edit == "K" else EXPECTED[state]
        yield (None if edit == "I" else row), (None if edit == "K" else NAMES[turn])
        state = NEXT[state][turn]
        row += edit != "I"


# --- Spark


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with the faults that their checksum asks for; ``lost`` marks those that go."""
    kind = F.crc32(
        F.concat_ws(
            ":",
            F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
            F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
        ).cast("binary")
    ) % 20
    text = F.expr("CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END")
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        kind.alias("kind"),
    )
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("lost"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place in the conversation and what tells faults, written once."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    return cut_lineage(
        with_ties(rows).select(
            "conv_id",
            "turn",
            turn_key().alias("place"),
            "role",
            "text",
            "lost",
            turn_digest().alias("digest"),
            (body == "").alias("blank"),
            (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        )
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``; rows with one role and text meet by conversation, without their texts."""
    same = Window.partitionBy("conv_id", "lost", "role", "digest").orderBy("place")
    return rows.withColumn(
        "fault",
        F.when(F.col("blank"), BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(F.col("truncated"), TRUNCATED)
        .otherwise(SOUND),
    )


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN = pa.schema(
    [("conv_id", pa.int64())] + [(c, pa.int64()) for c in FIELDS] + [("audit", pa.string()), ("initials", pa.string())]
)
PLAN_DDL = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in FIELDS) + ", audit string, initials string"
LEGAL = ("su", "ua", "au")


class _Conversation:
    """What is known of the rows of one conversation read so far."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.initials.append(initial or " ")
        self.faults.append(fault)
        if turn is not None:
            self.turns += turn != self.last  # turns arrive in order
            self.first = turn if self.first is None else self.first
            self.last = turn

    def plan(self) -> dict:
        initials = "".join(self.initials)
        cost, audit = cheapest(Lattice(initials, bytes(self.faults)))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            "conv_id": self.conv_id,
            "gaps": (gaps + (1 << 63)) % (1 << 64) - (1 << 63),
            "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE),
            "truncated": self.faults.count(TRUNCATED),
            "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
            "cost": cost,
            "audit": audit,
            "initials": initials,
        }


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts, the least cost, the audit and its rows' initials."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            found = []
            for conv_id, turn, initial, fault, lost in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        found.append(now.plan())
                    now = _Conversation(conv_id)
                if not lost:
                    now.add(turn, initial, fault)
            if found:
                yield pa.RecordBatch.from_pylist(found, _PLAN)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.plan()], _PLAN)

    narrow = with_faults(rows.drop("text")).select(
        "conv_id", "turn", "place", F.left("role", F.lit(1)).alias("initial"), "fault", "lost"
    )
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return bounded(dealt.select("conv_id", "turn", "initial", "fault", "lost")).mapInArrow(plan, PLAN_DDL)


_RESULT = pa.schema([*[f for f in _PLAN if f.name != "initials"], ("repaired_sha256", pa.string())])
RESULT_DDL = PLAN_DDL.removesuffix(", initials string") + ", repaired_sha256 string"
_PLAN_FIELDS = [f.name for f in _RESULT][:-1]


class _Repaired:
    """The hash of a repaired conversation, fed row by row."""

    def __init__(self, plan: dict):
        self.plan = plan
        self.steps = repaired_roles(plan["audit"], plan["initials"])
        self.state, self.begun, self.row = hashlib.sha256(), False, 0
        self.step = next(self.steps, None)

    def _write(self, role: str, text: str) -> None:
        self.state.update((b"\n" if self.begun else b"") + f"{role}:{text}".encode())
        self.begun = True

    def _insert(self) -> None:
        while self.step and self.step[0] is None:
            self._write(self.step[1], "")
            self.step = next(self.steps, None)

    def add(self, role: str, text: str) -> None:
        self._insert()
        if self.step and self.step[0] == self.row:
            self._write(self.step[1] or role, text)
            self.step = next(self.steps, None)
        self.row += 1

    def result(self) -> dict:
        self._insert()
        return {c: self.plan[c] for c in _PLAN_FIELDS} | {"repaired_sha256": self.state.hexdigest()}


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the counts, cost, audit and repaired_sha256.

    ``turns`` has conv_id, turn, role, text and ``lost``; a conversation all of whose rows
    are lost has zeros, an empty audit and the hash of nothing.
    """
    rows = placed(turns)
    plan = F.struct(*[f.name for f in _PLAN])
    heads = plans(rows).select(
        "conv_id", F.lit(None).cast(rows.schema["place"].dataType).alias("place"), plan.alias("plan")
    )
    texts = rows.where("NOT lost").select("conv_id", "place", "role", "text")
    both = heads.unionByName(texts, allowMissingColumns=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("plan", "role", "text"))
            for plan, role, text in zip(*columns):
                if plan is None:
                    now.add(role, text)
                else:
                    if now is not None:
                        found.append(now.result())
                    now = _Repaired(plan)
            if found:
                yield pa.RecordBatch.from_pylist(found, _RESULT)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], _RESULT)

    # A plan has no place, and nulls come first.
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return bounded(dealt.select("plan", "role", "text")).mapInArrow(write, RESULT_DDL)
