"""Structure repair of conversations, as lightest derivations over an agenda.

An item (i, q) says that the first i rows of a conversation have been turned into roles that leave the
pattern in state q. Its value is (cost, audit): the cost of the edits and their initials in order. Deductions
lead from item to item: Insert to (i, q'), Keep, Rerole and Delete to (i + 1, q'). Each adds its cost and
letter, so a better value of the item that it starts from never gives a worse one (two audits of one item and
one cost read equally many rows, hence neither is the beginning of the other). The agenda pops
items by (cost, rows read, audit), and every deduction raises that: Insert the cost, the others the rows. So the first time that an item is
popped, its value is final, and the goal (all rows, a pattern that is whole) takes the lightest repair, of
equally light ones the one whose audit comes first.

Conversations pass in order, ``STEP`` rows at a time: the final items at the end of a step are the axioms of
the next one. Any state reaches the end of any other at 7 more at most, so items that cost more than the
cheapest and 7 are left out; rows on which all items that are left agree are handed on and forgotten.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP = 256
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: Between the best ends of any two states.
APART = 7
#: States of the pattern (s?(ua)+)?, the role that a row may be given in each, and where roles lead.
START, SYSTEM, USER, ASSISTANT = range(4)
GIVEN = ["user", "user", "assistant", "user"]
AFTER = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
LEGAL = {"su", "ua", "au"}

Values = dict[int, tuple[int, str]]


def finalised(axioms: Values, rows: list[tuple[str, bool, bool]]) -> Values:
    """Final values of the items at the end of ``rows`` (initial, must go, truncated), for each state."""
    agenda = [(cost, 0, audit, q) for q, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    seen: set[tuple[int, int]] = set()
    ends: Values = {}
    most = None
    while agenda:
        cost, i, audit, q = heapq.heappop(agenda)
        if most is not None and cost > most:
            break
        if (i, q) in seen:
            continue
        seen.add((i, q))
        given = AFTER[q][GIVEN[q][0]]
        heapq.heappush(agenda, (cost + INSERT, i, audit + "I", given))
        if i == len(rows):
            ends[q] = (cost, audit)
            most = cost + APART if most is None else most
            continue
        initial, must_go, truncated = rows[i]
        heapq.heappush(agenda, (cost + DELETE, i + 1, audit + "D", q))
        if not must_go:
            heapq.heappush(agenda, (cost + REROLE + truncated, i + 1, audit + "R", given))
            if initial in AFTER[q]:
                heapq.heappush(agenda, (cost + truncated, i + 1, audit + "K", AFTER[q][initial]))
    return ends


class Repair:
    """One conversation, fed row by row."""

    def __init__(self, write) -> None:
        self.write = write  # takes (role, text) of each repaired row, in order
        self.rows: list[tuple[str, bool, bool]] = []
        self.texts: list[tuple[str, str]] = []  # of the rows that no audit has been handed on for
        self.items: Values = {START: (0, "")}
        self.state = START
        self.audit: list[str] = []

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self.rows.append((role[:1], must_go, truncated))
        self.texts.append((role, "" if must_go else text))
        if len(self.rows) == STEP:
            self.step()

    def step(self) -> None:
        self.items, self.rows = finalised(self.items, self.rows), []
        audits = [audit for _, audit in self.items.values()]
        low, high = min(audits), max(audits)
        same = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        self.hand_on(low[:same])
        self.items = {q: (cost, audit[same:]) for q, (cost, audit) in self.items.items()}

    def hand_on(self, audit: str) -> None:
        self.audit.append(audit)
        read = 0
        for edit in audit:
            given = GIVEN[self.state]
            role, text = (given, "") if edit == "I" else self.texts[read]
            read += edit != "I"
            if edit == "D":
                continue
            role = given if edit in "IR" else role
            self.write(role, text)
            self.state = AFTER[self.state][role[:1]]
        del self.texts[:read]

    def end(self) -> tuple[int, str]:
        """Cost and audit."""
        if self.rows:
            self.step()
        elif self.items == {START: (0, "")}:
            return 0, ""
        ends = finalised(self.items, [])
        cost, audit = min(ends[q] for q in (START, ASSISTANT) if q in ends)
        self.hand_on(audit)
        return cost, "".join(self.audit)


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``blank``, ``again`` (role and text seen earlier in the conversation) and ``truncated`` to rows.

    Expects conv_id, turn, role and text without null texts, and ``gone`` for rows that only stand for
    their conversation. The rows are dealt by conv_id; what follows by conv_id needs no other shuffle.
    """
    dealt = rows.repartition("conv_id")
    mark = [F.xxhash64(F.lit(n), "role", "text") for n in (1, 2)]
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = dealt.withColumns({"m1": mark[0], "m2": mark[1]})
    earlier = F.row_number().over(Window.partitionBy("conv_id", "gone", "m1", "m2").orderBy(*order)) > 1
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return dealt.withColumns({"again": earlier, "blank": blank, "truncated": ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")}).drop("m1", "m2")


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair(rows: DataFrame) -> DataFrame:
    """The lightest repair of each conversation.

    ``rows`` has conv_id, turn, role, text and ``gone``. Rows with ``gone`` are not part of their conversation,
    which gets its row all the same. A conversation's rows go by turn, null first, then by role and text; rows
    without conv_id are one conversation. Null roles and texts count as empty. Returns RESULT: the first
    faults by kind, gaps in the turns, pairs of neighbours whose roles do not follow, and the cost and the
    edits of the repair with a digest of the repaired ``role:text`` lines. No rows give no result.

    The digest of a conversation is one SHA-256 and so is made in one task, row by row; of a conversation
    only the rows on which its repairs still differ are held.
    """
    text = {"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit("")), "turn": F.col("turn").cast("bigint")}
    table = rows.withColumns(text).select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text", "gone")
    order = ["conv_id", "gone", F.col("turn").asc_nulls_first(), "role", "text"]
    table = faults(table).sortWithinPartitions(*order)
    names = [f.split()[0] for f in RESULT.split(", ")]
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        """Each row as a list, in order."""
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        done = []
        for conv, own in groupby(conversations(batches), key=lambda r: r[0]):
            digest, written = hashlib.sha256(), 0

            def write(role: str, body: str) -> None:
                nonlocal written
                digest.update(("\n" * (written > 0) + role + ":" + body).encode())  # noqa: B023
                written += 1

            lightest = Repair(write)
            counts = dict.fromkeys(("blank", "again", "truncated"), 0)
            illegal, before, turns, low, high = 0, None, 0, None, None
            for _, turn, role, body, gone, again, blank, truncated in own:
                if gone:
                    continue
                if turn is not None and turn != high:
                    turns, low, high = turns + 1, turn if low is None else low, turn
                illegal += before is not None and before + role[:1] not in LEGAL
                before = role[:1]
                again, truncated = again and not blank, truncated and not blank and not again
                for name, it in (("blank", blank), ("again", again), ("truncated", truncated)):
                    counts[name] += it
                lightest.add(role, body, blank or again, truncated)
            cost, audit = lightest.end()
            gaps = high - low + 1 - turns if turns else 0
            done.append((conv, gaps, *counts.values(), illegal, cost, audit, digest.hexdigest()))
            if len(done) == 2000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema)
                done = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema)

    return table.select("conv_id", "turn", "role", "text", "gone", "again", "blank", "truncated").mapInArrow(run, RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of their place, for ``repair``: dropped, emptied, cut, repeated or renamed.

    A null conv_id or turn is one space in the hashed text, a null role or text is one space in the row.
    """

    def space(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    what = F.crc32(F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn"))).cast("binary")) % 20
    role, text = space(F.col("role")), space(F.col("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(what == 4, "user").otherwise(role).alias("role"),
        F.when(what.isin(0, 1), "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (what == 0).alias("gone"), F.when(what == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")
