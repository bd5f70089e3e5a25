"""Prefix trie and structure repair of conversations, against plain definitions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketlens.llm import prefix_trie, repair
from basketlens.llm.runs import running
from tests.llm import brute

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TEXTS = ["Hello there.", "Fine!", "and then", "What?", " \t", "", "Yes.", "No. ", "é?", "so so", None]


def some_conversations(seed: int, convs: int, turns: int) -> list[tuple]:
    chance = random.Random(seed)
    rows = []
    for conv in range(convs):
        shared = random.Random(conv % 3)
        for turn in range(chance.randint(1, turns)):
            own = shared if chance.random() < 0.9 else chance
            role = own.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows.append((conv * 2, 2 * turn + (own.random() < 0.2), role, own.choice(TEXTS)))
    return rows


def odd_conversations() -> list[tuple]:
    """Null turns, gaps, empty fields, copies, a conversation that goes on far beyond a block, one with a fork deep inside."""
    rows = some_conversations(1, 40, 9)
    rows += [(1000 + c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for c in range(0, 30, 5) for t in range(23)]
    rows += [(1100, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if t != 18 else "another.") for t in range(23)]
    rows += [(1105, None, "user", "first"), (1105, 4, None, None), (1105, 900, "", ""), (-7, 0, "user", "ok."), (-3, 5, None, "x")]
    rows += [(5000 + c, 0, "user", "the same.") for c in range(300)]
    return rows


def nodes(table):
    turns, members = prefix_trie.with_shared_starts(prefix_trie.marked_turns(table))
    return {tuple(r) for r in prefix_trie.trie(turns, members).collect()}


def test_trie_equals_brute_force(spark):
    rows = [r for r in odd_conversations() if r[0] >= 0]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute.trie_nodes(brute.rebuilt(rows))
    assert nodes(table) == want
    cluttered = table.withColumns({n: F.lit("x") for n in ["pos", "m1", "depth", "x1", "size", "n", "conv", "block", "turns", "row", "one", "_part"]})
    assert nodes(cluttered.unionByName(cluttered.withColumn("conv_id", F.lit(None).cast("bigint")))) == want
    assert nodes(table.where("false")) == set()


def test_trie_keeps_repeated_rows_as_turns(spark):
    rows = [(1, 0, "user", "a")] * 3 + [(2, 0, "user", "a")] * 2
    turns = prefix_trie.marked_turns(spark.createDataFrame(rows, SCHEMA))
    found = {tuple(r)[:5] for r in prefix_trie.trie(turns, turns.select("conv_id").distinct()).collect()}
    assert found == {(1, 0, None, 2, 1), (1, 1, 1, 2, 1), (1, 2, 1, 2, 1), (1, 3, 1, 1, 0)}


@pytest.mark.parametrize("bits", [1, 12])
def test_ids_are_joined_over_pieces(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", bits)
    ids = [-9, -8, -1, 0, 5, 6, 7, 100, 4095, 4096, 10**12]
    ends = spark.createDataFrame([(d, 1, 2, c) for d in (1, 2) for c in ids], "depth bigint, x1 bigint, x2 bigint, conv_id bigint")
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(tuple(r) for r in prefix_trie._joined_ids(ends).collect()) == [(d, 1, 2, want) for d in (1, 2)]


def test_running_totals_go_on_over_tasks(spark):
    """One key holds most rows, so it lies in all ranges."""
    rows = [(7 if i % 10 else i, i, (i * 37) % 101, (i * 7919) % 65536) for i in range(3000)]
    table = spark.createDataFrame(rows, "k bigint, i bigint, v bigint, x bigint")
    found = running(table, "k", [F.col("i")], ["v"], ["x"]).collect()
    assert len(found) == len(rows)
    totals, marks = {}, {}
    by = {(r["k"], r["i"]): (r["before_v"], r["before_x"]) for r in found}
    for k, i, v, x in sorted(rows):
        assert by[k, i] == (totals.get(k, 0), marks.get(k, 0))
        totals[k], marks[k] = totals.get(k, 0) + v, marks.get(k, 0) ^ x
    assert running(table.where("false"), "k", [F.col("i")], ["v"]).count() == 0


def repairs(table):
    return {r["conv_id"]: tuple(r)[1:] for r in repair.repair(repair.damaged(table)).collect()}


@pytest.mark.parametrize("step", [1, 3, 256])
def test_repair_equals_brute_force(spark, monkeypatch, step):
    monkeypatch.setattr(repair, "STEP", step)
    rows = odd_conversations() + some_conversations(2, 60, 12) + [(None, 1, "user", "a."), (None, None, None, None), (77777, 1, "user", "a"), (77777, 1, "system", "b.")]
    assert repairs(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute.repaired(rows)


def test_repair_of_long_conversations_is_the_same_in_steps(spark):
    chance = random.Random(3)
    rows = [(c, t, chance.choice(["user", "assistant", "system", "tool"]), chance.choice(["so.", "x", f"{t}.", f"{t}"])) for c in range(3) for t in range(700)]
    assert repairs(spark.createDataFrame(rows, SCHEMA)) == brute.repaired(rows)


def test_repair_edges(spark):
    table = spark.createDataFrame(odd_conversations(), SCHEMA)
    want = repairs(table)
    cluttered = table.withColumns({n: F.lit("x") for n in ["gone", "again", "blank", "truncated", "copy", "copies", "m1", "m2", "audit", "cost"]})
    assert repairs(cluttered) == want
    assert repairs(table.where("false")) == {}
    dropped = [(c, t) for c in range(200) for t in range(2) if brute.zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert repairs(spark.createDataFrame([(*dropped[0], "user", "a")], SCHEMA)) == {dropped[0][0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_rows_are_handed_on_while_a_conversation_passes():
    """Rows are forgotten as soon as all repairs that are left agree on them."""
    held = []
    own = repair.Repair(lambda role, text: None)
    for i in range(5000):
        own.add(["user", "assistant", "tool", "system"][i * i % 4], f"text {i}", i % 11 == 0, i % 3 == 0)
        held.append(len(own.texts))
    own.end()
    assert max(held) <= 2 * repair.STEP


def test_conversations_are_dealt_once(spark):
    plan = repair.repair(repair.damaged(spark.createDataFrame(odd_conversations(), SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
