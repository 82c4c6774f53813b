"""The conversation trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, k1 long, last long"


def rebuilt(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_nodes(rows):
    members = {}
    conversations = rebuilt(rows)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    totals = {}
    for prefix in sorted(members, key=len, reverse=True):
        below = [totals[child] for child in children.get(prefix, [])]
        chars = len(prefix[-1][1]) if prefix else 0
        saved = (len(members[prefix]) - 1) * chars + sum(b[1] for b in below)
        totals[prefix] = (sum(b[0] for b in below) or 1, saved)
    out = set()
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(convs), len(prefix), parent, len(convs), len(children.get(prefix, [])), *totals[prefix], digest))
    return out


def check(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(7)
    got = prefix_trie.conversation_trie(table).collect()
    assert {tuple(r) for r in got} == brute_nodes(rows)
    assert len(got) == len(brute_nodes(rows))


def test_equals_a_trie_by_hand(spark):
    draw = random.Random(12)
    rows = []
    for c in [*range(0, 130), *range(201, 240), *range(1000, 1003)]:
        for turn in range(draw.choice([1, 2, 4, 7])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"text {draw.randint(0, 2)}é\U0001f44d"))
    rows += [(300, None, None, None), (300, 0, "user", None), (300, 5, None, "x"), (None, 1, "user", "lost")]
    rows += [(301, 1, "user", "same")] * 3 + [(302, None, "", "")] * 2
    rows.append((400, 0, "user", "long " * 50_000))
    check(spark, rows)


def test_long_copies_and_one_conversation_with_most_rows(spark):
    """Blocks of a long conversation and of its copies, and many copies of one conversation."""
    rows = [(c, turn, "user", f"t{turn}") for c in (500, 501, 777) for turn in range(1300)]
    rows += [(600 + c, turn, "user", "copy") for c in range(80) for turn in range(6)]
    rows += [(20_000 + 100 * c, 0, "user", "alike") for c in range(60)]
    check(spark, rows)


def test_id_chunks_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_A_CHUNK", 8)
    rows = [(c, 0, "user", "same") for c in range(0, 4000, 100)]
    check(spark, rows)


def test_small_sketch_changes_nothing(spark):
    rows = [(c, turn, "user", f"{c % 50} {turn}") for c in range(400) for turn in range(3)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns, plans = prefix_trie.rebuilt_turns(prefix_trie.numbered_turns(table))
    prefixes = prefix_trie.prefix_digests(turns)
    wide = prefix_trie.screened(prefixes)
    narrow = prefix_trie.screened(prefixes, least=16, most=16)
    times = prefixes.groupBy("k1", "k2", "depth").count()
    truth = {(r.conv_id, r.depth): r["count"] for r in prefixes.join(times, ["k1", "k2", "depth"]).collect()}
    for marked in (wide, narrow):
        assert all(truth[r.conv_id, r.depth] == 1 for r in marked.collect() if r.alone)
    assert wide.where("alone").count() > 0.9 * sum(n == 1 for n in truth.values())
    assert narrow.where("alone").count() == 0
    check(spark, rows)


def test_sketch_never_counts_too_low(spark):
    values = spark.range(3000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"))
    twice = values.union(values.limit(1500)).repartition(5)
    cells = prefix_trie.count_min_sketch(twice, 1 << 12)
    rows = np.array([tuple(r) for r in values.collect()], np.int64)
    spots = prefix_trie._cells(rows[:, 0].copy(), rows[:, 1].copy(), 1 << 12)
    estimate = np.minimum.reduce([cells[s] for s in spots])
    assert (estimate >= 1).all() and (estimate == 2).sum() >= 1500


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")]])
def test_empty_tables(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(table).count() == 0


def test_turnless_conversation(spark):
    """A conversation whose head conversation is missing and that has no turn after its first h."""
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    check(spark, [(turnless, 0, "user", "a"), (turnless, 1, "user", "b")])
    check(spark, [(turnless, 0, "user", "a"), (turnless, 1, "user", "b"), (5, 0, "user", "z")])
