"""The prefix trie against a plain dictionary of prefixes, with many shards and spilling queues."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from stratalake.llm.prefix_trie import SpillingQueue, prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth long"


def plain(rows):
    """Nodes as sets of members, totals by a walk over all descendants."""
    turns = {}
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(x)] for c, x in turns.items()}
    members = {}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = turns.get(base, [])[:h] + own[h:]
        for d in range(len(paths[c]) + 1):
            members.setdefault(tuple(paths[c][:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = set()
    for p, m in members.items():
        ends = sorted(c for c in m if len(paths[c]) == len(p))
        told = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p], told))
    return out


def found(spark, rows, **options):
    out = [tuple(r) for r in prefixes(spark.createDataFrame(rows, SCHEMA), **options).collect()]
    assert len(out) == len(set(out))
    return set(out)


def some(seed, convs, longest):
    """Conversations of few different turns, so that prefixes are shared; one is very long."""
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-20, 10 * convs), convs):
        n = pick.choice([1, 2, 3, 4, 6, 9, longest])
        rows += [(c, t, pick.choice(["user", "assistant"]), pick.choice(["a", "bé", "", "ccc"]), 7) for t in range(n)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"shard_nodes": 5, "block_levels": 2, "queue": 2}), (3, {"shard_nodes": 1, "block_levels": 3, "queue": 1})])
def test_against_plain(spark, seed, options):
    rows = some(seed, 80, 23)
    assert found(spark, rows, **options) == plain(rows)


def test_many_levels_of_shards(spark):
    """A chain of conversations that each hang on the one before, over more shards than one level joins."""
    rows = [(5 * c, t, "u", f"t{t}" if t < c else f"own {c}", 0) for c in range(60) for t in range(c + 2)]
    assert found(spark, rows, shard_nodes=20, block_levels=2, queue=3) == plain(rows)


def test_odd_rows(spark):
    """Null ids go, null roles and texts are empty, null turns come first, equal turns are ordered, repeated rows count."""
    rows = [
        (None, 0, "user", "lost", 1), (0, 1, "user", "second", 1), (0, None, "user", "first", 1), (0, 1, "user", "another second", 1),
        (1, 0, None, None, 1), (1, 0, None, None, 1), (1, 0, "", "", 1), (2, 5, "user", "x" * 100_000, 1), (5, 0, "user", "second", None),
        (9, 3, "a", "alone", 1), (12, 3, "a", "alone", 1), (10, None, None, "n", 1), (11, None, None, "n", 1), (-7, 0, "u", "negative", 1),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, shard_nodes=1, block_levels=1, queue=1) == plain(rows)
    assert found(spark, [r for r in rows if r[0] is None]) == set()


def test_many_equal_conversations(spark):
    """A third of all conversations are equal: one node with very many ends; all share a root with many children."""
    rows = [(c, t, "user", "same" if c % 3 == 0 else f"{c} {t}", 0) for c in range(3000) for t in range(2)]
    assert found(spark, rows, shard_nodes=500) == plain(rows)


def test_queue_spills():
    pick = random.Random(5)
    queue, held = SpillingQueue(4), []
    for _ in range(2000):
        if held and pick.random() < 0.4:
            held.sort()
            assert queue.least() == held[0] and queue.pop() == held.pop(0)
        else:
            entry = (pick.randint(-9, 9), pick.randint(0, 5), pick.randint(0, 99), 1)
            held.append(entry)
            queue.push(entry)
    assert queue.spills > 3
    assert [queue.pop() for _ in held] == sorted(held) and queue.least() is None
