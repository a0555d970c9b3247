from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from spendgrid.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += kids[node] == 0
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            kids[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -9, len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())


def trie(spark, rows, cells=1 << 12, schema=SCHEMA, more=()):
    turns = spark.createDataFrame([(*r, *more) for r in rows], schema).repartition(3)
    return sorted(tuple(-9 if v is None else v for v in r) for r in T.prefix_trie(turns, cells).collect())


def branching(n, seed):
    """Conversations that part at random, with copies and empty texts."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.randrange(1, 12)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["", "ab", "é😀"]) if rng.random() < 0.8 else f"own {c}") for t in range(length)]
    return rows


@pytest.mark.parametrize("cells", [1 << 12, 64, 8])
def test_equals_brute_force(spark, cells):
    """A sketch far too small proves less; the result is the same."""
    rows = branching(260, 1)
    assert trie(spark, rows, cells) == brute_trie(rows)


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 3)
    rng = random.Random(2)
    rows = [(c, t, "u", f"x{t}" if rng.random() < 0.995 else "y") for c in (0, 5, 7, 7000, 7011) for t in range(40)]
    rows += [(300, t, "u", f"x{t}") for t in range(2)] + [(311, 5, "u", "z"), (312, 0, "u", "w")]
    assert trie(spark, rows) == brute_trie(rows)


def test_many_ends_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(T, "TEXT_BYTES", 20)
    rows = [(c, 0, "user", "hello") for c in range(1200)]
    assert trie(spark, rows) == brute_trie(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (None, 0, "user", "no one"), (2, 5, "a", "x" * 50_000),
            (100, 0, "user", "base"), (103, 0, "user", "own"), (104, 0, "user", "own"), (-150, 0, "u", "v"), (-101, 1, "u", "v"), (305, 0, "u", "alone")]
    clash = SCHEMA + ", c int, d int, p1 string, block int"
    assert trie(spark, rows, schema=clash, more=(1, 2, "p", 4)) == brute_trie_signed(rows)
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    only_null = spark.createDataFrame([(None, 0, "a", "b")], SCHEMA)
    assert T.prefix_trie(only_null).collect() == []


def brute_trie_signed(rows):
    """The base of a negative id: the remainder takes its sign, as in SQL."""
    import math
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    moved = {c: c - int(math.fmod(c, 100)) for c in own}
    for c in own:  # the same trie from turns that are rebuilt already
        h = crc32(str(c).encode()) % 6
        base = [t[2:] for t in sorted(own.get(moved[c], []))][:h]
        out.append((c, base + [t[2:] for t in sorted(own[c])][h:]))
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(out):
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += kids[node] == 0
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            kids[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -9, len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())
