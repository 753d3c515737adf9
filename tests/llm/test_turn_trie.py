"""The trie against a plain one that walks every conversation turn by turn."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from entitymill.llm import turntrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    path = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        path[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(set)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].add(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    worth, leaves = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        own_worth = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            worth[node[:d]] += own_worth
            leaves[node[:d]] += not children[node]
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if path[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    leaves[node], worth[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows):
    return sorted((tuple(r) for r in turntrie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def random_rows(seed, convs, longest, texts):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 200), convs):
        n = rng.randrange(1, longest)
        rows += [(c, i, rng.choice(["user", "assistant"][i % 2 : i % 2 + 1]), rng.choice(texts), "x") for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rows = random_rows(seed, 60, 14, ["a b", "c", "", "d e f"][: 2 + seed % 3])
    assert trie(spark, rows) == plain_trie(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None, "x"), (1, None, "user", None, "x"), (1, 0, "", "a", "x"), (1, 0, "", "a", "x"),
            (2, 5, "user", "é ü\x0b x", "x"), (2, -1, "us", "er", "x"), (2, -1, "u", "ser", "x"), (None, 0, "user", "lost", "x"),
            (60, 0, "user", "base", "x"), (61, 0, "user", "own", "x"), (62, 0, "user", "own", "x"), (63, 0, "user", "own", "x"),
            (64, 0, "user", "own", "x"), (9_000_000_000, 0, "user", "far", "x"), (9_000_000_001, 0, "user", "far " * 50_000, "x")]
    assert trie(spark, rows) == plain_trie(rows)


def test_nothing_to_build(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "lost", "x")]) == []


def test_turnless_conversation(spark):
    lost = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lost, i, "user", "gone", "x") for i in range(3)]
    assert trie(spark, rows) == plain_trie(rows) == [
        (lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_many_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "STRIPE", 3)
    monkeypatch.setattr(turntrie, "CHUNK", 8)
    rows = [(c, i, "user", f"copy {i}", "x") for c in range(0, 150, 2) for i in range(6)]
    rows += [(1, i, "user", f"copy {i}" if i < 40 else f"own {i % 7}", "x") for i in range(90)]
    rows += [(3, i, "user", f"copy {i}" if i < 40 else f"own {i % 7}", "x") for i in range(70)]
    random.Random(1).shuffle(rows)
    assert trie(spark, rows) == plain_trie(rows)
