"""Tiled searches among names, and leaders in bands, against plain loops."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from entitymill.functions.similarity import _common_subsequence
from entitymill.operators import leaders, nametiles
from entitymill.operators.upsert import batch_links
from entitymill.plans.resolving import leaders_by_name, multi_signal_leaders

from .test_resolution import SCHEMA, indel, multi_signal_loop, records

WORDS = ["solar", "electric", "northwick", "ashford", "heating", "services", "plumbing"]


def block_names(seed, n):
    """Families of names with typos, in two blocks; short, equal and long names too."""
    rng, out = random.Random(seed), [("x", "a"), ("x", "ab"), ("y", "é" * 300), ("y", "é" * 290 + "f" * 10)]
    for _ in range(n):
        name = list(" ".join(rng.sample(WORDS, rng.choice([1, 2, 3]))))
        for _ in range(rng.choice([0, 1, 2, 4])):
            name[rng.randrange(len(name))] = rng.choice("abcdefé")
        out.append((rng.choice("xy"), "".join(name)))
    return out


def ratio(kind, new, known):
    return indel(new, known) if kind == "indel" else SequenceMatcher(None, new, known).ratio()


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(nametiles, "CHUNK", 20)
    monkeypatch.setattr(nametiles, "SLICE", 7)
    monkeypatch.setattr(nametiles, "FIRST_KNOWN", 50)


@pytest.mark.parametrize("kind", ["indel", "block"])
def test_first_similar_equals_the_loop(spark, small_tiles, kind):
    new = sorted(set(block_names(1, 120)))
    known = [(b, n, 7 * i // 2) for i, (b, n) in enumerate(sorted(set(block_names(2, 150))))]  # some share `at`
    floor = 85 if kind == "indel" else 0.85
    want = {}
    for block, name in new:
        hits = [(at, ratio(kind, name, n)) for b, n, at in known if b == block and ratio(kind, name, n) >= floor]
        if hits:
            want[block, name] = min(hits)
    got = nametiles.first_similar(
        spark.createDataFrame(new, "block string, name string").repartition(3),
        spark.createDataFrame(known, "block string, name string, at long").repartition(3), 0.85, kind).collect()
    assert {(r.block, r.name): (r["at"], r.ratio) for r in got} == want and len(got) == len(want) > 20


def test_most_similar_equals_the_loop(spark, small_tiles):
    new = sorted(set(block_names(3, 120)))
    known = [(b, n, 1000 - i) for i, (b, n) in enumerate(sorted(set(block_names(4, 150))))]
    want = {}
    for block, name in new:
        hits = [(-indel(name, n), at) for b, n, at in known if b == block and indel(name, n) >= 85]
        if hits:
            want[block, name] = (min(hits)[1], -min(hits)[0])
    got = nametiles.most_similar(
        spark.createDataFrame(new, "block string, name string"),
        spark.createDataFrame(known, "block string, name string, at long"), 0.85).collect()
    assert {(r.block, r.name): (r["at"], r.ratio) for r in got} == want and len(got) == len(want) > 20


def components(ids, links):
    tree = {i: i for i in ids}
    for u, v in links:
        tree = {i: tree[v] if t == tree[u] else t for i, t in tree.items()}
    return {frozenset(i for i in ids if tree[i] == t) for t in set(tree.values())}


def test_links_connect_all_similar_names_without_all_pairs(spark, small_tiles):
    rows = [(b, n, i) for i, (b, n) in enumerate(dict.fromkeys(block_names(5, 200)))]
    given = [(0, 1), (30, 900)]  # one end is no name
    pairs = [(u, v) for b, n, u in rows for c, m, v in rows if b == c and v < u and ratio("block", n, m) >= 0.85]
    got = nametiles.similar_links(
        spark.createDataFrame(rows, "block string, name string, at long"),
        spark.createDataFrame(given, "u long, v long"), 0.85, "block").collect()
    ids = [*range(len(rows)), 900]
    assert {tuple(r) for r in got} <= set(pairs) and len(got) < len(pairs)
    assert components(ids, [*map(tuple, got), *given]) == components(ids, [*pairs, *given])


def test_a_family_of_similar_names_gives_links_by_its_size(spark):
    name = "tri-state ashford electric {}"
    rows = [(i, None, None, None, "CA", name.format(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "record_id long, phone string, email string, domain string, state string, name_key string")
    assert 399 <= batch_links(df).count() < 1200  # all pairs: 79,800


def test_leaders_in_bands_equal_the_loop(spark, monkeypatch):
    monkeypatch.setattr(leaders, "FIRST_BAND", 30)
    monkeypatch.setattr(leaders, "GROWTH", 3)
    rows = records(11, 160)
    df = spark.createDataFrame(rows, SCHEMA)
    got = multi_signal_leaders(df).collect()
    assert {r.pos: (None if r.kept else r.reason) for r in got} == multi_signal_loop(rows)
    at = {r[0]: r for r in rows}
    for r in got:
        if r.reason == "name":
            one = at[r.pos]
            assert r.kept_pos == min(k.pos for k in got if k.kept and k.pos < r.pos and at[k.pos][4] and
                                     at[k.pos][3] == one[3] and SequenceMatcher(None, one[4], at[k.pos][4]).ratio() >= 0.85)
    kept, want = [], set()
    for pos, _, _, state, name in rows:
        if not (name and state and any(s == state and indel(name, n) >= 85 for s, n in kept)):
            want.add(pos)
            kept += [(state, name)] if name and state else []
    names_only = df.select("pos", "state", F.col("fuzzy_name"))
    assert {r.pos for r in leaders_by_name(names_only).where("kept").collect()} == want


def test_common_letters_with_places_equal_the_function():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 80))) for _ in range(2))
        assert nametiles._common(nametiles._places(a), len(a), b) == _common_subsequence(a, b)
