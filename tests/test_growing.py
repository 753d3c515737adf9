"""Deduplication with an index that grows, against the same rules in plain Python."""

import random
from collections import defaultdict
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from entitymill.operators import cluster, growing


def plain_components(rows, strong, weak, floor=0.5):
    """rows: {id: name}; strong: (id, key); weak: (id, key, first_only)."""
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def union(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    holders = defaultdict(list)
    for i, key in strong:
        holders[key].append(i)
    for ids in holders.values():
        for i in ids:
            union(ids[0], i)
    while True:
        found = {i: find(i) for i in rows}
        hub = {}
        for i, key, first_only in weak:
            if not first_only or found[i] == i:
                hub[key] = min(hub.get(key, found[i]), found[i])
        links = [(i, hub[k]) for i, k, _ in weak if k in hub and hub[k] != found[i] and rows[i] and rows[hub[k]]
                 and SequenceMatcher(None, rows[i], rows[hub[k]]).ratio() >= floor]
        if not links:
            return found
        for a, b in links:
            union(a, b)


def components(spark, rows, strong, weak):
    found = growing.growing_components(
        spark.createDataFrame(list(rows.items()), "id long, name string"),
        spark.createDataFrame(strong, "id long, key string"),
        spark.createDataFrame(weak, "id long, key string, first_only boolean"))
    return {r.id: r.component for r in found.collect()}


@pytest.mark.parametrize("seed", [3, 5])
def test_components_equal_the_rules_in_plain_python(spark, seed):
    rng = random.Random(seed)
    names = ["ashford electric", "ashford electrical", "ashton solar", "blue sky", "blue sky roofing", "x", "", None]
    rows = {i: rng.choice(names) for i in range(60)}
    strong = [(i, f"phone:{rng.randrange(40)}") for i in rows if rng.random() < 0.5]
    strong += [(i, f"email:{rng.randrange(60)}") for i in rows if rng.random() < 0.5]
    weak = [(i, f"domain:{rng.randrange(8)}", True) for i in rows if rng.random() < 0.7]
    weak += [(i, f"phone:toll{rng.randrange(2)}", False) for i in rows if rng.random() < 0.3]
    wanted = plain_components(rows, strong, weak)
    assert components(spark, rows, strong, weak) == wanted
    assert len(set(wanted.values())) < len(set(plain_components(rows, strong, []).values()))


def test_a_merged_row_hands_on_what_it_brings(spark):
    rows = {1: "ashford electric", 2: "other name", 3: "third name", 4: "ashford electric co", 5: "blue sky", 6: None}
    # 2 has the number of 1 and a mail of its own, which finds 3
    strong = [(1, "phone:1"), (2, "phone:1"), (2, "email:a"), (3, "email:a")]
    # 4 is similar to the domain's first entity, 5 is not, 6 has no name
    weak = [(i, "domain:d", True) for i in (1, 4, 5, 6)]
    assert components(spark, rows, strong, weak) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}


def test_a_merge_can_make_another_entity_the_first(spark):
    # in round one the domain's first entity is 2, which is merged with 1 through e: 3 is first then and takes 4
    rows = {1: "summit heating", 2: "summit heating inc", 3: "valley solar", 4: "valley solar power"}
    weak = [(1, "domain:e", True), (2, "domain:d", True), (2, "domain:e", False), (3, "domain:d", True), (4, "domain:d", True)]
    assert components(spark, rows, [], weak) == {1: 1, 2: 1, 3: 3, 4: 3} == plain_components(rows, [], weak)


def test_empty_tables(spark):
    assert components(spark, {}, [], []) == {}
    assert components(spark, {3: None, 4: ""}, [], []) == {3: 3, 4: 4}


@pytest.mark.parametrize("most_names, apart", [(1, True), (5, False)])
def test_shared_numbers_are_weak_on_request(spark, most_names, apart):
    rows = {1: "ashford electric", 2: "blue sky", 3: "ashford electrics", 4: "valley solar", 5: "valley solar"}
    frame = spark.createDataFrame(list(rows.items()), "id long, name string")
    members = spark.createDataFrame(
        [(1, "phone:800"), (2, "phone:800"), (3, "phone:800"), (4, "phone:7"), (5, "phone:7")], "id long, key string")
    own, shared = growing.split_shared(members, frame, most_names)
    found = growing.growing_components(frame, own, shared.withColumn("first_only", F.lit(False)))
    got = {r.id: r.component for r in found.collect()}
    assert got == ({1: 1, 2: 2, 3: 1, 4: 4, 5: 4} if apart else {1: 1, 2: 1, 3: 1, 4: 4, 5: 4})


def test_merged_sets_and_the_first_row(spark):
    rows = spark.createDataFrame(
        [(1, "A", "p1", ["x", "y"], None), (2, "B", "p2", ["y", None, ""], 7), (3, "C", None, None, 3), (4, "D", "", [], None)],
        "id long, company string, phone string, kinds array<string>, kw long")
    found = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "id long, component long")
    done = growing.merge_rows(rows, found, {"phones": "phone", "kinds": "kinds"}, ["company"], "kw")
    assert sorted(map(tuple, done.entities.collect())) == [(1, 3, "A", 7, 2, 2), (4, 1, "D", None, 0, 0)]
    assert sorted(map(tuple, done.values.collect())) == [
        (1, "kinds", "x", 1), (1, "kinds", "y", 2), (1, "phones", "p1", 1), (1, "phones", "p2", 1)]


def test_links_shrink_with_every_round(spark, monkeypatch):
    """Entities, not rows, are joined up again after the first round, and links between one entity's rows go."""
    written = []
    keep = cluster.keep_table

    def counted(df, name):
        table = keep(df, name)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(cluster, "keep_table", counted)
    # 40 businesses of 50 rows under three keys each, in a chain of weak links
    rows = spark.range(2000).selectExpr("id", "concat('ashford electric ', id div 50) AS name")
    strong = rows.selectExpr("id", "explode(array(concat('a', id div 50), concat('b', id div 25), concat('c', id div 10))) AS key")
    weak = rows.selectExpr("id", "explode(array(concat('w', id div 50), concat('w', id div 50 + 1))) AS key", "false AS first_only")
    found = growing.growing_components(rows, strong, weak)
    assert [r.component for r in found.select("component").distinct().collect()] == [0]
    links = [n for name, n in written if name == "links"]
    assert links[0] > 1900 and all(n <= 80 for n in links[1:]), written


@pytest.mark.parametrize("seed", [1, 2])
def test_contracted_links_give_the_least_node(spark, seed):
    rng = random.Random(seed)
    ids = [rng.randrange(10**12) for _ in range(300)]
    pairs = [(a, b) for a, b in zip(ids, ids[1:]) if rng.random() < 0.7]  # chains
    pairs += [(ids[7], i) for i in rng.sample(ids, 40)] + [(i, i) for i in ids[:3]]
    pairs += [(rng.choice(ids), rng.choice(ids)) for _ in range(15)]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    links = spark.createDataFrame(pairs, "u long, v long")
    for most in (0, 20):
        got = cluster.connected_components(nodes, links, finish_links=most).collect()
        assert {r.id: r.component for r in got} == {i: find(i) for i in ids}
