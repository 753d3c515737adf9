"""Dedup and clustering against plain loops on small fixtures."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from entitymill.functions.similarity import _common_subsequence, block_ratio, indel_ratio
from entitymill.operators import cluster, keyed, numbering, pairs, skew
from entitymill.plans.resolving import fuzzy_name_edges, leaders_by_name, multi_signal_leaders

WORDS = ["solar", "power", "pump", "bright", "hart", "ford", "valley", "electric", "air", "stone"]


def typo(rng, name):
    kind, i = rng.randrange(4), rng.randrange(len(name))
    return [name, name[:i] + name[i + 1 :], name[:i] + rng.choice("aeiou") + name[i:], name[:i] + "x" + name[i + 1 :]][kind]


def records(seed, n):
    """Rows with shared phones and domains and misspelt names; a third share one phone."""
    rng = random.Random(seed)
    out = []
    for pos in range(n):
        name = " ".join(rng.sample(WORDS, 2))
        out.append((
            pos,
            None if rng.random() < 0.4 else ("hot" if rng.random() < 0.3 else f"p{rng.randrange(n)}"),
            None if rng.random() < 0.5 else f"d{rng.randrange(n // 2)}",
            rng.choice(["CA", "TX", None]),
            None if rng.random() < 0.1 else typo(rng, name),
        ))
    return out


SCHEMA = "pos LONG, phone_key STRING, domain_key STRING, state STRING, fuzzy_name STRING"


def indel(a, b):
    return 200.0 * _common_subsequence(a, b) / (len(a) + len(b))


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence_matches_the_table_method():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 30))) for _ in range(2))
        assert _common_subsequence(a, b) == longest_common(a, b)


def multi_signal_loop(rows):
    kept, out = [], {}
    for pos, phone, domain, state, name in rows:
        reason = None
        if phone and any(k[1] == phone for k in kept):
            reason = "phone"
        elif domain and any(k[2] == domain for k in kept):
            reason = "domain"
        elif name and state and any(
            k[3] == state and k[4] and SequenceMatcher(None, name, k[4]).ratio() >= 0.85 for k in kept
        ):
            reason = "name"
        out[pos] = reason
        if reason is None:
            kept.append((pos, phone, domain, state, name))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_multi_signal_leaders_equal_the_loop(spark, seed):
    rows = records(seed, 160)
    got = multi_signal_leaders(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.pos: (None if r.kept else r.reason) for r in got} == multi_signal_loop(rows)
    assert all(r.kept_pos < r.pos for r in got if not r.kept)


def test_fuzzy_leaders_equal_the_loop(spark):
    rows = records(3, 200)
    kept, want = [], set()
    for pos, _, _, state, name in rows:
        hit = name and state and any(s == state and indel(name, n) >= 85 for s, n in kept)
        if not hit:
            want.add(pos)
            if name and state:
                kept.append((state, name))
    df = spark.createDataFrame(rows, SCHEMA).select("pos", "state", "fuzzy_name")
    assert {r.pos for r in leaders_by_name(df).where("kept").collect()} == want


@pytest.mark.parametrize("threshold", [0.81, 0.85, 0.9])
def test_candidate_pairs_lose_nothing(spark, threshold):
    rng = random.Random(7)
    names = {typo(rng, typo(rng, " ".join(rng.sample(WORDS, rng.choice([1, 2]))))) for _ in range(150)}
    names |= {"a", "ab", "abc", "aaaa", "aaaaa", "abab", "ababab"}
    df = spark.createDataFrame([("b", n) for n in names], "block STRING, name STRING")
    got = {
        (r.new_name, r.known_name)
        for r in pairs.candidate_pairs(df, df, threshold)
        .where(indel_ratio(F.col("new_name"), F.col("known_name")) >= threshold * 100)
        .collect()
    }
    want = {(a, b) for a in names for b in names if indel(a, b) >= threshold * 100}
    assert got == want


def test_candidate_pairs_are_unique(spark):
    df = spark.createDataFrame([("b", n) for n in ["solar power", "solar powers", "solr power"]], "block STRING, name STRING")
    rows = [tuple(r) for r in pairs.candidate_pairs(df, df, 0.85).collect()]
    assert len(rows) == len(set(rows)) == 9


def test_edges_are_directed(spark):
    rows = spark.createDataFrame([(1, "CA", "abcdefgh ij"), (2, "CA", "abcdefgh ijk")], "pos LONG, state STRING, fuzzy_name STRING")
    edges = fuzzy_name_edges(rows, block_ratio(F.col("new_name"), F.col("known_name")), 0.85)
    assert edges.count() == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_components_do_not_depend_on_order(spark, seed):
    rng = random.Random(seed)
    members = [(i, f"k{rng.randrange(60)}") for i in range(90) for _ in range(rng.choice([1, 1, 2]))]
    members += [(100 + i, f"chain{i}") for i in range(40)] + [(101 + i, f"chain{i}") for i in range(40)]
    members += [(200 + i, "hot") for i in range(60)]
    parent = {i: i for i, _ in members}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for i, key in members:
        a, b = root(i), root(first.setdefault(key, i))
        parent[max(a, b)] = min(a, b)
    rng.shuffle(members)
    df = spark.createDataFrame(members, "id LONG, key STRING")
    got = cluster.connected_components(df.select("id").distinct(), cluster.key_links(df)).collect()
    least = {}
    for i in parent:
        least.setdefault(root(i), []).append(i)
    want = {i: min(group) for group in least.values() for i in group}
    assert {r.id: r.component for r in got} == want


def test_lookup_join_splits_hot_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "id LONG, key STRING")
    table = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 300, 6)], "key STRING, v LONG")
    got = skew.lookup_join(rows, table, "key", "id", "left", hot_rows=20)
    want = rows.join(table, "key", "left")
    assert sorted(map(tuple, got.select("id", "key", "v").collect()), key=str) == sorted(
        map(tuple, want.select("id", "key", "v").collect()), key=str
    )
    assert skew.lookup_join(rows, table, "key", "id", hot_rows=20).count() == rows.join(table, "key").count()


def test_first_per_key_needs_an_order(spark):
    df = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    with pytest.raises(ValueError):
        keyed.first_per_key(df, ["k"], "pos")


def test_keep_first_variants(spark):
    rows = [(1, "p", "x"), (2, "p", "y"), (3, None, "x"), (4, None, "z"), (5, None, "z"), (6, None, None), (7, "q", "z"), (8, None, "y")]
    df = spark.createDataFrame(rows, "pos LONG, phone STRING, name STRING")

    def ids(frame):
        return sorted(r.pos for r in frame.collect())

    assert ids(keyed.first_per_key(df, ["phone"], "pos")) == [1, 7]
    assert ids(keyed.first_per_key(df, ["phone"], "pos", keep_missing=True)) == [1, 3, 4, 5, 6, 7, 8]
    assert ids(keyed.first_per_phone_else_name(df, "phone", "name", "pos")) == [1, 4, 6, 7, 8]
    assert ids(keyed.mark_later(df, "phone", "pos").where("is_duplicate")) == [2]
    once = keyed.phone_then_domain(df, "phone", "name", "pos")
    assert ids(once) == ids(keyed.phone_then_domain(once, "phone", "name", "pos"))


def test_row_numbers_have_no_gaps(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "pos")
    got = [tuple(r) for r in numbering.number_rows(df, "pos", stride=100).orderBy("pos").collect()]
    assert [n for _, n in got] == list(range(1, len(got) + 1))


def test_quota_and_newest_keep_the_best(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "big").otherwise("small").alias("g"), "id")
    quotas = spark.createDataFrame([("big", 3), ("small", 1)], "g STRING, quota INT")
    assert sorted(r.id for r in numbering.quota_per_group(df, quotas, "g", "id", 3).collect()) == [0, 1, 2, 900]
    newest = numbering.newest_per_group(df, "g", [F.desc("id")], "id", 2)
    assert sorted(r.id for r in newest.collect()) == [898, 899, 998, 999]


def test_threshold_of_four_fifths_is_refused(spark):
    # "ab" and "axb" reach 0.8 without a two-letter gram in common
    names = spark.createDataFrame([("b", "ab"), ("b", "axb")], "block string, name string")
    with pytest.raises(ValueError, match="above 0.8"):
        pairs.candidate_pairs(names, names, 0.8)


def leaders_in_order(members, edges):
    keys, points = {}, {}
    for pos, key in members:
        keys.setdefault(pos, set()).add(key)
    for key, other in edges:
        points.setdefault(key, set()).add(other)
    held, kept = set(), set()
    for pos in sorted(keys):
        if not any(k in held or points.get(k, set()) & held for k in keys[pos]):
            kept.add(pos)
            held |= keys[pos]
    return kept


@pytest.mark.parametrize("finish_rows", [0, 60, 1000])
def test_leaders_equal_the_scan_whatever_is_left_to_it(spark, finish_rows):
    rng = random.Random(finish_rows)
    members = sorted({(i, f"k{rng.randrange(50)}") for i in range(80) for _ in range(rng.choice([1, 2]))})
    edges = sorted({(f"k{rng.randrange(50)}", f"k{rng.randrange(50)}") for _ in range(30)})
    positions = spark.createDataFrame([(p,) for p in {p for p, _ in members} | {900}], "pos LONG")
    got = cluster.keep_leaders(
        positions, spark.createDataFrame(members, "pos LONG, key STRING"),
        spark.createDataFrame(edges, "key STRING, other_key STRING"), finish_rows=finish_rows)
    assert {r.pos for r in got.collect() if r.kept} == leaders_in_order(members, edges) | {900}


def jobs_of(spark, action):
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_a_long_chain_takes_few_jobs(spark):
    chain = [(i, f"k{j}") for i in range(1000) for j in (i, i + 1)]
    df = spark.createDataFrame(chain, "pos LONG, key STRING")
    out = []
    assert jobs_of(spark, lambda: out.extend(cluster.keep_leaders(df.select("pos"), df).collect())) < 20
    assert {r.pos for r in out if r.kept} == set(range(0, 1000, 2))
    links = spark.createDataFrame([(i, i + 1) for i in range(1000)], "u LONG, v LONG")
    nodes = spark.range(1005)
    out = []
    assert jobs_of(spark, lambda: out.extend(cluster.connected_components(nodes, links).collect())) < 20
    assert {r.id: r.component for r in out} == {i: 0 if i <= 1000 else i for i in range(1005)}


def test_components_by_rounds_alone(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    df = spark.createDataFrame(links, "u LONG, v LONG")
    some, all_at_once = (
        {r.id: r.component for r in cluster.connected_components(spark.range(300), df, finish).collect()}
        for finish in (0, 1_000_000))
    assert some == all_at_once and len(set(some.values())) > 50


def test_segments_do_not_overlap_and_fit():
    for threshold in (0.801, 0.81, 0.85, 0.9):
        assert all(2 * pairs.segments_needed(n, threshold) <= n for n in range(2, 500))
    counts = {"ab": 5, "bc": 1, "cd": 5, "de": 2, "ef": 9}
    assert pairs.cheapest_segments("abcdef", 2, counts, 1) == [1, 3]
    assert pairs.cheapest_segments("abcdef", 3, counts, 1) == [0, 2, 4]


def test_letter_counts_differ_no_more_than_the_names():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abcÄ &7Z") for _ in range(rng.randrange(1, 25)))
        b = typo(rng, a)
        apart = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(pairs.letter_counts(a), pairs.letter_counts(b)))
        assert indel(a, b) <= 100 and (1 - indel(a, b) / 100) * (len(a) + len(b)) + 1e-6 >= apart
