"""The near-copy stage against brute-force similarity."""

from __future__ import annotations

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from entitymill.llm import nearcopies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def first_of_groups(rows):
    """Places of the rows that stay, by comparing all pairs."""
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if group[i] != group[j] and 10 * len(a & b) >= 8 * len(a | b):
            group = [group[i] if g == group[j] else g for g in group]
    place = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    return {min((i for i in range(len(rows)) if group[i] == g), key=place) for g in set(group)}


def altered(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def near_rows():
    """Copies with 0 to 40 of 400 words replaced, short texts, one original with many copies, chains."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for errors in range(0, 41, 2):
        words = fresh(400)
        rows += [" ".join(words), altered(rng, words, errors)]
    hub = fresh(300)
    rows += [altered(rng, hub, 5) for _ in range(30)] + [" ".join(hub)]
    chain = fresh(200)
    for _ in range(8):
        rows.append(" ".join(chain))
        chain = altered(rng, chain, 3).split()
    rows += ["", None, " \n", "One two", "one  TWO", "one two three", " ".join(fresh(5)), "a b c d e f", "a b c d e g"]
    return list(enumerate(rows))


def test_stage_equals_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(first_of_groups(rows))
    assert nearcopies.first_rows(docs.limit(0)).count() == 0


def test_rows_without_an_own_id_stay_apart(spark):
    rng = random.Random(9)
    words = [[f"w{rng.randrange(5000)}" for _ in range(100)] for _ in range(6)]
    plain = [" ".join(w) for w in words]
    rows = [(1, plain[0]), (None, altered(rng, words[0], 1)), (None, plain[1]), (None, plain[2]), (4, plain[3]),
            (4, altered(rng, words[0], 1)), (4, plain[4]), (4, plain[4]), (None, plain[5]), (None, plain[5]),
            (7, plain[5]), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert {t or "" for _, t in got} == {*plain, ""} and len(got) == 7
    assert sorted(got, key=repr)[:2] == [(1, plain[0]), (4, min(plain[3], plain[4]))] and (7, plain[5]) in got


def family(rng, n):
    """Texts of 60 words, two of them replaced in each: near, but below 0.8 to each other."""
    words = [f"w{rng.randrange(5000)}" for _ in range(60)]
    return [altered(rng, words, 2) for _ in range(n)]


def test_tiles_of_many_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "CHUNK_SHINGLES", 300)
    rng = random.Random(10)
    rows = list(enumerate(family(rng, 60) + [t for _, t in near_rows()]))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(first_of_groups(rows))


def test_links_within_a_tile_connect_without_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 40, 100)
    sets = [np.unique(np.concatenate([base[: 100 - k % 5], rng.integers(0, 1 << 40, k % 5 + 30 * (k % 7 == 0))])) for k in range(50)]
    groups = np.arange(50)
    found = nearcopies.links_across(np.arange(50), groups, np.zeros(50, int), sets)
    tree = list(range(50))
    for i, j in itertools.combinations(range(50), 2):
        if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j])):
            tree = [tree[i] if t == tree[j] else t for t in tree]
    assert len(found) == 50 - len(set(tree))
    assert all(tree[u] == tree[v] for u, v in found)


def test_clashing_columns_and_very_long_texts(spark):
    rng = random.Random(11)
    long = " ".join(f"w{rng.randrange(90_000)}" for _ in range(60_000))
    rows = [(1, long, "id"), (2, long + " more words at the end", "id"), (3, "short text", "id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string").withColumn("band", F.lit(1)).withColumn("key", F.lit(2))
    assert sorted(r.key.doc_id for r in nearcopies.first_rows(docs).collect()) == [1, 3]


def test_simhash_pairs_are_the_nearest_copies(spark):
    rng = random.Random(12)
    words = [[f"w{rng.randrange(5000)}" for _ in range(1000)] for _ in range(4)]
    texts = {i: " ".join(w) for i, w in enumerate(words)} | {9: " ".join(words[0] + ["end"]), 10: " ".join(words[1] * 2)}
    prints = {i: nearcopies.simhash.fingerprint(t, nearcopies.SHINGLE) for i, t in texts.items()}
    rows = [(i, 900, int(np.uint64(p).astype(np.int64))) for i, p in prints.items()] + [(11, 900, int(np.uint64(prints[2]).astype(np.int64)))]
    got = nearcopies._simhash_pairs(spark.createDataFrame(rows, "id long, n long, fp long")).collect()
    fp = {r[0]: r[2] for r in rows}
    want = sorted(sorted(p) for p in itertools.combinations(fp, 2)
                  if ((fp[p[0]] ^ fp[p[1]]) & (1 << 64) - 1).bit_count() <= 3)
    assert sorted(sorted(r) for r in got) == want and [0, 9] in want and [2, 11] in want
