"""Collocations against plain counting, and the promise of the summaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from entitymill.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, rank int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, threshold, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    good = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    inside = defaultdict(int)
    for (lang, words), a in good.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i : i + k]] = max(inside[lang, words[i : i + k]], a)
    found = defaultdict(list)
    for (lang, words), a in good.items():
        if 100 * inside[lang, words] >= 100 * a:
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, rank, phrase.decode(), -a, l, r, n[lang], -score) for lang, some in found.items()
                  for rank, (score, a, phrase, l, r) in enumerate(sorted(some)[:top], 1))


def mined(spark, rows, **more):
    return sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA), **more).collect())


def random_rows(seed, docs, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "é", "THE", "The", "a-b", " x", "\x1c", "中"]
    glue = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "!", "\x0b", " \t"]
    return [(i, "".join(rng.choice(vocabulary[: 3 + i % len(vocabulary)]) + rng.choice(glue)
                        for _ in range(rng.randrange(80))), rng.choice(["en", "de", None]), 1) for i in range(docs)]


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, seed, monkeypatch):
    monkeypatch.setattr(phrases, "PARTITION_MASS", 500)
    rows = random_rows(seed, 150, 6)
    for threshold, top in ((4, 2000), (15, 7)):
        assert mined(spark, rows, threshold=threshold, top=top) == plain(rows, threshold, top)


def test_odd_rows(spark):
    copies = [(1, "Same old story. Same old story", None, 1)] * 60
    rows = [*copies, (None, None, "en", 1), (2, "", "en", 1), (3, " \t.;", "en", 1), (4, "alone", "en", 1),
            (5, "und und " * 30_000, "de", 1), (6, "x" * 100_000, "de", 1)]
    assert mined(spark, rows) == plain(rows, 100)
    assert mined(spark, rows[60:64]) == [] and mined(spark, []) == []


def test_slices_do_not_cut_phrases(spark, monkeypatch):
    rows = random_rows(9, 40, 4)
    rows.append((99, " ".join(t for _, t, *_ in rows), "en", 1))
    monkeypatch.setattr(phrases, "SLICE_BYTES", 200)
    small = phrases.corpus_slices(spark.createDataFrame(rows, SCHEMA), 200)
    assert small.count() > 20
    got = {(r.lang, r.phrase): r.a for r in phrases.frequent_ngrams(small, 5).collect()}
    whole = {(r.lang, r.phrase): r.a for r in phrases.frequent_ngrams(
        phrases.corpus_slices(spark.createDataFrame(rows, SCHEMA)), 5).collect()}
    assert got == whole and len(got) > 50


@pytest.mark.parametrize("seed", range(4))
def test_summaries_keep_all_frequent_numbers(seed):
    rng = np.random.default_rng(seed)
    rows, truth = [], Counter()
    for _ in range(30):
        numbers = np.concatenate([rng.integers(0, 1 << 31, 4000), rng.zipf(1.5, 2000) % 1000]).astype(np.uint32)
        values, counts = np.unique(numbers, return_counts=True)
        truth.update(dict(zip(values.tolist(), counts.tolist(), strict=True)))
        rows.append((0, values.tobytes(), phrases._packed(counts.astype(np.uint32))))
    summary = phrases.summarised(rows, 100, merged=5000)
    left = set(summary.survivors(100).tolist())
    assert summary.subtracted < 100 / phrases.SPARE
    assert len(summary.numbers) <= summary.capacity < len(truth)
    assert {x for x, n in truth.items() if n >= 100} <= left
    assert all(truth[x] >= 100 - summary.subtracted for x in left)


def test_exact_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    ngrams = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, big + 7), ("en", "b", 1, 2 * big)], "lang string, phrase string, size int, a bigint")
    totals = spark.createDataFrame([("en", 900_000_000_000)], "lang string, n bigint")
    row = phrases.scored_phrases(ngrams, totals).first()
    assert row.score == 1000 * big * 900_000_000_000 // ((big + 7) * 2 * big) and (row.l, row.r) == (big + 7, 2 * big)
