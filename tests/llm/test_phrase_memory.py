"""What the steps over slices hold at once."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from entitymill.llm import phrases


def test_row_groups_of_slices_hold_few_of_them(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(f"w{i} " for i in rng.integers(0, 10**9, 95_000)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in phrases.corpus_slices(docs.coalesce(1)).inputFiles()]
    sizes = [f.metadata.row_group(i).total_byte_size for f in files for i in range(f.metadata.num_row_groups)]
    # a hundred rows were written before the writer looked at their size, and were read at once
    assert sum(sizes) > 35 << 20 and max(sizes) < 32 << 20


def test_sums_of_some_at_a_time_are_those_of_all():
    rng = np.random.default_rng(6)
    for merged in (1, 50, 10**6):
        sums, total, first = phrases.Sums(merged), Counter(), {}
        for at in rng.permutation(40).tolist():
            hashes = rng.choice(60, rng.integers(1, 30), replace=False).astype(np.uint64) << np.uint64(58)
            hashes = np.unique(hashes)
            counts = rng.integers(1, 2**31, len(hashes)).astype(np.uint32)
            sums.add(at, hashes.tobytes(), counts.tobytes())
            for h, c in zip(hashes.tolist(), counts.tolist(), strict=True):
                total[h] += c
                first[h] = min(first.get(h, at), at)
        sums.merge()
        assert dict(zip(sums.hashes.tolist(), sums.total.tolist(), strict=True)) == total
        assert dict(zip(sums.hashes.tolist(), sums.first.tolist(), strict=True)) == first


def test_words_are_hashed_alike_in_stretches(monkeypatch):
    text = np.frombuffer("a bb, ccc a. a bb\tccc dd ee".encode(), np.uint8)
    whole = [(n, h.tolist(), at.tolist()) for n, h, at, _ in phrases._ngrams("en", text, 5)]
    monkeypatch.setattr(phrases, "WORDS", 2)
    assert [(n, h.tolist(), at.tolist()) for n, h, at, _ in phrases._ngrams("en", text, 5)] == whole
