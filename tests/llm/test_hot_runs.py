"""Hot runs: only one of all equal runs is cut into windows, and a text's spans leave a batch joined."""

from __future__ import annotations

import random

import pytest

from entitymill.llm import repeats, substrings, suffixes


@pytest.mark.parametrize(("module", "dedup", "size"), [
    (suffixes, suffixes.dedup_bytes, len), (substrings, substrings.dedup_substrings, lambda t: len(t.split()))])
def test_copies_of_hot_runs(spark, monkeypatch, module, dedup, size):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(10_000)}" for _ in range(200))
    docs = spark.createDataFrame([(i, passage) for i in range(160)], "doc_id long, text string").repartition(8, "doc_id")
    kept, spans = {}, []
    keep, by_text = repeats.keep_table, repeats.spans_by_text

    def counted(df, name):
        table = keep(df, name)
        kept[name] = table.count()
        return table

    def counted_spans(found):
        spans.append(found.count())
        return by_text(found)

    for where in (repeats, module):
        monkeypatch.setattr(where, "keep_table", counted)
    monkeypatch.setattr(module, "spans_by_text", counted_spans)
    got = dedup(docs, hot_rows=20).select("n_removed").collect()
    assert [r.n_removed for r in got] == [size(passage)] * 160
    # written rows follow the different windows, not the batches that hold them
    written = {n: k for n, k in kept.items() if n not in ("minimisers", "repeated", "runs")}
    assert max(written.values()) <= size(passage), written
    # and a text has one span, not one per hot run
    assert spans == [160]
