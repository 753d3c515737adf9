"""Token counts against the library's encoding of whole texts."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from entitymill.llm import tokencounts as tc

SIGNS = ["'s", "'re", "'", "''", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", " ",
         "a", " the", " Wort", "Zé", "ß", "ɏ", "ʰ", "ǅ", "Ω", "中文", "x̂", "1", "²", "½", "١", "、", "—", "“",
         "🙂", "_", "!", "?.", "<|endoftext|>", "<|", "﻿", "​"]


def odd_texts(n: int) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tc.TOKENIZER)


def library_counts(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def length_table(**more):
    with open(tc.TOKENIZER, encoding="utf-8") as file:
        return tc.LengthTable(file.read(), more.pop("frequent", {}), **more)


def test_odd_texts(tokenizer):
    texts = odd_texts(20_000)
    assert length_table().counts(texts) == library_counts(tokenizer, texts)


def test_every_doubtless_sign_in_context(tokenizer):
    chars = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070)]]
    texts = [a + c + b for c in chars for a in ("x", "1", " ", "'", "!") for b in ("y", "2", " ", "'s", " z")]
    assert length_table().counts(texts) == library_counts(tokenizer, texts)


def test_memory_is_bounded_and_the_frequent_stay(tokenizer):
    table = length_table(frequent={" the": 1}, memory=10)
    for low in range(0, 2000, 100):
        texts = odd_texts(2000)[low : low + 100]
        assert table.counts(texts) == library_counts(tokenizer, texts)
    assert " the" in table.known and len(table.known) < 2000


def test_portions_join_and_count(tokenizer):
    text = " ".join(t for t in odd_texts(3000) if t)
    parts = list(tc.portions(text, 500))
    assert "".join(parts) == text and len(parts) > 20
    assert sum(library_counts(tokenizer, parts)) == library_counts(tokenizer, [text])[0]


def test_count_tokens(spark, tokenizer):
    long = "wörd's " * 300_000
    texts = [None, "", "solo", "solo", long, "x" * 70, *odd_texts(200)]
    rows = [(i if i % 7 else None, t, 9) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    want = sorted(repr((i, len((t or "").encode()), n, n > 512)) for (i, t, _), n in zip(
        rows, library_counts(tokenizer, [t or "" for t in texts]), strict=True))
    for sample in (0, 50):
        got = tc.count_tokens(docs, sample=sample)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert tc.count_tokens(docs.limit(0)).count() == 0


def test_all_documents(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], library_counts(tokenizer, [r.text or "" for r in rows]), strict=True))
    assert {r.doc_id: r.n_tokens for r in tc.count_tokens(docs).collect()} == want


def test_other_tokenizers_are_refused():
    with open(tc.public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        tc.checked(file.read())
