"""Texts cut by array steps over their bytes, and looked up once for each distinct part."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from entitymill.llm import tokenfiles


@pytest.fixture(scope="module")
def encoder():
    with open(tokenfiles.TOKENIZER, encoding="utf-8") as file:
        return tokenfiles.PartEncoder(file.read())


def test_words_beside_signs_and_in_capitals_are_one_part(encoder):
    encoder.encode(["The the THE, (the) the. 1234 4321", "THE\nthe;"])
    assert sorted(encoder.known) == sorted([*"1234,().;", "the"])


def test_stretches_of_odd_texts_give_the_ids_of_whole_texts(encoder, monkeypatch):
    whole, rng = Tokenizer.from_file(tokenfiles.TOKENIZER), random.Random(7)
    signs = "aBcÉßĲɏɐİ×÷ªµ'.,<|>#_-19½²é́日Σſ😀K \u0085 \x00\x0b\x0c\x1c\x7f\t\r\n   "
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(2000)]
    texts += [None, "", " \n\t ", "x <|endoftext|>Y", "<|ENDOFTEXT|>", "IT'S It's", "W" * 9000, "É" * 9000, None]
    ids = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokenfiles, "MEMORY_PARTS", 300)  # forgets between stretches
    for size in (1, 500, 1 << 20):
        found, counts, lows = [], [], []
        # a slice: its offsets do not begin at zero
        for low, some in tokenfiles._stretches(pa.array(["x y", *texts]).slice(1), size):
            got, sizes = encoder.encode_all(some)
            lows.append(low)
            found += got.tolist()
            counts += sizes.tolist()
        assert counts == [len(x) for x in ids] and found == [i for x in ids for i in x]
        assert lows[0] == 0 and np.all(np.diff(lows) > 0) and (len(lows) == 1) == (size == 1 << 20)
