"""Parts of texts next to every letter of the ranges that are cut at signs."""

from __future__ import annotations

import string

import numpy as np
from tokenizers import Tokenizer

from entitymill.llm import tokenfiles


def test_every_letter_beside_every_sign():
    with open(tokenfiles.TOKENIZER, encoding="utf-8") as file:
        encoder = tokenfiles.PartEncoder(file.read())
    whole = Tokenizer.from_file(tokenfiles.TOKENIZER)
    letters = string.digits + string.ascii_letters + "".join(map(chr, range(0xC0, 0x250)))
    texts = [f"x{c}{s}{c}y {s}{c}{s} {c}1{s}{c}\n{c}" for c in letters for s in string.punctuation + "\t\r"]
    texts += ["BELEDİYESİ.", "İ", "İ.İ", "(İZMİR)", "İZMİR, İSTANBUL!"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    wanted = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, wanted, strict=True) if a != b] == []
