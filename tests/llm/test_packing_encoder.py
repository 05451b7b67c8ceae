"""Remembered chunks give the tokenizer's own ids."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from listenlake.llm import packing

ODD = [
    "", " ", "a\x1cb", "\x0b\x0c a\x85b", "E\u0301e\u0301 \u0301x", "\u0391\u03a3 \u03b1\u03a3.", "it's 'S don't x.'s '", "ÀÉÿß÷× ẞ",
    "İ ı ﬁ à", "x<|endoftext|>y <|start", "½²٣ 12a3 ___a_b", "\ud7a4 \u212b K 漢字かな", "\xa0\xadÃ \x7f", "a\tb\r\nc", "#" * 500, "z" * 3000,
]


def own_ids(tokenizer, texts):
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


@pytest.mark.parametrize("limits", [(250_000, 300_000), (20, 10)])
def test_ids_equal_the_tokenizers(monkeypatch, limits):
    monkeypatch.setattr(packing, "MEMO_CHUNKS", limits[0])
    monkeypatch.setattr(packing, "MEMO_PIECES", limits[1])
    encoder, plain = packing.Encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    assert encoder.known_rules
    rng = random.Random(5)
    letters = "abcXYZ019'’.,-_éÉßÿÃ÷ \t\n\u0301Σñ漢"
    mixed = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    for texts in (ODD, mixed[:1500], ODD + mixed[1500:], mixed, []):
        assert encoder(texts) == own_ids(plain, texts)


def test_every_byte_is_spelt_as_the_tokenizer_does():
    encoder, plain = packing.Encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    texts = [chr(c) + "a" + chr(c) for c in range(0x250)]
    assert encoder(texts) == own_ids(plain, texts)


def test_a_tokenizer_with_other_rules_is_used_as_it_is():
    path = packing.default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    encoder = packing.Encoder(path)
    assert not encoder.known_rules
    assert encoder(ODD) == own_ids(Tokenizer.from_file(path), ODD)
