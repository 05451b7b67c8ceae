"""What the encoder remembers, and where it parts words from marks."""

from __future__ import annotations

import random

import numpy as np
from tokenizers import Tokenizer

from listenlake.llm import packing


def test_a_frequent_word_reaches_the_tokenizer_once(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_CHUNKS", 50)
    monkeypatch.setattr(packing, "MEMO_PIECES", 50)
    made = []
    piece = packing.Encoder._piece
    monkeypatch.setattr(packing.Encoder, "_piece", lambda self, p: (made.append(p), piece(self, p))[1])
    encoder = packing.Encoder(packing.default_tokenizer())
    for i in range(20):
        rare = [f"r{chr(97 + i)}{chr(97 + k)}" for k in range(10)]
        encoder(["often Often, often. " + " ".join(rare)])
        assert len(encoder.chunks) <= 50 and len(encoder.pieces) <= 50
    assert made.count("often") == 1
    # Words beside marks and in capitals are the same words; two marks, 200 rare words.
    assert sorted(made) == sorted(set(made)) and len(made) == 203


def test_marks_next_to_letters_give_the_tokenizers_ids():
    path = packing.default_tokenizer()
    plain, rng = Tokenizer.from_file(path), random.Random(11)
    letters = ["ab's.,'tll rve!-_ 1d\n", "abÉé'.` \r\t^[]\\{}~@x0", "".join(map(chr, range(0x20, 0x7F))), "aé\x0b\x85漢é'., "]
    texts = ["".join(rng.choices(letters[i % 4], k=rng.randrange(90))) for i in range(2000)]
    texts += ["", " ", " a", "a ", "it's. x.'s y'.", "a...b", "1.2,3'4", "x''s 's.'s"]
    own = [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert packing.Encoder(path)(texts) == own
