"""Scoring by words' places gives what the network gives, and a word costs once per call."""

from __future__ import annotations

import numpy as np

from listenlake.llm import toxicity


def test_scores_equal_the_network_and_a_word_is_prepared_once(monkeypatch):
    rng = np.random.default_rng(3)
    net = toxicity.Network(["w1", "w2", "w3"])
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 30, n)) for n in (0, 1, 7, 31, 32, 33, 56, 57, 400)]
    net.shift = 0.1
    expected = []
    for t in texts:
        windows = toxicity.windows_of(t.split())
        expected.append(toxicity._sigmoid(np.float64(net.logits(windows, {}).max()) - 0.1) if windows else 0.0)
    calls = []
    trigrams = toxicity.trigrams
    monkeypatch.setattr(toxicity, "trigrams", lambda word: (calls.append(word), trigrams(word))[1])
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 5)
    cache: dict = {}
    for _ in range(3):
        calls.clear()
        assert np.allclose(net.scores(texts, cache), expected, atol=1e-6)
        # However full the memory is, a word is prepared once for these texts.
        assert len(calls) == len(set(calls)) <= 30
