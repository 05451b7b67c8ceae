"""Words are prepared together, and what is read by steps is what the network gives."""

from __future__ import annotations

import numpy as np

from listenlake.llm import toxicity

WORDS = ["a", "ab", "abc", "x9", "straße", "é", "漢字", "a𝒳b", "ﬁn", "word" * 50]


def test_trigrams_of_many_words_need_no_call_per_trigram(monkeypatch):
    flat, sizes = toxicity._buckets(WORDS)
    assert flat.tolist() == [g for w in WORDS for g in toxicity.trigrams(w)]
    assert sizes.tolist() == [len(toxicity.trigrams(w)) for w in WORDS]
    calls = []
    monkeypatch.setattr(toxicity, "_bucket", lambda gram: calls.append(gram) or 0)
    toxicity.Network(["a"]).scores(["plain words of seven bit letters " * 3], {})
    assert calls == []


def test_every_new_word_is_prepared_once_and_remembered(monkeypatch):
    made = []
    gates = toxicity.Network.gates
    monkeypatch.setattr(toxicity.Network, "gates", lambda self, words: (made.extend(words), gates(self, words))[1])
    net, memory = toxicity.Network(["ab", "é"]), {}
    long = " ".join(WORDS * 7)
    first = net.scores([long, "", "ab é", long], memory)
    assert sorted(made) == sorted(WORDS)
    assert net.scores([long, "", "ab é", long], memory).tolist() == first.tolist()
    assert len(made) == len(WORDS)
    net.scores(["ab new"], memory)
    assert made[len(WORDS) :] == ["new"]


def test_scores_equal_the_network_for_every_length():
    net = toxicity.Network(WORDS[:5])
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(WORDS, n)) for n in (1, 2, 31, 32, 33, 55, 56, 57, 80, 9000)]
    expected = [toxicity._sigmoid(np.float64(net.logits(toxicity.windows_of(t.split()), {}).max())) for t in texts]
    assert np.allclose(net.scores(texts, {}), expected, atol=1e-6)
