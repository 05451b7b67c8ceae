"""A small language keeps all its terms beside languages with many."""

from __future__ import annotations

import numpy as np

from listenlake.llm import language_id


def test_rare_language_keeps_all_its_terms(spark):
    rng = np.random.default_rng(5)

    def words(letters: str, n: int) -> list[str]:
        return ["".join(w) for w in rng.choice(list(letters), (n, 8))]

    # Each word twice, so that a joint rank by count puts every rare word last.
    large = [(lang, words(letters, 500)) for lang, letters in
             [("aa", "abcdefghijklmnopqrst"), ("bb", "uvwxyzäöüßéèêàâçñìòù"), ("cc", "αβγδεζηθικλμνξοπρστυ")] for _ in range(80)]
    rare = [("zz", words("бвгджзклмн", 5)) for _ in range(20)]
    rows = [(i, " ".join(w * 2), lang) for i, (lang, w) in enumerate(large)]
    rows += [(1000 + i, " ".join(w), lang) for i, (lang, w) in enumerate(rare)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "bb", "cc", "zz"]
    for lang, found in large + rare:
        assert model.knows(0, found).all()
        for size in range(1, language_id.LONGEST_GRAM + 1):
            assert model.knows(size, language_id.grams(found[0], size)).all()
    assert all(model.predict(" ".join(w), {})[0] == "zz" for _, w in rare)
    assert model.predict("бббб нннн", {})[0] == "zz"
    assert model.totals[0][3] == 100 + 0.5 * len(model.keys[0])


def test_scores_equal_brute_force(spark):
    """Words first, then the longest known n-grams, averaged; the mean over a text's words."""
    rows = [(1, "der hund bellt laut der", "de"), (2, "the dog barks the loud", "en"), (3, "le chien aboie fort", "fr")]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {size: {} for size in range(5)}
    for _, text, lang in rows:
        for word in text.split():
            for size in range(5):
                for term in [word] if size == 0 else language_id.grams(word, size):
                    counts[size].setdefault(term, dict.fromkeys(model.langs, 0))[lang] += 1
    totals = {k: {x: sum(t[x] for t in terms.values()) + 0.5 * len(terms) for x in model.langs} for k, terms in counts.items()}
    log = lambda size, term: np.array([np.log((counts[size][term][x] + 0.5) / totals[size][x]) for x in model.langs])

    def word_score(word):
        if word in counts[0]:
            return log(0, word)
        for size in (4, 3, 2, 1):
            hits = [log(size, g) for g in language_id.grams(word, size) if g in counts[size]]
            if hits:
                return np.mean(hits, axis=0)
        return np.zeros(3)

    memory = language_id.Memory(model)
    texts = ["der laute hund", "Dogs bark ²", "chiens", "xyz zq the", "ŵ", "the " * 500 + "hund"]
    for text, (pred, score) in zip(texts, model.predict_all(texts, memory)):
        words = [w for w in text.lower().split() if any(map(str.isalpha, w))]
        mean = np.mean([word_score(w) for w in words], axis=0)
        odds = np.exp(mean - mean.max())
        assert pred == model.langs[int(odds.argmax())] and abs(score - odds.max() / odds.sum()) < 1e-4
    assert model.predict_all(["", None, "² 12", "the"], memory)[:3] == [("und", 0.0)] * 3
