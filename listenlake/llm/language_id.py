"""Language ID: words first, then ever shorter character n-grams for unseen words.

A known word scores each language by the log of its frequency there.  A word that is
not known backs off: to its known 4-grams (with word ends marked), else its 3-grams,
then 2-grams, then single characters.

Words and n-grams are counted by Spark over a sample of labelled rows that is at most
``SAMPLE_ROWS`` per language in expectation, chosen by a hash of the id; every term of
the sample is kept, so what is broadcast grows with the number of languages and the
length of the sampled texts, not with the rows.  Scoring reads every whole text, batch
by batch, and shuffles nothing.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is
every text if nothing could be learned; equal scores go to the first language by name;
a null label is not learned from; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import stored, table

UNKNOWN = "und"
SAMPLE_ROWS = 4000
LONGEST_GRAM = 4
# Words remembered per task with their scores.
CACHE_WORDS = 200_000
# Characters of texts whose words are looked up together.
CHUNK_CHARS = 1 << 19
_WORD = re.compile(r"[^\W\d_]+")


# What the driver receives per term: the language's place, the term's length or 0, its hash, its count.
_NUMBERS = [("lang", "<i4"), ("size", "<i4"), ("key", "<i8"), ("n", "<i8")]


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of every language, by a hash of the id."""
    share = labelled.groupBy("lang").agg((F.lit(float(rows)) / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(stored(share, "lang-share"), "lang").where(place < F.col("_share")).drop("_share")


def _key(size: int, term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode(), size)


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"]):
            for word, n in Counter(_WORD.findall(text.lower())).items():
                counts[lang, 0, word] += n
                for size in range(1, LONGEST_GRAM + 1):
                    for gram in grams(word, size):
                        counts[lang, size, gram] += n
        langs, sizes, keys = zip(*((lang, size, _key(size, term)) for lang, size, term in counts)) if counts else ((), (), ())
        yield pd.DataFrame({"lang": langs, "size": sizes, "key": np.array(keys, np.uint64).view(np.int64), "n": list(counts.values())})


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's numbers as one value, so that the driver meets a few rows and not one per term."""
    parts = [batch.to_records(index=False, column_dtypes=dict(_NUMBERS)).astype(_NUMBERS).tobytes() for batch in batches]
    yield pd.DataFrame({"part": [b"".join(parts)]})


class Model:
    """Frequencies per language of words (size 0) and n-grams (their length).

    ``terms`` has numbers only: lang (its place in ``langs``), size, key, n.  Per size there are the sorted ``keys``, one row of log
    frequencies per key and one column per language; ``totals`` are per size.
    """

    def __init__(self, langs: list[str], terms: np.ndarray | pd.DataFrame):
        self.langs = langs
        self.keys: dict[int, np.ndarray] = {}
        self.scores: dict[int, np.ndarray] = {}
        self.totals: dict[int, np.ndarray] = {}
        sizes, column = np.asarray(terms["size"]), np.asarray(terms["lang"])
        for size in np.unique(sizes).tolist():
            own = sizes == size
            keys, row = np.unique(np.asarray(terms["key"], np.int64)[own].view(np.uint64), return_inverse=True)
            counts = np.zeros((len(keys), len(langs)))
            np.add.at(counts, (row, column[own]), np.asarray(terms["n"], np.float64)[own])
            self.keys[size], self.totals[size] = keys, counts.sum(axis=0) + 0.5 * len(keys)
            self.scores[size] = np.log((counts + 0.5) / self.totals[size]).astype(np.float32)

    def find(self, size: int, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for an unknown one."""
        known = self.keys.get(size, np.zeros(0, np.uint64))
        if not len(known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, -1)

    def knows(self, size: int, terms: list[str]) -> np.ndarray:
        return self.find(size, np.array([_key(size, t) for t in terms], np.uint64)) >= 0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row of log frequencies per word, by the longest terms that are known of it."""
        found = np.zeros((len(words), len(self.langs)), np.float32)
        at = self.find(0, np.array([_key(0, w) for w in words], np.uint64))
        known, left = at >= 0, np.flatnonzero(at < 0)
        if known.any():
            found[known] = self.scores[0][at[known]]
        for size in range(LONGEST_GRAM, 0, -1):
            parts = [(i, _key(size, g)) for i in left.tolist() for g in grams(words[i], size)]
            if not parts:
                continue
            at = self.find(size, np.array([k for _, k in parts], np.uint64))
            owner = np.array([i for i, _ in parts])[at >= 0]
            hits = np.bincount(owner, minlength=len(words))[:, None]
            sums = np.zeros((len(words), len(self.langs)))
            if len(owner):
                np.add.at(sums, owner, self.scores[size][at[at >= 0]])
            got = left[hits[left, 0] > 0]
            found[got] = sums[got] / hits[got]
            left = left[hits[left, 0] == 0]
        return found

    def predict(self, text: str | None, memory: Memory | None = None) -> tuple[str, float]:
        return self.predict_all([text], memory or Memory(self))[0]

    def predict_all(self, texts: list[str | None], memory: Memory) -> list[tuple[str, float]]:
        words = [_WORD.findall(t.lower()) if t else [] for t in texts]
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        rows, letters = memory.rows_of([w for own in words for w in own])
        ends = np.cumsum([len(own) for own in words])
        sums = np.vstack([np.zeros((1, len(self.langs))), np.cumsum(rows, axis=0, dtype=np.float64)])
        counts = np.concatenate([[0], np.cumsum(letters)])
        total = sums[ends] - sums[ends - [len(own) for own in words]]
        n = counts[ends] - counts[ends - [len(own) for own in words]]
        # The odds of a word of the text in the mean: a sum would be certain of any long text.
        odds = np.exp((total - total.max(axis=1, keepdims=True)) / np.maximum(n, 1)[:, None])
        best = odds.argmax(axis=1)
        sure = odds[np.arange(len(texts)), best] / odds.sum(axis=1)
        return [(self.langs[b], float(p)) if k else (UNKNOWN, 0.0) for b, p, k in zip(best, sure, n)]


class Memory:
    """The words a task has met, with their scores; emptied when it is full."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.rows, self.letters = np.zeros((0, len(model.langs)), np.float32), np.zeros(0, bool)

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of scores per word, zero for a word without a letter, and whether it has one."""
        if len(self.index) > CACHE_WORDS:
            self.__init__(self.model)
        fresh = [w for w in dict.fromkeys(words) if w not in self.index]
        if fresh:
            letters = np.array([any(map(str.isalpha, w)) for w in fresh])
            scores = self.model.word_scores(fresh) * letters[:, None]
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            self.rows, self.letters = np.vstack([self.rows, scores]), np.concatenate([self.letters, letters])
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        return self.rows[at], self.letters[at]


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of all terms of the sample from (doc_id, text, lang)."""
    usable = labelled.where("text is not null and lang is not null")
    terms = _sample(usable, sample_rows).select("lang", "text").mapInPandas(_count_terms, "lang string, size int, key long, n long")
    counted = stored(terms.groupBy("lang", "size", "key").agg(F.sum("n").alias("n")), "lang-terms")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1 if langs else F.lit(0)
    numbers = counted.select(place.cast("int").alias("lang"), "size", "key", "n").mapInPandas(_packed, "part binary")
    parts = [np.frombuffer(r["part"], _NUMBERS) for r in numbers.collect()]
    return Model(langs, np.concatenate(parts or [np.zeros(0, _NUMBERS)]))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``_lang`` of (pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = pickle.loads(shared.value)
        memory = Memory(own)
        for texts in batches:
            found, held, size = [], [], 0
            for text in texts:
                held.append(text)
                size += len(text or "")
                if size > CHUNK_CHARS:
                    found += own.predict_all(held, memory)
                    held, size = [], 0
            found += own.predict_all(held, memory) if held else []
            yield pd.DataFrame(found, columns=["pred", "score"])

    return docs.withColumn("_lang", F.pandas_udf(score, "pred string, score double", F.PandasUDFType.SCALAR_ITER)(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_from(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    rows = docs.where(~held_out(id_col))
    return learn(rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))


def identified(docs: DataFrame) -> DataFrame:
    """The documents in a learned language; the rest is rejected."""
    model = learn_from(docs)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("text").alias("text"))
    return predict(whole, model).where(F.col("_lang.pred") != UNKNOWN).select("_doc.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_from(docs)
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_lang.pred").alias("lang_pred"), F.col("_lang.score").alias("score"))
