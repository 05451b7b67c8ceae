"""Toxicity: a bidirectional GRU with attention pooling, trained in numpy.

A word's input is its own embedding plus the mean embedding of its hashed character
trigrams, so unseen forms of a known stem are recognised.  A text is cut into windows of
``WINDOW`` words that overlap by ``WINDOW - STRIDE``; every window is scored, and the
highest score is the text's.

The network is fitted on a sample of labelled rows, at most ``SAMPLE_ROWS`` per label in
expectation, chosen by a hash of the id.  A label tells of a whole text, so in each round
the window that scores highest stands for its text; in the first round the log odds of
words choose it.  Weights are some hundred kilobytes at every input size.

Defined cases: a null, empty or wordless text scores 0; without rows of both labels every
score is 0; null labels and ids are not learned from; repeated rows score alike; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, stored, table

SAMPLE_ROWS = 1200
WINDOW, STRIDE = 32, 24
WORDS, BUCKETS, DIM, HIDDEN = 4000, 4096, 16, 8
ROUNDS, STEPS, BATCH, RATE = 3, 130, 32, 0.01
# Windows scored at a time, and words whose inputs a task remembers.
CHUNK, CACHE_WORDS = 2048, 200_000
# Windows read in one pass when texts are scored: their steps stay in a core's own memory.
READ_ROWS = 256
_WORD = re.compile(r"[^\W_]+")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@lru_cache(1 << 17)
def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


# The checksum of three ASCII letters is the exclusive or of one value per place.
_CRC = np.array([[zlib.crc32(bytes(i) + bytes([x]) + bytes(2 - i)) for x in range(128)] for i in range(3)])
_CRC[1:] ^= zlib.crc32(bytes(3))


def trigrams(word: str) -> list[int]:
    marked = f"^{word}$"
    return [_bucket(marked[i : i + 3]) for i in range(max(1, len(marked) - 2))]


def _buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of words in a row, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    begins = np.ones(len(letters), bool)
    ends = np.cumsum(sizes + 2)
    begins[ends - 1] = begins[ends - 2] = False
    at = np.flatnonzero(begins)
    a, b, c = letters[at], letters[at + 1], letters[at + 2]
    plain = (a | b | c) < 128
    out = np.empty(len(at), np.int64)
    out[plain] = (_CRC[0, a[plain]] ^ _CRC[1, b[plain]] ^ _CRC[2, c[plain]]) % BUCKETS
    other = ~plain
    grams, of = np.unique(a[other] << 42 | b[other] << 21 | c[other], return_inverse=True)
    low = (1 << 21) - 1
    out[other] = np.array([_bucket(chr(g >> 42) + chr(g >> 21 & low) + chr(g & low)) for g in grams.tolist()], np.int64)[of]
    return out, sizes


def windows_of(words: list[str]) -> list[list[str]]:
    last = max(0, len(words) - WINDOW)
    starts = [*range(0, last, STRIDE), last]
    return [words[s : s + WINDOW] for s in starts] if words else []


class Network:
    def __init__(self, vocabulary: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        shapes = {"word": (len(vocabulary) + 1, DIM), "char": (BUCKETS, DIM), "att": (2 * HIDDEN, HIDDEN), "v": (HIDDEN,), "out": (2 * HIDDEN,)}
        for side in "fb":
            shapes |= {"W" + side: (DIM, 3 * HIDDEN), "U" + side: (HIDDEN, 3 * HIDDEN), "c" + side: (3 * HIDDEN,)}
        self.p = {k: (rng.normal(size=s) * 0.2).astype(np.float32) for k, s in shapes.items()}
        self.p["bias"] = np.zeros(1, np.float32)
        self.state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.step, self.shift = 0, 0.0

    def word_input(self, word: str) -> np.ndarray:
        return self.p["word"][self.ids.get(word, 0)] + self.p["char"][trigrams(word)].mean(axis=0)

    def _gru(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        b, t, _ = x.shape
        h = np.zeros((b, HIDDEN), np.float32)
        out = np.empty((b, t, HIDDEN), np.float32)
        a = x @ self.p["W" + side] + self.p["c" + side]
        for i in range(t) if side == "f" else range(t - 1, -1, -1):
            u = h @ self.p["U" + side]
            zr = _sigmoid(a[:, i, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(a[:, i, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            m = mask[:, i : i + 1]
            if keep is not None:
                keep.append((i, h, z, r, n, u[:, 2 * HIDDEN :], m))
            h = m * ((1 - z) * n + z * h) + (1 - m) * h
            out[:, i] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        keeps = {s: ([] if tape is not None else None) for s in "fb"}
        h = np.concatenate([self._gru(x, mask, s, keeps[s]) for s in "fb"], axis=2)
        k = np.tanh(h @ self.p["att"])
        e = np.where(mask > 0, k @ self.p["v"], -1e9)
        w = np.exp(e - e.max(axis=1, keepdims=True))
        w /= w.sum(axis=1, keepdims=True)
        pooled = (w[:, :, None] * h).sum(axis=1)
        if tape is not None:
            tape.update(x=x, h=h, k=k, w=w, pooled=pooled, keeps=keeps)
        return pooled @ self.p["out"] + self.p["bias"]

    def backward(self, tape: dict, d: np.ndarray) -> tuple[dict, np.ndarray]:
        h, k, w = tape["h"], tape["k"], tape["w"]
        g = {"out": tape["pooled"].T @ d, "bias": d.sum(keepdims=True)}
        dp = d[:, None] * self.p["out"]
        dw = (h * dp[:, None, :]).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("bt,bth->h", de, k)
        dk = de[:, :, None] * self.p["v"] * (1 - k * k)
        g["att"] = np.einsum("bth,btk->hk", h, dk)
        dh = w[:, :, None] * dp[:, None, :] + dk @ self.p["att"].T
        dx = np.zeros_like(tape["x"])
        for s, part in (("f", dh[:, :, :HIDDEN]), ("b", dh[:, :, HIDDEN:])):
            W, U = self.p["W" + s], self.p["U" + s]
            gW, gU, gc = np.zeros_like(W), np.zeros_like(U), np.zeros(3 * HIDDEN, np.float32)
            carry = np.zeros_like(part[:, 0])
            for i, before, z, r, n, un, m in reversed(tape["keeps"][s]):
                total = part[:, i] + carry
                new = total * m
                dn = new * (1 - z) * (1 - n * n)
                dz = new * (before - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                into = np.concatenate([dz, dr, dn], axis=1)
                back = np.concatenate([dz, dr, dn * r], axis=1)
                gW += tape["x"][:, i].T @ into
                gU += before.T @ back
                gc += into.sum(axis=0)
                dx[:, i] += into @ W.T
                carry = total * (1 - m) + new * z + back @ U.T
            g |= {"W" + s: gW, "U" + s: gU, "c" + s: gc}
        return g, dx

    def update(self, g: dict) -> None:
        """Adam."""
        self.step += 1
        for name, grad in g.items():
            m, v = self.state[name]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            self.p[name] -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)

    def train(self, windows: list[list[str]], labels: np.ndarray, rng: np.random.Generator) -> None:
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            batch = [windows[r] for r in rows]
            x = np.zeros((len(rows), WINDOW, DIM), np.float32)
            mask = np.zeros((len(rows), WINDOW), np.float32)
            seen = []
            for b, words in enumerate(batch):
                for t, word in enumerate(words):
                    # A word is hidden now and then, so that its characters learn too.
                    wid = self.ids.get(word, 0) if rng.random() > 0.5 else 0
                    grams = trigrams(word)
                    x[b, t] = self.p["word"][wid] + self.p["char"][grams].mean(axis=0)
                    mask[b, t] = 1
                    seen.append((b, t, wid, grams))
            tape: dict = {}
            score = _sigmoid(self.forward(x, mask, tape))
            g, dx = self.backward(tape, (score - labels[rows]).astype(np.float32) / len(rows))
            g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
            bs, ts, ws, _ = zip(*seen)
            np.add.at(g["word"], list(ws), dx[list(bs), list(ts)])
            sizes = [len(s[3]) for s in seen]
            share = np.repeat(dx[list(bs), list(ts)] / np.array(sizes)[:, None], sizes, axis=0)
            np.add.at(g["char"], np.concatenate([s[3] for s in seen]), share)
            self.update(g)

    def logits(self, windows: list[list[str]], cache: dict[str, np.ndarray]) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), CHUNK):
            part = windows[at : at + CHUNK]
            x = np.zeros((len(part), WINDOW, DIM), np.float32)
            mask = np.zeros((len(part), WINDOW), np.float32)
            for b, words in enumerate(part):
                rows = []
                for word in words:
                    row = cache.get(word)
                    if row is None:
                        row = self.word_input(word)
                        if len(cache) < CACHE_WORDS:
                            cache[word] = row
                    rows.append(row)
                x[b, : len(rows)] = rows
                mask[b, : len(rows)] = 1
            out[at : at + CHUNK] = self.forward(x, mask)
        return out

    def gates(self, words: list[str]) -> np.ndarray:
        """(word, gate, side, unit): what words add to the recurrence, halved where a sigmoid follows."""
        flat, sizes = _buckets(words)
        chars = np.add.reduceat(self.p["char"][flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None].astype(np.float32)
        x = self.p["word"][[self.ids.get(w, 0) for w in words]] + chars
        found = np.stack([(x @ self.p["W" + s] + self.p["c" + s]).reshape(-1, 3, HIDDEN) for s in "fb"], axis=2)
        found[:, :2] *= 0.5
        return found.reshape(len(words), 6 * HIDDEN)

    def scores(self, texts: list[str], memory: dict) -> np.ndarray:
        """Scores of texts; ``memory`` keeps the places of words in a table of gate inputs."""
        if len(memory.get("places", ())) > CACHE_WORDS:
            memory.clear()
        # A word that is looked up for the first time gets the next place.
        places = memory.setdefault("places", defaultdict(count().__next__))
        table = memory.get("table", np.empty((0, 6 * HIDDEN), np.float32))
        size = len(places)
        cut = [_WORD.findall(t.lower()) for t in texts]
        words = np.fromiter(map(places.__getitem__, chain.from_iterable(cut)), np.int64)
        if fresh := list(islice(reversed(places), len(places) - size))[::-1]:
            if len(places) > len(table):
                table = np.concatenate([table[:size], np.empty((max(size, 1024) + len(fresh), 6 * HIDDEN), np.float32)])
            table[size : len(places)] = self.gates(fresh)
            memory["table"] = table
        out, long, of, at = np.zeros(len(texts)), [], [], 0
        for i, n in enumerate(map(len, cut)):
            if n >= WINDOW:
                last = at + n - WINDOW
                long.append(np.r_[at:last:STRIDE, last])
                of.append(i)
            elif n:
                out[i] = _sigmoid(np.float64(self.read(table, words[at : at + n, None])[0]) - self.shift)
            at += n
        if long:
            starts, steps = np.concatenate(long), np.arange(WINDOW)[:, None]
            logits = np.concatenate([self.read(table, words[steps + starts[r : r + READ_ROWS]]) for r in range(0, len(starts), READ_ROWS)])
            begin = np.cumsum([0, *map(len, long)])[:-1]
            out[of] = _sigmoid(np.maximum.reduceat(logits, begin).astype(np.float64) - self.shift)
        return out

    def read(self, table: np.ndarray, by_step: np.ndarray) -> np.ndarray:
        """Logits of windows that are equally long, given by step as places in ``table``.

        The same network as ``forward``.  Both sides advance in one step, the backward one from
        the end.  Rows are laid out by gate, side and unit, columns by window, so that every
        operation of a step runs over one stretch of memory.
        """
        t, b = by_step.shape
        h2 = 2 * HIDDEN
        found = table.take(by_step, axis=0).reshape(t, b, 3, 2, HIDDEN)
        a = np.empty((t, 3, 2, HIDDEN, b), np.float32)
        a[:, :, 0] = found[:, :, :, 0].transpose(0, 2, 3, 1)
        a[:, :, 1] = found[::-1, :, :, 1].transpose(0, 2, 3, 1)
        a = a.reshape(t, 3 * h2, b)
        own = np.zeros((2, HIDDEN, 3, 2, HIDDEN), np.float32)
        for side, s in enumerate("fb"):
            own[side, :, :, side] = self.p["U" + s].reshape(HIDDEN, 3, HIDDEN)
        own[:, :, :2] *= 0.5
        own = own.reshape(h2, 3 * h2)
        h = np.zeros((h2, b), np.float32)
        u = np.empty((3 * h2, b), np.float32)
        both = np.empty((t, h2, b), np.float32)
        for i in range(t):
            np.matmul(h.T, own, out=u.T)
            zr = a[i, : 2 * h2]
            zr += u[: 2 * h2]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            n = u[2 * h2 :]
            n *= zr[h2:]
            n += a[i, 2 * h2 :]
            np.tanh(n, out=n)
            z = zr[:h2]
            h = np.multiply(h, z, out=both[i])
            n *= np.subtract(1, z, out=z)
            h += n
        both[:, HIDDEN:] = both[::-1, HIDDEN:]
        both = np.ascontiguousarray(both.transpose(0, 2, 1))
        flat = both.reshape(t * b, h2)
        # Summed in the order of ``forward``, whose windows are filled up to WINDOW.
        e = np.full((b, WINDOW), -1e9, np.float32)
        e[:, :t] = (np.tanh(flat @ self.p["att"]) @ self.p["v"]).reshape(t, b).T
        w = np.exp(e - e.max(axis=1, keepdims=True))
        w /= w.sum(axis=1, keepdims=True)
        pooled = (w.T[:t, :, None] * both).sum(axis=0)
        return pooled @ self.p["out"] + self.p["bias"]


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Network | None:
    """A network fitted to a bounded sample; none without rows of both labels."""
    rng = np.random.default_rng(seed)
    cut = [(windows_of(_WORD.findall(t.lower())), y) for t, y in zip(texts, labels)]
    cut = [(c, y) for c, y in cut if c]
    if len({y for _, y in cut}) < 2:
        return None
    docs = {0: Counter(), 1: Counter()}
    for c, y in cut:
        docs[y].update({w for window in c for w in window})
    n = {y: sum(1 for _, label in cut if label == y) for y in (0, 1)}
    both = docs[0] + docs[1]
    odds = {w: np.log((docs[1][w] + 0.5) / (n[1] + 1)) - np.log((docs[0][w] + 0.5) / (n[0] + 1)) for w in both}
    net = Network([w for w, _ in sorted(both.items(), key=lambda e: (-e[1], e[0]))[:WORDS]], seed)
    flat = [w for c, _ in cut for w in c]
    ends = np.cumsum([len(c) for c, _ in cut])
    for turn in range(ROUNDS):
        marks = np.array([max(odds[w] for w in window) for window in flat]) if turn == 0 else net.logits(flat, {})
        chosen, target = [], []
        for (c, y), end in zip(cut, ends):
            start = end - len(c)
            best = np.argsort(-marks[start:end], kind="stable")
            picks = best[:1] if y else np.unique(np.r_[best[:1], rng.integers(0, len(c), 1)])
            chosen += [flat[start + i] for i in picks]
            target += [y] * len(picks)
        for _ in range(-(-STEPS * BATCH // len(chosen))):
            net.train(chosen, np.array(target, np.float32), rng)
    marks = net.logits(flat, {})
    top = np.array([marks[end - len(c) : end].max() for (c, _), end in zip(cut, ends)])
    truth = np.array([y for _, y in cut])
    # The cut that parts the sample best, in the middle of its gap.
    tries = np.sort(top)
    tries = (tries[1:] + tries[:-1]) / 2
    right = [((top >= t) == truth).mean() for t in tries]
    best = np.flatnonzero(np.array(right) == max(right)) if len(right) else []
    net.shift = float(tries[best].mean()) if len(best) else 0.0
    net.state = {}
    return net


def sample(rows: DataFrame, per_label: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of about so many rows of each label, by a hash of the id."""
    share = rows.groupBy("toxic").agg((F.lit(float(per_label)) / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(stored(share, "toxic-share"), "toxic").where(place < F.col("_share")).drop("_share")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_ROWS) -> Network | None:
    usable = labels.where(~held_out() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    chosen = stored(sample(usable, per_label), "toxic-ids")
    rows = docs.join(chosen, "doc_id").select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, text) with a column ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))

    @F.pandas_udf("double", F.PandasUDFType.SCALAR_ITER)
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, cache = pickle.loads(shared.value), {}
        for texts in batches:
            # Few texts at a time: their windows are in memory together.
            parts = [texts.iloc[i : i + 64].tolist() for i in range(0, len(texts), 64)]
            yield pd.Series(np.concatenate([own.scores(p, cache) if own else np.zeros(len(p)) for p in parts] or [[]]), dtype="float64")

    return docs.withColumn("score", of_texts("text"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
