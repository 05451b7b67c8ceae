"""Periodic runs, the Jaccard join and the prefix trie against brute-force versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlake.llm import components, jaccard_join, periodic_runs, prefix_trie

SCHEMA = "doc_id long, text string, source string, n long, runs string, key string, label string"
WORDS = ["".join(np.random.default_rng(i).choice(list("abcdefgäß"), 5)) for i in range(200)]


def prose(n: int, seed: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def frame(spark, texts, extra=()):
    rows = [(i, t, None, i, "r", None, "l") for i, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Periodic runs


def brute_runs(words):
    """Every maximal stretch in which words q apart are equal; of equal stretches the least q."""
    found, taken = [], set()
    for q in range(1, len(words) // 2 + 1):
        start = None
        for i in range(len(words) - q + 1):
            equal = i + q < len(words) and words[i] == words[i + q]
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                length = i - start + q
                if length >= 2 * q and (start, length) not in taken:
                    taken.add((start, length))
                    if length >= max(24, 3 * q):
                        found.append((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


RUN_TEXTS = [
    None, "", " \t\n", "a " * 23, "a " * 24, "a\n" * 400, "a b c " * 8, "a b c " * 8 + "a b", "x " + "a b c d e f g h i " * 3 + "y",
    prose(30, 1) + " " + "p q r " * 10 + "p q s " * 10 + prose(30, 2), ("a a b " * 9 + "c ") * 3, prose(7, 3) + " " + (prose(40, 4) + " ") * 4,
    prose(1500, 5), "ä Ä " * 20, "one", (prose(500, 6) + " ") * 2, "a b " * 700 + prose(300, 7),
]


def test_random_words_have_the_brute_force_runs():
    rng = np.random.default_rng(1)
    for _ in range(400):
        words = rng.integers(0, int(rng.integers(1, 6)), int(rng.integers(0, 160)))
        for _ in range(int(rng.integers(0, 4)) if len(words) > 10 else 0):
            at, p = int(rng.integers(0, len(words))), int(rng.integers(1, 20))
            for i in range(at + p, min(len(words), at + int(rng.integers(10, 120)))):
                words[i] = words[i - p]
        assert periodic_runs.runs_of(words) == brute_runs(words.tolist())


def test_squares_are_the_primitive_ones():
    rng = np.random.default_rng(2)
    for _ in range(200):
        words = rng.integers(0, 3, int(rng.integers(1, 40))).tolist()
        primitive = lambda u: all(u != u[:k] * (len(u) // k) for k in range(1, len(u)) if len(u) % k == 0)
        expected = {(i, d) for i in range(len(words)) for d in range(1, (i + 1) // 2 + 1)
                    if words[i - d + 1 : i + 1] == words[i - 2 * d + 1 : i - d + 1] and primitive(words[i - d + 1 : i + 1])}
        assert set(periodic_runs.squares(words)) == expected


def test_runs_and_collapsed_texts(spark):
    docs = frame(spark, RUN_TEXTS, [(None, "k l " * 20, None, None, None, None, None)] * 2)
    expected = Counter()
    for i, text in [*enumerate(RUN_TEXTS), (None, "k l " * 20), (None, "k l " * 20)]:
        words = words_of(text)
        runs = brute_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        expected[i, len(words), tuple(runs), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    found = Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic_runs.find_runs(docs).collect())
    assert found == expected


def rewritten(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_query_columns(spark, tmp_path):
    texts = [prose(60 + i, i) if i % 7 else None for i in range(80)] + RUN_TEXTS[3:12]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    expected = set()
    for i, text in enumerate(texts):
        words = rewritten(words_of(text), i)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        expected.add((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                      sha(" ".join(w for k, w in enumerate(words) if k not in gone)), len(words)))
    assert {tuple(r) for r in periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()} == expected


# Jaccard join


def shingle_set(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute_join(rows):
    sets = sorted({s for _, s in rows if s}, key=sorted)
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[top(i)] = top(j)
    where = {s: top(i) for i, s in enumerate(sets)}
    first = {}
    for i, s in rows:
        if s and i is not None:
            first[where[s]] = min(i, first.get(where[s], i))
    return Counter((i, len(s), first.get(where[s]) if s else i) for i, s in rows)


def near_copies():
    """Families in which some links hold only over others, shared passages, all odd cases."""
    texts = [None, "", " \n", "One", "one", "two words", "Two  WORDS", "a b c", "a b c d", "A B C D", prose(5000, 9), prose(5000, 9) + " x", "w " * 3000]
    passage = prose(60, 50)
    for family in range(6):
        rng = np.random.default_rng(family)
        words = prose(120, family).split()
        for copy in range(12):
            if copy % 4 != 3:
                words = list(words)
                words[int(rng.integers(0, len(words)))] = f"new{family}x{copy}"
            texts.append(" ".join(words))
    texts += [prose(40, 100 + k) + " " + passage + " " + prose(40, 200 + k) for k in range(30)]
    return texts


@pytest.mark.parametrize("limits", [{}, {"most_rows": 3, "levels": 0}, {"most_rows": 3, "levels": 1}, {"most_shingles": 600}])
def test_join_equals_brute_force(spark, limits):
    texts = near_copies()
    docs = frame(spark, texts, [(None, texts[20], "s", 1, "", "", ""), (None, "nobody else", "s", 1, "", "", ""), (20, texts[20], "s", 1, "", "", "")])
    rows = [*enumerate(map(shingle_set, texts)), (None, shingle_set(texts[20])), (None, shingle_set("nobody else")), (20, shingle_set(texts[20]))]
    assert rows_of(jaccard_join.components(docs, **limits)) == brute_join(rows)


def test_join_without_small_cells_and_frequent_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_CELL", 1)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 40)
    texts = near_copies()
    assert rows_of(jaccard_join.components(frame(spark, texts))) == brute_join(list(enumerate(map(shingle_set, texts))))


def test_common_counts_shared_shingles():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, int(rng.integers(1, 4000)))).astype(np.uint64) for _ in range(9)]
    expected = [[len(np.intersect1d(a, b)) if i != j else None for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    found = jaccard_join._common(sets)
    assert all(found[i, j] == expected[i][j] for i in range(9) for j in range(9) if i != j)


@pytest.mark.parametrize("kind", ["rising", "shuffled"])
def test_a_chain_of_a_thousand_contracts_in_few_rounds(spark, monkeypatch, kind):
    rounds = []
    stored = components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: (rounds.append(label), stored(df, label))[1])
    nodes = list(range(1000)) if kind == "rising" else np.random.default_rng(3).permutation(1000).tolist()
    edges = spark.createDataFrame([*zip(nodes, nodes[1:]), (5000, 5001)], "a long, b long").coalesce(2)
    found = components.contract(edges).collect()
    assert len({r.root for r in found if r.node < 1000}) == 1 and len({r.root for r in found}) == 2 and len(found) == 1002
    assert rounds.count("components-parents") <= 20


# Prefix trie


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role, text))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return nodes_of(whole)


def nodes_of(whole):
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = set()
    for node, convs in members.items():
        inside = [m for m in members if m[: len(node)] == node]
        leaves = sum(not any(len(k) == len(m) + 1 and k[: len(m)] == m for k in members) for m in inside)
        saved = sum((len(members[m]) - 1) * (len(m[-1][1].encode()) if m else 0) for m in inside)
        ended = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                 sum(len(k) == len(node) + 1 and k[: len(node)] == node for k in members), leaves, saved, hashlib.sha256(ended.encode()).hexdigest()))
    return out


TURNS = "conv_id long, turn long, role string, text string, depth long, part string, v long"


def conversations():
    rng = np.random.default_rng(6)
    rows = []
    for c in [*range(-12, 40), 60, 61, 1003]:
        for t in range(int(rng.integers(1, 14))):
            text = [None, "", "hello", "é" * 3, f"say {c}"][int(rng.integers(0, 5)) if t > 2 else t + 1]
            rows.append((c, None if t == 0 and c % 3 == 0 else t, [None, "user", "assistant"][t % 3], text))
    return rows + [(7, 3, "user", "same turn"), (7, 3, "user", "same turn"), (None, 1, "user", "nobody")]


@pytest.mark.parametrize("walked", [16384, 10])
def test_trie_equals_brute_force(spark, walked):
    rows = [r for r in conversations() if r[0] != 7] + [(7, 3, "user", "same turn"), (7, 3, "user", "same turn"), (7, None, None, None)]
    turns = spark.createDataFrame([(*r, 9, "p", 1) for r in rows], TURNS).repartition(5)
    found = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(turns)), walked=walked).collect()
    assert {tuple(r) for r in found} == brute_trie(rows) and len(found) == len(brute_trie(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = [(c, t, "user", f"{t % 3 if t < 5 else c}") for c in range(30) for t in range(c % 9)]
    rows += [(500, t, "user", f"z{t}") for t in range(700)]
    seq = prefix_trie.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    found = prefix_trie.trie(seq, prefix_trie.lengths(seq), walked=200)
    deep = {c: tuple(t) for c, t in own.items() if c != 500}
    assert {tuple(r) for r in found.where("depth < 12 and conv_id < 500 and depth > 2").collect()} == {r for r in nodes_of(deep) if r[1] > 2}
    assert found.where("conv_id = 500").agg(F.max("depth"), F.count("*")).first() == (700, 700)


def test_equal_turns_do_not_depend_on_the_order_of_rows(spark):
    rows = [(c, 1, r, t) for c in (0, 5, 10) for r, t in (("user", "x"), ("user", "y"), (None, "x"))]
    one, two = (spark.createDataFrame(x, "conv_id long, turn long, role string, text string").coalesce(1) for x in (rows, rows[::-1]))
    assert rows_of(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(one)))) == rows_of(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(two))))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert periodic_runs.find_runs(docs).count() == 0
    assert jaccard_join.components(docs).count() == 0
    seq = prefix_trie.numbered(spark.createDataFrame([], TURNS))
    assert prefix_trie.trie(*prefix_trie.rebuilt(seq)).count() == 0
