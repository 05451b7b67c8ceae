"""Periodic runs of words: a suffix automaton with link-cut access, squares, runs.

A run is a stretch of consecutive words with smallest period q, at least 24 words and
three periods long, that no neighbouring word extends with the same period.

The words of a stretch go into a suffix automaton.  Its suffix links form a tree, and the
node of a prefix has that prefix's suffixes on its path to the root.  Each appended word
walks this path by the access operation of a link-cut tree: the path falls into segments
whose texts were last seen ending at the same word, and all of it is recoloured with the
new word's number.  A segment holds the suffixes of lengths ``(low, high]``.  If the
distance d between its last end and the new one lies in that range, the suffix of length d
stands twice in a row: a square of period d, primitive because nothing ended in between.
Each square outside the run last found for its period is extended both ways to a run.

Only stretches that can hold a run enter the automaton.  In a run every sequence of eight
words stands again one period off (24 words and three periods leave room for both), so a
word outside every repeated sequence of eight, in stretches of at least 24, is in no run.
This is exact: equal hashes that are no true repeats only add words.

Rows are independent, so the plan is one map without a shuffle.  A worker holds a batch of
bounded bytes and about 40 bytes a word of the longest stretch.

Defined cases: a null text has no words; a null id keeps its words as they are in the
query's rewriting; repeated rows are judged one by one; columns besides id and text are
not read; an empty table gives an empty result.  Words are compared byte for byte.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, table

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Words of a sequence that must stand twice; at most a third of LEAST_WORDS.
SEQUENCE = 8
# Bytes of text after which a batch is handed on.
BATCH_BYTES = 8 << 20

_OUT = pa.schema([
    ("doc_id", pa.int64()),
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _numbered(words: list) -> np.ndarray:
    index: dict = {}
    return np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """The parts ``[first, end)`` of a text that can hold a run."""
    if len(ids) < LEAST_WORDS:
        return []
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x7F4A7C15)
    h ^= h >> np.uint64(31)
    for step in (1, 2, 4):
        h = h[:-step] * np.uint64(0xBF58476D1CE4E5B9) + h[step:]
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    ordered = h[order]
    twin = ordered[1:] == ordered[:-1]
    if not twin.any():
        return []
    repeated = np.zeros(len(h) + 2, bool)
    repeated[order[1:][twin] + 1] = True
    repeated[order[:-1][twin] + 1] = True
    edges = np.flatnonzero(repeated[1:] != repeated[:-1])
    first, end = edges[::2], edges[1::2] + SEQUENCE - 1
    wide = end - first >= LEAST_WORDS
    return list(zip(first[wide].tolist(), end[wide].tolist()))


def _automaton(ids: list[int]) -> tuple[array, array, array]:
    """Length and suffix link of every state, and the state of every prefix.

    State 1 is the empty text, 0 means none.  A state's first transition lies in two
    arrays; only states with several have a dictionary.
    """
    length, link, word, target = array("i", [0, 0]), array("i", [0, 0]), array("i", [-1, -1]), array("i", [0, 0])
    more: dict[int, dict[int, int]] = {}
    ends, last = array("i"), 1
    for c in ids:
        new, p, q = len(length), last, 0
        length.append(length[last] + 1), link.append(0), word.append(-1), target.append(0)
        while p:
            if word[p] == c:
                q = target[p]
                break
            if word[p] < 0:
                word[p], target[p] = c, new
            else:
                others = more.setdefault(p, {})
                q = others.get(c, 0)
                if q:
                    break
                others[c] = new
            p = link[p]
        if not p:
            link[new] = 1
        elif length[p] + 1 == length[q]:
            link[new] = q
        else:
            twin = len(length)
            length.append(length[p] + 1), link.append(link[q]), word.append(word[q]), target.append(target[q])
            if q in more:
                more[twin] = dict(more[q])
            link[q] = link[new] = twin
            while p:
                if word[p] == c:
                    if target[p] != q:
                        break
                    target[p] = twin
                else:
                    others = more.get(p)
                    if others is None or others.get(c) != q:
                        break
                    others[c] = twin
                p = link[p]
        ends.append(new)
        last = new
    return length, link, ends


def squares(ids: list[int]) -> Iterator[tuple[int, int]]:
    """(last word, period) of every primitive square, in the order of their ends."""
    length, link, ends = _automaton(ids)
    # Splay trees over path segments: left is towards the root of the suffix links.  ``up``
    # is the splay parent, or at a segment's splay root the state above the segment.
    up, left, right = array("i", link), array("i", bytes(4 * len(link))), array("i", bytes(4 * len(link)))
    up[1] = 0
    seen = array("i", [-1]) * len(link)  # last end, valid at a segment's splay root

    def rotate(x: int, p: int) -> None:
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            seen[x] = seen[p]

    for i, state in enumerate(ends):
        below, x = 0, state
        while x:
            p = up[x]
            while p and (left[p] == x or right[p] == x):
                g = up[p]
                if g and (left[g] == p or right[g] == p):
                    if (left[g] == p) == (left[p] == x):
                        rotate(p, g)
                    else:
                        rotate(x, p)
                    rotate(x, up[x])
                else:
                    rotate(x, p)
                p = up[x]
            end = seen[x]
            if end >= 0 and length[p] < i - end <= length[x]:
                yield i, i - end
            lower = right[x]
            if lower:
                seen[lower] = end
            right[x] = below
            below, x = x, p
        seen[below] = i


def _extended(ids: np.ndarray, at: int, step: int, period: int) -> int:
    """How many words from ``at`` on, by ``step``, equal the word one period back."""
    total, width = 0, 64
    while True:
        if step > 0:
            a = ids[at + total : at + total + width]
            b = ids[at + total - period : at + total - period + len(a)]
        else:
            low = max(0, at - total - width + 1)
            a = ids[low : at - total + 1][::-1]
            b = ids[low + period : at - total + 1 + period][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total += len(a)
        if len(a) < width:
            return total
        width *= 2


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found = set()  # neighbouring stretches share a few words, which may lie in a run of one of them
    for first, end in stretches(ids):
        reach: dict[int, int] = {}
        for last, period in squares(ids[first:end].tolist()):
            last += first
            if reach.get(period, -1) >= last:
                continue
            stop = last + 1 + _extended(ids, last + 1, 1, period)
            head = last - 2 * period + 1
            start = head - _extended(ids, head - 1, -1, period) if head else 0
            reach[period] = stop - 1
            if stop - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found.add((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [w for w, k in zip(words, kept.tolist()) if k]


def looped(words: list, doc_id: int | None) -> list:
    """The query's rewriting: in a tenth of the documents the tail repeats its beginning."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _found(rewrite: bool):
    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, words = doc_id.as_py(), text.as_py().split()
                if rewrite:
                    words = looped(words, doc_id)
                runs = runs_of(_numbered(words))
                left = b" ".join(collapsed(words, runs))
                rows.append((doc_id, len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], left))
                held += len(left)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)

    return batches_of


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, runs, collapsed (the text without repeats).

    ``rewrite`` applies ``looped`` to the words first.
    """
    texts = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(_found(rewrite), SCHEMA)


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    better = lambda a, b: (a.length * b.period > b.length * a.period) | (
        (a.length * b.period == b.length * a.period) & (F.struct(a.start, a.period) <= F.struct(b.start, b.period)))
    return F.reduce(runs, F.element_at(runs, 1), lambda a, b: F.when(better(a, b), a).otherwise(b))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), rewrite=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    listed = F.array_join(lines, "")
    best = F.when(F.size("runs") > 0, greatest(F.col("runs")))
    rows = found.select("doc_id", "n_words", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"))
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


# crc32 bit by bit, least bit first, over the decimal id; words q apart that are equal, as islands.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda s: list_transform(range(8), lambda k: (ascii(s) >> k::INTEGER)::BIGINT & 1)))),
      lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS h
  FROM documents
), f AS (
  SELECT *, len(words) AS n, (h // 10) % nullif(len(words), 0) AS a, 3 + (h // 10) % 8 AS parts FROM d
), w AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // parts) ELSE i END]) ELSE words END AS words
  FROM f
), e AS MATERIALIZED (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
q AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM q),
s AS MATERIALIZED (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)
), r AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS q FROM s GROUP BY doc_id, start, length
), t AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
    first({'start': start, 'length': length, 'q': q} ORDER BY length::DOUBLE / q DESC, start, q) AS best
  FROM r GROUP BY doc_id
), k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM e WHERE NOT EXISTS (FROM r WHERE r.doc_id = e.doc_id AND e.i >= r.start + r.q AND e.i < r.start + r.length) GROUP BY doc_id
)
SELECT w.doc_id, coalesce(t.n_runs, 0) AS n_runs, t.best.start AS start, t.best.length AS length, t.best.q AS period,
  1000 * t.best.length // t.best.q AS exponent_milli, sha256(coalesce(t.listed, '')) AS runs_sha256,
  sha256(coalesce(k.kept, '')) AS collapsed_sha256, w.n AS n_words
FROM w LEFT JOIN t ON t.doc_id = w.doc_id LEFT JOIN k ON k.doc_id = w.doc_id
"""
