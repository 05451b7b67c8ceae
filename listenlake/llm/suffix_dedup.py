"""Removal of byte strings that repeat: every 400-byte string that starts anywhere else.

The column-wise construction of a collection's suffix order inserts one symbol per
document and round.  Run over whole documents it needs as many rounds, each over all
external files, as the longest document has bytes; the README gives the figures and
says why it is not used over the whole collection here.  What is kept of it is the
column-wise pass, on short aligned contexts:

1. Each 400-byte string picks an anchor, its leftmost 32-byte string of least hash.
   Equal strings pick the same anchor at the same place.  A run of strings that
   share an anchor is one row.
2. Anchors whose hash occurs once hold no repeat and end there.  The others carry their
   context, at most 768 bytes; equal contexts are folded before the shuffle.
3. Contexts of one anchor are aligned and read column by column, each adding one
   symbol's value to a running sum; two sums 400 columns apart identify a string.
   Strings that occur twice are marked.  Equal strings stand in the same column, so an
   anchor of many contexts is marked in stretches of columns, ``STRINGS`` strings at a
   time.  An anchor with more than ``ANCHOR_CONTEXTS`` distinct contexts has its strings
   counted by a plain aggregate over all tasks.
4. The marked places return to their documents.

A string is identified by a 64-bit sum of random values, next to a 64-bit anchor hash.

Defined cases: a null text is an empty one; a shorter text keeps all bytes; rows that
repeat are documents of their own, so all their strings repeat; a null id stays null;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, stored, table

LENGTH = 400
GRAM = 32
# Starts a string offers to its anchor, and the columns of an aligned context.
PLACES = LENGTH - GRAM + 1
COLUMNS = PLACES - 1 + LENGTH
# Contexts whose columns are summed at a time.
ROWS = 1024
# Strings compared at a time, about 90 bytes of a worker's memory each.
STRINGS = 2**20

# Contexts of an anchor up to which one task reads them; beyond it their strings are counted one by one.
ANCHOR_CONTEXTS = 20_000
# Rows handed on at a time.
FLUSH_ROWS = 20_000
_HIGH = np.uint64(0xFFFFFFFF00000000)
_SYMBOLS = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)

_ANCHORS = "row long, anchor long, left int, start long, width int, digest long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first start, last start) of each run of strings with one anchor."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    h, factor, size = _SYMBOLS[np.frombuffer(data, np.uint8)], np.array([0x9E3779B97F4A7C15], np.uint64), 1
    while size < GRAM:
        # The hash of twice as many bytes, as a polynomial.
        h = h[:-size] * factor + h[size:]
        factor, size = factor * factor, 2 * size
    h = _mixed(h)
    # Half a hash, then the place: the least is the leftmost of least hash.
    least, size = (h & _HIGH) | np.arange(len(h), dtype=np.uint64), 1
    while size < PLACES:
        # The least of ``size`` places becomes that of twice as many, or of PLACES at last.
        step = min(size, PLACES - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    place = (least & ~_HIGH).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], n] - 1
    return h[place[first]], place[first], first, last


def _find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash

    for batch in batches:
        parts, held = [], 0
        for row, text in zip(batch["row"], batch["text"]):
            data = text.encode()
            h, place, first, last = anchors(data)
            if len(h):
                view = memoryview(data)
                digests = [xxhash.xxh64_intdigest(view[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())]
                parts.append((np.full(len(h), row), h, place - first, first, last - first + 1, np.array(digests, np.uint64)))
                held += len(h)
            if held >= FLUSH_ROWS:
                yield _anchor_frame(parts)
                parts, held = [], 0
        if parts:
            yield _anchor_frame(parts)


def _anchor_frame(parts: list[tuple]) -> pd.DataFrame:
    row, h, left, start, width, digest = (np.concatenate(c) for c in zip(*parts))
    return pd.DataFrame({
        "row": row, "anchor": h.view(np.int64), "left": left.astype(np.int32), "start": start,
        "width": width.astype(np.int32), "digest": digest.view(np.int64),
    })


def _cut_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["anchor", "left", "width", "digest", "n", "hot", "context"]
    for batch in batches:
        rows = []
        for text, places in zip(batch["text"], batch["places"]):
            data = text.encode()
            for p in places:
                context = data[p["start"] : p["start"] + p["width"] + LENGTH - 1]
                rows.append((p["anchor"], p["left"], p["width"], p["digest"], p["n"], p["hot"], context))
            if len(rows) >= FLUSH_ROWS:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)


def _sums(
    group: pd.DataFrame, values: np.ndarray, first: int = 0, end: int = PLACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the group, start inside its context, identity) of every string of the columns from ``first`` to before ``end``."""
    rows, starts, keys = [], [], []
    read = np.arange(first, end + LENGTH - 1)
    for at in range(0, len(group), ROWS):
        part = group.iloc[at : at + ROWS]
        left, width = part["left"].to_numpy(np.int64), part["width"].to_numpy(np.int64)
        grid = np.zeros((len(part), COLUMNS), np.uint8)
        for i, context in enumerate(part["context"]):
            shift = PLACES - 1 - left[i]
            grid[i, shift : shift + len(context)] = np.frombuffer(context, np.uint8)
        total = np.zeros((len(part), len(read) + 1), np.uint64)
        np.cumsum(values[read, grid[:, first : end + LENGTH - 1]], axis=1, out=total[:, 1:])
        identity = total[:, LENGTH:] - total[:, :-LENGTH]
        column = np.arange(first, end)[None, :] - (PLACES - 1 - left)[:, None]
        i, c = np.nonzero((column >= 0) & (column < width[:, None]))
        anchor = part["anchor"].to_numpy(np.int64).view(np.uint64)[i]
        rows.append(i + at)
        starts.append(column[i, c])
        keys.append(_mixed(identity[i, c] + _mixed(anchor + (c + first).astype(np.uint64))))
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(keys)


def _marks_of(group: pd.DataFrame, values: np.ndarray) -> pd.DataFrame:
    """The runs of repeated starts of each context."""
    out = []
    if len(group):
        folded = group["n"].to_numpy() > 1
        # A column of no hits at either end, where runs begin and end.
        hits = np.zeros((len(group), PLACES + 2), bool)
        step = max(1, STRINGS // len(group))
        for first in range(0, PLACES, step):
            rows, starts, keys = _sums(group, values, first, min(first + step, PLACES))
            _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
            hits[rows, starts + 1] = (counts[inverse] > 1) | folded[rows]
        rows, begin = np.nonzero(hits[:, 1:] & ~hits[:, :-1])
        _, end = np.nonzero(hits[:, :-1] & ~hits[:, 1:])
        if len(rows):
            of = group.iloc[rows]
            out = {"anchor": of["anchor"].to_numpy(), "left": of["left"].to_numpy(), "width": of["width"].to_numpy(),
                   "digest": of["digest"].to_numpy(), "from": begin, "to": end - 1 + LENGTH}
    return pd.DataFrame(out, columns=["anchor", "left", "width", "digest", "from", "to"])


def _values() -> np.ndarray:
    """A random value of each symbol in each column."""
    return np.random.default_rng(11).integers(0, 2**64, (COLUMNS, 256), dtype=np.uint64)


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of a context with its identity, for anchors that are counted string by string."""
    values = _values()
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            group = batch.iloc[at : at + ROWS]
            rows, starts, keys = _sums(group, values)
            of = group.iloc[rows][["anchor", "left", "width", "digest", "n"]].reset_index(drop=True)
            yield of.assign(**{"from": starts, "key": keys.view(np.int64)})


def _mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; an anchor's rows may run over a batch's end."""
    values, held = _values(), None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        anchor = held["anchor"].to_numpy()
        begin = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        # Whole anchors, ROWS contexts at a time as far as one has no more.
        at = 0
        while at < begin[-1]:
            far = np.searchsorted(begin, at + ROWS, "right") - 1
            to = begin[far] if begin[far] > at else begin[far + 1]
            yield _marks_of(held.iloc[at:to], values)
            at = to
        held = held.iloc[at:]
    if held is not None:
        yield _marks_of(held, values)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, marks in zip(batch["doc_id"].astype("Int64"), batch["text"], batch["marks"]):
            data = np.frombuffer(text.encode(), np.uint8)
            depth = np.zeros(len(data) + 1, np.int64)
            for mark in marks if marks is not None else ():
                depth[mark["from"]] += 1
                depth[mark["to"]] -= 1
            gone = np.cumsum(depth)[:-1] > 0
            spans = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])) if len(gone) else 0
            kept = data[~gone].tobytes()
            rows.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        made = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        yield made.assign(doc_id=made["doc_id"].astype("Int64"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchor_contexts: int = ANCHOR_CONTEXTS
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept."""
    narrow = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "repeat-docs")
    runs = stored(rows.select("row", "text").mapInPandas(_find_anchors, _ANCHORS), "repeat-anchors")
    # Stored, so that the join sees two plain shuffles and can split a hot anchor.
    again = stored(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor"), "repeat-again")
    runs = stored(runs.join(again, "anchor", "left_semi"), "repeat-candidates")
    what = ["anchor", "left", "width", "digest"]
    # Of equal contexts one is cut from its document.
    folded = runs.groupBy(*what).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("at"))
    folded = stored(folded, "repeat-folded")
    many = folded.groupBy("anchor").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > anchor_contexts)
    many = stored(many.select("anchor", F.lit(True).alias("hot")), "repeat-hot")
    wanted = folded.join(many, "anchor", "left").select(
        F.col("at.row").alias("row"),
        F.struct(*what, "n", F.coalesce("hot", F.lit(False)).alias("hot"), F.col("at.start").alias("start")).alias("p"),
    )
    cut = rows.select("row", "text").join(wanted.groupBy("row").agg(F.collect_list("p").alias("places")), "row")
    contexts = cut.select("text", "places").mapInPandas(
        _cut_contexts, "anchor long, left int, width int, digest long, n long, hot boolean, context binary"
    )
    contexts = stored(contexts, "repeat-contexts")
    dealt = contexts.where("not hot").repartition("anchor").sortWithinPartitions("anchor")
    marks = dealt.mapInPandas(_mark, "anchor long, left int, width int, digest long, from long, to long")
    # A hot anchor's strings are counted with a partial step, in as many tasks as there are.
    spelt = contexts.where("hot").mapInPandas(
        _spell, "anchor long, left int, width int, digest long, n long, from long, key long"
    )
    repeated = stored(spelt.groupBy("key").agg(F.sum("n").alias("_n")).where("_n > 1").select("key"), "repeat-strings")
    single = spelt.join(repeated, "key", "left_semi").select(*what, "from", (F.col("from") + LENGTH).alias("to"))
    marks = stored(marks.unionByName(single), "repeat-marks")
    placed = runs.join(marks, what).select(
        "row", F.struct((F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to")).alias("m")
    )
    marked = rows.join(placed.groupBy("row").agg(F.collect_list("m").alias("marks")), "row", "left")
    return marked.select("doc_id", "text", "marks").mapInPandas(_remove, _RESULT)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``has_repeats``: whether a document shares a string of 400 bytes with another place."""
    removed = remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
    return removed.withColumn("has_repeats", F.col("n_removed") > 0)
