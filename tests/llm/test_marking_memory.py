from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd

from listenlake.llm import suffix_dedup

NAMES = ["anchor", "left", "width", "digest", "n", "hot", "context"]


def contexts(anchor: int, n: int) -> list[tuple]:
    """Contexts around one anchor, of many lefts and widths; every other one shares its middle with the one before."""
    random, rows = np.random.default_rng(anchor), []
    for i in range(n):
        if i % 2 == 0:
            body = random.integers(97, 123, suffix_dedup.COLUMNS, dtype=np.uint8)
        else:
            body = body.copy()
            body[random.integers(0, 300)] = body[random.integers(500, suffix_dedup.COLUMNS)] = 48
        left = int(random.integers(0, suffix_dedup.PLACES))
        width = int(random.integers(1, left + 2))
        begin = suffix_dedup.PLACES - 1 - left
        cut = body[begin : begin + width + suffix_dedup.LENGTH - 1].tobytes()
        rows.append((anchor, left, width, i, 1 + (i % 7 == 0), False, cut))
    return rows


def batches(rows: list[tuple], size: int) -> list[pd.DataFrame]:
    return [pd.DataFrame(rows[i : i + size], columns=NAMES) for i in range(0, len(rows), size)]


def test_stretches_of_columns_mark_as_by_brute_force(monkeypatch):
    rows = [r for anchor, n in ((1, 3), (2, 90), (3, 1), (4, 1), (5, 40), (6, 2)) for r in contexts(anchor, n)]
    seen = Counter()
    for anchor, left, width, _, n, _, cut in rows:
        for s in range(width):
            seen[anchor, left - s, cut[s : s + 400]] += n
    expected = {
        (anchor, digest, s) for anchor, left, width, digest, _, _, cut in rows for s in range(width)
        if seen[anchor, left - s, cut[s : s + 400]] > 1
    }
    for strings, some, size in ((2**20, 1024, 1000), (2000, 8, 1000), (400, 2, 11)):
        monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
        monkeypatch.setattr(suffix_dedup, "ROWS", some)
        marks = pd.concat(suffix_dedup._mark(iter(batches(rows, size))), ignore_index=True)
        found = [
            (m["anchor"], m["digest"], s) for m in marks.to_dict("records") for s in range(m["from"], m["to"] - 400 + 1)
        ]
        assert len(found) == len(set(found)) and set(found) == expected


def test_memory_of_marking_does_not_follow_the_contexts_of_an_anchor():
    def peak(n: int) -> float:
        body = np.random.default_rng(n).integers(97, 123, (n, suffix_dedup.COLUMNS), dtype=np.uint8)
        rows = [(1, suffix_dedup.PLACES - 1, suffix_dedup.PLACES, i, 1, False, b.tobytes()) for i, b in enumerate(body)]
        given = batches(rows, n)
        del body, rows
        tracemalloc.start()
        for _ in suffix_dedup._mark(iter(given)):
            pass
        most = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        return most

    # 3.0 million strings; taken together they needed 264 MB.
    assert peak(8000) < 160
