"""SimHash near-dedup: segment popcounts, a grid join, an exact check, components.

A fingerprint maps to the bit counts of its segments.  The Manhattan distance of two
such vectors is at most the bit distance of the fingerprints, so it bounds it from
below.  Segments of two bits are used, in two halves of sixteen.  If two fingerprints
differ by at most three bits, the vectors of one half lie at most one apart.  So each
fingerprint is entered, per half, in the grid cell of its own vector, and looks in that
cell and in those one count higher; of two vectors that are one apart, one looks up
and finds the other.  Whatever meets in a cell is verified by the bit distance.

Equal fingerprints are folded before the join.  A cell hands on only a spanning star of
what it found linked, never all pairs.  A cell with more than ``CELL`` entries is split
into blocks, and every pair of blocks is a cell of its own, so no link is lost and no
task holds a hot cell.  Components come from contracting edges by random ranks, in a
logarithmic number of rounds, each written to the shared folder.

Defined cases: a null text is an empty one, with fingerprint zero, which links like any
other; fewer words than a shingle make one shingle; a null id takes part but is never a
component's id, unless all are null; repeated rows share a component; other columns
are not read by ``components`` and are carried by ``representatives``; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import stored, table, text_of
from listenlake.llm.components import contract as contract_edges

SHINGLE = 3
DISTANCE = 3
SEED = 42
# Entries and searches a grid cell holds before it is split into blocks.
CELL = 2000
# Shingle hashes whose bits are unpacked at a time.
CHUNK = 1 << 16
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_EDGES = "a long, b long"


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(p.encode(), SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of_texts(text)


def _grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entry and searches of each fingerprint: rows of (cell, fp, enters)."""
    low = np.uint64(0x5555555555555555)
    for batch in batches:
        fp = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        # Two-bit fields, each with the bit count of its segment.
        counts = (fp & low) + ((fp >> np.uint64(1)) & low)
        for half in (0, 1):
            own = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            tag = np.uint64(half << 32)
            yield pd.DataFrame({"cell": (own | tag).view(np.int64), "fp": fp.view(np.int64), "enters": True})
            for segment in range(16):
                shift = np.uint64(2 * segment)
                some = ((own >> shift) & np.uint64(3)) < 2
                cell = (own[some] + (np.uint64(1) << shift)) | tag
                yield pd.DataFrame({"cell": cell.view(np.int64), "fp": fp[some].view(np.int64), "enters": False})


def _stars(entries: np.ndarray, searches: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning star for each set of entries and searches that hang together."""
    near = np.bitwise_count(entries[:, None] ^ searches[None, :]) <= distance
    fresh_e, fresh_s = np.ones(len(entries), bool), np.ones(len(searches), bool)
    edges = []
    for first in range(len(entries)):
        if not fresh_e[first]:
            continue
        fresh_e[first] = False
        front, members = np.array([first]), [entries[[first]]]
        while len(front):
            reach = np.flatnonzero(near[front].any(axis=0) & fresh_s)
            fresh_s[reach] = False
            members.append(searches[reach])
            front = np.flatnonzero(near[:, reach].any(axis=1) & fresh_e) if len(reach) else reach
            fresh_e[front] = False
            members.append(entries[front])
        found = np.unique(np.concatenate(members).view(np.int64))
        edges.extend((int(found[0]), int(x)) for x in found[1:])
    return edges


def _cell_links(distance: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by cell and block; a group may run over a batch's end."""
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = _starts(held)[-1]
            yield _links_of(held.iloc[:last], distance)
            held = held.iloc[last:]
        if held is not None and len(held):
            yield _links_of(held, distance)

    return links


def _starts(rows: pd.DataFrame) -> np.ndarray:
    cell, block = rows["cell"].to_numpy(), rows["block"].to_numpy()
    return np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (block[1:] != block[:-1])])


def _links_of(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    edges: list[tuple[int, int]] = []
    if len(rows):
        fp, enters = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64), rows["enters"].to_numpy(dtype=bool)
        starts = _starts(rows)
        ends = np.r_[starts[1:], len(rows)]
        for start, end in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            mask = enters[start:end]
            if mask.any():
                edges += _stars(fp[start:end][mask], fp[start:end], distance)
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges between distinct fingerprints whose components are those of all links."""
    if not 0 <= distance <= 3:
        raise ValueError("the grid finds distances up to 3")
    cells = stored(fps.select("fp").mapInPandas(_grid, "cell long, fp long, enters boolean"), "simhash-cells")
    hot = stored(
        cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
        .select("cell", F.ceil(F.col("n") / CELL).cast("int").alias("blocks")),
        "simhash-hot",
    )
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # Block pair (i, j) meets the entries of block i with all rows of block j.
    every = F.sequence(F.lit(0), blocks - 1)
    as_entry = F.transform(every, lambda j: F.struct((mine * blocks + j).alias("block"), F.lit(True).alias("enters")))
    as_search = F.transform(every, lambda i: F.struct((i * blocks + mine).alias("block"), F.lit(False).alias("enters")))
    alone = F.array(F.struct(F.lit(0).alias("block"), F.col("enters")))
    places = F.when(blocks == 1, alone).when(F.col("enters"), F.concat(as_entry, as_search)).otherwise(as_search)
    dealt = cells.join(hot, "cell", "left").select("cell", "fp", F.explode(places).alias("p")).select(
        "cell", "fp", "p.block", "p.enters"
    )
    sorted_cells = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block")
    return sorted_cells.mapInPandas(_cell_links(distance), _EDGES).distinct()


def contract(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of an edge; root is one fingerprint per component."""
    return contract_edges(edges).withColumnRenamed("node", "fp")


def _components(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id) of every fingerprint in ``rows`` of (doc_id, fp)."""
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    rooted = fps.join(contract(links(fps, distance)), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stored(rooted.join(ids, "root").select("fp", "component_id"), "simhash-components")


def components(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprints(text_of(text_col), shingle).alias("fp")), "simhash-rows")
    found = rows.join(_components(rows, distance), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Of each component the document with the smallest id, with all its columns; of
    repeated rows one.  Only ids and fingerprints are compared and shuffled in bulk."""
    whole = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("doc_id"),
            fingerprints(text_of(text_col), shingle).alias("fp"), F.monotonically_increasing_id().alias("_row"),
        ),
        "simhash-docs",
    )
    rows = whole.select("doc_id", "fp", "_row")
    found = rows.join(_components(rows, distance), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = found.groupBy("component_id").agg(F.min("_row").alias("_row"))
    return whole.join(stays, "_row", "left_semi").select("_doc.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))
