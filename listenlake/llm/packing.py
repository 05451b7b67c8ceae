"""Packing: cost-balanced, into sequences of a fixed number of tokens.

A document's ids are cut into whole sequences as long as they fill one; what is left,
its tail, is packed.  Tails are dealt by a hash to groups of bounded size.  A group
opens as many sequences as its tokens need, takes the tails by falling cost (linear
plus quadratic in the length, as attention costs) and gives each to the sequence of
the lowest cost that has room.  A tail that fits nowhere is cut over the sequences
with most room.  So a group pads less than one sequence, which is about a
thousandth of its tokens.

Only tails are shuffled, with their ids; the pieces that fill a sequence stay where
they were made.  Tokenised rows are written once, so a lost executor costs a re-read.

Defined cases: a null text is an empty one and has the end id alone; a null id stays
null; repeated rows are documents of their own; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, stored, table

CAPACITY = 2048
END_ID = 1
# Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
# Tails per group: at most CAPACITY * 4 bytes each, so a group stays below 16 MB of ids.
GROUP_TAILS = 2048
# Characters encoded at a time.
BATCH_CHARS = 1 << 20
# Chunks and other pieces whose ids a worker remembers, and as many that it met before those.
MEMO_CHUNKS, MEMO_PIECES = 250_000, 100_000
_CHUNK = re.compile(r"[^ \t\n\r]+")
# The rules of the tokenizer file by which texts fall into pieces.
_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# The same rules for printable ASCII and the Latin-1 letters, which NFC leaves alone.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PLAIN_TEXT = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff \t\n\r]*")
# A piece ends between a letter and a mark, so a space there changes no ids; an apostrophe may begin one of both.
_WORD_END = "([a-z\u00df-\u00f6\u00f8-\u00ff])([!-&(-/:-@\\[-`{-~])"
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
# The tokenizer spells a byte as the letter of its number if that prints, else as one from 256 on.
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}
_SPELLING = "".join(chr(_BYTE_LETTERS.get(b, b)) for b in range(256))

_CUT = "doc_id long, start long, doc_tokens long, length long, ids_crc32 long, tail binary, salt long"
_PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Memory(dict):
    """Ids of what was met lately; ``make`` gives those of anything else.

    A full memory is set aside: what is met again returns from there, the rest goes when the
    next one is full.
    """

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        made = self.before.get(key)
        if made is None:
            made = self.make(key)
        self[key] = made
        return made


class Encoder:
    """Ids of texts, by a tokenizer that never joins across white space.

    A text's ids are those of its space-separated chunks in a row, so the ids of a chunk are
    remembered and only new ones reach the tokenizer.  In texts of plain characters, words are
    parted from the marks behind them first, and a new chunk falls into the pre-tokenizer's own
    pieces, which repeat more often still.  A text that names
    one of the tokenizer's special tokens, and any text of a tokenizer with other rules, is
    encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        # Texts are taken apart here only if the file states the rules that _CHUNK and _PIECES follow.
        self.known_rules = all(rules[k] == v for k, v in _RULES.items())
        self.pieces = Memory(self._piece, MEMO_PIECES)
        # Plain chunks stand in lower case.
        self.chunks = Memory(self._chunk, MEMO_CHUNKS)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else charmap_decode(piece.encode(), "strict", _SPELLING)[0]
        ids = [t.id for t in self.model.tokenize(spelt)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._piece(chunk)
        words, rest = self.chunks, self.pieces
        return b"".join([words[p] if p.isalpha() else rest[p] for p in _PIECES.findall(chunk)])

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of plain characters: each distinct chunk is looked up once."""
        parted = pc.replace_substring_regex(pa.array([t.lower() for t in texts], pa.large_string()), _WORD_END, r"\1 \2")
        split = pc.ascii_split_whitespace(parted)
        coded = split.values.dictionary_encode()
        known = self.chunks
        found = [known[c] for c in coded.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        # Every chunk's ids are copied from where its text stands first among the distinct ones.
        order = coded.indices.to_numpy()
        ends = np.r_[0, np.cumsum(sizes[order])]
        from_ = np.repeat((np.cumsum(sizes) - sizes)[order] - ends[:-1], sizes[order])
        from_ += np.arange(len(from_))
        raw = ids[from_].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        plain, other, whole = [], [], []
        for i, text in enumerate(texts):
            if not self.known_rules or any(s in text for s in self.special):
                whole.append(i)
            elif _PLAIN_TEXT.fullmatch(text):
                plain.append(i)
            else:
                other.append(i)
        out = dict(zip(whole, self._whole([texts[i] for i in whole])))
        out |= zip(plain, self._plain([texts[i] for i in plain]))
        # Chunks of other characters reach the tokenizer together, once for these texts.
        known = self.chunks
        split = {i: [c.lower() if _PLAIN.fullmatch(c) else c for c in _CHUNK.findall(texts[i])] for i in other}
        odd = [c for c in set().union(*split.values()) if not _PLAIN.fullmatch(c)]
        ids_of = dict(zip(odd, self._whole(odd)))
        for i, chunks in split.items():
            out[i] = b"".join([ids_of[c] if c in ids_of else known[c] for c in chunks])
        return [out[i] for i in range(len(texts))]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One per worker process, kept over its tasks."""
    return Encoder(path)


def _runs(texts: list[str]) -> Iterator[list[str]]:
    run, chars = [], 0
    for text in texts:
        if run and chars + len(text) > BATCH_CHARS:
            yield run
            run, chars = [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield run


def tokenised(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Full pieces with their checksum, tails with their ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder_of(tokenizer)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            ids_of = iter(batch["doc_id"].tolist())
            for run in _runs(batch["text"].tolist()):
                rows = []
                for text, raw in zip(run, encode(run)):
                    doc_id, raw = next(ids_of), raw + end
                    tokens = len(raw) // 4
                    whole = tokens // capacity * capacity
                    for start in range(0, whole, capacity):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + capacity)])
                        rows.append((doc_id, start, tokens, capacity, crc, None, 0))
                    if whole < tokens:
                        rows.append((doc_id, whole, tokens, tokens - whole, None, raw[4 * whole :], zlib.crc32(text.encode())))
                yield _frame(rows, _CUT)

    return docs.mapInPandas(cut, _CUT)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Whole numbers stay whole beside nulls."""
    names = [field.split()[0] for field in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    for field in schema.split(", "):
        name, kind = field.split()
        if kind == "long":
            frame[name] = frame[name].astype("Int64")
    return frame


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of every piece; items come by falling length."""
    n_bins = max(1, -(-int(lengths.sum()) // capacity))
    room = np.full(n_bins, capacity, dtype=np.int64)
    cost = np.zeros(n_bins)
    pieces = []

    def put(item: int, start: int, length: int, seq: int) -> None:
        pieces.append((item, start, length, seq, capacity - int(room[seq])))
        room[seq] -= length
        cost[seq] += LINEAR * length + QUADRATIC * length * length

    for item in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[item])
        fits = room >= left
        if fits.any():
            put(item, 0, left, int(np.where(fits, cost, np.inf).argmin()))
            continue
        while left:
            seq = int(room.argmax())
            part = min(left, int(room[seq]))
            put(item, start, part, seq)
            start, left = start + part, left - part
    return pieces


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    group_tails: int = GROUP_TAILS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    narrow = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    cut = stored(tokenised(narrow, tokenizer, capacity, end_id), "packing-cut")
    full = cut.where("tail is null").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    tails = cut.where("tail is not null")
    groups = max(1, -(-tails.count() // group_tails))
    # The row number keeps repeated rows from all going to one group.
    dealt = tails.withColumn("salt", F.pmod(F.xxhash64("doc_id", "salt", F.monotonically_increasing_id()), F.lit(groups)))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(_crc=[zlib.crc32(x) for x in rows["tail"]]).sort_values(["doc_id", "_crc"], kind="stable")
        base = int(rows["salt"].iloc[0]) << 20
        tails_of, ids = rows["tail"].tolist(), rows["doc_id"].astype("Int64").tolist()
        starts, totals = rows["start"].tolist(), rows["doc_tokens"].tolist()
        out = []
        for item, start, length, seq, offset in assign(rows["length"].to_numpy(dtype=np.int64), capacity):
            crc = zlib.crc32(tails_of[item][4 * start : 4 * (start + length)])
            doc_id = None if ids[item] is pd.NA else ids[item]
            out.append((doc_id, starts[item] + start, length, crc, totals[item], (base + seq) * 2 + 1, offset))
        return _frame(out, _PIECE)

    return full.unionByName(dealt.groupBy("salt").applyInPandas(pack_group, _PIECE))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
