"""Exact dedup: a two-pass Bloom filter, then a shuffle of possible repeats only.

Pass one sets four bits of one 64-bit filter word per text hash and keeps, per word,
the bits that may have been set twice.  Pass two tests every hash against these: a
text whose bits are not all there is alone and passes straight through.  Only the rest
is shuffled and grouped by the full SHA-256.

A word set by one row holds no repeat.  For two rows ``or & ~xor`` gives exactly the
bits both set; from three rows on all set bits count.  So a repeat is never missed, and
the aggregates are fixed-width with a partial step before the shuffle.

Defined cases: a null text is an empty one, and all empty texts are equal.  Among equal
texts the one with most code points stays, then the smallest id (a missing id last),
then the first read of repeated rows.  Columns besides id and text are carried along
by ``deduplicate`` and not read by ``decisions``; names cannot clash, because working
columns live in one struct.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import WHITE, stored, table, text_of

# The filter holds two words per row, and at least this many.
LEAST_WORDS = 1024
# Filter words that may be broadcast (about 24 bytes each); beyond it the filter is joined.
BROADCAST_WORDS = 1_000_000


def _digest(text_col: str) -> Column:
    return F.sha2(F.translate(text_of(text_col), WHITE, ""), 256)


def _hash(digest: Column) -> Column:
    """The first 60 bits of the digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _mask(h: Column) -> Column:
    """Four bits of a word; the word number comes from other bits of the hash."""
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {s}) & 63 as int))") for s in (36, 42, 48, 54)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def _filter_words(rows: int) -> int:
    words = LEAST_WORDS
    while words < 2 * rows:
        words *= 2
    return words


def repeated_bits(hashes: DataFrame, words: int) -> DataFrame:
    """Pass one: per filter word the bits that may be set by two rows (column ``_h``)."""
    return (
        hashes.select((F.col("_h") % words).alias("_word"), _mask(F.col("_h")).alias("_mask"))
        .groupBy("_word")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_or("_mask").alias("o"), F.bit_xor("_mask").alias("x"))
        .where("n > 1")
        .select("_word", F.expr("case when n = 2 then o & ~x else o end").alias("_twice"))
        .where("_twice <> 0")
    )


def flag_possible_repeats(rows: DataFrame, bits: DataFrame, words: int, n_bits: int) -> DataFrame:
    """Pass two: adds ``_maybe``, true for every row whose hash may occur again."""
    small = F.broadcast(bits) if n_bits <= BROADCAST_WORDS else bits
    tested = rows.withColumn("_word", F.col("_h") % words).join(small, "_word", "left")
    hit = F.coalesce(F.col("_twice").bitwiseAND(_mask(F.col("_h"))) == _mask(F.col("_h")), F.lit(False))
    return tested.withColumn("_maybe", hit).drop("_word", "_twice")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One small row per document; the only pass over the texts that ``decisions`` needs."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        _digest(text_col).alias("text_sha256"),
        F.char_length(text_of(text_col)).cast("bigint").alias("n_chars"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return stored(rows.withColumn("_h", _hash(F.col("text_sha256"))), "exact-narrow")


def _filtered(narrow: DataFrame) -> tuple[DataFrame, int, int]:
    words = _filter_words(narrow.count())
    bits = stored(repeated_bits(narrow, words), "exact-bits")
    return bits, words, bits.count()


def _groups(maybe: DataFrame) -> DataFrame:
    """Count and winner of every text that may repeat; a hot text is folded before the shuffle."""
    best = F.min(F.struct((-F.col("n_chars")).alias("_n"), F.col("doc_id").isNull().alias("_null"), "doc_id", "_row"))
    groups = maybe.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best"))
    return groups.select("text_sha256", "group_size", F.col("_best.doc_id").alias("keep_id"), F.col("_best._row").alias("_keep_row"), (-F.col("_best._n")).alias("most_chars"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = _narrow(docs, id_col, text_col)
    flagged = flag_possible_repeats(narrow, *_filtered(narrow))
    alone = flagged.where("not _maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    maybe = flagged.where("_maybe")
    # Stored, so that the join below sees two plain shuffles and can split a hot text.
    groups = stored(_groups(maybe), "exact-groups")
    shuffled = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep_row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(shuffled)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    A row that is alone is never shuffled.  Of the possible repeats only the candidates
    for staying travel with their texts: those that equal their group's winner in id
    and length, of which repeated rows are folded to one.
    """
    narrow = _narrow(docs, id_col, text_col)
    bits, words, n_bits = _filtered(narrow)
    groups = stored(_groups(flag_possible_repeats(narrow, bits, words, n_bits).where("_maybe")), "exact-groups")
    best = groups.select("text_sha256", "keep_id", "most_chars")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(id_col).alias("_id"),
        _digest(text_col).alias("text_sha256"),
        F.char_length(text_of(text_col)).cast("bigint").alias("_n"),
    )
    flagged = flag_possible_repeats(whole.withColumn("_h", _hash(F.col("text_sha256"))), bits, words, n_bits)
    alone = flagged.where("not _maybe").select("_doc.*")
    same = F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_n") == F.col("most_chars"))
    winners = flagged.where("_maybe").join(best, "text_sha256").where(same)
    first = winners.groupBy("text_sha256").agg(F.first("_doc").alias("_doc"))
    return alone.unionByName(first.select("_doc.*"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
