"""Document fingerprints: bottom-k sketches of shingle hashes, with SQL functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's five-word
shingles.  The sketch of a union is the k smallest of both sketches, so parts can be
sketched apart and merged.  Of the k smallest of a union, the share found in both
sketches estimates resemblance; the k-th smallest hash tells the number of distinct
shingles; both together give containment.

Defined cases: a null text is an empty one; a text of fewer words than a shingle has one
shingle, its whole sequence; an empty sketch resembles an empty one by 1 and any
other by 0; rows with equal ids are ordered by a hash of their text; a null id comes
first in the order; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, stored, table

SHINGLE = 5
K = 128
# Ids per block of the order by id, in the mean; a block is one group of a window.
BLOCK_ROWS = 1000
_SPACE = r"[\x20\x09-\x0D]+"
_LEAST = -(2**63)


def hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """The hash of each shingle, repeats included."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    return F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice(w, i, F.lit(shingle))),
            )
        ),
    )[0]


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes(text, shingle))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k, else from how low the k-th smallest hash lies."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of a's shingles that b has too."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, text, next_text, own, next): the text of the next id, both sketches; the last row's next is the first.

    Ids are dealt to blocks of equal width.  The first row of each block also visits the
    block before, as its last row, so one shuffle of the texts is enough and no
    task sees more than a block.
    """
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)))
    low, high, n = rows.where("doc_id is not null").agg(F.min("_key"), F.max("_key"), F.count(F.lit(1))).first()
    width = max(1, (high - low + 1) * block_rows // n) if n else 1
    rows = rows.withColumn("_block", F.expr(f"if(_key = {_LEAST}, -1L, (_key - {low or 0}L) div {width}L)"))
    firsts = stored(rows.groupBy("_block").agg(F.min("_key").alias("_first")), "order-blocks")
    # One row per block, not per document; numbered in ranges of blocks.
    by_block = Window.partitionBy(F.expr("_block div 65536")).orderBy("_block")
    local = firsts.withColumn("_host", F.lag("_block").over(by_block))
    ends = firsts.groupBy(F.expr("_block div 65536").alias("_zone")).agg(F.max("_block").alias("_end"))
    last = ends.agg(F.max("_end")).first()[0]
    chain = Window.partitionBy(F.lit(0)).orderBy("_zone")
    before = ends.select(F.col("_zone"), F.coalesce(F.lag("_end").over(chain), F.lit(last)).alias("_before"))
    hosts = (
        local.withColumn("_zone", F.expr("_block div 65536")).join(before, "_zone")
        .select("_first", F.coalesce("_host", "_before").alias("_host"))
    )
    hosts = stored(hosts, "order-hosts")
    stay = rows.select("_block", F.lit(0).alias("_visit"), "_key", "doc_id", "text")
    visit = rows.join(hosts, F.col("_key") == F.col("_first")).select(
        F.col("_host").alias("_block"), F.lit(1).alias("_visit"), "_key", "doc_id", "text"
    )
    order = Window.partitionBy("_block").orderBy("_visit", "_key", "_tie")
    dealt = stay.unionByName(visit).withColumn("_tie", F.xxhash64("text")).withColumn("next_text", F.lead("text").over(order))
    # The second window has the first one's partitioning and order: it shuffles and sorts nothing.
    made = dealt.withColumn("own", sketch(F.col("text"))).withColumn("next", F.lead("own").over(order))
    return made.where("_visit = 0").select("doc_id", "text", "next_text", "own", "next")


def edited(text: Column, other: Column) -> Column:
    """The last half of the code points replaced by as many from the start of ``other``."""
    half = F.expr("cast(char_length(text) div 2 as int)")
    kept = F.substring(text, F.lit(1), F.char_length(text) - half)
    return F.concat(kept, F.substring(other, F.lit(1), half))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    pairs = with_next(docs)
    changed = edited(F.col("text"), F.col("next_text"))
    made = pairs.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(changed, 256).alias("edited_sha256"),
        "own", sketch(changed).alias("new"), resemblance(F.col("own"), F.col("next")).alias("near_next"),
    )
    made = stored(made, "sketches")
    return made.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("new")).alias("edited_fingerprint"), resemblance(F.col("own"), F.col("new")).alias("near_edited"),
        "near_next", distinct_shingles(F.col("own")).alias("n_shingles"),
        containment(F.col("own"), F.col("new")).alias("contained_in_edited"),
    )
