"""Mixing sources to target weights: hash-random keys, a range sort, prefix sums, a cut.

Every document gets a random key from a hash of its id and text.  Rows are
range-sorted by source and key, so a hot source spreads over many partitions.  A
prefix sum inside each partition plus the sum of the partitions before it gives each
document's place in its source.  A source whose budget is e times its size and r words
more takes every document e times and once more what lies below r; the document at the
cut gives only the words below it, so a budget is met exactly.

The tables of sources, and of sources by partition, hold sums only; their size follows
the number of sources and partitions and not that of the documents.

Defined cases: a null text has size 0; a null source is a source of its own, the last;
a source of size 0 has target 0; repeated rows are documents of their own; other columns
are carried by ``mix`` and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlake.llm.common import stored, table, text_of

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
# Rows per range at least; the number of ranges is also at least the shuffle's.
RANGE_ROWS = 500_000


def _size(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Per source its number, size, target and whole budget.

    Sources reach their ceiling in the order of ceiling by weight, so the level at which
    the rest shares what is left follows from prefix sums in that order.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sizes.withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")))
        .withColumn("ceiling", (F.col("source_size") * most).cast("double"))
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("left", F.sum(F.col("source_size").cast("double")).over(everything)
                    - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
        .withColumn("heft", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("heft"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))).over(everything)["level"])
        .withColumn("target", F.least(F.col("ceiling"), F.col("weight") * F.col("level")))
        .select("sid", "source", "source_size", "target",
                F.least(F.round("target").cast("long"), F.col("source_size") * most).alias("budget"))
    )


def _placed(rows: DataFrame, weights: tuple, most: int) -> DataFrame:
    """Adds source_size, target and taken to rows of (source, key, doc_id, size)."""
    spark = rows.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(targets(sizes, weights, most), "mix-sources")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)
    numbered = rows.alias("r").join(sources.alias("s"), F.expr("r.source <=> s.source")).select(
        "sid", "key", "doc_id", "size", "s.source_size", "target", "budget"
    )
    order = ["sid", "key", "doc_id", "size"]
    ranged = stored(
        numbered.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "mix-ranges"
    )
    inside = Window.partitionBy("part", "sid").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("sid", "part").agg(F.sum("size").alias("n"))
    starts = stored(sums.select("sid", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "mix-starts")
    begin = F.col("base") + F.col("upto") - F.col("size")
    epochs = F.expr("coalesce(budget div nullif(source_size, 0), 0)")
    rest = F.col("budget") - epochs * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest - begin))
    return (
        ranged.withColumn("upto", F.sum("size").over(inside))
        .join(starts, ["sid", "part"])
        .withColumn("taken", (epochs * F.col("size") + extra).cast("long"))
        .select("doc_id", "key", "size", "source_size", "target", "taken")
    )


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit("mix"), F.col(id_col), text_of(text_col))


def plan(
    docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = docs.select(
        F.col(source_col).alias("source"), _key(id_col, text_col).alias("key"),
        F.col(id_col).alias("doc_id"), _size(text_of(text_col)).alias("size"),
    )
    return _placed(stored(rows, "mix-rows"), weights, most).drop("key")


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixed documents: each as often as it is taken, the one at a cut with its first words."""
    keyed = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(source_col).alias("source"),
            _key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), _size(text_of(text_col)).alias("size"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mix-docs",
    )
    # The row number takes the id's place: it tells repeated rows apart.
    places = _placed(keyed.select("source", "key", F.col("_row").alias("doc_id"), "size"), weights, most)
    places = places.select(F.col("doc_id").alias("_row"), "taken").where("taken > 0")
    copies = keyed.join(places, "_row").select(
        "_doc", "size", "taken", F.explode(F.expr("sequence(0L, (taken - 1) div size)")).alias("_copy")
    )
    rest = F.col("taken") - F.col("_copy") * F.col("size")
    words = F.filter(F.split(F.col("_doc")[text_col], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), rest.cast("int")), " ")
    text = F.when(rest < F.col("size"), cut).otherwise(F.col("_doc")[text_col])
    return copies.select(*[text.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in docs.columns])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents"))
