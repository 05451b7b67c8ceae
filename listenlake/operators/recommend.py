"""Next-song recommendation by implicit-feedback collaborative filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.functions.measures import plays
from listenlake.session import ensure_checkpoint_dir

_BUCKETS = 1024


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Number the distinct values of ``column`` from 0 without a gap.

    Values are ranked inside hash buckets, and a bucket starts where the ones
    before it end, so no task sees all values and the driver sees none.  The result
    depends on the values alone, hence a recomputed task gives the same numbers.
    """
    ids = (
        df.select(column)
        .distinct()
        .withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(_BUCKETS)))
    )
    sizes = ids.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return ids.withColumn("_place", place).join(starts, "_bucket").select(
        column, (F.col("_start") + F.col("_place") - 1).cast("int").alias(index)
    )


def recommend_songs(
    silver: DataFrame,
    n: int = 10,
    rank: int = 8,
    iterations: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``n`` songs per user by predicted preference: (user_id, song_id, place, score).

    Training input is one row per (user, song) with its plays; it is checkpointed in
    the shared folder because ALS reads it in every iteration.
    """
    from pyspark.ml.recommendation import ALS

    ensure_checkpoint_dir(silver.sparkSession)
    counts = silver.groupBy("user_id", "song_id").agg(plays().alias("plays")).filter("plays > 0")
    counts = counts.checkpoint()
    users = dense_index(counts, "user_id", "user_index").checkpoint()
    songs = dense_index(counts, "song_id", "song_index").checkpoint()
    ratings = (
        counts.join(users, "user_id")
        .join(songs, "song_id")
        .select("user_index", "song_index", F.col("plays").cast("float").alias("plays"))
        .checkpoint()
    )
    als = ALS(
        userCol="user_index",
        itemCol="song_index",
        ratingCol="plays",
        implicitPrefs=True,
        rank=rank,
        maxIter=iterations,
        seed=seed,
    )
    picks = als.fit(ratings).recommendForAllUsers(n)
    return (
        picks.select("user_index", F.posexplode("recommendations").alias("_at", "_rec"))
        .select(
            "user_index",
            F.col("_rec.song_index").alias("song_index"),
            (F.col("_at") + 1).alias("place"),
            F.col("_rec.rating").alias("score"),
        )
        .join(users, "user_index")
        .join(songs, "song_index")
        .select("user_id", "song_id", "place", "score")
    )


# Songs of a user above which the user's pairs are dealt over several tasks.
HEAVY = 200
NEIGHBOURS = 20
_MICRO = 1_000_000


def similar_songs(silver: DataFrame, neighbours: int = NEIGHBOURS, heavy: int = HEAVY) -> DataFrame:
    """The nearest songs of each song: (song_id, other_id, similarity, place).

    Similarity is the cosine of the two sets of listeners, in millionths, from the users
    that both songs share.  A user with many songs is split: one block of songs meets all of
    them per task.  Pairs are counted map-side before they shuffle, and only ``neighbours``
    per song and task go on to the ranking.
    """
    heard = silver.filter(F.col("event_type") == "play").select("user_id", "song_id").distinct()
    blocks = heard.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / heavy).alias("blocks"))
    dealt = heard.join(blocks, "user_id")
    left = dealt.select("user_id", "song_id", F.pmod(F.xxhash64("song_id"), "blocks").alias("block"))
    right = dealt.select("user_id", F.col("song_id").alias("other_id"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    shared = (
        left.join(right, ["user_id", "block"]).filter("song_id <> other_id")
        .groupBy("song_id", "other_id").agg(F.count(F.lit(1)).alias("both"))
    )
    listeners = heard.groupBy("song_id").agg(F.count(F.lit(1)).alias("n"))
    others = listeners.select(F.col("song_id").alias("other_id"), F.col("n").alias("m"))
    scored = shared.join(listeners, "song_id").join(others, "other_id").select(
        "song_id", "other_id", F.floor(F.col("both") * _MICRO / F.sqrt((F.col("n") * F.col("m")).cast("double"))).alias("similarity")
    )
    nearest = Window.partitionBy("song_id").orderBy(F.desc("similarity"), "other_id")
    return scored.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= neighbours)


def recommend_similar(silver: DataFrame, n: int = 5, neighbours: int = NEIGHBOURS, heavy: int = HEAVY) -> DataFrame:
    """Per user the ``n`` best songs not played yet: (user_id, song_id, score, place).

    Candidates are the neighbours of the songs a user plays, scored by the sum of their
    similarities; no user meets the whole catalogue.
    """
    heard = silver.filter(F.col("event_type") == "play").select("user_id", "song_id").distinct()
    near = similar_songs(silver, neighbours, heavy).select("song_id", "other_id", "similarity")
    candidates = (
        heard.join(near, "song_id").groupBy("user_id", F.col("other_id").alias("song_id"))
        .agg(F.sum("similarity").alias("score"))
        .join(heard, ["user_id", "song_id"], "left_anti")
    )
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), "song_id")
    return candidates.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)
