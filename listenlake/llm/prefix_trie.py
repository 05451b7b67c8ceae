"""Conversation prefix trie: Euler tour, distributed list ranking, prefix sums.

A node is a distinct sequence of first turns; conversations that begin with it are its
members.  Turns are numbered by a range sort with prefix counts, so that a conversation of
any length spreads over many tasks.  A prefix is known by the exclusive-or of the hashes of
its numbered turns (two of 64 bits), which again is a prefix sum; nodes are the distinct
prefixes, and a node's parent is its prefix without the last turn.  Texts are hashed where
they are read and never shuffled.

Each node has an enter and an exit arc.  Enter leads to the first child's enter, or to the
node's own exit; exit leads to the next sibling's enter, or to the parent's exit.  Siblings
have consecutive numbers, so no group of children is ever gathered.  The tour is ranked by
contraction: each round tosses a coin per arc and splices out arcs that show heads behind one
that shows tails, a quarter of them, until a bounded list is left, which one task walks;
then rounds are undone in reverse.  Work is linear in the arcs, rounds are logarithmic.
What a subtree holds is the difference of prefix sums at a node's two positions.

The hash of the ids that end at a node is a chain over all of them, so a node's ids pass
through one task, in sorted batches; only the hasher's state is held.

Defined cases: null role or text is empty; a null turn comes first; equal turns of a
conversation are ordered by the hash of role and text, and repeated rows are turns of
their own; rows without a conversation id belong to none and are left out; a
conversation whose rebuilt sequence is empty is a member of the root; other columns are not
read; an empty table has no conversation and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlake.llm.common import stored, table, text_of

# Rows per range at least; the number of ranges is also at least the shuffle's.
RANGE_ROWS = 500_000
# Arcs of a contracted list that one task walks.
WALKED_ARCS = 16_384
# The query's rebuilding: conversations share the head of the first one of each five.
FAMILY, HEADS = 5, 9
_NODE = ["depth", "p1", "p2"]


def _ranges(rows: DataFrame) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)


def _ranged(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """The rows dealt by ranges of ``order``, with the range's number as ``part``."""
    return stored(rows.repartitionByRange(_ranges(rows), *order).withColumn("part", F.spark_partition_id()), label)


def numbered(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, part, depth (from 1), two hashes, bytes of the text."""
    role = text_of("role")
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.xxhash64(F.lit(1), role, text_of()).alias("t1"), F.xxhash64(F.lit(2), role, text_of()).alias("t2"),
        F.octet_length(text_of()).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv_id", "turn", "t1", "t2", "tie"]
    ranged = _ranged(stored(rows, "trie-turns"), order, "trie-ranges")
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "part").orderBy(*order[1:])
    places = ranged.withColumn("row", F.row_number().over(inside)).join(base, ["conv_id", "part"])
    return stored(places.select("conv_id", "part", (F.col("base") + F.col("row")).alias("depth"), "t1", "t2", "bytes"), "trie-numbered")


def lengths(seq: DataFrame) -> DataFrame:
    return seq.groupBy("conv_id").agg(F.max("depth").alias("length"))


def rebuilt(seq: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's sequences: the first h turns of conversation c - c % 5, then c's own after its
    first h; h is crc32(c) % 9.  Returns the turns and (conv_id, length)."""
    own = lengths(seq).select(
        "conv_id", F.col("length").alias("n"), (F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).alias("first"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"),
    )
    of_first = own.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    plan = stored(
        own.join(of_first, "first", "left").withColumn("head", F.least("h", F.coalesce("n_first", F.lit(0))))
        .select("conv_id", "first", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
        "trie-plan",
    )
    heads = seq.where(F.col("depth") < HEADS).select(F.col("conv_id").alias("first"), "depth", "t1", "t2", "bytes")
    head = plan.join(heads, "first").where("depth <= h").select("conv_id", F.lit(-1).alias("part"), "depth", "t1", "t2", "bytes")
    tail = seq.join(plan, "conv_id").where("depth > h").select(
        "conv_id", "part", (F.col("head") + F.col("depth") - F.col("h")).alias("depth"), "t1", "t2", "bytes"
    )
    return stored(head.unionByName(tail), "trie-rebuilt"), plan.select("conv_id", "length")


def _xor(a: str, b: str) -> Column:
    return F.coalesce(F.col(a), F.lit(0)).bitwiseXOR(F.coalesce(F.col(b), F.lit(0)))


def prefixes(seq: DataFrame) -> DataFrame:
    """Adds to each turn its prefix (p1, p2) and the prefix before it (q1, q2)."""
    rows = seq.withColumns({f"m{k}": F.xxhash64(F.lit(k), "depth", f"t{k}") for k in (1, 2)})
    parts = rows.groupBy("conv_id", "part").agg(F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("conv_id", "part", F.bit_xor("x1").over(earlier).alias("b1"), F.bit_xor("x2").over(earlier).alias("b2"))
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumns({f"r{k}": F.bit_xor(f"m{k}").over(inside) for k in (1, 2)}).join(base, ["conv_id", "part"])
    run = run.withColumns({f"p{k}": _xor(f"r{k}", f"b{k}") for k in (1, 2)})
    return run.select("conv_id", "depth", "bytes", "p1", "p2", _xor("p1", "m1").alias("q1"), _xor("p2", "m2").alias("q2"))


def nodes_of(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The distinct prefixes with the root, numbered so that siblings follow each other:
    v, depth, p1, p2, up (the parent's v), parent_conv_id, last (no sibling follows), conv_id, n_convs, bytes."""
    below = rows.groupBy(*_NODE).agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), "n_convs", "conv_id", zero.alias("bytes")
    )
    order = ["depth", "q1", "q2", "p1", "p2"]
    ranged = _ranged(stored(root.unionByName(below), "trie-nodes"), order, "trie-node-ranges")
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    base = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = stored(
        ranged.withColumn("row", place).join(base, "part").withColumn("v", F.col("base") + F.col("row") - 1).drop("part", "row", "base"),
        "trie-placed",
    )
    parents = placed.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("v").alias("up"), F.col("conv_id").alias("parent_conv_id"),
    )
    follower = placed.select((F.col("v") - 1).alias("v"), *[F.col(c).alias(f"f_{c}") for c in order[:3]])
    same = (F.col("f_depth") == F.col("depth")) & (F.col("f_q1") == F.col("q1")) & (F.col("f_q2") == F.col("q2"))
    linked = placed.join(parents, order[:3], "left").join(follower, "v", "left")
    return stored(
        linked.select("v", *_NODE, "up", "parent_conv_id", (~F.coalesce(same, F.lit(False))).alias("last"), "conv_id", "n_convs", "bytes"),
        "trie-linked",
    )


def tour(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The arcs as a list: id (2v enters node v, 2v + 1 leaves it), next (-1 at the end), hops."""
    firsts = children.select(F.col("up").alias("v"), "first_child")
    enter = nodes.join(firsts, "v", "left").select(
        (F.col("v") * 2).alias("id"), F.coalesce(F.col("first_child") * 2, F.col("v") * 2 + 1).alias("next")
    )
    leave = nodes.select(
        (F.col("v") * 2 + 1).alias("id"),
        F.when(F.col("up").isNull(), -1).when(F.col("last"), F.col("up") * 2 + 1).otherwise(F.col("v") * 2 + 2).alias("next"),
    )
    return enter.unionByName(leave).withColumn("hops", F.lit(1).cast("long"))


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = list(batches)
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    follow = dict(zip(rows["id"].tolist(), zip(rows["next"].tolist(), rows["hops"].tolist())))
    at, place, ids, places = 0, 0, [], []
    while at in follow:
        ids.append(at)
        places.append(place)
        at, hops = follow[at]
        place += hops
    yield pd.DataFrame({"id": ids, "place": places}, dtype="int64")


def ranked(arcs: DataFrame, walked: int = WALKED_ARCS) -> DataFrame:
    """(id, place) of every arc of the list that begins at arc 0."""
    arcs = stored(arcs, "trie-arcs")
    rounds = []
    while arcs.count() > walked:
        heads = (F.xxhash64("id", F.lit(len(rounds))).bitwiseAND(F.lit(1)) == 1) & (F.col("id") != 0)
        stay = arcs.where(~heads).select(*[F.col(c).alias(f"x_{c}") for c in arcs.columns])
        go = arcs.where(heads).select(*[F.col(c).alias(f"y_{c}") for c in arcs.columns])
        met = stored(stay.join(go, F.col("x_next") == F.col("y_id"), "full"), "trie-round")
        rounds.append(met.where("x_id is not null and y_id is not null").select(F.col("y_id").alias("id"), "x_id", "x_hops"))
        arcs = met.select(
            F.coalesce("x_id", "y_id").alias("id"), F.coalesce("y_next", "x_next").alias("next"),
            (F.coalesce("x_hops", F.lit(0)) + F.coalesce("y_hops", F.lit(0))).alias("hops"),
        )
    places = stored(arcs.coalesce(1).mapInPandas(_walk, "id long, place long"), "trie-places")
    for gone in reversed(rounds):
        before = places.select(F.col("id").alias("x_id"), "place")
        back = gone.join(before, "x_id").select("id", (F.col("place") + F.col("x_hops")).alias("place"))
        places = stored(places.unionByName(back), "trie-places")
    return places


def subtree_sums(nodes: DataFrame, children: DataFrame, places: DataFrame) -> DataFrame:
    """(v, n_leaves, saved_tokens) of every node, from prefix sums along the tour."""
    parents = children.select(F.col("up").alias("v"), F.lit(0).alias("leaf"))
    weights = nodes.join(parents, "v", "left").select(
        (F.col("v") * 2).alias("id"), F.coalesce("leaf", F.lit(1)).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    width = max(1024, int(places.count() ** 0.5))
    line = places.join(weights, "id", "left").fillna(0).withColumn("block", F.expr(f"place div {width}"))
    line = stored(line, "trie-line")
    earlier = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = line.groupBy("block").agg(F.sum("leaf").alias("n"), F.sum("saved").alias("s"))
    base = sums.select("block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"base_{c}") for c in ("n", "s")])
    inside = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    upto = line.withColumns({"n": F.sum("leaf").over(inside), "s": F.sum("saved").over(inside)}).join(base, "block")
    enters = F.col("id") % 2 == 0
    part = lambda c, own: F.when(enters, F.col(own) - F.col(c) - F.col(f"base_{c}")).otherwise(F.col(c) + F.col(f"base_{c}"))
    return upto.groupBy(F.expr("id div 2").alias("v")).agg(
        F.sum(part("n", "leaf")).alias("n_leaves"), F.sum(part("s", "saved")).alias("saved_tokens")
    )


def _hash_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by node and id; a node may run over many batches."""
    node, state = None, None
    for batch in batches:
        done = []
        for key, ids in batch.groupby(_NODE, sort=False)["conv_id"]:
            joined = ",".join(map(str, ids.tolist())).encode()
            if key == node:
                state.update(b"," + joined)
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(joined)
        yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*_NODE, "ends_sha256"])


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ids, ascending, comma-joined."""
    last = rows.join(convs, "conv_id").where("depth = length").select(*_NODE, "conv_id")
    none = convs.where("length = 0").select(*[F.lit(0).cast("long").alias(c) for c in _NODE], "conv_id")
    dealt = last.unionByName(none).repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
    return dealt.mapInPandas(_hash_ids, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(seq: DataFrame, convs: DataFrame, walked: int = WALKED_ARCS) -> DataFrame:
    """One row per node of the trie of the turns ``seq`` (as from ``numbered``); ``convs`` has every
    conversation and its length, those without turns too."""
    rows = stored(prefixes(seq), "trie-rows")
    nodes = nodes_of(rows, convs)
    children = stored(
        nodes.where("up is not null").groupBy("up").agg(F.min("v").alias("first_child"), F.count(F.lit(1)).alias("n_children")), "trie-children"
    )
    sums = subtree_sums(nodes, children, ranked(tour(nodes, children), walked))
    counted = children.select(F.col("up").alias("v"), "n_children")
    whole = nodes.join(ends(rows, convs), _NODE, "left").join(counted, "v", "left").join(sums, "v")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(numbered(table(spark, sf_dir, "conversations"))))


# crc32 bit by bit, least bit first, over the decimal id; prefixes as lists of (role, text).
ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, conv_id - ((conv_id % 5) + 5) % 5 AS first, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda s: list_transform(range(8), lambda k: (ascii(s) >> k::INTEGER)::BIGINT & 1)))),
    lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 9 AS h
  FROM c
), r AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
  FROM h LEFT JOIN c f ON f.conv_id = h.first
), p AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM r
), m AS (
  SELECT conv_id, depth, len(turns) AS length, turns[1:depth] AS node, CASE WHEN depth > 0 THEN turns[1:depth - 1] END AS parent FROM p
), n AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256,
    (count(*) - 1) * coalesce(strlen(any_value(node)[any_value(depth)].text), 0) AS saved
  FROM m GROUP BY node
), k AS (
  SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent
), s AS (
  SELECT a.node, sum((k.node IS NULL)::BIGINT) AS n_leaves, sum(d.saved) AS saved_tokens
  FROM n a JOIN n d ON d.depth >= a.depth AND d.node[1:a.depth] = a.node LEFT JOIN k ON k.node = d.node GROUP BY a.node
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n up ON n.depth > 0 AND up.node = n.parent
"""
