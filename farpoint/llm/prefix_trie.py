"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn columns.

A node is a distinct sequence of first d turns (role, text).  The turns of a
conversation are laid out in blocks of WIDTH columns; one ``GROUP BY block, key,
ROLLUP(t0, ..)`` gives all prefixes of all blocks together, its grouping_id the
depth.  A long conversation goes on in further blocks; ``key`` is the node at which
the block before ended.

A node is fingerprinted by the XOR of its turns' hashes, each hashed with its
position: so the parent's fingerprint follows from a node's own, and the key of every
block is a running XOR, without a round per block.

Sums over subtrees take a second ROLLUP: every node belongs to its smallest member;
with each conversation's sums from a depth downwards over the nodes that belong to it,
a subtree's sum is the sum over its members.  Conversations without a node of their
own (copies) drop out before.

Turns are ranked after range partitioning by (conversation, turn, role, text), running
values are taken within stretches of STRETCH turns and over the stretches' totals, and the
conversations that end at one node are joined to texts of at most ID_RANGE ids
before they are hashed as a stream; so no conversation and no node, however hot,
is gathered as a whole.

Defined cases: rows without a conv_id belong to no conversation and are left out;
null role or text counts as empty; a null turn comes first; equal turns are ordered by
role, then text, and repeated rows are turns of their own; an empty table gives no
node; further columns are not read.  Turns and nodes are known by 64-bit fingerprints.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from farpoint.llm.scratch import Scratch

WIDTH = 8                  # turn columns of a block
STRETCH = 4096             # turns whose running values are taken together
ID_BITS = 12               # ids of one range of 2^12 are joined to one text
HEAD_EVERY, HEAD_TURNS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"


# ---- turns ------------------------------------------------------------------

def ranked_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((conv_id, part, rank_in_part, h, words), (conv_id, part, n, first)): turns in order.

    A turn's rank is ``first`` of its (conversation, part) plus ``rank_in_part``.  Parts are range
    partitions, so a hot conversation has many; equal rows are spread by their place in the scan.
    """
    t = (conversations.filter(F.col("conv_id").isNotNull())
         .select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
         .withColumn("place", F.monotonically_increasing_id()))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "place"]
    placed = (t.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", F.xxhash64("role", "text").alias("h"),
                      F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("int").alias("words"),
                      F.monotonically_increasing_id().alias("at")))
    s = scratch.save(placed).withColumn("part", F.shiftright("at", 33))
    per = s.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("begin"))
    before = Win.partitionBy("conv_id").orderBy("part").rowsBetween(Win.unboundedPreceding, -1)
    per = scratch.save(per.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return s, per


def rebuilt_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, h, words), (conv_id)): conversations with the first turns of another.

    Conversation c takes the first k turns of c - c % 20 (all, if fewer), then its own after its
    first k; k = crc32(c) % 4.
    """
    s, per = ranked_turns(conversations, scratch)
    size = per.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))
    head = F.col("conv_id") - F.col("conv_id") % HEAD_EVERY
    own = size.select("conv_id", head.alias("head"),
                      (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).alias("k"))
    convs = scratch.save(own.join(size.select(F.col("conv_id").alias("head"), F.col("n_turns").alias("n_head")),
                                  "head", "left")
                         .withColumn("taken", F.least("k", F.coalesce("n_head", F.lit(0)))))
    # the part table carries what a turn must know of its conversation
    at = per.join(convs.select("conv_id", "k", "taken"), "conv_id")
    turns = s.join(at.select("conv_id", "part", "begin", "first", "k", "taken"), ["conv_id", "part"]).withColumn(
        "rank", F.col("first") + F.col("at") - F.col("begin"))
    kept = turns.filter(F.col("rank") >= F.col("k")).select(
        "conv_id", (F.col("rank") - F.col("k") + F.col("taken")).alias("pos"), "h", "words")
    heads = turns.filter((F.col("rank") < HEAD_TURNS - 1) & (F.col("conv_id") % HEAD_EVERY == 0)).select(
        F.col("conv_id").alias("head"), "rank", "h", "words")
    lent = heads.join(convs.select("conv_id", "head", "k"), "head").filter(F.col("rank") < F.col("k")).select(
        "conv_id", F.col("rank").alias("pos"), "h", "words")
    return scratch.save(kept.unionByName(lent)), convs.select("conv_id")


def plain_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, h, words), (conv_id)): conversations as they are."""
    s, per = ranked_turns(conversations, scratch)
    turns = s.join(per.select("conv_id", "part", "begin", "first"), ["conv_id", "part"]).select(
        "conv_id", (F.col("first") + F.col("at") - F.col("begin")).alias("pos"), "h", "words")
    return scratch.save(turns), per.select("conv_id").distinct()


def _placed(h: Column, pos: Column) -> Column:
    """A turn's part of its node's fingerprint."""
    return F.xxhash64(h, pos.cast("bigint"))


def turn_blocks(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, block, key, t0 .. ): WIDTH turns a row; key: fingerprint of all turns before.

    A conversation without turns has one block without turns.
    """
    i = F.col("pos") % WIDTH
    cols = [F.max(F.when(i == k, F.struct("h", "words"))).alias(f"t{k}") for k in range(WIDTH)]
    b = (turns.withColumn("block", F.floor(F.col("pos") / WIDTH))
         .groupBy("conv_id", "block").agg(*cols, F.bit_xor(_placed(F.col("h"), F.col("pos"))).alias("x"))
         .withColumn("stretch", F.floor(F.col("block") / (STRETCH // WIDTH))))
    b = scratch.save(b)
    zero = F.lit(0).cast("bigint")
    totals = b.groupBy("conv_id", "stretch").agg(F.bit_xor("x").alias("x"))
    over = Win.partitionBy("conv_id").orderBy("stretch").rowsBetween(Win.unboundedPreceding, -1)
    totals = totals.select("conv_id", "stretch", F.coalesce(F.bit_xor("x").over(over), zero).alias("x0"))
    inside = Win.partitionBy("conv_id", "stretch").orderBy("block").rowsBetween(Win.unboundedPreceding, -1)
    out = (b.withColumn("x1", F.coalesce(F.bit_xor("x").over(inside), zero))
           .join(totals, ["conv_id", "stretch"])
           .select("conv_id", "block", F.col("x0").bitwiseXOR(F.col("x1")).alias("key"),
                   *[f"t{k}" for k in range(WIDTH)]))
    none = convs.join(turns.filter("pos = 0").select("conv_id"), "conv_id", "left_anti")
    empty = [F.lit(None).cast("struct<h:bigint,words:int>").alias(f"t{k}") for k in range(WIDTH)]
    return scratch.save(out.unionByName(none.select("conv_id", zero.alias("block"), zero.alias("key"), *empty)))


# ---- the trie ---------------------------------------------------------------

def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """(nid, depth, parent_nid, words, level, the aggregates) of every node, in one ROLLUP."""
    cols = ", ".join(f"t{k}" for k in range(WIDTH))
    rolled = blocks.sparkSession.sql(
        f"SELECT block, key, {cols}, grouping_id() AS gid, {aggregates} "
        f"FROM {{b}} GROUP BY block, key, ROLLUP({cols})", b=blocks)
    # the lowest bits of grouping_id stand for the columns rolled up
    level = F.lit(WIDTH) - F.bit_count(F.col("gid").bitwiseAND(F.lit((1 << WIDTH) - 1)))
    rolled = rolled.withColumn("level", level)
    last = F.lit(None).cast("struct<h:bigint,words:int>")
    for k in range(WIDTH):
        last = F.when(F.col("level") == k + 1, F.col(f"t{k}")).otherwise(last)
    rolled = rolled.withColumn("last", last).withColumn("depth", F.col("block") * WIDTH + F.col("level"))
    # a column without a turn is no node; a block's level 0 is the node before it
    rolled = rolled.filter(F.col("last").isNotNull() | (F.col("depth") == 0))
    nid = F.col("key")
    for k in range(WIDTH):
        nid = nid.bitwiseXOR(F.when(F.col("level") > k, _placed(
            F.col(f"t{k}.h"), F.col("block") * WIDTH + k)).otherwise(F.lit(0).cast("bigint")))
    rolled = rolled.withColumn("nid", nid)
    parent = F.when(F.col("depth") > 0, F.col("nid").bitwiseXOR(_placed(F.col("last.h"), F.col("depth") - 1)))
    return rolled.withColumn("parent_nid", parent).withColumn("words", F.coalesce("last.words", F.lit(0)))


def trie_nodes(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(nid, depth, parent_nid, conv_id, n_convs, n_children, own): all nodes without subtree sums."""
    nodes = scratch.save(_rollup(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id").select(
        "nid", "depth", "parent_nid", "words", "n_convs", "conv_id"))
    kids = (nodes.filter("depth > 0").groupBy(F.col("parent_nid").alias("nid"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count(F.lit(1)).alias("n_children")))
    return scratch.save(nodes.join(kids, ["nid", "depth"], "left").select(
        "nid", "depth", "parent_nid", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own")))


def subtree_sums(nodes: DataFrame, blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(nid, depth, saved_tokens, n_leaves) of every node."""
    own = nodes.select("conv_id", "depth", "own", (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                       F.floor(F.col("depth") / STRETCH).alias("stretch"))
    totals = own.groupBy("conv_id", "stretch").agg(F.sum("own").alias("o"), F.sum("leaf").alias("l"))
    later = Win.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Win.unboundedPreceding, -1)
    totals = totals.select("conv_id", "stretch", F.coalesce(F.sum("o").over(later), F.lit(0)).alias("o0"),
                           F.coalesce(F.sum("l").over(later), F.lit(0)).alias("l0"))
    down = Win.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(Win.unboundedPreceding, 0)
    from_here = (own.withColumn("o1", F.sum("own").over(down)).withColumn("l1", F.sum("leaf").over(down))
                 .join(totals, ["conv_id", "stretch"])
                 .select("conv_id", "depth", (F.col("o0") + F.col("o1")).alias("o"),
                         (F.col("l0") + F.col("l1")).alias("l")))
    i = (F.col("depth") - 1) % WIDTH
    wide = from_here.filter("depth > 0").groupBy("conv_id", F.floor((F.col("depth") - 1) / WIDTH).alias("block")).agg(
        *[F.max(F.when(i == k, F.col(c))).alias(f"{c}{k}") for k in range(WIDTH) for c in "ol"])
    every = own.groupBy("conv_id").agg(F.sum("own").alias("o"), F.sum("leaf").alias("l"))
    b = blocks.join(every, "conv_id").join(wide, ["conv_id", "block"], "left")
    # above its own nodes a conversation brings all of them
    b = b.select("block", "key", *[f"t{k}" for k in range(WIDTH)], "o", "l", *[
        F.coalesce(f"{c}{k}", c).alias(f"{c}{k}") for k in range(WIDTH) for c in "ol"])
    sums = ", ".join(f"sum({c}) AS {c}, " + ", ".join(f"sum({c}{k}) AS {c}{k}" for k in range(WIDTH)) for c in "ol")
    rolled = _rollup(b, sums)

    def at_level(c):
        x = F.col(c)
        for k in range(WIDTH):
            x = F.when(F.col("level") == k + 1, F.col(f"{c}{k}")).otherwise(x)
        return x
    return rolled.select("nid", "depth", at_level("o").alias("saved_tokens"), at_level("l").alias("n_leaves"))


def ends(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(nid, depth, ends_sha256): SHA-256 of the ids that end at a node, ascending, comma-joined."""
    last = turns.groupBy("conv_id").agg(F.bit_xor(_placed(F.col("h"), F.col("pos"))).alias("nid"),
                                        F.count(F.lit(1)).alias("depth"))
    last = convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("nid", F.lit(0).cast("bigint")).alias("nid"), F.coalesce("depth", F.lit(0)).alias("depth"))
    # ids are distinct, so a range gives at most 2^ID_BITS of them
    ranges = scratch.save(last.groupBy("nid", "depth", F.shiftright("conv_id", ID_BITS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    n = ranges.groupBy("nid", "depth").agg(F.count(F.lit(1)).alias("n"))
    counted = ranges.join(n, ["nid", "depth"])
    one = counted.filter("n = 1").select("nid", "depth", F.sha2(F.col("ids"), 256).alias("ends_sha256"))
    many = counted.filter("n > 1").select("nid", "depth", "range", "ids")

    def run(batches):
        node, sha, out = None, None, ([], [], [])

        def close():
            for x, y in zip(out, (*node, sha.hexdigest())):
                x.append(y)
        for b in batches:
            for nid, depth, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (nid, depth) != node:
                    if node:
                        close()
                    node, sha = (nid, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_buffer())
        if node:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
            names=["nid", "depth", "ends_sha256"])
    streamed = (many.repartition("nid", "depth").sortWithinPartitions("nid", "depth", "range")
                .mapInArrow(run, "nid bigint, depth bigint, ends_sha256 string"))
    return one.unionByName(streamed)


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256);
    conv_id: the node's smallest member.  ``rebuild``: conversations first take the first
    turns of another (``rebuilt_turns``).
    """
    scratch = Scratch(conversations.sparkSession, "prefix_trie")
    turns, convs = (rebuilt_turns if rebuild else plain_turns)(conversations, scratch)
    blocks = turn_blocks(turns, convs, scratch)
    nodes = trie_nodes(blocks, scratch)
    sums = subtree_sums(nodes, blocks, scratch)
    # below its first own node a conversation's nodes have a parent of its own
    first = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"))
    n = nodes.join(first, "conv_id")
    inner = n.filter(F.col("depth") > F.col("first")).withColumn("parent_conv_id", F.col("conv_id"))
    tops = n.filter(F.col("depth") == F.col("first")).withColumn("parent_depth", F.col("depth") - 1)
    parent = nodes.select(F.col("nid").alias("parent_nid"), F.col("depth").alias("parent_depth"),
                          F.col("conv_id").alias("parent_conv_id"))
    tops = tops.join(parent, ["parent_nid", "parent_depth"], "left").drop("parent_depth")
    out = scratch.save(inner.unionByName(tops))
    return (out.join(sums, ["nid", "depth"]).join(ends(turns, convs, scratch), ["nid", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
