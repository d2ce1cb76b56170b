"""The trie of conversations' turns, each node under the smallest conversation that passes it, with what sharing saves.

Smallest-member ownership: a node belongs to its smallest member. All nodes below it hold a part of its members, that
one among them, so what a conversation owns is a suffix of its path: one number, the depth from which it owns, says all.
A running window over each path marks the owned nodes, and one group-by over prefixes adds up, for each member, the
tokens of the part of its path that it does not own (its occurrences' tokens minus the owned ones: every node counts
once less than it has members), and flags for owned leaves and owned children. No node ever meets its subtree.

A node is named by its depth and 128 bits: the xor of a hash of each place and turn, so names come from running totals,
and a path of any length is spread over tasks. What a conversation knows about itself reaches its turns in blocks of
``BLOCK`` turns, a parent's owner reaches the children by a running total in the order of parents, and the ends of a
node are joined by tasks into pieces of text that the hash then reads in order.

Defined results: null roles and texts are empty; turns are ordered by turn (null first), then role and text; repeated
rows are turns of their own; rows without a conversation id take no part; an empty table gives nothing, not even a root;
other columns are left alone.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut
from lawloom.operators.scan import running

#: Turns of one conversation that meet in one join key.
BLOCK = 4096
#: Characters of joined ids in one row.
PIECE = 65536
NODE = ["depth", "x", "y"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place from 1), a and b (128 bits of role and text) and chars of every turn."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *said, F.monotonically_increasing_id().alias("row")).where("conv_id is not null")
    md5 = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    half = lambda at: F.conv(F.substring(md5, at, 16), 16, -10).cast("long")
    placed = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")], count="i")  # equal rows, too, may span tasks
    return cut(placed.select("conv_id", "i", half(1).alias("a"), half(17).alias("b"), F.char_length("text").cast("long").alias("chars")))


def shared_head(conv: Column, modulus: int = 6) -> Column:
    """How many turns a conversation takes over from its base."""
    return F.crc32(conv.cast("string").cast("binary")) % modulus


def _blocks(per_conv: DataFrame) -> DataFrame:
    """The rows once for each block of places from 0 to n."""
    return per_conv.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {BLOCK}"))))


def rebuilt(turns: DataFrame, *, every: int = 100, modulus: int = 6) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id, n) and their turns, the first ones taken from the base ``conv_id - conv_id % every``."""
    head = shared_head(F.col("conv_id"), modulus)
    lengths = turns.groupBy("conv_id").agg(F.max("i").alias("own_n"))
    # at most a few turns for each base, and at most 2 * every conversations that take them
    base = turns.where((F.col("conv_id") % every == 0) & (F.col("i") < modulus)).withColumnRenamed("conv_id", "base")
    base_n = base.groupBy("base").agg(F.max("i").alias("base_n"))
    convs = lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base_n, "base", "left")
    kept = F.least(head, F.coalesce("base_n", F.lit(0).cast("long")))
    convs = cut(convs.select("conv_id", "base", "own_n", head.alias("h"), kept.alias("kept"), (kept + F.greatest(F.col("own_n") - head, F.lit(0))).alias("n")))
    taken = convs.where("kept > 0").join(base, "base").where("i <= kept").select("conv_id", F.col("i").alias("depth"), "a", "b", "chars", "n")
    shifts = _blocks(convs.where("own_n > h").select("conv_id", "h", "kept", F.col("n").alias("rest"), F.col("own_n").alias("n")))
    own = turns.where(F.col("i") > head).withColumn("block", F.expr(f"i div {BLOCK}")).join(shifts, ["conv_id", "block"])
    own = own.select("conv_id", (F.col("i") - F.col("h") + F.col("kept")).alias("depth"), "a", "b", "chars", F.col("rest").alias("n"))
    return convs.select("conv_id", "n"), taken.unionByName(own)


def occurrences(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each conversation and node on its path, the root included: its name, the parent's, and tokens above it."""
    u, v = F.xxhash64("depth", "a", "b"), F.xxhash64("b", "depth", "a")
    rows = turns.select("conv_id", "depth", "n", "chars", u.alias("u"), v.alias("v"))
    along = running(rows, ["conv_id"], [F.col("depth")], sums={"upto": "chars"}, xors={"x": "u", "y": "v"})
    none = F.lit(0).cast("long")
    root = convs.select("conv_id", none.alias("depth"), "n", none.alias("x"), none.alias("y"), none.alias("px"), none.alias("py"), none.alias("above"), none.alias("chars"))
    up = [F.col("x").bitwiseXOR(F.col("u")).alias("px"), F.col("y").bitwiseXOR(F.col("v")).alias("py")]
    return cut(along.select("conv_id", "depth", "n", "x", "y", *up, (F.col("upto") - F.col("chars")).alias("above"), "chars").unionByName(root))


def ownership(occ: DataFrame) -> DataFrame:
    """conv_id, n, own_from (n + 1 where it owns nothing), own_above (tokens above what it owns) and whether its end is a leaf of its own."""
    nodes = occ.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.max("n").alias("furthest"), F.first("above").alias("above"))
    top = F.min(F.struct("depth", "above"))
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(top.alias("top"), F.max(F.col("furthest") == F.col("depth")).alias("leaf"))
    ends = occ.where("depth = n").select("conv_id", "n", (F.col("above") + F.col("chars")).alias("total"))
    own = F.coalesce("top.depth", F.col("n") + 1).alias("own_from")
    return ends.join(owners, "conv_id", "left").select("conv_id", "n", own, F.coalesce("top.above", "total").alias("own_above"), F.coalesce("leaf", F.lit(False)).alias("leaf"))


def summed(occ: DataFrame, owned: DataFrame) -> DataFrame:
    """One row for each node: its totals over all members."""
    rows = occ.withColumn("block", F.expr(f"depth div {BLOCK}")).join(_blocks(owned).drop("n"), ["conv_id", "block"])
    child = (F.col("n") > F.col("depth")) & (F.col("own_from") <= F.col("depth") + 1)
    return cut(
        rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.first("px").alias("px"),
            F.first("py").alias("py"),
            F.max(F.col("own_from") == F.col("depth")).alias("top"),
            F.count("*").alias("n_convs"),
            F.sum(child.cast("long")).alias("n_children"),
            F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
            F.sum(F.greatest(F.col("own_above") - F.col("above"), F.lit(0))).alias("saved_tokens"),
        )
    )


def parents(nodes: DataFrame) -> DataFrame:
    """The topmost owned node of each conversation (but the root) with its parent's owner, whatever a parent's number of children."""
    up = nodes.where("n_children > 0").select(*NODE, F.lit(0).alias("kind"), F.lit(None).cast("long").alias("conv_id"), F.col("conv_id").alias("owner"))
    down = nodes.where("top and depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"), F.lit(1).alias("kind"), "conv_id", F.lit(0).cast("long").alias("owner"))
    along = running(up.unionByName(down), NODE, [F.col("kind"), F.col("conv_id")], sums={"parent_conv_id": "owner"})
    return along.where("kind = 1").select("conv_id", "parent_conv_id")


def _pieces(batches):
    """Joined ids of each node's ends, in their order, in pieces."""
    names = [*NODE, "first", "piece"]
    key, first, held, size = None, None, [], 0
    out: list[tuple] = []

    def close():
        if held:
            out.append((*key, first, ",".join(held)))

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n < 4 else pa.string()) for n, c in enumerate(zip(*out))], names)

    for b in batches:
        for *node, conv in zip(*(b[c].to_pylist() for c in (*NODE, "conv_id"))):
            if node != key or size >= PIECE:
                close()
                key, first, held, size = node, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield batch()
            out = []
    close()
    if out:
        yield batch()


def _hashes(batches):
    """SHA-256 of each node's pieces, joined, as they come."""
    key, digest, out = None, None, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n < 3 else pa.string()) for n, c in enumerate(zip(*out))], [*NODE, "ends_sha256"])

    for b in batches:
        for *node, piece in zip(*(b[c].to_pylist() for c in (*NODE, "piece"))):
            if node == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = node, hashlib.sha256()
            digest.update(piece.encode())
        if out:
            yield batch()
            out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
        yield batch()


def ends(occ: DataFrame) -> DataFrame:
    """ends_sha256 of every node at which conversations end: of their ids, ascending, with commas between."""
    rows = occ.where("depth = n").select(*NODE, "conv_id")
    dealt = rows.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = dealt.mapInArrow(_pieces, "depth long, x long, y long, first long, piece string")
    by_node = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return by_node.mapInArrow(_hashes, "depth long, x long, y long, ends_sha256 string")


def trie(conversations: DataFrame, *, every: int = 100, modulus: int = 6) -> DataFrame:
    """The nodes of all rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    occ = occurrences(*rebuilt(ordered(conversations), every=every, modulus=modulus))
    nodes = summed(occ, ownership(occ))
    # a conversation has one topmost node, and a node one owner and depth, so no key of these joins has many rows
    tops = nodes.where("top and depth > 0").select("conv_id", *NODE).join(parents(nodes), "conv_id").drop("conv_id")
    whole = nodes.join(tops, NODE, "left").join(ends(occ), NODE, "left")
    parent = F.when(F.col("depth") == 0, None).when(F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id")
    return whole.select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
