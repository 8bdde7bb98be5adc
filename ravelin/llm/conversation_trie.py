"""Trie of conversation prefixes: every distinct sequence of first turns is a node, with what a cache of it would save.

* A turn is one digest of its role and text, made where it is read, so no text is ever shuffled. Turns are ranked within
  their conversation by range partitions, and prefixes get digests of digests, block by block: neither step takes a
  conversation into one task.
* Prefixes are summed by digest: the least conversation, the node's *owner*, and how many there are. A conversation that
  owns a node owns all nodes further down its own path, so its first owned depth is found by binary search, all
  conversations at once: each round joins one prefix of each that is still open to the least owners.
* The nodes of an owner form a chain, whose top hangs on a node of another chain. Chains are summed bottom-up, those
  first on which no open chain hangs, and within a chain by running sums from its end.
* The members that end at a node are sorted by range partitions and joined to texts of ``CHUNK`` ids where they
  lie; SHA-256 has no other order than the first to the last, so the chunks of one node are then hashed in one task, as a
  stream.

Cases: rows without conv_id are no conversation's; a null turn comes first, and rows that share a turn come in the order
of their digests; null role or text is empty. Repeated rows are turns of their own. A conversation without turns belongs to
the root. No conversations give no nodes. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import discard, map_arrow, materialize
from ravelin.llm.prefix import ranked, running

#: Turns whose digests make a block's, as a power of two; ids in one piece of text; share of all prefixes from which a node's
#: owner is broadcast (so at most as many nodes are).
BLOCK_BITS = 4
CHUNK = 4096
HOT = 1000


def digested(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n_bytes) of every row that belongs to a conversation."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.sha2(whole.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def in_order(turns: DataFrame) -> DataFrame:
    """``turns`` (as ``digested`` gives them) with ``at``, their place in the conversation from 0."""
    return ranked(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], "at", "turns")


def rebuilt(ordered: DataFrame, family: int = 5, spread: int = 9) -> DataFrame:
    """Turns of conversations that share beginnings: conversation c begins with the first h turns of conversation
    c - c % ``family``, h being crc32 of its decimal id modulo ``spread``, and goes on with its own after its first h.

    ``ordered`` is what ``in_order`` gives; at most ``family`` conversations read the first turns of one.
    """
    ids = ordered.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread)
    ids = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    begins = ordered.where(F.col("at") < spread - 1).select(F.col("conv_id").alias("base"), "at", "digest", "n_bytes")
    taken = ids.join(begins, "base").where(F.col("at") < F.col("h")).select("conv_id", F.col("at").alias("turn"), "digest", "n_bytes")
    own = ordered.where(F.col("at") >= F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).select("conv_id", F.col("at").alias("turn"), "digest", "n_bytes")
    return taken.unionByName(own)


def prefix_digests(turns: DataFrame, span: int) -> DataFrame:
    """(conv_id, at, prefix): a digest of the turns up to and with each place, from 0 to ``span``."""
    block = F.shiftright("at", BLOCK_BITS)
    path = Window.partitionBy("conv_id", block).orderBy("at")
    own = turns.select("conv_id", "at", F.sha2(F.concat_ws("", F.collect_list("digest").over(path.rowsBetween(Window.unboundedPreceding, 0))).cast("binary"), 256).alias("prefix"))
    if span < 1 << BLOCK_BITS:
        return own
    blocks = own.groupBy("conv_id", block.alias("block")).agg(F.max_by("prefix", "at").alias("digest"))
    above = prefix_digests(blocks.withColumnRenamed("block", "at"), span >> BLOCK_BITS).select("conv_id", (F.col("at") + 1).alias("block"), F.col("prefix").alias("before"))
    both = own.withColumn("block", block).join(above, ["conv_id", "block"], "left")
    return both.select("conv_id", "at", F.when(F.col("before").isNull(), F.col("prefix")).otherwise(F.sha2(F.concat("before", "prefix").cast("binary"), 256)).alias("prefix"))


def first_owned(prefixes: DataFrame, owners: DataFrame, lengths: DataFrame, longest: int) -> DataFrame:
    """(conv_id, n_turns, first): the least depth at which the conversation is its node's owner, or n_turns + 1."""
    state = lengths.select("conv_id", "n_turns", F.lit(1).cast("long").alias("first"), (F.col("n_turns") + 1).alias("last"))
    while longest:
        state = state.withColumn("depth", F.when(F.col("first") < F.col("last"), F.call_function("div", F.col("first") + F.col("last"), F.lit(2).cast("long"))))
        asked = state.where("depth IS NOT NULL").select("conv_id", "depth").join(prefixes, ["conv_id", "depth"])
        asked = asked.join(owners.select(F.col("prefix").alias("cold"), F.col("conv_id").alias("owner")), "cold", "left").select("conv_id", (F.coalesce("hot_owner", "owner") == F.col("conv_id")).alias("owned"))
        state = state.join(asked, "conv_id", "left").select("conv_id", "n_turns", F.when(~F.col("owned"), F.col("depth") + 1).otherwise(F.col("first")).alias("first"), F.when(F.col("owned"), F.col("depth")).otherwise(F.col("last")).alias("last"))
        state = materialize(state, "first-owned")
        longest >>= 1
    return state.select("conv_id", "n_turns", "first")


def chain_totals(chains: DataFrame) -> DataFrame:
    """``chains`` (conv_id, parent_conv_id, parent_depth, saved, leaves), the sums with those of all chains below added.

    Every round finishes the chains on which none hangs that is not; there are as many rounds as chains upon chains.
    """
    kids = chains.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("kids")).where("conv_id IS NOT NULL")
    left = materialize(chains.join(kids, "conv_id", "left").fillna(0, ["kids"]), "chains")
    done = None
    while True:
        ready = materialize(left.where("kids = 0").drop("kids"), "chains-done")
        done = ready if done is None else done.unionByName(ready)
        sums = ready.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("n"), F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        ahead = left.where("kids > 0").join(sums, "conv_id", "left").fillna(0, ["n", "s", "l"])
        ahead = materialize(ahead.select("conv_id", "parent_conv_id", "parent_depth", (F.col("saved") + F.col("s")).alias("saved"), (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("kids") - F.col("n")).alias("kids")), "chains")
        discard(left)
        left = ahead
        if left.isEmpty():
            return done


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (prefix, conv_id) to texts of at most ``CHUNK`` ids."""
    for batch in batches:
        rows = zip(batch["prefix"].to_pylist(), batch["conv_id"].to_pylist(), strict=True)
        out = []
        for prefix, members in groupby(rows, key=lambda r: r[0]):
            ids = [m for _, m in members]
            out += [(prefix, ids[i], ",".join(map(str, ids[i : i + CHUNK]))) for i in range(0, len(ids), CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["prefix", "least", "ids"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one SHA-256 for each prefix; the hash that is open goes on in the next batch."""
    now, held = None, None

    def result(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([h for _, h in found], pa.string())], ["prefix", "ends_sha256"])

    for batch in batches:
        found = []
        for prefix, ids in zip(batch["prefix"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if held is None or prefix != now:
                if held is not None:
                    found.append((now, held.hexdigest()))
                now, held = prefix, hashlib.sha256(ids.encode())
            else:
                held.update(b"," + ids.encode())
        yield result(found)
    if held is not None:
        yield result([(now, held.hexdigest())])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, conv_id): SHA-256 of the ids in ascending order, joined by commas."""
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = map_arrow(ends.select("prefix", "conv_id").repartitionByRange(tasks, "prefix", "conv_id").sortWithinPartitions("prefix", "conv_id"), _pieces, "prefix string, least long, ids string")
    return map_arrow(pieces.repartition("prefix").sortWithinPartitions("prefix", "least"), _hashes, "prefix string, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, turn, digest, n_bytes, as ``digested`` gives them).

    ``ids`` names conversations (conv_id) that may have no turn. Per node, all long but the last: conv_id, its smallest
    member; depth; parent_conv_id, its parent's conv_id; n_convs, its members; n_children; n_leaves, the childless nodes of its
    subtree; saved_tokens, over its subtree, a node's (n_convs - 1) times the bytes of its last text; ends_sha256, the
    SHA-256 of the ids of the members that end there.
    """
    turns = materialize(in_order(turns).select("conv_id", "at", "digest", "n_bytes"), "turns-in-order")
    known = turns.select("conv_id") if ids is None else turns.select("conv_id").union(ids.select(F.col("conv_id").cast("long")).where("conv_id IS NOT NULL"))
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    lengths = materialize(known.distinct().join(lengths, "conv_id", "left").fillna(0, ["n_turns"]), "lengths")
    n_convs, root, longest, n_turns = lengths.agg(F.count("*"), F.min("conv_id"), F.max("n_turns"), F.sum("n_turns")).first()
    longest = longest or 0

    by_depth = materialize(prefix_digests(turns, longest).join(turns, ["conv_id", "at"]).select("conv_id", (F.col("at") + 1).alias("depth"), "prefix", "n_bytes"), "prefixes")
    nodes = materialize(by_depth.groupBy("depth", "prefix").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes")), "nodes")
    # The counts add up to n_turns, so fewer than HOT + 1 nodes have that share; the rest of the prefixes is dealt by prefix.
    hot = F.broadcast(nodes.where(F.col("n_convs") * HOT >= F.lit(n_turns or 0)).select("prefix", F.col("conv_id").alias("hot_owner")))
    cold = F.when(F.col("hot_owner").isNull(), F.col("prefix")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    prefixes = materialize(by_depth.join(hot, "prefix", "left").select("conv_id", "depth", "prefix", "hot_owner", cold.alias("cold")), "prefixes-hot")
    owners = nodes.select("prefix", "conv_id")

    first = first_owned(prefixes, owners, lengths, longest)
    tops = first.where("first <= n_turns").withColumn("depth", F.col("first") - 1)
    above = tops.join(prefixes, ["conv_id", "depth"], "left").join(owners.select(F.col("prefix").alias("cold"), F.col("conv_id").alias("owner")), "cold", "left")
    is_root = F.col("conv_id") == F.lit(root)
    parent = F.when(is_root, None).when(F.col("depth") == 0, F.lit(root)).otherwise(F.coalesce("hot_owner", "owner")).cast("long")
    chains = above.select("conv_id", "n_turns", "first", parent.alias("parent_conv_id"), F.col("depth").alias("parent_depth"))
    chains = materialize(chains.unionByName(lengths.where(is_root & (F.col("n_turns") == 0)).select("conv_id", "n_turns", F.lit(1).cast("long").alias("first"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(0).cast("long").alias("parent_depth"))), "chains-found")

    top = lengths.where(is_root).select(F.lit(0).cast("long").alias("depth"), F.lit("").alias("prefix"), "conv_id", F.lit(n_convs).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("n_bytes"))
    hung = chains.where("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth")).agg(F.count("*").alias("hung"))
    placed = nodes.unionByName(top).join(chains, "conv_id").join(hung, ["conv_id", "depth"], "left")
    n_children = F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("n_turns")).cast("long")
    placed = placed.withColumns({"n_children": n_children, "saved": (F.col("n_convs") - 1) * F.col("n_bytes"), "leaves": (n_children == 0).cast("long"), "parent_conv_id": F.when((F.col("depth") > F.col("first")) | is_root & (F.col("depth") > 0), F.col("conv_id")).otherwise(F.col("parent_conv_id"))})
    placed = materialize(placed.select("conv_id", "depth", "prefix", "parent_conv_id", "n_convs", "n_children", "saved", "leaves"), "nodes-placed")

    sums = placed.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    totals = chain_totals(chains.select("conv_id", "parent_conv_id", "parent_depth").join(sums, "conv_id"))
    below = totals.where("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth")).agg(F.sum("saved").alias("saved_below"), F.sum("leaves").alias("leaves_below"))
    own = placed.join(below.withColumnRenamed("depth", "d").withColumnRenamed("conv_id", "c"), (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left").drop("c", "d").fillna(0, ["saved_below", "leaves_below"])
    own = own.withColumns({"saved": F.col("saved") + F.col("saved_below"), "leaves": F.col("leaves") + F.col("leaves_below")}).drop("saved_below", "leaves_below")
    summed = running(own, "depth", ["saved", "leaves"], longest, ("conv_id",), descending=True)

    last = prefixes.join(lengths.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select("prefix", "conv_id")
    ends = ends_hashes(last.unionByName(lengths.where("n_turns = 0").select(F.lit("").alias("prefix"), "conv_id")))
    return summed.join(ends, "prefix", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
