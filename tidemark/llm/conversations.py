"""The trie of conversation prefixes and the totals of its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. A conversation's prefixes get two running sums of
hashes of (depth, role, text), 122 bits together, so texts are hashed where they are read and
never shuffled, and a conversation of any length is spread over many tasks.

Totals come from tree contraction: every round rakes all leaves into their parents and splices
nodes with one child left out of their chains, where their hash is smaller than those of both
neighbours. Spliced nodes are re-expanded from the last round to the first. Rounds follow the
logarithm of the tree, however deep its chains are. Children are only ever summed and counted
before a shuffle, so a parent of a third of all nodes costs a row per task.

Null role or text counts as empty, a null turn comes first, and turns with equal numbers are
ordered by a digest of role and text; a repeated row is a turn of its own. Rows with a null
conv_id belong to no conversation. An empty table gives no conversation and no node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_to_one
from tidemark.operators.ranking import with_group_totals
from tidemark.scratch import discard, keep

#: Conversations share the beginning of the one whose id is the next lower multiple of FAMILY,
#: for crc32(id) mod LONGEST_START turns.
FAMILY, LONGEST_START = 5, 9
_PRIME = (1 << 61) - 1


def _digest(content: Column, part: int) -> Column:
    """Half of an MD5 as a long."""
    half = F.substring(F.md5(content), 1 + 16 * part, 15)
    return F.conv(half, 16, 10).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, pos (from 0), digests a and b of role and text, bytes of the text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        _digest(content, 0).alias("a"),
        _digest(content, 1).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(1).cast("long").alias("one"),
    )
    slim = keep(slim, "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("row")]
    placed = with_group_totals(slim, ["conv_id"], order, ["one"])
    return placed.select("conv_id", (F.col("cum_one") - 1).alias("pos"), "a", "b", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, length) of each, and their turns with depth from 1.

    Conversation c takes the first h turns of c - c % 5 (all if it has fewer, none if it is
    absent), then its own turns after its first h; h = crc32(decimal c) % 9.
    """
    sizes = keep(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conv-sizes")
    family = sizes.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % LONGEST_START).alias("h"),
    )
    base_sizes = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    shared = F.least("h", F.coalesce("n_base", F.lit(0)))
    family = keep(family.join(base_sizes, "base", "left").withColumn("shared", shared), "conv-family")
    own = (
        join_to_one(turns, family.select("conv_id", "h", "shared"), ["conv_id"])
        .where("pos >= h")
        .select("conv_id", (F.col("shared") + F.col("pos") - F.col("h") + 1).alias("depth"), "a", "b", "bytes")
    )
    first = turns.where(F.col("pos") < LONGEST_START - 1).withColumnRenamed("conv_id", "base")
    taken = (
        first.join(family.select("conv_id", "base", "h"), "base")
        .where("pos < h")
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", "bytes")
    )
    lengths = family.select("conv_id", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return lengths, own.unionByName(taken)


def prefix_nodes(lengths: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie: nodes (node, parent, conv_id, depth, parent_conv_id, n_convs, bytes) and, per
    conversation, the node where it ends (node, conv_id).

    ``lengths`` has conv_id and length, ``turns`` conv_id, depth, digests a and b, bytes. A
    node's conv_id is its smallest member; parent is null for the root alone.
    """
    value = lambda salt: F.xxhash64(F.lit(salt), "depth", "a", "b").cast("decimal(20,0)")
    valued = turns.select("conv_id", "depth", "bytes", value(1).alias("va"), value(2).alias("vb"))
    placed = with_group_totals(valued, ["conv_id"], [F.col("depth")], ["va", "vb"])
    short = lambda x: (x % F.lit(_PRIME).cast("decimal(20,0)")).cast("long")
    steps = keep(
        placed.select(
            "conv_id", "depth", "bytes",
            short(F.col("cum_va")).alias("ha"), short(F.col("cum_vb")).alias("hb"),
            short(F.col("cum_va") - F.col("va")).alias("pa"), short(F.col("cum_vb") - F.col("vb")).alias("pb"),
        ),
        "prefix-steps",
    )
    key = ["depth", "ha", "hb"]
    inner = steps.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("bytes").alias("bytes"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), zero.alias("ha"), zero.alias("hb"), "conv_id", "n_convs",
        zero.alias("bytes"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
    )
    found = keep(inner.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "prefix-found")
    above = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("ha").alias("pa"), F.col("hb").alias("pb"),
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = keep(
        join_to_one(found, above, ["depth", "pa", "pb"], "left").select(
            "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "bytes", "ha", "hb"
        ),
        "prefix-nodes",
    )
    last = steps.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"], "left_semi").select("conv_id", *key)
    none = lengths.where("length = 0").select("conv_id", zero.alias("depth"), zero.alias("ha"), zero.alias("hb"))
    ends = keep(last.unionByName(none), "prefix-ends")
    ended = keep(join_to_one(ends, nodes.select(*key, "node"), key).select("node", "conv_id"), "prefix-ended")
    discard(found, ends, steps)
    return nodes.drop("ha", "hb"), ended


def _priority(node: Column, turn: int) -> Column:
    return F.struct(F.xxhash64(F.lit(turn), node), node)


def subtree_totals(nodes: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(node, measures): the sum of every measure over each node's subtree, itself included.

    ``nodes`` has node (unique long), parent (null for a root; a forest is fine) and long
    measures without nulls. Rake and compress in join rounds:

    * rake: every leaf's total is final and goes to its parent;
    * compress: a node with one child left, whose hash is below its child's and its parent's,
      is spliced out; the child carries what it held on to the grandparent;
    * expand, last round first: a spliced node's total is what it held plus its child's total.
    """
    up = [f"up_{m}" for m in measures]
    first = nodes.select(F.col("parent").alias("node")).where("node is not null").distinct()
    live = keep(
        nodes.join(first.withColumn("inner", F.lit(True)), "node", "left").select(
            "node", "parent", F.col("inner").isNull().alias("leaf"),
            *[F.lit(0).cast("long").alias(u) for u in up], *[F.col(m).cast("long").alias(m) for m in measures],
        ),
        "tree-live",
    )
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not live.isEmpty():
        turn = len(rounds)
        children = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            *[F.coalesce(F.sum(F.when(F.col("leaf"), F.col(m) + F.col(f"up_{m}"))), F.lit(0)).alias(f"gain_{m}") for m in measures],
            F.count(F.when(~F.col("leaf"), 1)).alias("left"),
            F.min(F.when(~F.col("leaf"), F.struct("node", *up))).alias("only"),
        )
        chosen = (
            F.col("parent").isNotNull()
            & (F.col("left") == 1)
            & (_priority(F.col("node"), turn) < _priority(F.col("only.node"), turn))
            & (_priority(F.col("node"), turn) < _priority(F.col("parent"), turn))
        )
        raked = keep(
            live.where(~F.col("leaf")).join(children, "node").select(
                "node", "parent", (F.col("left") == 0).alias("leaf"), *up,
                *[(F.col(m) + F.col(f"gain_{m}")).alias(m) for m in measures],
                "only", F.coalesce(chosen, F.lit(False)).alias("chosen"),
            ),
            "tree-raked",
        )
        spliced = raked.where("chosen")
        moves = spliced.select(
            F.col("only.node").alias("node"), F.col("parent").alias("grand"),
            *[(F.col(m) + F.col(f"up_{m}")).alias(f"more_{m}") for m in measures],
        )
        after = keep(
            raked.where("not chosen").join(moves, "node", "left").select(
                "node", F.coalesce("grand", "parent").alias("parent"), "leaf",
                *[(F.col(f"up_{m}") + F.coalesce(f"more_{m}", F.lit(0))).alias(f"up_{m}") for m in measures], *measures,
            ),
            "tree-live",
        )
        rounds.append((live, raked))
        live = after
    if not rounds:
        return live.select("node", *measures)
    totals = None
    while rounds:
        before, raked = rounds.pop()
        known = before.where("leaf").select("node", *measures)
        if totals is None:
            totals = keep(known, "tree-totals")
        else:
            below = totals.select(F.col("node").alias("child"), *[F.col(m).alias(f"sub_{m}") for m in measures])
            held = raked.where("chosen").select(
                "node", F.col("only.node").alias("child"),
                *[(F.col(m) + F.col(f"only.up_{m}")).alias(m) for m in measures],
            )
            grown = held.join(below, "child").select(
                "node", *[(F.col(m) + F.col(f"sub_{m}")).alias(m) for m in measures]
            )
            wider = keep(totals.unionByName(known).unionByName(grown), "tree-totals")
            discard(totals)
            totals = wider
        discard(before, raked)
    discard(live)
    return totals


def conversation_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens) and the ends (node, conv_id) of the rebuilt conversations.

    saved_tokens is the sum over a node's subtree of (n_convs - 1) times the UTF-8 bytes of a
    node's last text: what a store that keeps every node once does not write again.
    """
    lengths, turns = rebuilt_turns(keep(ordered_turns(conversations), "conv-turns"))
    nodes, ends = prefix_nodes(lengths, turns)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    counted = keep(nodes.join(children, "node", "left").na.fill({"n_children": 0}), "trie-nodes")
    weighed = counted.select(
        "node", "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(weighed, ["n_leaves", "saved_tokens"])
    return keep(counted.drop("bytes").join(totals, "node"), "trie"), ends


#: Ids joined into one piece of a node's list; pieces are what the digest's task reads.
PIECE = 1 << 15


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's ids, ascending, joined by commas.

    Ids are range-sorted and joined into pieces where they lie; SHA-256 reads a list from its
    start to its end, so a node's pieces, not its rows, are streamed through one task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        out: list[tuple] = []

        def close():
            if ids:
                out.append((node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def made():
            part = pa.RecordBatch.from_pylist(
                [dict(zip(("node", "first", "ids"), r, strict=True)) for r in out],
                pa.schema([("node", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]),
            )
            out.clear()
            return part

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node or len(ids) == PIECE:
                    close()
                    node = n
                ids.append(c)
            if len(out) >= 1024:
                yield made()
        close()
        if out:
            yield made()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, found = None, None, []
        for batch in batches:
            for n, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n == node:
                    state.update(b",")
                else:
                    if state is not None:
                        found.append((node, state.hexdigest()))
                    node, state = n, sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([h for _, h in found], pa.string())],
                ["node", "ends_sha256"],
            )
            found = []
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["node", "ends_sha256"]
            )

    ranged = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = ranged.select("node", "conv_id").mapInArrow(pieces, "node long, first long, ids string")
    whole = joined.repartition("node").sortWithinPartitions("node", "first")
    return whole.mapInArrow(digest, "node long, ends_sha256 string")


def trie_digest(conversations: DataFrame) -> DataFrame:
    """The trie's nodes with a digest of the conversations that end at each."""
    nodes, ends = conversation_trie(conversations)
    return nodes.join(ends_digests(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
