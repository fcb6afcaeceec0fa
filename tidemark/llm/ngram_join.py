"""N-gram Jaccard self-join by prefix filters under several global token orders.

Two sets of similarity 0.8 share a token among the first n - ceil(0.8 n) + 1 of each, in
whatever order all tokens are put. Tokens fall into ``ORDERS`` classes by hash; order k puts tokens that
only one document has first, then class k, then the next class and so on, and within a class
rare tokens before frequent ones. A candidate must share a prefix token in every order.

The filters are intersected one after the other. Each order counts its class among the
documents that the orders before it left; a document whose tokens of its own already fill its
prefix has no partner and goes, so an order only shuffles what is still possible. Candidates
then meet in the buckets of prefix tokens, first with one member per bucket, the one with the
fewest tokens of its own, so that a family of any size is linked by as many pairs as it has
members. Only buckets that still span components form pairs; members of large ones are compared
block by block in tasks that hand on links only. Every link is confirmed on full sets, and no
bucket or document is cut.

Equal sets are one class, represented by its smallest id. Null, empty and wordless texts have
no shingles and are linked with nothing. A null id is never linked; its component is null. Rows
that repeat an id are one node with the links of all its texts, and never ruled out early.
Shingles are 64-bit hashes. Other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import chunks, mix
from tidemark.llm.components import component_labels, merged_labels
from tidemark.llm.near_duplicates import _linked_in_blocks, confirmed, shingle_sets
from tidemark.scratch import discard, keep

ORDERS = 3
#: Links from this similarity on, in percent.
PERCENT = 80
#: Open buckets up to this size form pairs; members of larger ones are compared in blocks.
SMALL_BUCKET = 64


def set_sizes(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, n_shingles and a fingerprint of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                sets, bounds = shingle_sets(texts, width)
                size = np.diff(bounds)
                starts = bounds[:-1][size > 0]
                prints = np.zeros((2, len(size)), np.uint64)
                if len(starts):
                    prints[0, size > 0] = np.add.reduceat(mix(sets), starts)
                    prints[1, size > 0] = np.bitwise_xor.reduceat(mix(sets + np.uint64(0x632BE59BD9B4E019)), starts)
                columns = [pa.array(size, pa.int64()), *[pa.array(p.view(np.int64)) for p in prints]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *columns], ["doc_id", "n_shingles", "fp_a", "fp_b"]
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_shingles long, fp_a long, fp_b long")


def tokens_of(docs: DataFrame, width: int, only: int | None = None) -> DataFrame:
    """(rep, token) for every shingle of every text, of one class or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                sets, bounds = shingle_sets(texts, width)
                owner = np.repeat(np.arange(lo, hi), np.diff(bounds))
                token = np.ascontiguousarray(sets).view(np.int64)
                if only is not None:
                    mine = token % ORDERS == only
                    token, owner = token[mine], owner[mine]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), pa.array(token)], ["rep", "token"]
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"rep {key}, token long")


def _alone(tokens: DataFrame) -> DataFrame:
    """(rep, more): how many of a document's tokens no other document has."""
    owned = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("owners"), F.min("rep").alias("rep"))
    return owned.where("owners = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("more"))


def _texts(docs: DataFrame, live: DataFrame) -> DataFrame:
    ids = live.select(F.col("rep").alias("doc_id")).distinct()
    return docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")


def _possible() -> Column:
    """Whether a document's shared tokens can still reach the similarity with some set."""
    return F.col("free") | ((F.col("n") - F.col("alone")) * 100 >= PERCENT * F.col("n"))


def survivors(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """The rows of ``reps`` (rep, n, free) that every order leaves, with ``alone``."""
    live = reps.withColumn("alone", F.lit(0).cast("long"))
    for k in range(ORDERS):
        # The first order reads all texts where they lie; a copy only makes it less strict.
        texts = _texts(docs, live) if k else docs.where("doc_id is not null")
        more = _alone(tokens_of(texts, width, k))
        counted = live.join(more, "rep", "left").withColumn("alone", F.col("alone") + F.coalesce("more", F.lit(0)))
        after = keep(counted.drop("more").where(_possible()), "join-live")
        if k:
            discard(live)
        live = after
    return live


def _prefixes_of(batch: pa.RecordBatch) -> list[pa.Array]:
    """The prefix of every document of a batch (n, free, held as df and token) in every order."""
    n, free = np.asarray(batch["n"]), batch["free"].to_numpy(zero_copy_only=False)
    held = batch["held"]
    doc = np.asarray(pc.list_parent_indices(held)).astype(np.int64)
    df, token = (np.asarray(pc.struct_field(pc.list_flatten(held), f)) for f in ("df", "token"))
    size = np.bincount(doc, minlength=len(n))
    # Tokens that no other document has come first in every order, whatever their class.
    length = n - -(-n * PERCENT // 100) + 1
    room = np.where(free, size, np.clip(length - (n - size), 0, size))
    start = np.cumsum(size) - size
    out = []
    for k in range(ORDERS):
        order = np.lexsort((token, df, (token % ORDERS - k) % ORDERS, doc))
        chosen = order[np.arange(len(order)) - start[doc] < room[doc]]
        bounds = np.concatenate([[0], np.cumsum(room)]).astype(np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(token[chosen])))
    return out


def prefixes(docs: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """Per live document: rep, n, alone and, for every order k, p<k>: the prefix tokens in
    that order that another document has. Documents with an empty prefix are left out."""
    tokens = keep(tokens_of(_texts(docs, live), width), "join-tokens")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = (
        tokens.join(shared, "token")
        .groupBy("rep")
        .agg(F.collect_list(F.struct("df", "token")).alias("held"))
        .join(live, "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch[c] for c in ("rep", "n", "alone", "free")]
            yield pa.RecordBatch.from_arrays([*kept, *_prefixes_of(batch)], ["rep", "n", "alone", "free", *names])

    names = [f"p{k}" for k in range(ORDERS)]
    key = live.schema["rep"].dataType.simpleString()
    placed = held.select("rep", "n", "alone", "free", "held").mapInArrow(
        run, f"rep {key}, n long, alone long, free boolean, " + ", ".join(f"{p} array<long>" for p in names)
    )
    some = F.lit(True)
    for p in names:
        some = some & (F.size(p) > 0)
    found = keep(placed.where(some), "join-prefixes")
    discard(tokens)
    return found


def _rows(found: DataFrame) -> DataFrame:
    """(k, token, rep, n, alone) for every prefix token in every order."""
    each = [found.select(F.lit(k).alias("k"), F.explode(f"p{k}").alias("token"), "rep", "n", "alone") for k in range(ORDERS)]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def _open(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of buckets that span components, of documents that have such in every order."""
    if labels is None:
        labelled = rows.withColumn("label", F.col("rep"))
    else:
        known = labels.withColumnRenamed("node", "rep")
        labelled = rows.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = labelled.groupBy("k", "token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    opened = keep(labelled.join(mixed.select("k", "token"), ["k", "token"]), "join-open")
    whole = opened.groupBy("rep").agg(F.count_distinct("k").alias("ks")).where(F.col("ks") == ORDERS)
    return keep(opened.join(whole.select("rep"), "rep", "left_semi"), "join-open")


def _sized(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= PERCENT * F.greatest(a, b)


def _with_leaders(rows: DataFrame, seed: int) -> DataFrame:
    """Pairs (a, b) of a document and a leader whose buckets it is in under every order.

    A bucket's leader has the fewest tokens of its own at first, later the least hash."""
    rank = F.struct(
        *([F.col("alone")] if seed == 0 else []), F.xxhash64("rep", F.lit(seed)).alias("h"), "rep", "n", "label"
    )
    leaders = rows.groupBy("k", "token").agg(F.min(rank).alias("o"))
    met = (
        rows.join(leaders, ["k", "token"])
        .where((F.col("label") != F.col("o.label")) & _sized(F.col("n"), F.col("o.n")))
        .groupBy(F.col("rep").alias("a"), F.col("o.rep").alias("b"))
        .agg(F.count_distinct("k").alias("ks"))
    )
    return met.where(F.col("ks") == ORDERS).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _across(rows: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs across components that share a prefix token in every order, from the buckets
    of the first order; the other orders' prefixes are compared before anything is verified."""
    others = [f"p{k}" for k in range(1, ORDERS)]
    held = rows.select("token", "rep", "label", "n").join(found.select("rep", *others), "rep")
    other = held.select("token", *[F.col(c).alias(f"{c}_b") for c in ("rep", "label", "n", *others)])
    met = held.join(other, "token").where(
        (F.col("rep") > F.col("rep_b")) & (F.col("label") != F.col("label_b")) & _sized(F.col("n"), F.col("n_b"))
    )
    for p in others:
        met = met.where(F.arrays_overlap(p, f"{p}_b"))
    return met.select(F.col("rep").alias("a"), F.col("rep_b").alias("b")).distinct()


def links_across(docs: DataFrame, found: DataFrame, own: DataFrame, width: int) -> DataFrame:
    """(node, label): the components of the documents in ``found`` and of the links ``own``."""
    rows = keep(_rows(found), "join-rows")
    labels = component_labels(keep(own, "join-own"))
    tried = None
    for seed in (0, 1):
        opened = _open(rows, labels)
        pairs = keep(_with_leaders(opened, seed), "join-pairs")
        fresh = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        labels = merged_labels(labels, keep(confirmed(fresh, docs, width), "join-links"))
        tried = pairs if tried is None else tried.union(pairs)
    first = keep(_open(rows, labels).where("k = 0"), "join-first")
    sizes = first.groupBy("token").agg(F.count(F.lit(1)).alias("members"))
    sized = first.join(sizes, "token")
    few = _across(sized.where(F.col("members") <= SMALL_BUCKET), found).join(tried, ["a", "b"], "left_anti")
    fresh = keep(few, "join-pairs")
    if not fresh.isEmpty():
        labels = merged_labels(labels, keep(confirmed(fresh, docs, width), "join-links"))
    many = keep(sized.where(F.col("members") > SMALL_BUCKET).select(F.col("token").alias("key"), "rep"), "join-many")
    if many.isEmpty():
        return labels
    known = labels.withColumnRenamed("node", "rep")
    placed = many.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    still = keep(placed.join(mixed.select("key"), "key"), "join-many")
    if still.isEmpty():
        return labels
    return merged_labels(labels, keep(_linked_in_blocks(still, docs, width), "join-links"))


def jaccard_components(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    sizes = keep(set_sizes(docs, width), "join-sizes")
    able = sizes.where("doc_id is not null and n_shingles > 0")
    same = ["fp_a", "fp_b", "n_shingles"]
    classes = keep(able.groupBy(*same).agg(F.min("doc_id").alias("rep")), "join-classes")
    member_of = keep(able.join(classes, same).select("doc_id", "rep", "n_shingles").distinct(), "join-members")
    several = member_of.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("y"), F.count(F.lit(1)).alias("texts"))
    several = keep(several.where("texts > 1"), "join-several")
    free = several.select(F.col("doc_id").alias("rep"), F.lit(True).alias("free"))
    reps = (
        classes.groupBy("rep").agg(F.max("n_shingles").alias("n")).join(free, "rep", "left")
        .withColumn("free", F.coalesce("free", F.lit(False)))
    )
    own = member_of.join(several.select("doc_id", "b"), "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b")
    live = survivors(docs, keep(reps, "join-reps"), width)
    found = prefixes(docs, live, width)
    labels = links_across(docs, found, own, width)
    least = (
        member_of.select("doc_id", "rep").distinct()
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("label"))
    )
    component = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return sizes.select("doc_id", "n_shingles").join(least, "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )
