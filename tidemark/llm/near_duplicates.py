"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

A document gets a few small collections of minhashes. A table's key is a pair of
collections, so c collections make c(c-1)/2 tables: 112 minhashes serve 378 tables of
8-hash keys, where plain banding would need 3,024. Two documents meet when they agree on two
collections. At similarity 0.8 a pair is missed with probability below 1e-5; below 0.3 it
rarely meets.

Copies (equal shingle sets) become one class first, so groups of copies of any size cost one
row. Buckets of neighbouring collections then link their members to one drawn by hash. Where
buckets still span components, a document whose own shingles rule out every link is put
aside; the others meet another draw, in all tables. At last small buckets form the pairs
across components that are still possible, and members of large ones are compared block by
block, where a task hands on links only. No pair inside one component is formed, and no
bucket is cut.

Null, empty and wordless texts have no shingles and are linked with nothing. Rows with a null
id are never linked; their component is null and they are kept. Rows that repeat an id are
one node with the links of all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesets import Texts, chunks, mix, windows
from tidemark.llm.components import component_labels, merged_labels
from tidemark.scratch import discard, keep

COLLECTIONS, PER_COLLECTION = 28, 4
N_HASHES = COLLECTIONS * PER_COLLECTION
#: Agreeing minhashes below which a pair is not looked at further: at similarity 0.8 fewer
#: than 62 of 112 agree with probability below 1e-9.
LEAST_AGREEMENT = 62
#: Links from this similarity on, in percent.
PERCENT = 80
#: In open buckets up to this size all pairs are formed; members of larger ones are compared
#: block by block, with so many documents in a block.
SMALL_BUCKET, BLOCK = 64, 512

_SALT = mix(np.arange(1, N_HASHES + 1, dtype=np.uint64))
_ODD = mix(np.arange(1001, N_HASHES + 1001, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and the bounds of the texts."""
    low = texts.lowered()
    start, end, doc = low.words()
    words = low.hashes(start, end)
    n_words = np.bincount(doc, minlength=len(texts))
    hashes, at = windows(words, doc, width)
    all_hashes, owners = [hashes], [doc[at]]
    for k in range(1, width):
        if (n_words == k).any():
            short, at = windows(words, doc, k)
            own = doc[at]
            whole = n_words[own] == k
            all_hashes.append(mix(short[whole] + np.uint64(k)))
            owners.append(own[whole])
    h, d = np.concatenate(all_hashes), np.concatenate(owners)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[first], d[first]
    return h, np.searchsorted(d, np.arange(len(texts) + 1))


def _signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minhashes, one row per non-empty set."""
    out = np.empty((len(starts), N_HASHES), dtype=np.uint64)
    for k in range(N_HASHES):
        out[:, k] = np.minimum.reduceat((sets ^ _SALT[k]) * _ODD[k], starts)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _packed(minhashes: np.ndarray) -> np.ndarray:
    """One long per collection: 16 bits of each of its four minhashes.

    Equal minhashes stay equal; unequal ones look equal once in 65,536, which only adds
    candidates.
    """
    short = np.ascontiguousarray((minhashes >> np.uint64(16)).astype(np.uint16))
    return short.view(np.int64)


def _lists(values: np.ndarray, kind: pa.DataType, filled: np.ndarray) -> pa.ListArray:
    """A list column with one row of ``values`` for each filled entry, else an empty list."""
    offsets = np.concatenate([[0], np.cumsum(np.where(filled, values.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, n_shingles, a fingerprint of the set, its collections of minhashes."""
    source = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                sets, bounds = shingle_sets(texts, width)
                size = np.diff(bounds)
                full = size > 0
                starts = bounds[:-1][full]
                fp = np.zeros((len(size), 2), dtype=np.uint64)
                if len(starts):
                    fp[full, 0] = np.add.reduceat(mix(sets), starts)
                    fp[full, 1] = np.bitwise_xor.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts)
                sig = _signatures(sets, starts) if len(starts) else np.zeros((0, N_HASHES), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(size, pa.int64()),
                        pa.array(_signed(fp[:, 0])),
                        pa.array(_signed(fp[:, 1])),
                        _lists(_packed(sig), pa.int64(), full),
                    ],
                    ["doc_id", "n_shingles", "fp_a", "fp_b", "sig"],
                )

    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {key}, n_shingles long, fp_a long, fp_b long, sig array<long>"
    )


def _table_key(i: Column, part_i: Column, j: Column, part_j: Column) -> Column:
    return F.xxhash64(i, part_i, j, part_j)


def buckets(reps: DataFrame) -> DataFrame:
    """(key, rep) for every table in which at least two class representatives meet, with one
    of the bucket's members drawn by hash, and whether the table's collections are neighbours.

    Only collections shared with another representative can be part of such a key, so the
    pairs of collections are formed from those alone.
    """
    each = reps.select("rep", F.posexplode("sig").alias("i", "part"))
    shared = (
        each.groupBy("i", "part")
        .agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
        .where("lo <> hi")
        .select("i", "part")
    )
    own = (
        each.join(shared, ["i", "part"])
        .groupBy("rep")
        .agg(F.sort_array(F.collect_set(F.struct("i", "part"))).alias("own"))
        .where(F.size("own") >= 2)
    )
    keys = F.flatten(
        F.transform(
            "own",
            lambda x, n: F.transform(
                F.slice("own", n + 2, F.size("own")),
                lambda y: F.struct(
                    _table_key(x["i"], x["part"], y["i"], y["part"]).alias("key"),
                    (y["i"] - x["i"]).isin(1, COLLECTIONS - 1).alias("ring"),
                ),
            ),
        )
    )
    met = keep(own.select("rep", F.explode(keys).alias("k")).select("rep", "k.*"), "near-keys")
    first = F.struct(F.xxhash64("rep", "key", F.lit(1)), F.col("rep").alias("rep"))
    busy = (
        met.groupBy("key")
        .agg(
            F.min("rep").alias("lo"),
            F.max("rep").alias("hi"),
            F.min(first)["rep"].alias("first"),
        )
        .where("lo <> hi")
        .drop("lo", "hi")
    )
    found = keep(met.join(busy, "key"), "near-buckets")
    discard(met)
    return found


def _agreeing(x: Column, y: Column) -> Column:
    """How many of the four minhashes of a collection agree."""
    differ = x.bitwiseXOR(y)
    lanes = [F.shiftrightunsigned(differ, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(PER_COLLECTION)]
    return sum(((lane == 0).cast("int") for lane in lanes[1:]), (lanes[0] == 0).cast("int"))


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose sizes and minhashes allow the similarity."""
    a = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("s_a"))
    b = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("s_b"))
    agree = F.aggregate(F.zip_with("s_a", "s_b", _agreeing), F.lit(0), lambda n, x: n + x)
    sized = F.least("n_a", "n_b") * 100 >= PERCENT * F.greatest("n_a", "n_b")
    return pairs.join(a, "a").join(b, "b").where(sized & (agree >= LEAST_AGREEMENT)).select("a", "b")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) of ids whose full shingle sets are similar enough.

    Texts meet their pairs by id and become hash sets at once; only sets of documents in a
    pair travel on.
    """

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for lo, hi, texts in chunks(batch.column(at)):
                sets, bounds = shingle_sets(texts, width)
                cells = [sets[bounds[i] : bounds[i + 1]].tobytes() for i in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                columns = [c for i, c in enumerate(part.columns) if i != at]
                names = [n for i, n in enumerate(part.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.binary())], [*names, "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep_row = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                union = len(p) + len(q) - both
                keep_row.append(union > 0 and 100 * both >= PERCENT * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep_row, pa.bool_()))

    texts = docs.select(F.col("doc_id").alias("a"), "text").where("a is not null")
    key = texts.schema["a"].dataType.simpleString()
    left = pairs.join(texts, "a").select("a", "b", "text").mapInArrow(to_sets, f"a {key}, b {key}, set binary")
    ends = pairs.select(F.col("b").alias("a")).distinct()
    right = texts.join(ends, "a", "left_semi").select("a", "text").mapInArrow(to_sets, f"a {key}, set binary")
    met = left.withColumnRenamed("set", "set_a").join(
        right.select(F.col("a").alias("b"), F.col("set").alias("set_b")), "b"
    )
    return met.select("a", "b", "set_a", "set_b").mapInArrow(compare, f"a {key}, b {key}").distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _could_link(overlap: Column, size_a: Column, size_b: Column) -> Column:
    """Whether sets of these sizes with at most this overlap can reach the similarity."""
    return overlap * (100 + PERCENT) >= PERCENT * (size_a + size_b)


def _open_rows(met: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the buckets that span several components, with their component."""
    known = labels.withColumnRenamed("node", "rep")
    labelled = met.select("key", "rep", *columns).join(known, "rep", "left").withColumn(
        "label", F.coalesce("label", "rep")
    )
    spread = F.min("label") != F.max("label")
    mixed = labelled.groupBy("key").agg(spread.alias("mixed")).where("mixed")
    return keep(labelled.join(mixed.select("key"), "key"), "near-open")


def _with_support(rows: DataFrame, docs: DataFrame, reps: DataFrame, several: DataFrame, width: int) -> DataFrame:
    """The open rows that can still have a link in their bucket, with set size n and support.

    A document's support is how many of its shingles another open document has as well. No
    overlap is larger, so a document that differs from all others in too many places is out
    before any pair with it is formed. Exact: nothing that could link goes.
    """

    def explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                sets, bounds = shingle_sets(texts, width)
                owner = np.repeat(np.arange(lo, hi), np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), pa.array(_signed(sets))], ["rep", "shingle"]
                )

    ids = rows.select("rep").distinct()
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(ids, "rep", "left_semi")
    key = texts.schema["rep"].dataType.simpleString()
    alone = (
        texts.mapInArrow(explode_sets, f"rep {key}, shingle long")
        .groupBy("shingle").agg(F.count(F.lit(1)).alias("owners"), F.min("rep").alias("rep"))
        .where("owners = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
        .join(several.select(F.col("doc_id").alias("rep")), "rep", "left_anti")
    )
    sized = reps.select("rep", F.col("n_shingles").alias("n")).join(ids, "rep", "left_semi").join(alone, "rep", "left")
    able = rows.join(
        sized.select("rep", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("support")), "rep"
    )
    least = able.groupBy("key").agg(F.min("n").alias("least"))
    able = able.join(least, "key").where(_could_link(F.col("support"), F.col("n"), F.col("least")))
    return keep(able.select("key", "rep", "n", "support"), "near-able")


def _drawn(rows: DataFrame) -> DataFrame:
    """Every row and the member of its bucket with the fewest shingles of its own, where they
    are in different components.

    In a family of copies that is the text they were made from, if it is there; it is the same
    in all the family's buckets."""
    alone = (F.col("n") - F.col("support")).alias("alone")
    pick = F.struct(alone, F.xxhash64("rep", F.lit(2)), "rep", "label", "n", "support")
    other = rows.groupBy("key").agg(F.min(pick).alias("o"))
    met = rows.join(other, "key").where(
        (F.col("label") != F.col("o.label"))
        & _could_link(F.least("support", "o.support"), F.col("n"), F.col("o.n"))
    )
    return met.select(F.col("rep").alias("a"), F.col("o.rep").alias("b"))


def _across(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """All pairs across components in a bucket that can still link, each one once.

    A pair shares as many buckets as it has pairs of equal collections. It is formed in the
    bucket of its first two; if that one is large, the blocks compare it.
    """
    held = rows.select("key", "rep", "label", "n", "support").join(reps.select("rep", "sig"), "rep")
    other = held.select("key", *[F.col(c).alias(f"{c}_b") for c in ("rep", "label", "n", "support", "sig")])
    equal = F.filter(
        F.sequence(F.lit(0), F.lit(COLLECTIONS - 1)), lambda i: F.get("sig", i) == F.get("sig_b", i)
    )
    i, j = F.get(equal, F.lit(0)), F.get(equal, F.lit(1))
    met = held.join(other, "key").where(
        (F.col("rep") > F.col("rep_b"))
        & (F.col("label") != F.col("label_b"))
        & _could_link(F.least("support", "support_b"), F.col("n"), F.col("n_b"))
        & (F.col("key") == _table_key(i, F.get("sig", i), j, F.get("sig", j)))
    )
    return met.select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))


def _split_by_size(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    sized = rows.join(sizes, "key")
    return sized.where(F.col("members") <= SMALL_BUCKET), sized.where(F.col("members") > SMALL_BUCKET)


def block_links(labels: np.ndarray, ids: list, sets: list[np.ndarray]) -> list[tuple]:
    """One link (a, b) for every two labels among the documents that have any."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    column = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(flat))))
    shared = np.diff(np.append(start, len(flat))) > 1
    renumbered = np.cumsum(shared) - 1
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    inside = shared[column]
    column, owner = renumbered[column[inside]], owner[inside]
    for lo in range(0, int(shared.sum()), 4096):
        here = (column >= lo) & (column < lo + 4096)
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[owner[here], column[here] - lo] = 1
        both += part @ part.T
    size = np.array([len(x) for x in sets])
    union = size[:, None] + size[None, :] - both
    hit = (100 * both >= PERCENT * union) & (labels[:, None] < labels[None, :])
    found = {}
    for i, j in zip(*np.nonzero(hit), strict=True):
        found.setdefault((labels[i], labels[j]), (max(ids[i], ids[j]), min(ids[i], ids[j])))
    return list(found.values())


def _linked_in_blocks(rows: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Links across components among the members of large open buckets.

    Documents that meet in such buckets form a group. A group is cut into blocks, every two
    blocks are one task, and a task hands on links only, never pairs.
    """
    # One row per document of a bucket: its own and the bucket's least document, without a join.
    hub = F.min("rep").over(Window.partitionBy("key"))
    groups = component_labels(rows.select(F.col("rep").alias("a"), hub.alias("b")).distinct())
    groups = groups.select(F.col("node").alias("rep"), F.col("label").alias("group"))
    counts = groups.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = (
        rows.select("rep", "label").distinct().join(groups, "rep").join(counts, "group")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    )
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    key = texts.schema["rep"].dataType.simpleString()
    columns = ["rep", "label", "group", "blocks", "block"]

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(len(columns))):
                sets, bounds = shingle_sets(texts, width)
                cells = [sets[bounds[i] : bounds[i + 1]].tobytes() for i in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(cells, pa.binary())], [*columns, "set"])

    def compare(table: pa.Table) -> pa.Table:
        ids = table["rep"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        links = block_links(np.array(table["label"].to_pylist()), ids, sets)
        kind = table.schema.field("rep").type
        return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})

    with_sets = placed.join(texts, "rep").select(*columns, "text").mapInArrow(
        to_sets, f"rep {key}, label {key}, group {key}, blocks int, block int, set binary"
    )
    sent = with_sets.select(
        "rep", "label", "set", "group", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "rep", "label", "set", "group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    return sent.groupBy("group", "lo", "hi").applyInArrow(compare, f"a {key}, b {key}").distinct()


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed = keep(signatures(docs, width), "near-signatures")
    able = signed.where("doc_id is not null and n_shingles > 0")
    same = ["fp_a", "fp_b", "n_shingles"]
    classes = keep(able.groupBy(*same).agg(F.min("doc_id").alias("rep")), "near-sets")
    member_of = keep(able.drop("sig").join(classes, same).select("doc_id", "rep"), "near-members")
    first = classes.withColumnRenamed("rep", "doc_id")
    reps = keep(
        able.join(first, [*same, "doc_id"], "left_semi").select(F.col("doc_id").alias("rep"), "n_shingles", "sig"),
        "near-classes",
    )
    met = buckets(reps)

    several = member_of.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("hi")).where("b <> hi")
    own = member_of.join(several, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b")
    tried = keep(likely(_ordered(met.where("ring").select(F.col("rep").alias("a"), F.col("first").alias("b"))), reps), "near-pairs")
    links = keep(confirmed(tried, docs, width).union(own), "near-links")
    labels = component_labels(links)
    opened = _open_rows(met, labels, [])
    discard(met, links)
    able = _with_support(opened, docs, reps, several, width)
    discard(opened)
    for drawn in (True, False):
        rows = _open_rows(able, labels, ["n", "support"])
        pairs = _drawn(rows) if drawn else _across(_split_by_size(rows)[0], reps)
        untried = _ordered(pairs).join(tried, ["a", "b"], "left_anti")
        untried = keep(likely(untried, reps), "near-pairs")
        discard(rows)
        if not untried.isEmpty():
            tried = tried.union(untried)
            links = keep(confirmed(untried, docs, width), "near-links")
            merged = merged_labels(labels, links)
            discard(labels, links)
            labels = merged
    rows = _open_rows(able, labels, ["n", "support"])
    discard(able)
    _, many = _split_by_size(rows)
    if not many.isEmpty():
        labels = merged_labels(labels, keep(_linked_in_blocks(keep(many, "near-many"), docs, width), "near-links"))

    least = keep(
        member_of.select("doc_id", "rep").distinct()
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("label", "rep")).alias("label")),
        "near-components",
    )
    discard(classes, member_of, reps, rows, labels)
    found = signed.select("doc_id", "n_shingles").join(least, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: one per component, all without shingles or id."""
    verdict = keep(near_duplicates(docs, width), "near-verdict")
    gone = verdict.where("not kept").select("doc_id")
    stay = docs.join(gone, "doc_id", "left_anti")
    repeated = verdict.where("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id").count()
    if repeated.where("count > 1").isEmpty():
        return stay
    unique = stay.where("doc_id is not null").dropDuplicates(["doc_id"])
    return unique.unionByName(stay.where("doc_id is null"))
