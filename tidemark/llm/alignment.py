"""Alignment of the tokens of two tokenizers over the same bytes, and counts of linked ids.

A chunk of texts becomes two flat id arrays with parent indices. Byte ends are segmented
cumulative sums of the tokens' lengths; an Acero hash join on (document, end) finds the ends
both tokenizers share, and these cut the tokens into groups. Every A token is linked to every
B token of its group. ``Table.group_by`` makes a chunk's distinct (document, id pair) rows and a
task's partial counts; Spark adds the counts up.

Counts of the most frequent pairs, at most ``FREQUENT`` by a histogram of counts, go to the
tasks as a sorted array; links of all other pairs are joined to their counts by id pair. A pair
that is joined is in fewer documents than any broadcast one, so no join key is hot.

The first tokenizer is a byte-level BPE whose merges are numbered in order (checked), so its
ids serve as ranks of a faster implementation. Its file and the other tokenizer's are read by
the driver and sent to the tasks.

Texts that are null or empty, or whose tokens do not spell a space and the text, have no
tokens: zeros and an empty digest. Repeated rows are documents of their own, a null id stays
null, other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import column_bytes
from tidemark.scratch import discard, keep

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text aligned at once; a longer text is aligned alone.
CHUNK = 1 << 19
#: Links expanded at once; a text with more is counted slice by slice.
LINKS = 1 << 20
#: Pairs whose counts are sent to every task: 12 bytes each.
FREQUENT = 1 << 18
#: Distinct pairs a task counts before it hands its partial counts on.
HELD_PAIRS = 1 << 20
#: The split of the byte-level tokenizer (fixed value of its file format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SEPARATORS = (",", "|", ";", "")


def _byte_letters() -> dict[str, int]:
    """The printable character of every byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass(frozen=True)
class Side:
    """One tokenizer: its encoder, the bytes of every id, and ids as text with a separator."""

    encode: object
    pieces: pa.Array
    lengths: np.ndarray
    printed: pa.Array

    @staticmethod
    def of(encode, pieces: list[bytes]) -> Side:
        printed = pa.array([f"{i}{s}" for s in _SEPARATORS for i in range(len(pieces))], pa.large_string())
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        return Side(encode, pa.array(pieces, pa.large_binary()), lengths, printed)


@lru_cache(maxsize=2)
def byte_side(content: bytes) -> Side:
    import tiktoken

    spec = json.loads(content)
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
    order = [spec["model"]["vocab"]["".join(m)] for m in merges]
    if order != list(range(256, 256 + len(order))) or spec["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError("merges are not numbered in order, or a space is added: ids cannot serve as ranks")
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    return Side.of(lambda texts: [fast.encode_ordinary(" " + t) for t in texts], pieces)


@lru_cache(maxsize=2)
def piece_side(content: bytes) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    pieces = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
        for i in range(model.get_piece_size())
        for p in [model.id_to_piece(i)]
    ]
    return Side.of(lambda texts: model.encode(texts, num_threads=1), pieces)


def _flat(ids: list[list[int]]) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(bounds[-1]))
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def _spelt(side: Side, ids: pa.ListArray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each document's tokens spell a space and its text."""
    joined = side.pieces.take(ids.flatten())
    _, offsets, spelling = joined.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(joined) + 1][np.asarray(ids.offsets)]
    spelling = np.frombuffer(spelling, np.uint8) if spelling is not None else np.zeros(0, np.uint8)
    size = np.diff(bounds)
    return np.array(
        [
            n > 0 and hi - lo == n + 1 and spelling[lo] == 0x20 and bool((spelling[lo + 1 : hi] == data[at : at + n]).all())
            for lo, hi, at, n in zip(ends[:-1], ends[1:], bounds[:-1], size, strict=True)
        ],
        dtype=bool,
    )


@dataclass(frozen=True)
class Aligned:
    """Documents of a chunk: flat ids, document and group of every token, per side; groups
    are numbered through the chunk, ``owner`` is the document of each."""

    ids: tuple[np.ndarray, np.ndarray]
    doc: tuple[np.ndarray, np.ndarray]
    end: tuple[np.ndarray, np.ndarray]
    group: tuple[np.ndarray, np.ndarray]
    owner: np.ndarray
    n: int

    def counts(self, side: int) -> np.ndarray:
        return np.bincount(self.doc[side], minlength=self.n)


def align(column: pa.Array, a: Side, b: Side) -> Aligned:
    """Tokens and groups of a column of texts."""
    data, bounds = column_bytes(column)
    n = len(column)
    texts = [data[lo:hi].tobytes().decode("utf-8", "replace") for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
    lists = [_flat(side.encode(texts)) for side in (a, b)]
    good = _spelt(a, lists[0], data, bounds) & _spelt(b, lists[1], data, bounds)
    ids, docs, ends = [], [], []
    for side, made in zip((a, b), lists, strict=True):
        kept = pc.if_else(pa.array(good), made, pa.scalar([], made.type)) if not good.all() else made
        flat, parent = np.asarray(pc.list_flatten(kept)), np.asarray(pc.list_parent_indices(kept)).astype(np.int64)
        running = np.asarray(pc.cumulative_sum(pa.array(side.lengths[flat])))
        base = np.zeros(n, np.int64)
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        base[parent[first]] = running[first] - side.lengths[flat[first]]
        ids.append(flat)
        docs.append(parent)
        ends.append(running - base[parent])
    tables = [
        pa.table({"doc": d, "end": e}).group_by(["doc", "end"]).aggregate([])
        for d, e in zip(docs, ends, strict=True)
    ]
    shared = tables[0].join(tables[1], ["doc", "end"], join_type="inner", use_threads=False)
    cuts = np.sort((np.asarray(shared["doc"]) << 32) | np.asarray(shared["end"]))
    group = [np.searchsorted(cuts, (d << 32) | e) for d, e in zip(docs, ends, strict=True)]
    return Aligned(tuple(ids), tuple(docs), tuple(ends), tuple(group), cuts >> 32, n)


def group_texts(found: Aligned, a: Side, b: Side) -> list[bytes]:
    """Per document its groups in order, as a1,a2|b1;a3|b2,b3."""
    n_groups = len(found.owner)
    sizes = [np.bincount(g, minlength=n_groups) for g in found.group]
    before = [np.cumsum(s) - s for s in sizes]
    out = np.empty(len(found.ids[0]) + len(found.ids[1]), np.int64)
    closing = np.full(n_groups, 2)
    closing[np.flatnonzero(np.diff(found.owner, append=-1))] = 3
    for k in (0, 1):
        ids, group = found.ids[k], found.group[k]
        last = np.diff(group, append=-1) != 0
        mark = np.where(last, 1 if k == 0 else closing[group], 0)
        other = before[1][group] if k == 0 else before[0][group] + sizes[0][group]
        vocabulary = len((a, b)[k].lengths)
        out[np.arange(len(ids)) + other] = mark * vocabulary + ids + (len(a.printed) if k else 0)
    printed = pa.chunked_array([a.printed, b.printed]).combine_chunks()
    joined = printed.take(pa.array(out))
    _, offsets, text = joined.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(joined) + 1]
    at = np.concatenate([[0], np.cumsum(found.counts(0) + found.counts(1))])
    return [text[lo:hi].to_pybytes() if hi > lo else b"" for lo, hi in zip(ends[at[:-1]], ends[at[1:]], strict=True)]


def linked_pairs(found: Aligned) -> pa.Table:
    """(doc, pair, n): each document's distinct id pairs and how many links have them.

    A group's repeated ids are counted first, so its rows are distinct ids times distinct ids.
    """
    sides = []
    for k in (0, 1):
        counted = pa.table({"group": found.group[k], "id": found.ids[k]}).group_by(["group", "id"], use_threads=False)
        counted = counted.aggregate([([], "count_all")])
        group = np.asarray(counted["group"])
        order = np.argsort(group, kind="stable")
        sides.append((group[order], np.asarray(counted["id"]).astype(np.int64)[order], np.asarray(counted["count_all"])[order]))
    (ga, ia, na), (gb, ib, nb) = sides
    width = np.bincount(gb, minlength=len(found.owner))
    start = np.cumsum(width) - width
    repeat = width[ga]
    parts, at, upto = [], 0, np.cumsum(repeat)
    while at < len(ga):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, "right")))
        reps = repeat[at:to]
        left = np.repeat(np.arange(at, to), reps)
        right = start[ga[left]] + np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
        rows = pa.table({"doc": found.owner[ga[left]], "pair": (ia[left] << 32) | ib[right], "n": na[left] * nb[right]})
        parts.append(rows.group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]))
        at = to
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    whole = pa.concat_tables(parts)
    if len(parts) > 1:
        whole = whole.group_by(["doc", "pair"], use_threads=False).aggregate([("n_sum", "sum")]).rename_columns(["doc", "pair", "n_sum"])
    order = np.argsort(np.asarray(whole["doc"]), kind="stable")
    whole = whole.take(pa.array(order))
    return pa.table({"doc": whole["doc"], "pair": whole["pair"], "n": whole["n_sum"]})


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``CHUNK`` bytes of text each."""
    _, bounds = column_bytes(column)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))


def _sent(docs: DataFrame, a_file: str, b_file: str):
    """The tokenizer files, read by the driver and broadcast."""
    with open(a_file, "rb") as first, open(b_file, "rb") as second:
        return docs.sparkSession.sparkContext.broadcast((first.read(), second.read()))


def alignments(docs: DataFrame, a_file: str = BYTE_BPE, b_file: str = PIECE_BPE) -> DataFrame:
    """Per row: doc_id, and per side the ids, byte ends and group numbers of its tokens."""
    files = _sent(docs, a_file, b_file)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(files.value[0]), piece_side(files.value[1])
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                found = align(batch.column(1).slice(lo, hi - lo), a, b)
                columns, names = [batch.column(0).slice(lo, hi - lo)], ["doc_id"]
                first = np.searchsorted(found.owner, np.arange(found.n))
                for k, side in enumerate("ab"):
                    counts = found.counts(k)
                    columns += [
                        _lists(found.ids[k], counts, pa.int32()),
                        _lists(found.end[k], counts, pa.int64()),
                        _lists((found.group[k] - first[found.doc[k]]).astype(np.int32), counts, pa.int32()),
                    ]
                    names += [f"{side}_ids", f"{side}_ends", f"{side}_groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"{s}_ids array<int>, {s}_ends array<long>, {s}_groups array<int>" for s in "ab")
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, {kinds}")


def document_pairs(docs: DataFrame, a_file: str = BYTE_BPE, b_file: str = PIECE_BPE) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct id pairs as
    lists a, b (ids) and n (links)."""
    files = _sent(docs, a_file, b_file)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(files.value[0]), piece_side(files.value[1])
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                found = align(batch.column(1).slice(lo, hi - lo), a, b)
                pairs = linked_pairs(found)
                doc, pair, n = (np.asarray(pairs[c]) for c in ("doc", "pair", "n"))
                held = np.bincount(doc, minlength=found.n)
                links = np.zeros(found.n, np.int64)
                np.add.at(links, doc, n)
                texts = group_texts(found, a, b)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(found.counts(0), pa.int64()),
                        pa.array(found.counts(1), pa.int64()),
                        pa.array(np.bincount(found.owner, minlength=found.n), pa.int64()),
                        pa.array(links, pa.int64()),
                        pa.array([sha256(t).hexdigest() if t else "" for t in texts], pa.string()),
                        _lists((pair >> 32).astype(np.int32), held, pa.int32()),
                        _lists((pair & 0xFFFFFFFF).astype(np.int32), held, pa.int32()),
                        _lists(n, held, pa.int64()),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "a array<int>, b array<int>, n array<long>",
    )


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, count): in how many rows of ``linked`` each id pair is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("count", "sum")]).rename_columns(["a", "b", "count"])

        rows = 0
        for batch in batches:
            part = pa.table({"a": pc.list_flatten(batch.column(0)), "b": pc.list_flatten(batch.column(1))})
            counted = part.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "count"])
            held.append(counted)
            rows += counted.num_rows
            if rows > 2 * HELD_PAIRS:
                held[:] = [merged()]
                rows = held[0].num_rows
                if rows > HELD_PAIRS:
                    yield from held.pop().to_batches(1 << 16)
                    rows = 0
        if held:
            yield from merged().to_batches(1 << 16)

    partial = linked.select("a", "b").mapInArrow(run, "a int, b int, count long")
    return partial.groupBy("a", "b").agg(F.sum("count").alias("count"))


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The pairs above a count that at most ``FREQUENT`` pairs reach, and their counts."""
    bits = F.floor(F.log2(F.col("count").cast("double"))).cast("int")
    histogram = sorted(((r["bits"], r["pairs"]) for r in counts.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("pairs")).collect()), reverse=True)
    least, total = 63, 0
    for power, pairs in histogram:
        total += pairs
        if total > FREQUENT:
            break
        least = power
    pair = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
    rows = counts.where(F.col("count") >= 1 << min(least, 62)).select(pair.alias("pair"), "count").toArrow()
    keys, found = np.asarray(rows["pair"]), np.asarray(rows["count"])
    order = np.argsort(keys)
    return keys[order], found[order]


def cross_tokenizer_alignment(docs: DataFrame, a_file: str = BYTE_BPE, b_file: str = PIECE_BPE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is the number of rows whose text links it; n_best counts the links whose
    count is the highest of their A id (ties included), count_sum adds the counts of all links.
    """
    linked = keep(
        document_pairs(docs, a_file, b_file).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    counts = keep(pair_counts(linked), "pair-counts")
    best_of = counts.groupBy("a").agg(F.max("count").alias("best"))  # a row per id of the vocabulary
    best_rows = best_of.toArrow()
    best = np.zeros(max(np.asarray(best_rows["a"]).max(initial=0) + 1, 1), np.int64)
    best[np.asarray(best_rows["a"])] = np.asarray(best_rows["best"])
    known = docs.sparkSession.sparkContext.broadcast((*_frequent(counts), best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found, top = known.value
        for batch in batches:
            a, b, n = (pc.list_flatten(batch.column(i)) for i in (1, 2, 3))
            a, b, n = np.asarray(a).astype(np.int64), np.asarray(b).astype(np.int64), np.asarray(n)
            doc = np.asarray(pc.list_parent_indices(batch.column(1)))
            pair = (a << 32) | b
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            count = np.where(hit, found[at], 0) if len(keys) else np.zeros(len(pair), np.int64)
            sums, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(sums, doc, count * n)
            np.add.at(bests, doc, np.where(hit & (count == top[a]), n, 0))
            rare = np.bincount(doc[~hit], minlength=len(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(bests), pa.array(sums),
                    _lists(a[~hit].astype(np.int32), rare, pa.int32()),
                    _lists(b[~hit].astype(np.int32), rare, pa.int32()),
                    _lists(n[~hit], rare, pa.int64()),
                ],
                ["row", "bests", "sums", "a", "b", "n"],
            )

    looked = keep(
        linked.select("row", "a", "b", "n").mapInArrow(
            run, "row long, bests long, sums long, a array<int>, b array<int>, n array<long>"
        ),
        "looked-up",
    )
    rare = looked.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("row", "p.*")
    placed = rare.join(F.broadcast(best_of), "a").join(counts, ["a", "b"])
    sums = placed.groupBy("row").agg(
        F.sum(F.col("count") * F.col("n")).alias("more"),
        F.sum(F.when(F.col("count") == F.col("best"), F.col("n")).otherwise(0)).alias("more_best"),
    )
    seen = looked.select("row", "bests", "sums").join(sums, "row", "left")
    out = keep(
        linked.drop("a", "b", "n").join(seen, "row").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            (F.col("bests") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("sums") + F.coalesce("more", F.lit(0))).alias("count_sum"),
            "groups_sha256",
        ),
        "alignment",
    )
    discard(linked, counts, looked)
    return out
