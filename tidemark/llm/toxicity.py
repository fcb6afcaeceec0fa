"""Toxicity by the nearest labelled examples.

Vectors are TF-IDF over telling terms: words and word beginnings that stand in toxic examples
significantly more often than in others. The nearest examples by exact cosine come from a
block-max inverted index: every block of examples has an upper bound per term, blocks are
taken in order of their summed bound, and the search ends when no block can still enter the
best k. Votes weighted by similarity, shrunk to the base rate, give the score.

A text without telling terms (also a null or empty one) has no neighbours; its score is the
share of toxic examples among such examples. Equal similarities rank in index order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import LETTER, Texts, chunks, mix
from tidemark.scratch import keep

#: The index holds at most this many labelled rows, those with the smallest hash of their id.
MAX_EXAMPLES = 20_000
#: Most telling terms kept, by chi-squared.
MAX_TERMS = 4_096
#: A term is telling from this many examples on.
LEAST_EXAMPLES = 4
#: Beginnings of words that are terms as well, in bytes.
BEGINNINGS = (6, 7)
NEIGHBOURS, BLOCK, SHRINK = 32, 64, 1.0


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, text number) of every occurrence."""
    low = texts.lowered()
    start, end, doc = low.runs(LETTER)
    hashes, owners = [low.hashes(start, end)], [doc]
    for n in BEGINNINGS:
        long = end - start > n
        hashes.append(mix(low.hashes(start[long], start[long] + n) + np.uint64(n)))
        owners.append(doc[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by b then a, with how often each occurs."""
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    first = np.ones(len(a), dtype=bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(first)
    return a[at], b[at], np.diff(np.append(at, len(a)))


@dataclass(frozen=True)
class Vocabulary:
    """Telling terms by sorted hash; ``present`` marks the slots any of them falls into."""

    hashes: np.ndarray
    present: np.ndarray

    @classmethod
    def of(cls, hashes: list[int]) -> Vocabulary:
        array = np.sort(np.array(hashes, dtype=np.int64).view(np.uint64))
        present = np.zeros(1 << 20, dtype=bool)
        present[(array >> np.uint64(44)).astype(np.int64)] = True
        return cls(array, present)

    def find(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term number, text number, occurrences) of the telling terms of every text."""
        h, doc = terms(texts)
        at = np.flatnonzero(self.present[(h >> np.uint64(44)).astype(np.int64)])
        h, doc = h[at], doc[at]
        term = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        real = self.hashes[term] == h if len(self.hashes) else np.zeros(len(h), dtype=bool)
        return _distinct(term[real], doc[real])


class BlockMaxIndex:
    """Unit vectors of labelled examples, in blocks, with the largest weight per term and block."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        # Examples with the same leading term stand together, so bounds tell blocks apart.
        lead = np.array([t[np.argmax(w)] for t, w in vectors], dtype=np.int64) if vectors else np.zeros(0, np.int64)
        order = np.lexsort((ids, lead))
        self.ids, self.toxic = ids[order], toxic[order].astype(np.float64)
        self.n_blocks = -(-len(order) // BLOCK)
        example = np.concatenate([np.full(len(vectors[i][0]), k) for k, i in enumerate(order)] or [np.zeros(0, np.int64)])
        term = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, np.int64)])
        weight = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        by_term = np.lexsort((example, term))
        self.example, self.weight, term = example[by_term], weight[by_term], term[by_term]
        block = self.example // BLOCK
        cell_first = np.ones(len(term), dtype=bool)
        cell_first[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.cell_start = np.append(np.flatnonzero(cell_first), len(term))
        self.cell_block = block[self.cell_start[:-1]]
        self.cell_max = np.maximum.reduceat(self.weight, self.cell_start[:-1]) if len(term) else np.zeros(0)
        self.term_cells = np.searchsorted(term[self.cell_start[:-1]], np.arange(n_terms + 1))

    def nearest(self, query_terms: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines of the k nearest with a cosine above 0.

        Blocks are scored a few at a time, each lot twice as large as the one before."""
        spans = [np.arange(self.term_cells[t], self.term_cells[t + 1]) for t in query_terms]
        cells = np.concatenate(spans)
        factor = np.repeat(query, [len(s) for s in spans])
        block = self.cell_block[cells]
        bound = np.bincount(block, weights=factor * self.cell_max[cells], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        place = np.empty(self.n_blocks, dtype=np.int64)
        place[order] = np.arange(self.n_blocks)
        turn = place[block]
        best, cosine = np.zeros(0, np.int64), np.zeros(0)
        lo, lot = 0, 4
        while lo < self.n_blocks:
            floor = cosine[-1] + 1e-12 if len(best) == k else 0.0
            hi = min(lo + lot, int(np.searchsorted(-bound[order], -floor, "left")))
            if hi <= lo:
                break
            own = np.flatnonzero((turn >= lo) & (turn < hi))
            start = self.cell_start[cells[own]]
            size = self.cell_start[cells[own] + 1] - start
            each = np.repeat(np.arange(len(own)), size)
            posting = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size) + start[each]
            at = (turn[own][each] - lo) * BLOCK + self.example[posting] % BLOCK
            score = np.bincount(at, weights=factor[own][each] * self.weight[posting], minlength=(hi - lo) * BLOCK)
            hit = np.flatnonzero(score > 0)
            best = np.concatenate([best, order[lo + hit // BLOCK] * BLOCK + hit % BLOCK])
            cosine = np.concatenate([cosine, score[hit]])
            top = np.argsort(-cosine, kind="stable")[:k]
            best, cosine = best[top], cosine[top]
            lo, lot = hi, lot * 2
        return best, cosine


def unit_vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1.0 + np.log(count)) * idf
    return w / max(np.sqrt((w * w).sum()), 1e-12)


def labelled_examples(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """(doc_id, toxic, text) of the training rows; equal texts count once, toxic if any is."""
    picked = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
        .dropna()
        .where(F.crc32(F.col("_id").cast("string")) % 5 != 0)
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_examples)
    )
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select(F.col("doc_id").alias("_id"), text.alias("_text"))
        .join(F.broadcast(picked), "_id")
        .groupBy(F.xxhash64("_text").alias("_same"))
        .agg(F.min(F.struct("_id", "_text")).alias("_first"), F.max("_y").alias("toxic"))
        .select(F.col("_first._id").alias("doc_id"), "toxic", F.col("_first._text").alias("text"))
    )


def telling_terms(examples: DataFrame) -> list[int]:
    """Hashes of the terms that stand in toxic examples significantly more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, texts in chunks(batch.column(1)):
                h, doc, _ = _distinct(*terms(texts))
                values, which = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array(np.bincount(which, minlength=len(values))),
                        pa.array(np.bincount(which, weights=toxic[lo + doc], minlength=len(values)).astype(np.int64)),
                    ],
                    ["term", "n", "n_toxic"],
                )

    counted = (
        examples.select("toxic", "text").mapInArrow(run, "term long, n long, n_toxic long")
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("k"))
        .where(F.col("n") >= LEAST_EXAMPLES)
    )
    total = examples.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).first()
    size, base = total["n"], (total["k"] or 0) / max(total["n"], 1)
    if not 0 < base < 1:
        return []
    # The bar rises with the number of terms tried, so chance does not pass it.
    bar = 10 + 2 * np.log(max(counted.count(), 1))
    expected = F.col("n") * base
    chi = F.pow(F.col("k") - expected, 2) / (expected * (1 - base)) * (size / (size - F.least(F.col("n"), F.lit(size - 1))))
    chosen = (
        counted.withColumn("chi", chi).where((F.col("k") > expected) & (F.col("chi") >= bar))
        .orderBy(F.desc("chi"), "term").limit(MAX_TERMS)
    )
    return [r["term"] for r in chosen.select("term").collect()]


def document_frequencies(docs: DataFrame, shared) -> tuple[np.ndarray, int]:
    """Over all documents: how many hold each telling term, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        found, n = np.zeros(len(vocabulary.hashes), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, texts in chunks(batch.column(0)):
                term, _, _ = vocabulary.find(texts)
                found += np.bincount(term, minlength=len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(found))), pa.array(np.concatenate([[n], found]))], ["term", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r["term"]: r["n"] for r in rows}
    return np.array([got.get(t, 0) for t in range(len(shared.value.hashes))], dtype=np.int64), got.get(-1, 0)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """Per row: doc_id, score, neighbours (ids of the nearest examples), n_terms."""
    context = docs.sparkSession.sparkContext
    examples = keep(labelled_examples(docs, labels, max_examples), "toxicity-examples")
    vocabulary = Vocabulary.of(telling_terms(examples))
    shared = context.broadcast(vocabulary)
    df, n_docs = document_frequencies(docs, shared)
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(2)):
                term, doc, count = shared.value.find(texts)
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                part = batch.slice(lo, hi - lo)
                cut = lambda x, edge=edge: [x[a:b].tolist() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(cut(term), pa.list_(pa.int64())), pa.array(cut(count), pa.list_(pa.int64()))],
                    ["doc_id", "toxic", "term", "count"],
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = examples.select("doc_id", "toxic", "text").mapInArrow(
        vectors, f"doc_id {key}, toxic int, term array<long>, count array<long>"
    ).collect()
    rows.sort(key=lambda r: r["doc_id"])
    plain = [r["toxic"] for r in rows if not r["term"]]
    base = (sum(plain) + 0.1) / (len(plain) + 1)
    told = [r for r in rows if r["term"]]
    index = context.broadcast(
        BlockMaxIndex(
            np.array([r["doc_id"] for r in told], dtype=np.int64 if key in ("bigint", "int") else object),
            np.array([r["toxic"] for r in told], dtype=np.int64),
            [
                (np.array(r["term"]), unit_vector(np.array(r["count"], dtype=float), idf[np.array(r["term"])]))
                for r in told
            ],
            len(vocabulary.hashes),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, vocabulary = index.value, shared.value
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                score = np.full(hi - lo, base)
                neighbours: list[list] = [[] for _ in range(hi - lo)]
                term, doc, count = vocabulary.find(texts)
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                for i in np.flatnonzero(np.diff(edge)):
                    own = slice(edge[i], edge[i + 1])
                    query = unit_vector(count[own].astype(float), idf[term[own]])
                    best, cosine = near.nearest(term[own], query, NEIGHBOURS)
                    score[i] = (cosine @ near.toxic[best] + SHRINK * base) / (cosine.sum() + SHRINK)
                    neighbours[i] = near.ids[best[:5]].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(score),
                        pa.array(neighbours, pa.list_(batch.schema.field(0).type)),
                        pa.array(np.diff(edge)),
                    ],
                    ["doc_id", "score", "neighbours", "n_terms"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, score double, neighbours array<{key}>, n_terms long"
    )


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract of ``op1``, with the evidence."""
    return score_toxicity(docs, labels).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
        "n_terms",
    )
