"""TF-IDF: a bounded vocabulary counted in two scans, then unit vectors row by row."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.scratch import discard, keep

#: Counters of hashed pairs, in chunks that are added up each on its own.
PAIR_COUNTERS, COUNTERS_PER_CHUNK = 1 << 22, 1 << 16
BYTES_PER_SLICE = 4 << 20  # text taken apart at a time, one document more at most
#: Different words and pairs that a task numbers and counts before it hands them on.
MOST_WORDS, MOST_PAIRS = 1 << 20, 1 << 21


@dataclass(frozen=True)
class TermRules:
    """Which terms enter the index. The defaults are those of the retrieval index."""

    stop_words: tuple[str, ...] = ()
    min_df: int = 1
    max_df: float = 1.0
    max_features: int = 20_000


@dataclass(frozen=True)
class TermModel:
    """A fitted vocabulary, never longer than ``rules.max_features``.

    A term's place in ``terms`` and ``document_frequency`` is its position in a vector.
    """

    rules: TermRules
    n_docs: int
    terms: tuple[str, ...]
    document_frequency: tuple[int, ...]

    @property
    def idf(self) -> np.ndarray:
        """Smoothed inverse document frequency, ln((1 + n) / (1 + df)) + 1."""
        return np.log((1.0 + self.n_docs) / (1.0 + np.array(self.document_frequency, dtype=float))) + 1.0

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, term, df, float(w))
            for i, (term, df, w) in enumerate(zip(self.terms, self.document_frequency, self.idf, strict=True))
        ]
        return spark.createDataFrame(rows, "term_id int, term string, df bigint, idf double")


def with_terms(df: DataFrame, text_column: str, stop_words: Sequence[str]) -> DataFrame:
    """Add ``terms``: words without stop words, then pairs of what is left."""
    words = tx.words(F.col(text_column))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    return (
        df.withColumn("_words", words)
        .withColumn("terms", tx.with_bigrams(F.col("_words")))
        .drop("_words")
    )


class _Numbered(dict):
    """Numbers for words as they come; -1 for stop words and single characters."""

    def __init__(self, stop_words: Sequence[str]) -> None:
        super().__init__(dict.fromkeys(stop_words, -1))
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        number = -1
        if len(word) > 1:
            number = len(self.words)
            self.words.append(word)
        self[word] = number
        return number


def _spaced(text: Column) -> Column:
    """Lower-cased text with a space for everything between words."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " ")


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts a few at a time, with the place of the first; a null text is empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + BYTES_PER_SLICE, "right")))
        yield lo, pc.fill_null(texts.slice(lo, hi - lo), "").to_pylist()
        lo = hi


def _numbers(texts: list[str], number: Callable[[str], int]) -> tuple[np.ndarray, np.ndarray]:
    """Number and text of every word in order, without the words numbered -1."""
    split = [t.split(" ") for t in texts]
    doc = np.repeat(np.arange(len(split)), [len(words) for words in split])
    numbers = np.fromiter(map(number, chain.from_iterable(split)), np.int64, len(doc))
    kept = numbers != -1
    return numbers[kept], doc[kept]


def _per_term(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every code once with its occurrences and documents; ``doc`` must not fall."""
    order = np.argsort(code, kind="stable")
    code, doc = code[order], doc[order]
    first = np.ones(len(code), dtype=bool)
    first[1:] = code[1:] != code[:-1]
    fresh = first.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return code, at, at
    return code[at], np.diff(np.append(at, len(code))), np.add.reduceat(fresh.astype(np.int64), at)


def _added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of several slices as those of one."""
    code, total, df = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code, kind="stable")
    code = code[order]
    at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else order
    if not len(at):
        return code, total, df
    return code[at], np.add.reduceat(total[order], at), np.add.reduceat(df[order], at)


class _Pairs:
    """Neighbouring words of a task's texts and the counters they fall into."""

    def __init__(self, ids: _Numbered) -> None:
        self.ids, self.hashes = ids, np.zeros(0, dtype=np.uint64)

    def of(self, number: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second word, text and counter of every pair."""
        fresh = self.ids.words[len(self.hashes) :]
        added = np.fromiter((zlib.crc32(w.encode()) for w in fresh), np.uint64, len(fresh))
        self.hashes = np.concatenate([self.hashes, added])
        near = np.flatnonzero(doc[1:] == doc[:-1])
        first, second = number[near], number[near + 1]
        mixed = (self.hashes[first] << np.uint64(32)) + self.hashes[second]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return first, second, doc[near], (mixed >> np.uint64(42)).astype(np.int64)


def _word_counts(texts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """First scan of spaced texts: ``(term, total, df)`` per task and word, and counters of hashed pairs.

    A row with a ``chunk`` holds counters; the row without term and chunk counts documents.
    """
    stop = tuple(stop_words)
    schema = "term string, total long, df long, chunk int, counters binary"
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def batch(*columns: list) -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["term", "total", "df", "chunk", "counters"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(PAIR_COUNTERS, dtype=np.int64)
        ids, n_docs = _Numbered(stop), 0
        pairs, total, df = _Pairs(ids), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def words() -> pa.RecordBatch:
            none = [None] * len(ids.words)
            return batch(ids.words, total, df, none, none)

        for part in batches:
            n_docs += part.num_rows
            for _, texts in _slices(part.column(0)):
                number, doc = _numbers(texts, ids.__getitem__)
                code, times, docs = _per_term(number, doc)
                grown = len(ids.words) - len(total)
                total, df = (np.concatenate([x, np.zeros(grown, dtype=np.int64)]) for x in (total, df))
                total[code] += times
                df[code] += docs
                counters += np.bincount(pairs.of(number, doc)[3], minlength=PAIR_COUNTERS)
                if len(ids) > MOST_WORDS:
                    yield words()
                    ids = _Numbered(stop)
                    pairs, total, df = _Pairs(ids), total[:0], df[:0]
        yield words()
        yield batch([None], [n_docs], [None], [None], [None])
        for chunk in range(PAIR_COUNTERS // COUNTERS_PER_CHUNK):
            cells = counters[chunk * COUNTERS_PER_CHUNK : (chunk + 1) * COUNTERS_PER_CHUNK]
            if cells.any():
                yield batch([None], [None], [None], [chunk], [cells.tobytes()])

    return texts.mapInArrow(count, schema)


def _full_counters(counted: DataFrame, least: int) -> np.ndarray:
    """Whether a counter reached ``least`` over all tasks, one bit each."""

    def add(chunk: pa.Table) -> pa.Table:
        cells = np.zeros(COUNTERS_PER_CHUNK, dtype=np.int64)
        for part in chunk["counters"]:
            cells += np.frombuffer(part.as_buffer(), dtype=np.int64)
        bits = np.packbits(cells >= least).tobytes()
        return pa.table({"chunk": chunk["chunk"].slice(0, 1), "bits": pa.array([bits], pa.binary())})

    chunks = counted.where("chunk is not null").select("chunk", "counters")
    size = COUNTERS_PER_CHUNK // 8
    full = np.zeros(PAIR_COUNTERS // 8, dtype=np.uint8)
    for row in chunks.groupBy("chunk").applyInArrow(add, "chunk int, bits binary").collect():
        full[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return full


def _pair_counts(texts: DataFrame, stop_words: Sequence[str], full: np.ndarray) -> DataFrame:
    """Second scan: ``(term, total, df)`` per task of the pairs in full counters."""
    stop = tuple(stop_words)
    shared = texts.sparkSession.sparkContext.broadcast(full)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        ids = _Numbered(stop)
        pairs, parts, held, merged = _Pairs(ids), [], 0, 0

        def send() -> pa.RecordBatch:
            code, total, df = parts[0]
            words = pa.array(ids.words, pa.string())
            first, second = (words.take(pa.array(x)) for x in (code >> 32, code & 0xFFFFFFFF))
            terms = pc.binary_join_element_wise(first, second, " ")
            return pa.RecordBatch.from_arrays([terms, pa.array(total), pa.array(df)], names=["term", "total", "df"])

        for part in batches:
            for _, texts in _slices(part.column(0)):
                first, second, doc, counter = pairs.of(*_numbers(texts, ids.__getitem__))
                met = wanted[counter]
                parts.append(_per_term((first[met] << 32) | second[met], doc[met]))
                held += len(parts[-1][0])
                if held > max(2 * merged, MOST_PAIRS // 4):
                    parts = [_added(parts)]
                    held = merged = len(parts[0][0])
                if held > MOST_PAIRS or len(ids) > MOST_WORDS:
                    parts = [_added(parts)]
                    yield send()
                    ids = _Numbered(stop)
                    pairs, parts, held, merged = _Pairs(ids), [], 0, 0
        if parts:
            parts = [_added(parts)]
            yield send()

    return texts.mapInArrow(count, "term string, total long, df long")


def fit_terms(documents: DataFrame, text_column: str, rules: TermRules = TermRules()) -> TermModel:
    """Terms whose document frequency is in range; the most frequent, then A to Z.

    The first scan counts words, and pairs by hash in a fixed number of counters. A pair is
    no more frequent than its counter, so only pairs whose counter reaches the last of
    ``max_features`` words can enter, and the second scan counts those alone. Exact: with
    fewer words than that, all pairs are counted. Null texts don't count as documents.
    Whatever made the texts runs once: both scans read them as written here.
    """
    texts = keep(documents.select(_spaced(F.col(text_column)).alias("text")).where("text is not null"), "term-texts")
    counted = keep(_word_counts(texts, rules.stop_words), "term-counts")
    n_docs = counted.where("term is null and chunk is null").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]

    def in_range(stats: DataFrame) -> DataFrame:
        return stats.where((F.col("df") >= rules.min_df) & (F.col("df") <= F.lit(rules.max_df * n_docs)))

    def summed(stats: DataFrame) -> DataFrame:
        return in_range(stats.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df")))

    def first(stats: DataFrame) -> DataFrame:
        return stats.orderBy(F.desc("total"), "term").limit(rules.max_features)

    words = keep(first(summed(counted.where("term is not null"))), "term-words")
    place = words.agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("last")).first()
    least = place["last"] if place["n"] == rules.max_features else 1
    full = _full_counters(counted, max(least or 1, rules.min_df, 1))
    pairs = summed(_pair_counts(texts, rules.stop_words, full)).where(F.col("total") >= least)
    kept = first(words.union(pairs)).select("term", "df").collect()
    discard(texts, counted, words)
    if not kept:
        raise ValueError("no term is frequent enough for an index")
    frequency = {r["term"]: r["df"] for r in kept}
    terms = _positions(documents.sparkSession, list(frequency))
    return TermModel(rules, n_docs, terms, tuple(frequency[t] for t in terms))


def _positions(spark: SparkSession, terms: list[str]) -> tuple[str, ...]:
    """The terms in the order Spark's counter gives them: sums over terms keep their last digits."""
    once = spark.createDataFrame([(terms,)], "terms array<string>")
    return tuple(CountVectorizer(inputCol="terms", outputCol="_tf", vocabSize=len(terms)).fit(once).vocabulary)


def _vector_maker(model: TermModel) -> Callable[[pa.Array], pa.Array]:
    """Texts to the fields of their unit vectors."""
    stop = frozenset(model.rules.stop_words)
    words = list(dict.fromkeys(w for term in model.terms for w in term.split(" ")))
    numbered = {w: i for i, w in enumerate(words)} | dict.fromkeys(stop, -1)
    size, n_words = len(model.terms), len(words)
    single = np.full(n_words + 1, -1)  # the last place is that of unknown words
    codes, places = [], []
    for place, term in enumerate(model.terms):
        first, *second = (numbered[w] for w in term.split(" "))
        if second:
            codes.append(first * n_words + second[0])
            places.append(place)
        else:
            single[first] = place
    order = np.argsort(np.array(codes, dtype=np.int64))
    code, place_of = np.array([*np.array(codes, dtype=np.int64)[order], -1]), np.array([*np.array(places, dtype=np.int64)[order], -1])
    idf = model.idf

    class Known(dict):
        def __missing__(self, word: str) -> int:
            return n_words if len(word) > 1 else -1

    known = Known(numbered)

    def entries(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number, doc = _numbers(texts, known.__getitem__)
        near = np.flatnonzero((doc[1:] == doc[:-1]) & (number[1:] < n_words) & (number[:-1] < n_words))
        met = number[near] * n_words + number[near + 1]
        at = np.searchsorted(code[:-1], met)
        pair = np.where(code[at] == met, place_of[at], -1)
        place = np.concatenate([single[number], pair])
        row = np.concatenate([doc, doc[near]])[place >= 0]
        cell, times = np.unique(row * size + place[place >= 0], return_counts=True)
        row, place = cell // size, cell % size
        weight = times * idf[place]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(texts)))
        return np.bincount(row, minlength=len(texts)), place, weight / norm[row]

    def vectors(texts: pa.Array) -> pa.Array:
        none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        parts = [entries(part) for _, part in _slices(texts)] or [none]
        filled, place, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        offsets = pa.array(np.concatenate([[0], np.cumsum(filled)]).astype(np.int32))
        n = len(texts)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(n, dtype=np.int8)),
                pa.array(np.full(n, size, dtype=np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(weight)),
            ],
            ["type", "size", "indices", "values"],
        )

    return vectors


def vectorise(df: DataFrame, text_column: str, model: TermModel) -> DataFrame:
    """Add ``tfidf``, a sparse unit vector. Terms outside the vocabulary are ignored; a null
    text has none."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(VectorUDT())
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = _vector_maker(shared.value)
        for texts in batches:
            yield make(texts)

    return df.withColumn("tfidf", vector(_spaced(F.col(text_column))))


def sparse_rows(vectors: DataFrame, key: str, vector: str = "tfidf") -> DataFrame:
    """``(key, indices, values)``: the entries of a sparse vector as two arrays."""
    fields = vectors.select(key, F.unwrap_udt(F.col(vector)).alias("_fields"))
    return fields.select(key, "_fields.indices", "_fields.values")


def postings(vectors: DataFrame, key: str, vector: str = "tfidf") -> DataFrame:
    """``(key, term_id, weight)``, one row per term of a document, without a shuffle."""
    zipped = F.arrays_zip(F.col("indices").alias("term_id"), F.col("values").alias("weight"))
    return sparse_rows(vectors, key, vector).select(key, F.inline(zipped))
