"""Hybrid retrieval: dense cosine plus lexical overlap, per table of questions.

Documents carry ``doc_id``, ``source`` and an ``embedding``; questions carry
``question_id`` and an ``embedding`` in the same space; the lexical side is a postings
table. Both parts are rounded to eight decimals and their mix to ten, so that floating
point noise decides no rank; ties are broken by ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import round_half_up
from tidemark.operators.ranking import top_k

ALPHA = 0.65  # fixed value: weight of the dense side
# Evidence budget per source.
DEFAULT_QUOTAS = {"kpi": 3, "model_driver": 3, "topic_summary": 6, "review": 4}
PART_DIGITS = 8
SCORE_DIGITS = 10

# Question vectors up to this size are sent to every task; more are met by a keyed join.
BROADCAST_VECTOR_BYTES = 32 << 20
QUESTIONS_PER_BLOCK = 2_048
DOCUMENTS_PER_CELL = 8_192
# Scores exist for one tile at a time, whatever the batch and the number of questions: some
# seven arrays of 16 MB.
TILE_DOCUMENTS, TILE_QUESTIONS = 2_048, 1_024
PRODUCTS_PER_SLICE = 1 << 20  # term products at a time
_ENTRIES = ("indices", "values")


def lexical_scores(postings: DataFrame, question_terms: DataFrame) -> DataFrame:
    """Overlap per (question, document), scaled by the question's best over all documents.

    An equi-join on the term: only documents that share a term appear. The scale is
    taken before any source filter. ``question_terms`` are postings keyed by question.
    """
    weights = question_terms.withColumnRenamed("weight", "question_weight")
    raw = (
        postings.join(weights, "term_id")
        .groupBy("question_id", "doc_id")
        .agg(F.sum(F.col("weight") * F.col("question_weight")).alias("raw"))
    )
    best = raw.groupBy("question_id").agg(F.max("raw").alias("best"))
    scaled = F.coalesce(F.try_divide("raw", "best"), F.lit(0.0))
    return raw.join(best, "question_id").select(
        "question_id", "doc_id", round_half_up(scaled, PART_DIGITS).alias("lexical")
    )


@dataclass(frozen=True)
class TermOverlap:
    """The lexical side straight from term weights, without a table of pairs.

    Documents and questions carry the entries of their unit term vectors as ``indices`` and
    ``values``; the overlap is their product inside the tile that also makes the cosine.
    ``corpus`` holds the entries of all documents, of which each question's best is the scale
    before any source filter. Null entries count as none.
    """

    corpus: DataFrame


def with_entries(vectors: DataFrame, vector: str = "tfidf") -> DataFrame:
    """The rows with the entries of their term vector as ``indices`` and ``values``."""
    fields = F.unwrap_udt(F.col(vector))
    kept = [c for c in vectors.columns if c not in (vector, *_ENTRIES)]
    return vectors.select(*kept, fields["indices"].alias("indices"), fields["values"].alias("values"))


def best_documents(
    documents: DataFrame,
    questions: DataFrame,
    k: int,
    lexical: DataFrame | TermOverlap | None = None,
    alpha: float = ALPHA,
    per_source: bool = True,
    broadcast_bytes: int = BROADCAST_VECTOR_BYTES,
) -> DataFrame:
    """Best k documents per (question, source), or per question, with their score parts.

    Every question meets every document, but as one matrix product per batch of
    documents, and a batch hands on its best k only: no table of pairs exists. Small
    question tables go to every task; larger ones are joined in blocks on a key, so that
    no side has to fit in one task. Without ``lexical`` the score is the cosine; it is a
    table from ``lexical_scores`` or, without a table of pairs, a ``TermOverlap``.
    """
    entries = list(_ENTRIES) if isinstance(lexical, TermOverlap) else []
    docs = documents.select("doc_id", "source", "embedding", *entries)
    asked = questions.select("question_id", "embedding", *entries)
    terms = F.sum(F.array_size("indices")) if entries else F.lit(0)
    size = asked.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim"), terms.alias("entries")
    ).first()
    schema = T.StructType(
        [questions.schema["question_id"], documents.schema["doc_id"], documents.schema["source"]]
    )
    for part in ("dense", "lexical", "score"):
        schema = schema.add(part, "double")
    if size["n"] == 0:
        return documents.sparkSession.createDataFrame([], schema)
    weights = (1.0, 0.0) if lexical is None else (alpha, 1.0 - alpha)
    sent = (size["n"] * (size["dim"] or 0) + 2 * (size["entries"] or 0)) * 8
    if isinstance(lexical, TermOverlap):
        if sent <= broadcast_bytes:
            scored = _meet_all_terms(docs, asked.toArrow(), lexical, weights, k, per_source, schema)
        else:
            scored = _meet_terms_in_blocks(docs, asked, size["n"], lexical, weights, k, per_source, schema)
    elif sent <= broadcast_bytes:
        scored = _meet_all(docs, asked.toArrow(), lexical, weights, k, per_source, schema)
    else:
        scored = _meet_in_blocks(docs, asked, size["n"], lexical, weights, k, per_source, schema)
    finite = scored.where(F.col("score").isNotNull() & ~F.isnan("score"))
    return top_k(finite, ["question_id", "source"] if per_source else ["question_id"], _best_first(), k)


def dense_top(
    documents: DataFrame,
    questions: DataFrame,
    k: int,
    per_source: bool = True,
    broadcast_bytes: int = BROADCAST_VECTOR_BYTES,
) -> DataFrame:
    """Best k documents by cosine alone."""
    best = best_documents(documents, questions, k, None, 1.0, per_source, broadcast_bytes)
    return best.select("question_id", "doc_id", "source", "dense")


def _with_overlaps(docs: DataFrame, lexical: DataFrame | None, keys: list[str]) -> DataFrame:
    """Attach each document's overlaps as two lists: at most one entry per question."""
    if lexical is None:
        return docs
    lists = lexical.groupBy(*keys).agg(F.collect_list(F.struct("question_id", "lexical")).alias("o"))
    attached = docs.join(lists, keys, "left")
    return attached.select(
        *docs.columns, F.col("o.question_id").alias("overlap_ids"), F.col("o.lexical").alias("overlaps")
    )


def _meet_all(
    docs: DataFrame, asked: pa.Table, lexical: DataFrame | None, weights: tuple[float, float], k: int,
    per_source: bool, schema: T.StructType,
) -> DataFrame:
    ids, matrix = asked["question_id"].combine_chunks(), _unit_rows(asked["embedding"].combine_chunks())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _tile_tops(batch, ids, matrix, weights, k, per_source)

    return _with_overlaps(docs, lexical, ["doc_id"]).mapInArrow(score, schema)


class _AskedTerms:
    """The questions' term entries by term, in tiles of questions, and each question's best."""

    def __init__(self, indices: pa.Array, values: pa.Array, best: np.ndarray | None = None) -> None:
        question = pc.list_parent_indices(indices).to_numpy(zero_copy_only=False)
        term = indices.flatten().to_numpy(zero_copy_only=False)
        weight = values.flatten().to_numpy(zero_copy_only=False)
        self.n, self.best, self.tiles = len(indices), best, []
        for first in range(0, self.n, TILE_QUESTIONS):
            here = np.flatnonzero((question >= first) & (question < first + TILE_QUESTIONS))
            here = here[np.argsort(term[here], kind="stable")]
            self.tiles.append((term[here], question[here] - first, weight[here]))

    def raw(self, part: pa.RecordBatch, first: int) -> np.ndarray:
        """Summed weight products of the documents of a tile and the questions from ``first`` on."""
        asked_term, question, asked_weight = self.tiles[first // TILE_QUESTIONS]
        width = min(TILE_QUESTIONS, self.n - first)
        out = np.zeros(part.num_rows * width)
        row = pc.list_parent_indices(part["indices"]).to_numpy(zero_copy_only=False)
        term = part["indices"].flatten().to_numpy(zero_copy_only=False)
        weight = part["values"].flatten().to_numpy(zero_copy_only=False)
        low = np.searchsorted(asked_term, term, "left")
        met = np.searchsorted(asked_term, term, "right") - low
        kept = np.flatnonzero(met)
        row, weight, low, met = row[kept], weight[kept], low[kept], met[kept]
        ends = np.cumsum(met)
        lo = 0
        while lo < len(met):  # a slice holds PRODUCTS_PER_SLICE products, and those of one entry more
            before = ends[lo] - met[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, before + PRODUCTS_PER_SLICE, "right")))
            n = met[lo:hi]
            starts = ends[lo:hi] - n - before
            at = np.repeat(low[lo:hi] - starts, n) + np.arange(n.sum())
            cell = np.repeat(row[lo:hi], n) * width + question[at]
            out += np.bincount(cell, weights=np.repeat(weight[lo:hi], n) * asked_weight[at], minlength=len(out))
            lo = hi
        return out.reshape(part.num_rows, width)

    def scaled(self, part: pa.RecordBatch, first: int) -> np.ndarray:
        best = self.best[first : first + TILE_QUESTIONS]
        return _rounded(np.divide(raw := self.raw(part, first), best, out=np.zeros_like(raw), where=best > 0))

    def largest(self, batch: pa.RecordBatch) -> np.ndarray:
        """Each question's best raw overlap within a batch of documents."""
        out = np.zeros(self.n)
        for lo in range(0, batch.num_rows, TILE_DOCUMENTS):
            part = batch.slice(lo, TILE_DOCUMENTS)
            for first in range(0, self.n, TILE_QUESTIONS):
                here = slice(first, first + TILE_QUESTIONS)
                out[here] = np.maximum(out[here], self.raw(part, first).max(axis=0))
        return out


def _meet_all_terms(
    docs: DataFrame, asked: pa.Table, lexical: TermOverlap, weights: tuple[float, float], k: int,
    per_source: bool, schema: T.StructType,
) -> DataFrame:
    ids, matrix = asked["question_id"].combine_chunks(), _unit_rows(asked["embedding"].combine_chunks())
    indices, values = (asked[c].combine_chunks() for c in _ENTRIES)

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _AskedTerms(indices, values)
        best = np.zeros(terms.n)
        for batch in batches:
            best = np.maximum(best, terms.largest(batch))
        found = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(best[found])], names=["place", "best"]
        )

    maxima = lexical.corpus.select(*_ENTRIES).mapInArrow(largest, "place int, best double")
    best = np.zeros(len(ids))
    for row in maxima.groupBy("place").agg(F.max("best").alias("best")).collect():
        best[row["place"]] = row["best"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _AskedTerms(indices, values, best)
        for batch in batches:
            if batch.num_rows:
                yield from _tile_tops(batch, ids, matrix, weights, k, per_source, terms)

    return docs.mapInArrow(score, schema)


def _meet_terms_in_blocks(
    docs: DataFrame, asked: DataFrame, n_questions: int, lexical: TermOverlap,
    weights: tuple[float, float], k: int, per_source: bool, schema: T.StructType,
) -> DataFrame:
    keys = ["_block", "_cell"]

    def largest(batch: pa.Table, questions: pa.Table) -> pa.Table:
        best = np.zeros(questions.num_rows)
        if batch.num_rows and questions.num_rows:
            terms = _AskedTerms(*[questions[c].combine_chunks() for c in _ENTRIES])
            best = terms.largest(batch.combine_chunks().to_batches()[0])
        return pa.table({"question_id": questions["question_id"], "best": pa.array(best)})

    corpus = lexical.corpus.select("doc_id", *_ENTRIES)
    left, right = _cells(corpus, asked.select("question_id", *_ENTRIES), n_questions)
    found = T.StructType([asked.schema["question_id"], T.StructField("best", T.DoubleType())])
    maxima = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(largest, found)
    best = maxima.groupBy("question_id").agg(F.max("best").alias("best"))

    def score(batch: pa.Table, questions: pa.Table) -> pa.Table:
        if not batch.num_rows or not questions.num_rows:
            return _nothing(batch, questions)
        ids = questions["question_id"].combine_chunks()
        matrix = _unit_rows(questions["embedding"].combine_chunks())
        highest = pc.fill_null(questions["best"].combine_chunks(), 0.0).to_numpy(zero_copy_only=False)
        terms = _AskedTerms(*[questions[c].combine_chunks() for c in _ENTRIES], highest)
        rows = batch.combine_chunks().to_batches()[0]
        return pa.Table.from_batches(_tile_tops(rows, ids, matrix, weights, k, per_source, terms))

    left, right = _cells(docs, asked.join(best, "question_id", "left"), n_questions)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def _cells(docs: DataFrame, asked: DataFrame, n_questions: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_block`` and ``_cell``: each is repeated over the other's parts."""
    blocks = -(-n_questions // QUESTIONS_PER_BLOCK)
    cells = max(1, -(-docs.count() // DOCUMENTS_PER_CELL))
    left = docs.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    return (
        left.withColumn("_cell", _part("doc_id", cells)),
        right.withColumn("_block", _part("question_id", blocks)),
    )


def _meet_in_blocks(
    docs: DataFrame, asked: DataFrame, n_questions: int, lexical: DataFrame | None,
    weights: tuple[float, float], k: int, per_source: bool, schema: T.StructType,
) -> DataFrame:
    """A block matrix product by equi-join: each side is repeated over the other's blocks."""
    blocks = -(-n_questions // QUESTIONS_PER_BLOCK)
    cells = max(1, -(-docs.count() // DOCUMENTS_PER_CELL))
    block, cell = _part("question_id", blocks), _part("doc_id", cells)
    left = docs.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if lexical is not None:
        lexical = lexical.withColumn("_block", block)
    left = _with_overlaps(left, lexical, ["doc_id", "_block"]).withColumn("_cell", cell)
    right = asked.withColumn("_block", block).withColumn(
        "_cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    )

    def score(batch: pa.Table, questions: pa.Table) -> pa.Table:
        if not batch.num_rows or not questions.num_rows:
            return _nothing(batch, questions)
        ids = questions["question_id"].combine_chunks()
        matrix = _unit_rows(questions["embedding"].combine_chunks())
        rows = batch.combine_chunks().to_batches()[0]
        return pa.Table.from_batches(_tile_tops(rows, ids, matrix, weights, k, per_source))

    keys = ["_block", "_cell"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def _nothing(batch: pa.Table, questions: pa.Table) -> pa.Table:
    numbers = pa.array([], pa.float64())
    columns = {
        "question_id": questions["question_id"].slice(0, 0), "doc_id": batch["doc_id"].slice(0, 0),
        "source": batch["source"].slice(0, 0), "dense": numbers, "lexical": numbers, "score": numbers,
    }
    return pa.table(columns)


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _unit_rows(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of length one. A zero vector stays zero; a missing one, one of another
    width or with a missing entry counts as zero."""
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    if width is None:
        width = int(length.max()) if len(length) else 0
    rows, fits = np.zeros((len(vectors), width)), length == width
    if width and fits.any():
        flat = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        rows[fits] = flat.astype(float).reshape(-1, width)
        rows[~np.isfinite(rows).all(axis=1)] = 0.0
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _rounded(values: np.ndarray, digits: int = PART_DIGITS) -> np.ndarray:
    """As ``round_half_up``: through ten decimals, then halves away from zero."""
    steps = 10 ** (SCORE_DIGITS - digits)
    whole = np.abs(np.rint(values * 10.0**SCORE_DIGITS))
    return np.sign(values) * np.floor((whole + steps // 2) / steps) / 10.0**digits


def _tile_tops(
    batch: pa.RecordBatch, ids: pa.Array, matrix: np.ndarray, weights: tuple[float, float], k: int,
    per_source: bool, terms: _AskedTerms | None = None,
) -> Iterator[pa.RecordBatch]:
    """The k best documents of every tile of documents for each question (and source)."""
    batch = batch.take(pc.sort_indices(batch["doc_id"]))  # ties go to the smaller doc_id
    for lo in range(0, batch.num_rows, TILE_DOCUMENTS):
        part = batch.slice(lo, TILE_DOCUMENTS)
        vectors = _unit_rows(part["embedding"], matrix.shape[1])
        row, asked, overlap = _overlaps(part, ids)
        groups = _row_groups(part, per_source)
        for first in range(0, len(ids), TILE_QUESTIONS):
            dense = _rounded(vectors @ matrix[first : first + TILE_QUESTIONS].T)
            if terms is None:
                lexical = np.zeros_like(dense)
                here = (asked >= first) & (asked < first + TILE_QUESTIONS)
                lexical[row[here], asked[here] - first] = overlap[here]
            else:
                lexical = terms.scaled(part, first)
            score = _rounded(weights[0] * dense + weights[1] * lexical, SCORE_DIGITS)
            best = [rows[np.argsort(-score[rows], axis=0, kind="stable")[:k]] for rows in groups]
            place = np.concatenate([b.ravel() for b in best])
            column = np.concatenate([np.tile(np.arange(score.shape[1]), len(b)) for b in best])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(column + first)),
                    part["doc_id"].take(pa.array(place)),
                    part["source"].take(pa.array(place)),
                    pa.array(dense[place, column]),
                    pa.array(lexical[place, column]),
                    pa.array(score[place, column]),
                ],
                names=["question_id", "doc_id", "source", "dense", "lexical", "score"],
            )


def _overlaps(part: pa.RecordBatch, ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place of the question and overlap of every entry in the documents' lists."""
    if "overlaps" not in part.schema.names:
        none = np.zeros(0, dtype=int)
        return none, none, np.zeros(0)
    at = pc.index_in(part["overlap_ids"].flatten(), value_set=ids)
    known = pc.is_valid(at).to_numpy(zero_copy_only=False)
    row = pc.list_parent_indices(part["overlaps"]).to_numpy()[known]
    values = part["overlaps"].flatten().to_numpy(zero_copy_only=False)[known]
    return row, at.drop_null().to_numpy(), values


def _row_groups(part: pa.RecordBatch, per_source: bool) -> list[np.ndarray]:
    if not per_source:
        return [np.arange(part.num_rows)]
    codes = part["source"].dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return [np.flatnonzero(codes == code) for code in np.unique(codes)]


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc("doc_id")]


def search(
    documents: DataFrame,
    questions: DataFrame,
    lexical: DataFrame | TermOverlap,
    k: int = 6,
    alpha: float = ALPHA,
    sources: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_VECTOR_BYTES,
) -> DataFrame:
    """Flat top k per question; an empty source list means no restriction."""
    allowed = documents.where(F.col("source").isin(*sources)) if sources else documents
    return best_documents(allowed, questions, k, lexical, alpha, False, broadcast_bytes)


def search_stratified(
    documents: DataFrame,
    questions: DataFrame,
    lexical: DataFrame | TermOverlap,
    quotas: Mapping[str, int],
    alpha: float = ALPHA,
    broadcast_bytes: int = BROADCAST_VECTOR_BYTES,
) -> DataFrame:
    """A fixed budget per source, one scoring pass for all sources, best score first."""
    wanted = {source: k for source, k in quotas.items() if k > 0}
    most = max(wanted.values(), default=1)
    allowed = documents.where(F.col("source").isin(*wanted))
    placed = best_documents(allowed, questions, most, lexical, alpha, True, broadcast_bytes)
    budget = F.lit(0)
    for source, k in wanted.items():
        budget = F.when(F.col("source") == source, k).otherwise(budget)
    final = Window.partitionBy("question_id").orderBy(*_best_first())
    return placed.where(F.col("rank") <= budget).withColumn("rank", F.row_number().over(final))


def scale_quotas(quotas: Mapping[str, int], k: int | None) -> dict[str, int]:
    """Resize the budget to about k items, keeping the mix and at least one per source."""
    if not k:
        return dict(quotas)
    total = sum(quotas.values())
    return {source: max(1, round(q * (k / total))) for source, q in quotas.items()}


def quota_table(requests: DataFrame, quotas: Mapping[str, int] = DEFAULT_QUOTAS) -> DataFrame:
    """The scaled budget per request row with a ``top_k`` column (halves round to even)."""
    total = float(sum(quotas.values()))
    listed = F.array(
        *[F.struct(F.lit(src).alias("source"), F.lit(q).alias("quota")) for src, q in quotas.items()]
    )
    scaled = F.greatest(
        F.lit(1), F.bround(F.col("quota") * (F.col("top_k") / F.lit(total)), 0).cast("int")
    )
    unset = F.col("top_k").isNull() | (F.col("top_k") == 0)
    return requests.select("*", F.inline(listed)).withColumn(
        "quota", F.when(unset, F.col("quota")).otherwise(scaled)
    )


def search_requested(
    documents: DataFrame,
    questions: DataFrame,
    lexical: DataFrame | TermOverlap,
    quotas: Mapping[str, int] = DEFAULT_QUOTAS,
    flat_k: int = 6,
    alpha: float = ALPHA,
    broadcast_bytes: int = BROADCAST_VECTOR_BYTES,
) -> DataFrame:
    """Every question with its own ``top_k`` and ``sources``, in one scoring pass.

    A question that names sources gets its ``top_k`` best within them (``flat_k`` if null or
    0); one with null or no sources gets the budget per source, scaled to its ``top_k``.
    """
    named = F.coalesce(F.array_size("sources"), F.lit(0)) > 0
    wanted = F.coalesce(F.nullif(F.col("top_k"), F.lit(0)), F.lit(flat_k)).cast("int")
    requests = questions.select("question_id", "top_k", "sources")
    budget = (
        quota_table(requests.where(~named), quotas)
        .select("question_id", "source", "quota", F.lit(None).cast("int").alias("total"))
        .union(
            requests.where(named).select(
                "question_id", F.explode(F.array_distinct("sources")), wanted, wanted
            )
        )
    )
    most = budget.agg(F.max("quota")).first()[0] or 1
    allowed = documents.join(budget.select("source").distinct(), "source", "left_semi")
    placed = best_documents(allowed, questions, most, lexical, alpha, True, broadcast_bytes)
    within = placed.join(budget, ["question_id", "source"]).where("rank <= quota")
    final = Window.partitionBy("question_id").orderBy(*_best_first())
    ranked = within.withColumn("rank", F.row_number().over(final))
    return ranked.where("total is null or rank <= total").select(*placed.columns)
