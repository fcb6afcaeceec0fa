"""Topics: non-negative factorisation of TF-IDF documents, terms, names, assignment.

Document weights depend only on the (small) term matrix, so they are solved anew in
every pass instead of being stored: a pass reads the documents once and returns sums
no larger than terms × topics. Nothing grows with the corpus but the scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lexicons as lx
from tidemark.functions import text as tx
from tidemark.functions.numbers import round_half_up
from tidemark.operators.embedding import batch_products, singular_vectors
from tidemark.operators.ranking import top_k
from tidemark.operators.tfidf import TermModel, TermRules, fit_terms, sparse_rows, vectorise
from tidemark.session import ensure_checkpoint_dir

N_TOPICS = 8
TERMS_PER_TOPIC = 10
_TINY = 1e-12
_SETTLED = 1e-6
_NOISE = 1e-6  # smaller entries of a singular vector, relative to the largest, count as zero


def topic_rules(stop_words: tuple[str, ...] = ()) -> TermRules:
    """Terms in 5 documents or more, at most 85% of them, 8,000 at most."""
    return TermRules(tuple(stop_words) + lx.DOMAIN_STOPWORDS, min_df=5, max_df=0.85, max_features=8_000)


@dataclass(frozen=True)
class TopicModel:
    term_model: TermModel
    components: np.ndarray  # topics × terms
    passes: int

    def term_table(self, spark) -> DataFrame:
        """``(topic_id, term, weight)`` for every non-zero weight."""
        rows = [
            (int(k), self.term_model.terms[t], float(self.components[k, t]))
            for k, t in zip(*np.nonzero(self.components > _TINY), strict=True)
        ]
        return spark.createDataFrame(rows, "topic_id int, term string, weight double")


def _solve_weights(products: np.ndarray, gram: np.ndarray, steps: int = 100) -> np.ndarray:
    """Non-negative W minimising ||V − W H|| given V Hᵀ and H Hᵀ, by multiplicative steps.

    Steps end when no weight moves by more than a millionth of itself or of the largest.
    """
    weights = np.full_like(products, 1.0)
    weights *= products.sum(axis=1, keepdims=True) / np.maximum((weights @ gram).sum(axis=1, keepdims=True), _TINY)
    for _ in range(steps):
        before = weights
        weights = before * products / np.maximum(before @ gram, _TINY)
        if np.allclose(weights, before, rtol=_SETTLED, atol=_SETTLED * weights.max(initial=0.0)):
            break
    return weights


def _pass(documents: DataFrame, components: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One scan: Σ WᵀV and Σ WᵀW for the document weights that fit the components best."""
    topics, n_terms = components.shape
    gram = components @ components.T
    transposed = np.ascontiguousarray(components.T)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_term = np.zeros((n_terms, topics))
        by_topic = np.zeros((topics, topics))
        for batch in batches:
            products, row, term, weight = batch_products(batch, transposed)
            w = _solve_weights(products, gram)
            for k in range(topics):
                by_term[:, k] += np.bincount(term, weight * w[row, k], minlength=n_terms)
            by_topic += w.T @ w
        used = np.flatnonzero(by_term.any(axis=1))
        ids = np.concatenate([used, -1 - np.arange(topics)])
        values = np.vstack([by_term[used], by_topic])
        yield pd.DataFrame({"id": ids, **{f"s{k}": values[:, k] for k in range(topics)}})

    names = [f"s{k}" for k in range(topics)]
    schema = "id long, " + ", ".join(f"{n} double" for n in names)
    rows = (
        documents.mapInPandas(sums, schema)
        .groupBy("id")
        .agg(*[F.sum(n).alias(n) for n in names])
        .collect()
    )
    by_term, by_topic = np.zeros((n_terms, topics)), np.zeros((topics, topics))
    for r in rows:
        target, at = (by_term, r["id"]) if r["id"] >= 0 else (by_topic, -1 - r["id"])
        target[at] = [r[n] for n in names]
    return by_term.T, by_topic


def _initial_components(
    vectors: DataFrame, n_docs: int, n_terms: int, topics: int, mean: float
) -> np.ndarray:
    """Non-negative start from the leading singular vectors, zeros lifted to the mean.

    The sign of each vector is taken so that its positive part is the heavier one.
    """
    right, strength = singular_vectors(vectors, min(topics, n_terms, n_docs))
    out = np.full((topics, n_terms), mean)
    for k in range(right.shape[1]):
        v = right[:, k]
        positive, negative = np.maximum(v, 0.0), np.maximum(-v, 0.0)
        part = positive if np.linalg.norm(positive) >= np.linalg.norm(negative) else negative
        scaled = np.sqrt(strength[k]) * part / max(np.linalg.norm(part), _TINY)
        out[k] = np.where(scaled > _NOISE * scaled.max(initial=0.0), scaled, mean)
    return out


TOPIC_COLUMNS = ("topic_id", "topic_label", "topic_strength")


def fit_topics(
    corpus: DataFrame,
    text_column: str = "clean_text",
    key: str = "review_id",
    topics: int = N_TOPICS,
    rules: TermRules | None = None,
    max_passes: int = 600,
    tolerance: float = 1e-4,
) -> TopicModel:
    """Alternate document weights (in the tasks) and term weights (model-sized)."""
    ensure_checkpoint_dir(corpus.sparkSession)
    model = fit_terms(corpus, text_column, rules or topic_rules())
    vectors = vectorise(corpus.select(key, text_column), text_column, model).select(key, "tfidf").checkpoint()
    documents = sparse_rows(vectors, key)
    totals = documents.agg(
        F.sum(F.aggregate("values", F.lit(0.0), lambda a, v: a + v)).alias("sum"),
        F.sum(F.aggregate("values", F.lit(0.0), lambda a, v: a + v * v)).alias("squares"),
    ).first()
    mean = totals["sum"] / (model.n_docs * len(model.terms))
    components = _initial_components(vectors, model.n_docs, len(model.terms), topics, mean)
    first = previous = None
    passes = 0
    for _ in range(max_passes):
        passes += 1
        by_term, by_topic = _pass(documents, components)
        error = totals["squares"] - 2 * (components * by_term).sum() + (by_topic * (components @ components.T)).sum()
        first = error if first is None else first
        for _ in range(20):
            components = components * by_term / np.maximum(by_topic @ components, _TINY)
        if previous is not None and previous - error < tolerance * max(first, _TINY):
            break
        previous = error
    return TopicModel(model, components, passes)


def topic_weights(corpus: DataFrame, model: TopicModel, text_column: str, key: str) -> DataFrame:
    """Document weights on the fixed topics: ``(key, weights array<double>)``."""
    vectors = vectorise(corpus.select(key, text_column), text_column, model.term_model)
    return vectors.select(key, _weights(model, F.col("tfidf")).alias("weights"))


def _weights(model: TopicModel, vector: Column) -> Column:
    """A row's weights; only the vector's entries travel to Python, other columns stay."""
    gram = model.components @ model.components.T
    transposed = np.ascontiguousarray(model.components.T)

    @F.pandas_udf("array<double>")
    def solve(indices: pd.Series, values: pd.Series) -> pd.Series:
        batch = pd.DataFrame({"indices": indices, "values": values})
        products, *_ = batch_products(batch, transposed)
        return pd.Series(list(_solve_weights(products, gram, 200)), index=indices.index, dtype=object)

    fields = F.unwrap_udt(vector)
    return solve(fields["indices"], fields["values"])


def dominant_topic(weights: Column) -> tuple[Column, Column]:
    """Strongest topic (the first on ties, 0 for an all-zero document) and its share."""
    strongest = F.array_max(weights)
    total = F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)
    topic = (F.array_position(weights, strongest) - 1).cast("int")
    share = F.coalesce(F.try_divide(strongest, total), F.lit(0.0))
    return topic, round_half_up(share, 4)


def top_terms(term_table: DataFrame, k: int = TERMS_PER_TOPIC) -> DataFrame:
    """``(topic_id, terms)``: the k heaviest terms per topic in order."""
    ranked = top_k(term_table, ["topic_id"], [F.desc("weight"), F.asc("term")], k)
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("topic_id").agg(listed["term"].alias("terms"))


def topic_labels(term_table: DataFrame, k: int = TERMS_PER_TOPIC) -> DataFrame:
    """``(topic_id, terms, topic_label)``."""
    return top_terms(term_table, k).withColumn("topic_label", tx.topic_name(F.col("terms")))


def assign_topics(
    corpus: DataFrame, model: TopicModel, text_column: str = "clean_text", key: str = "review_id"
) -> DataFrame:
    """``(key, topic_id, topic_label, topic_strength)``; labels are one row per topic."""
    return with_topics(corpus.select(key, text_column), model, text_column).select(key, *TOPIC_COLUMNS)


def with_topics(corpus: DataFrame, model: TopicModel, text_column: str = "clean_text") -> DataFrame:
    """The rows as they are with ``topic_id``, ``topic_label`` and ``topic_strength``.

    No join on an id: rows with the same id stay as many as they were. Columns of these
    names, ``terms`` and ``tfidf`` are replaced.
    """
    topic, strength = dominant_topic(F.col("_weights"))
    labels = topic_labels(model.term_table(corpus.sparkSession)).select("topic_id", "topic_label")
    kept = corpus.drop(*TOPIC_COLUMNS)
    # Out of a generator, so that the optimiser solves a row once and not per use.
    solved = F.inline(F.array(F.struct(_weights(model, F.col("tfidf")).alias("_weights"))))
    weighted = vectorise(kept, text_column, model.term_model).select("*", solved).drop("tfidf")
    placed = weighted.withColumns({"topic_id": topic, "topic_strength": strength}).drop("_weights")
    labelled = placed.join(F.broadcast(labels), "topic_id", "left")
    return labelled.withColumn("topic_label", F.coalesce("topic_label", F.lit("misc"))).select(
        *kept.columns, *TOPIC_COLUMNS
    )
