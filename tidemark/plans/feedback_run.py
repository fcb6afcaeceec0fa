"""Feedback from raw text to scored, topic-labelled reviews and a topic summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lexicons as lx
from tidemark.operators import feedback, kpi, topics
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import tables

# Columns kept in the review table, as far as they are there.
REVIEW_COLUMNS = (
    "review_id", "customerID", "review_date", "channel", "rating", "review_text", "clean_text",
    "sentiment_score", "sentiment_label", "sentiment_backend", "topic_id", "topic_label",
    "topic_strength",
)


@dataclass(frozen=True)
class FeedbackRun:
    reviews: DataFrame
    summary: DataFrame
    terms: DataFrame
    model: topics.TopicModel | None  # None where the topics are given


def run_feedback(
    reviews: DataFrame,
    stop_words: Sequence[str] = (),
    positive: Mapping[str, float] = lx.POSITIVE_WORDS,
    negative: Mapping[str, float] = lx.NEGATIVE_WORDS,
    negators: Sequence[str] = lx.NEGATORS,
    n_topics: int = topics.N_TOPICS,
    max_passes: int = 600,
) -> FeedbackRun:
    """Clean, score, find topics, assign them, summarise.

    The cleaned and scored corpus is read by every later step, so it is kept once.
    """
    ensure_checkpoint_dir(reviews.sparkSession)
    corpus = feedback.clean_corpus(reviews)
    scored = feedback.score_sentiment(corpus, positive=positive, negative=negative, negators=negators).checkpoint()
    rules = topics.topic_rules(tuple(stop_words))
    model = topics.fit_topics(scored, topics=n_topics, rules=rules, max_passes=max_passes)
    enriched = topics.with_topics(scored, model)
    kept = [c for c in REVIEW_COLUMNS if c in enriched.columns]
    terms = topics.topic_labels(model.term_table(reviews.sparkSession))
    return FeedbackRun(enriched.select(*kept), kpi.topic_summary(enriched), terms, model)


def write_feedback(
    run: FeedbackRun, folder: str | None = None, json_path: str | None = None, backend: str = "lexicon",
    names: Mapping[str, str] = tables.TABLES,
) -> None:
    """The review and topic tables, and the topics with their terms as JSON."""
    dated = run.reviews
    if "review_date" in dated.columns:
        dated = dated.withColumn("review_date", F.col("review_date").cast("string"))
    tables.write_table(dated, names["review_topics"], folder=folder)
    tables.write_table(run.summary, names["topics"], folder=folder)
    if json_path:
        tables.export_topics(run.summary, run.terms, backend, json_path)
