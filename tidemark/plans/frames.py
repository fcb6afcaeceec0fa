"""The frames that several queries share, built from the views by the operators."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from tidemark.functions.numbers import exact_avg
from tidemark.operators import cleaning, decisions, explain, feedback, features, kpi, retrieval, tfidf
from tidemark.plans.views import Views
from tidemark.scratch import keep
from tidemark.session import ship_package

# The benchmark texts are invented words, so their lexicon and stop words are parameters.
TEXT_POSITIVE = {"that": 1.0, "with": 1.2, "thatin": 1.6, "la": 0.7, "no": 0.5}
TEXT_NEGATIVE = {"of": 1.1, "der": 0.9, "ononst": 2.0, "rewh": 1.4, "is": 0.8}
TEXT_NEGATORS = ("in", "de", "no", "not")
TEXT_STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "de", "la", "der")

THRESHOLD = 0.5
TENURE_EDGES = (60.0, 70.0, 74.0, 77.0, float("inf"))
TENURE_LABELS = ("0-60", "60-70", "70-74", "74-77", "77+")

# A linear model over engineered features, for the attribution queries.
LINEAR_MODEL = {
    "tenure": -0.04,
    "MonthlyCharges": 0.02,
    "services_count": -0.15,
    "is_month_to_month": 0.9,
    "is_manual_payment": 0.35,
    "charge_drift": 0.01,
    "charge_drift_pct": -0.6,
    "has_premium_support": -0.4,
}

SCENARIOS = (
    {"offer_cost": 45.0, "save_rate": 0.30, "margin": 0.35, "horizon_months": 12, "threshold": 0.50},
    {"offer_cost": 20.0, "save_rate": 0.25, "margin": 0.35, "horizon_months": 12, "threshold": 0.30},
    {"offer_cost": 90.0, "save_rate": 0.40, "margin": 0.50, "horizon_months": 24, "threshold": 0.70},
    {"offer_cost": 500.0, "save_rate": 0.05, "margin": 0.10, "horizon_months": 6, "threshold": 0.95},
)


class Frames:
    """One scale folder, from raw views to decisions and retrieval inputs."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        ship_package(spark)
        self.spark = spark
        self.views = Views(spark, folder)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.clean_accounts(self.views.raw_accounts, [F.col("customerID")])

    @cached_property
    def features(self) -> DataFrame:
        return features.engineer_features(self.clean, edges=TENURE_EDGES, labels=TENURE_LABELS)

    @cached_property
    def review_features(self) -> DataFrame:
        return features.review_features(self.views.feedback)

    @cached_property
    def full_features(self) -> DataFrame:
        return features.add_review_features(self.features, self.review_features)

    @cached_property
    def scored(self) -> DataFrame:
        """A probability with many ties, exact in every engine, and the outcome."""
        p = (F.col("customerID").cast("bigint") * 37 % 1000).cast("double") / 1000
        return self.features.withColumn("churn_probability", p).withColumn("label", F.col("Churn"))

    @cached_property
    def predictions(self) -> DataFrame:
        return decisions.decide(self.scored, THRESHOLD)

    @cached_property
    def joined(self) -> DataFrame:
        return decisions.with_account_columns(self.predictions, self.features)

    @cached_property
    def corpus(self) -> DataFrame:
        return feedback.clean_corpus(self.views.feedback)

    @cached_property
    def sentiment(self) -> DataFrame:
        return feedback.score_sentiment(
            self.corpus, positive=TEXT_POSITIVE, negative=TEXT_NEGATIVE, negators=TEXT_NEGATORS
        )

    @cached_property
    def topics(self) -> DataFrame:
        """Sentiment with a given topic per text: the number in its channel."""
        topic = (F.substring("channel", 4, 10).cast("int") % 8).alias("topic_id")
        return self.sentiment.withColumn("topic_id", topic).withColumn(
            "topic_label", F.concat(F.lit("theme "), F.col("topic_id").cast("string"))
        )

    @cached_property
    def topic_summary(self) -> DataFrame:
        return kpi.topic_summary(self.topics)

    @cached_property
    def segments(self) -> DataFrame:
        """A given assignment of eight segments and their names, by value, tenure and products."""
        segment = (
            4 * (F.col("MonthlyCharges") >= 100).cast("int")
            + 2 * (F.col("tenure") >= 72).cast("int")
            + (F.col("services_count") >= 5).cast("int")
        )
        return self.features.withColumn("segment_id", segment).withColumn(
            "segment_name", F.concat(F.lit("segment "), segment.cast("string"))
        )

    @cached_property
    def explained(self) -> DataFrame:
        names = list(LINEAR_MODEL)
        means = self.features.agg(*[exact_avg(n).alias(n) for n in names]).first()
        contributions = explain.linear_contributions(
            F.array(*[F.col(n).cast("double") for n in names]),
            names, list(LINEAR_MODEL.values()), [means[n] for n in names],
        )
        return self.features.select("customerID", contributions.alias("contributions"))

    @cached_property
    def term_model(self) -> tfidf.TermModel:
        rules = tfidf.TermRules(stop_words=TEXT_STOP_WORDS)
        return tfidf.fit_terms(self.views.evidence, "text", rules)

    @cached_property
    def postings(self) -> DataFrame:
        vectors = tfidf.vectorise(self.views.evidence.select("doc_id", "text"), "text", self.term_model)
        return tfidf.postings(vectors, "doc_id")

    @cached_property
    def lexical(self) -> DataFrame:
        asked = self.views.questions.select("question_id", "question")
        vectors = tfidf.vectorise(asked, "question", self.term_model)
        # Written, so that its true size is known: few terms of questions go to the postings.
        terms = keep(tfidf.postings(vectors, "question_id"), "question-terms")
        return retrieval.lexical_scores(self.postings, terms)

    @cached_property
    def indexed_evidence(self) -> DataFrame:
        """Evidence with its vector and the entries of its term vector, written once: a search
        reads them for the scale and for the scores."""
        vectors = tfidf.vectorise(self.views.evidence, "text", self.term_model).drop("text")
        return keep(retrieval.with_entries(vectors), "evidence-vectors")

    @cached_property
    def encoded_questions(self) -> DataFrame:
        vectors = tfidf.vectorise(self.views.questions, "question", self.term_model)
        return retrieval.with_entries(vectors)

    @cached_property
    def overlap(self) -> retrieval.TermOverlap:
        return retrieval.TermOverlap(self.indexed_evidence)

    @cached_property
    def evidence_text(self) -> DataFrame:
        share = F.create_map(F.lit("negative_share"), F.col("negative_share").cast("string"))
        return self.views.evidence.select("doc_id", "text", share.alias("metadata"))

    @cached_property
    def hits(self) -> DataFrame:
        found = retrieval.search_stratified(
            self.indexed_evidence, self.encoded_questions, self.overlap, retrieval.DEFAULT_QUOTAS
        )
        from tidemark.operators.answers import with_text

        return with_text(found, self.evidence_text)


