"""Feedback text: cleaning and sentiment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lexicons as lx
from tidemark.functions import text as tx


def clean_corpus(
    reviews: DataFrame, text_column: str = "review_text", min_tokens: int = 3, nfkc: bool = True
) -> DataFrame:
    """Add ``clean_text`` and ``token_count``; drop texts with too little left to read.

    The text comes out of a generator, so the optimiser cannot copy the pattern chain
    into the filter and into every later use.
    """
    cleaned = F.struct(tx.normalise(F.col(text_column), nfkc).alias("clean_text"))
    return (
        reviews.select("*", F.inline(F.array(cleaned)))
        .withColumn("token_count", tx.token_count(F.col("clean_text")))
        .where(F.col("token_count") >= min_tokens)
    )


def score_sentiment(
    df: DataFrame,
    text_column: str = "clean_text",
    positive: Mapping[str, float] = lx.POSITIVE_WORDS,
    negative: Mapping[str, float] = lx.NEGATIVE_WORDS,
    negators: Sequence[str] = lx.NEGATORS,
    backend: Callable[[Column], Column] | None = None,
    backend_name: str = "lexicon",
) -> DataFrame:
    """Add score, label and the backend that produced them.

    ``backend`` maps the text column to a score column, for example an Arrow UDF
    around a model; the lexicon is the default.
    """
    text = F.col(text_column)
    score = backend(text) if backend else tx.lexicon_sentiment(text, positive, negative, negators)
    return (
        df.withColumn("sentiment_score", score)
        .withColumn("sentiment_label", tx.sentiment_label(F.col("sentiment_score")))
        .withColumn("sentiment_backend", F.lit(backend_name))
    )


def model_backend(
    load: Callable[[], Callable[[np.ndarray], np.ndarray]], batch_size: int = 32
) -> Callable[[Column], Column]:
    """A backend for ``score_sentiment`` around a model.

    ``load`` runs once in every Python worker and returns a function from an array of texts
    to their scores; it gets ``batch_size`` texts at a time, whatever the Arrow batch. A null
    text is scored as an empty one.
    """

    def make() -> Callable[[np.ndarray], np.ndarray]:
        predict = load()
        return lambda texts: np.asarray(predict(texts), dtype=float)

    scored = predict_batch_udf(make, return_type=T.DoubleType(), batch_size=batch_size)
    return lambda text: scored(F.coalesce(text, F.lit("")))


@dataclass(frozen=True)
class WordScores:
    """Log odds of words between two classes: a linear model of word counts."""

    words: dict[str, float]
    prior: float

    def load(self) -> Callable[[np.ndarray], np.ndarray]:
        """Scores from -1 to 1: twice the probability of the first class less one."""

        def predict(texts: np.ndarray) -> np.ndarray:
            margin = [self.prior + sum(self.words.get(w, 0.0) for w in t.split(" ")) for t in texts]
            return np.tanh(np.array(margin) / 2)

        return predict


def fit_word_scores(
    labelled: DataFrame, positive: Column, text_column: str = "clean_text", max_words: int = 20_000
) -> WordScores:
    """Fit on rows whose ``positive`` is not null; the ``max_words`` most frequent words count.

    Words are counted in Spark, the chosen ones (ties from A to Z) reach the driver. One count
    is added to every word of both classes and to both classes' rows.
    """
    rows = labelled.select(F.col(text_column).alias("text"), positive.alias("positive")).where("positive is not null")
    words = rows.select("positive", F.explode(F.split("text", " ")).alias("word")).where("word <> ''")
    counted = words.groupBy("word").agg(
        F.count_if("positive").alias("yes"), F.count_if(~F.col("positive")).alias("no")
    )
    kept = counted.orderBy(F.desc(F.col("yes") + F.col("no")), "word").limit(max_words).collect()
    size = rows.agg(F.count_if("positive").alias("yes"), F.count_if(~F.col("positive")).alias("no")).first()
    all_yes = sum(r["yes"] + 1 for r in kept)
    all_no = sum(r["no"] + 1 for r in kept)
    odds = {r["word"]: float(np.log((r["yes"] + 1) / all_yes) - np.log((r["no"] + 1) / all_no)) for r in kept}
    return WordScores(odds, float(np.log((size["yes"] + 1) / (size["no"] + 1))))
