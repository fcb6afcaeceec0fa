"""Queries that fit something: models, segments, topics, projections. Rows are checked
by the tests on small fixtures; SQL cannot repeat an iterative fit. Every query runs at
the defaults of its operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.numbers import round_half_up
from tidemark.operators import cleaning, embedding, evidence, explain, modelling, segmentation, tfidf, topics
from tidemark.plans import answering_run, feedback_run, training_run
from tidemark.plans import frames as fr
from tidemark.plans.catalog_accounts import scratch
from tidemark.plans.frames import Frames
from tidemark.plans.registry import register
from tidemark.scratch import keep


def _training(f: Frames) -> tuple[DataFrame, list[str], list[str]]:
    frame = modelling.prepare_training_frame(f.full_features)
    numeric, categorical = modelling.model_inputs(frame)
    return frame, numeric, categorical


@register(
    "m1_stratified_split",
    """SELECT churned, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS test_rows
       FROM (SELECT Churn AS churned FROM {features}) labelled GROUP BY churned""",
)
def _(f: Frames) -> DataFrame:
    frame = modelling.prepare_training_frame(f.features)
    return frame.groupBy(F.col("label").alias("churned")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("test_rows")
    )


@register("m2_m3_encoding")
def _(f: Frames) -> DataFrame:
    frame, numeric, categorical = _training(f)
    encoding = modelling.fit_encoding(frame.where(~F.col("is_test")), numeric, categorical)
    values = F.zip_with(
        F.array(*[F.lit(n) for n in encoding.names]), F.array(*encoding.values()),
        lambda n, v: F.struct(n.alias("feature"), v.alias("value")),
    )
    rows = encoding.with_rare(frame).select(F.inline(values))
    return rows.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("deviation"),
    )


def _cross_validated(f: Frames, name: str) -> DataFrame:
    frame, numeric, categorical = _training(f)
    train = frame.where(~F.col("is_test"))
    scores = modelling.cross_validate(train, modelling.CANDIDATES[name], numeric, categorical)
    rows = [(name, i, score) for i, score in enumerate(scores)]
    return f.spark.createDataFrame(rows, "model string, fold int, roc_auc double")


@register("m4a_m5_logistic_regression_cv")
def _(f: Frames) -> DataFrame:
    return _cross_validated(f, "logistic_regression")


@register("m4b_random_forest_cv")
def _(f: Frames) -> DataFrame:
    return _cross_validated(f, "random_forest")


@register("m4c_depthwise_boosting_cv")
def _(f: Frames) -> DataFrame:
    return _cross_validated(f, "boosting_depthwise")


@register("m4d_leafwise_boosting_cv")
def _(f: Frames) -> DataFrame:
    return _cross_validated(f, "boosting_leafwise")


def _fitted(f: Frames, calibration: str | None = "sigmoid") -> modelling.ChurnModel:
    """A calibrated linear model with its background, without the comparison of candidates."""
    frame, numeric, categorical = _training(f)
    train = frame.where(~F.col("is_test"))
    encoding = modelling.fit_encoding(train, numeric, categorical)
    base = modelling.fit_model(encoding.encode(train), modelling.logistic_regression)
    parts = modelling.calibrate(train, modelling.logistic_regression, encoding, calibration, folds=3)
    return modelling.ChurnModel(
        "logistic_regression", encoding, base, parts, threshold=0.3,
        background=modelling.background_means(encoding.encode(train), encoding.names),
        medians=cleaning.exact_median(train, ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]),
    )


@register("m6_m7_m10_k7_training_report")
def _(f: Frames) -> DataFrame:
    run = training_run.train(f.full_features, modelling.CANDIDATES)
    policy = run.decision_policy.select("threshold", "n_targeted", "expected_net_saving", "roi")
    chosen = run.candidates.orderBy(F.desc("cv_roc_auc_mean"), "name").limit(1)
    return (
        chosen.select(F.col("name").alias("selected_model"), "cv_roc_auc_mean", F.lit(1).alias("k"))
        .join(policy.withColumn("k", F.lit(1)), "k")
        .join(run.final_metrics.withColumn("k", F.lit(1)), "k")
        .drop("k")
    )


@register("m7_isotonic_calibration")
def _(f: Frames) -> DataFrame:
    scored = _fitted(f, "isotonic").score(f.full_features)
    return scored.select("customerID", "Churn", "churn_probability")


@register("m11_m22_k4_scored_base")
def _(f: Frames) -> DataFrame:
    return training_run.score_accounts(_fitted(f), f.full_features).drop("scored_at")


@register("k10_c12_saved_model_scores_raw_accounts")
def _(f: Frames) -> DataFrame:
    folder = scratch(f)
    modelling.save_model(_fitted(f), folder, f.spark)
    loaded = modelling.load_model(folder, f.spark)
    return training_run.score_accounts(loaded, f.views.raw_accounts).drop("scored_at")


@register("m12_m15_trained_model_drivers")
def _(f: Frames) -> DataFrame:
    explained = training_run.explained_accounts(_fitted(f, None), f.full_features)
    return explain.top_drivers(explained, "customerID")


@register("m13_m14_tree_importance")
def _(f: Frames) -> DataFrame:
    frame, numeric, categorical = _training(f)
    train = frame.where(~F.col("is_test"))
    encoding = modelling.fit_encoding(train, numeric, categorical)
    base = modelling.fit_model(encoding.encode(train), modelling.CANDIDATES["random_forest"])
    model = modelling.ChurnModel("random_forest", encoding, base, ())
    return explain.global_importance(training_run.explained_accounts(model, frame))


def _boosted(f: Frames) -> tuple[modelling.ChurnModel, DataFrame]:
    """A depth-wise booster on all training rows, without the comparison of candidates."""
    frame, numeric, categorical = _training(f)
    train = frame.where(~F.col("is_test"))
    encoding = modelling.fit_encoding(train, numeric, categorical)
    base = modelling.fit_model(encoding.encode(train), modelling.CANDIDATES["boosting_depthwise"])
    return modelling.ChurnModel("boosting_depthwise", encoding, base, ()), frame


@register(
    "m13_m15_tree_shapley_sums",
    """SELECT customerID, CAST(0 AS DOUBLE) AS gap, CAST(0 AS DOUBLE) AS beyond_model
       FROM {features}""",
)
def _(f: Frames) -> DataFrame:
    model, frame = _boosted(f)
    explained = training_run.explained_accounts(model, frame)
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x["contribution"])
    scored = model.score(frame, "p").select("customerID", F.log(F.col("p") / (1 - F.col("p"))).alias("margin"))
    return explained.join(scored, "customerID").select(
        "customerID",
        F.abs(F.round(F.col("base_value") + total - F.col("prediction"), 6)).alias("gap"),
        F.abs(F.round(F.col("prediction") - F.col("margin"), 6)).alias("beyond_model"),
    )


@register("m13_m15_w3_booster_drivers")
def _(f: Frames) -> DataFrame:
    model, frame = _boosted(f)
    return explain.top_drivers(training_run.explained_accounts(model, frame), "customerID")


@register(
    "m4c_leaf_weights",
    """SELECT CAST(0 AS BIGINT) AS wrong_leaves, CAST(0 AS BIGINT) AS thin_leaves""",
)
def _(f: Frames) -> DataFrame:
    model, _ = _boosted(f)
    rules = model.base.rules
    leaves = model.base.node_table(f.spark).where("feature < 0")
    weight = F.lit(-rules.rate) * F.col("gradient") / (F.col("hessian") + rules.penalty)
    return leaves.agg(
        F.count_if(F.abs(F.col("value") - weight) > 1e-9).alias("wrong_leaves"),
        F.count_if(F.col("hessian") < rules.least_hessian - 1e-6).alias("thin_leaves"),
    )


@register("m14_impurity_fallback")
def _(f: Frames) -> DataFrame:
    frame, numeric, categorical = _training(f)
    train = frame.where(~F.col("is_test"))
    encoding = modelling.fit_encoding(train, numeric, categorical)
    base = modelling.fit_model(encoding.encode(train), modelling.CANDIDATES["random_forest"])
    return explain.model_importance(f.spark, encoding.names, modelling.impurity_weights(base))


@register("m21_background_sample")
def _(f: Frames) -> DataFrame:
    return explain.background_sample(f.features, "customerID").select("customerID", "tenure", "MonthlyCharges")


def _driver_documents(f: Frames) -> DataFrame:
    """Evidence on what drives the linear model, from the contributions of all customers."""
    model = _fitted(f, None)
    auc = modelling.area_under_roc(model.score(f.full_features.withColumn("label", F.col("Churn"))))
    importance = explain.global_importance(training_run.explained_accounts(model, f.full_features), 10)
    return evidence.driver_documents(evidence.ranked_importance(importance), model.name, auc)


@register("r3_t10_driver_evidence")
def _(f: Frames) -> DataFrame:
    return _driver_documents(f).select("doc_id", "text", "source")


@register("m16_m17_segmentation")
def _(f: Frames) -> DataFrame:
    return segmentation.segment(f.features).assignments


@register(
    "m16_nearest_centres",
    "SELECT customerID, CAST(0 AS BIGINT) AS nearer_centres FROM {features}",
)
def _(f: Frames) -> DataFrame:
    """Centres that are nearer to a customer than the one of the own segment."""
    features = keep(f.features.select("customerID", *segmentation.SEGMENT_FEATURES), "segment-features")  # read twice
    result = segmentation.segment(features)
    points, _ = segmentation.standardised_inputs(features)
    found = points.join(result.assignments.select("customerID", "segment_id"), "customerID")
    gaps = F.array(
        *[
            sum(((F.col("scaled")[i] - float(c)) * (F.col("scaled")[i] - float(c)) for i, c in enumerate(centre)), F.lit(0.0))
            for centre in result.centres
        ]
    )
    own = F.element_at(gaps, F.col("segment_id") + 1)
    nearer = F.size(F.filter(gaps, lambda gap: gap < own - 1e-9))
    return found.select("customerID", nearer.cast("bigint").alias("nearer_centres"))


@register("n4_n5_t6_x9_topics")
def _(f: Frames) -> DataFrame:
    corpus = keep(f.corpus.select("review_id", "clean_text"), "corpus")  # read twice, cleaned once
    model = topics.fit_topics(corpus, rules=topics.topic_rules(fr.TEXT_STOP_WORDS))
    labelled = topics.topic_labels(model.term_table(f.spark))
    return labelled.select("topic_id", F.array_join("terms", ", ").alias("terms"), "topic_label")


@register("n8_feedback_run")
def _(f: Frames) -> DataFrame:
    run = feedback_run.run_feedback(
        f.views.feedback, fr.TEXT_STOP_WORDS, fr.TEXT_POSITIVE, fr.TEXT_NEGATIVE, fr.TEXT_NEGATORS
    )
    return run.summary


@register("r7_svd_embedding")
def _(f: Frames) -> DataFrame:
    documents = f.views.evidence.select("doc_id", "text")
    model = tfidf.fit_terms(documents, "text", tfidf.TermRules(fr.TEXT_STOP_WORDS))
    projection = embedding.fit_projection(documents, "text", model)
    vectors = embedding.embed(documents, "text", "doc_id", projection)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return vectors.select(
        "doc_id", F.size("embedding").alias("dimensions"), round_half_up(length, 4).alias("length")
    )


@register("r15_cited_answers_over_all_evidence")
def _(f: Frames) -> DataFrame:
    corpus = evidence.build_corpus(
        [
            evidence.kpi_documents(f.features),
            _driver_documents(f),
            evidence.topic_documents(f.topic_summary),
            evidence.review_documents(f.sentiment),
        ]
    )
    index = answering_run.build_index(corpus, fr.TEXT_STOP_WORDS)
    return answering_run.answer_questions(index, f.views.questions.select("question_id", "question"))


@register("x9_topic_names")
def _(f: Frames) -> DataFrame:
    words = tfidf.with_terms(f.views.feedback, "review_text", fr.TEXT_STOP_WORDS)
    counted = words.select("lang", F.explode("terms").alias("term")).groupBy("lang", "term")
    weighted = counted.agg(F.count(F.lit(1)).alias("weight")).withColumnRenamed("lang", "topic_id")
    return topics.top_terms(weighted).select("topic_id", tx.topic_name(F.col("terms")).alias("topic_label"))
