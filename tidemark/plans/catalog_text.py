"""Queries over feedback text, evidence and questions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lexicons as lx
from tidemark.functions import text as tx
from tidemark.functions.numbers import round_half_up
from tidemark.operators import answers, evidence, explain, feedback, kpi, retrieval, tfidf, topics
from tidemark.operators.ranking import top_k
from tidemark.plans import feedback_run
from tidemark.plans import frames as fr
from tidemark.plans.catalog_accounts import scratch
from tidemark.plans.frames import Frames
from tidemark.plans.oracle_views import mean, rnd, strings, term_rows, total
from tidemark.plans.registry import register
from tidemark.scratch import keep
from tidemark.sources import tables

# ---------------------------------------------------------------- feedback


@register("n1_x1_x2_p3_clean_corpus", "SELECT review_id, clean_text, token_count FROM {corpus}")
def _(f: Frames) -> DataFrame:
    return f.corpus.select("review_id", "clean_text", "token_count")


@register(
    "n2_x3_x4_sentiment",
    "SELECT review_id, sentiment_score, sentiment_label, sentiment_backend FROM {sentiment}",
)
def _(f: Frames) -> DataFrame:
    return f.sentiment.select("review_id", "sentiment_score", "sentiment_label", "sentiment_backend")


@register(
    "g1_sentiment_model",
    """WITH labelled AS (SELECT rating >= 4 AS positive, clean_text FROM {corpus} WHERE rating <> 3),
       counted AS (
         SELECT word, count(*) FILTER (positive) AS yes, count(*) FILTER (NOT positive) AS no
         FROM (SELECT positive, unnest(string_split(clean_text, ' ')) AS word FROM labelled) w
         WHERE word <> '' GROUP BY word ORDER BY count(*) DESC, word LIMIT 20000),
       odds AS (
         SELECT word, ln((yes + 1.0) / (SELECT sum(yes + 1) FROM counted))
                      - ln((no + 1.0) / (SELECT sum(no + 1) FROM counted)) AS weight FROM counted),
       margins AS (
         SELECT review_id, coalesce(sum(weight), 0)
             + (SELECT ln((count(*) FILTER (positive) + 1.0) / (count(*) FILTER (NOT positive) + 1)) FROM labelled) AS m
         FROM (SELECT review_id, unnest(string_split(clean_text, ' ')) AS word FROM {corpus}) w
         LEFT JOIN odds USING (word) GROUP BY review_id)
       SELECT review_id, """ + rnd("tanh(m / 2)", 6) + """ AS sentiment_score, 'word odds' AS sentiment_backend
       FROM margins""",
)
def _(f: Frames) -> DataFrame:
    rating = F.col("rating")
    model = feedback.fit_word_scores(f.corpus, F.when(rating != 3, rating >= 4))
    scored = feedback.score_sentiment(
        f.corpus, backend=feedback.model_backend(model.load), backend_name="word odds"
    )
    return scored.select("review_id", round_half_up("sentiment_score", 6).alias("sentiment_score"), "sentiment_backend")


@register(
    "k6_feedback_tables",
    """SELECT review_id, CAST(review_date AS VARCHAR) AS review_date, clean_text, sentiment_score, topic_id,
              topic_label, documents, s.avg_rating AS avg_rating
       FROM {topics} t JOIN {topic_summary} s USING (topic_id, topic_label)""",
)
def _(f: Frames) -> DataFrame:
    folder = scratch(f)
    names = {part: f"tidemark_{part}_{uuid.uuid4().hex}" for part in ("review_topics", "topics")}
    kept = [c for c in feedback_run.REVIEW_COLUMNS if c in f.topics.columns]
    reviews = keep(f.topics, "topics")  # read for the reviews and the summary, cleaned once
    summary = keep(kpi.topic_summary(reviews), "topic-summary")
    terms = summary.select("topic_id", F.array("topic_label").alias("terms"))
    run = feedback_run.FeedbackRun(reviews.select(*kept), summary, terms, None)
    feedback_run.write_feedback(run, folder, f"{folder}/json", names=names)
    written = "topic_id int, topic_label string, documents bigint, avg_rating double"
    summary = f.spark.read.schema(written).json(f"{folder}/json")
    return f.spark.table(names["review_topics"]).join(F.broadcast(summary), ["topic_id", "topic_label"]).select(
        "review_id", "review_date", "clean_text", "sentiment_score", "topic_id", "topic_label", "documents", "avg_rating"
    )


@register("a17_median_tokens", "SELECT 'token_count' AS feature, median(token_count) AS median FROM {corpus}")
def _(f: Frames) -> DataFrame:
    return kpi.column_medians(f.corpus, ["token_count"])


@register("a9_n7_g3_topic_summary", "SELECT * FROM {topic_summary}")
def _(f: Frames) -> DataFrame:
    return f.topic_summary


_RANKED_THEMES = "SELECT * FROM {topic_summary} ORDER BY negative_share DESC, documents DESC, topic_id"


@register("p5_t5_themes_limit_first", f"SELECT * FROM ({_RANKED_THEMES} LIMIT 6) six WHERE negative_share > 0")
def _(f: Frames) -> DataFrame:
    return kpi.plotted_themes(f.topic_summary)


@register("p5_themes_filter_first", f"SELECT * FROM ({_RANKED_THEMES}) ranked WHERE negative_share > 0 LIMIT 6")
def _(f: Frames) -> DataFrame:
    return kpi.plotted_themes(f.topic_summary, limit_first=False)


@register(
    "t4_worst_reviews",
    "SELECT review_id, sentiment_score FROM {sentiment} ORDER BY sentiment_score, review_id LIMIT 300",
)
def _(f: Frames) -> DataFrame:
    return evidence.select_reviews(f.sentiment, 300).select("review_id", "sentiment_score")


@register(
    "w8_worst_verbatims",
    """SELECT review_id, review_text, rating, channel, sentiment_score
       FROM (SELECT *, row_number() OVER (PARTITION BY substring(review_text, 1, 40)
                                          ORDER BY sentiment_score, review_id) AS rn
             FROM (SELECT * FROM {sentiment} ORDER BY sentiment_score, review_id LIMIT 60) pool) numbered
       WHERE rn = 1 ORDER BY sentiment_score, review_id LIMIT 3""",
)
def _(f: Frames) -> DataFrame:
    return kpi.worst_verbatims(f.sentiment)


_TOPIC_STOP = strings(fr.TEXT_STOP_WORDS + lx.DOMAIN_STOPWORDS)
_TOPIC_TERMS = term_rows("{corpus}", "review_id", "clean_text", _TOPIC_STOP)


@register(
    "n3_topic_tfidf",
    f"""WITH counts AS ({_TOPIC_TERMS}), size AS (SELECT count(*) AS n FROM {{corpus}}),
        vocabulary AS (SELECT term, df, ln((1.0 + n) / (1 + df)) + 1.0 AS idf
            FROM (SELECT term, count(*) AS df, sum(tf) AS occurrences FROM counts GROUP BY term) c, size
            WHERE df >= 5 AND df <= 0.85e0 * n ORDER BY occurrences DESC, term LIMIT 8000),
        weighted AS (SELECT review_id, term, tf * idf AS raw FROM counts JOIN vocabulary USING (term)),
        unit AS (SELECT term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY review_id)) AS weight FROM weighted)
        SELECT term, df, {rnd('idf', 8)} AS idf, {rnd(total('weight', 10), 6)} AS weight
        FROM vocabulary JOIN unit USING (term) GROUP BY term, df, idf""",
)
def _(f: Frames) -> DataFrame:
    corpus = keep(f.corpus.select("review_id", "clean_text"), "corpus")  # read twice, cleaned once
    model = tfidf.fit_terms(corpus, "clean_text", topics.topic_rules(fr.TEXT_STOP_WORDS))
    vectors = tfidf.vectorise(corpus, "clean_text", model)
    return _term_weights(model.table(f.spark), tfidf.postings(vectors, "review_id"))


def _term_weights(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """Per term: document frequency, idf and the sum of its weights over all documents."""
    summed = postings.groupBy("term_id").agg(F.sum(F.col("weight").cast("decimal(28,10)")).alias("w"))
    return terms.join(summed, "term_id").select(
        "term", "df", round_half_up("idf", 8).alias("idf"), round_half_up("w", 6).alias("weight")
    )


@register(
    "n6_dominant_topic",
    f"""SELECT review_id, CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS INTEGER) AS topic_id,
               coalesce({rnd('greatest(a, b, c) / nullif(a + b + c, 0)', 4)}, 0.0) AS topic_strength
        FROM (SELECT review_id, CAST(length(review_text) % 7 AS DOUBLE) AS a, CAST(token_count % 5 AS DOUBLE) AS b,
                     CAST(length(clean_text) % 3 AS DOUBLE) AS c FROM {{corpus}}) given""",
)
def _(f: Frames) -> DataFrame:
    weights = F.array(
        *[
            x.cast("double")
            for x in (F.length("review_text") % 7, F.col("token_count") % 5, F.length("clean_text") % 3)
        ]
    )
    given = f.corpus.select("review_id", weights.alias("weights"))
    topic, strength = topics.dominant_topic(F.col("weights"))
    return given.select("review_id", topic.alias("topic_id"), strength.alias("topic_strength"))


@register(
    "t6_top_terms",
    """SELECT lang, term, CAST(rank AS INTEGER) AS rank FROM (
         SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank
         FROM (SELECT lang, term, sum(tf) AS n FROM {review_terms} GROUP BY lang, term) counted) ranked
       WHERE rank <= 10""".replace(
        "{review_terms}",
        "(SELECT lang, t.* FROM (" + term_rows("{feedback}", "review_id", "review_text") + ") t JOIN {feedback} USING (review_id)) terms",
    ),
)
def _(f: Frames) -> DataFrame:
    words = tfidf.with_terms(f.views.feedback, "review_text", fr.TEXT_STOP_WORDS)
    counted = words.select("lang", F.explode("terms").alias("term")).groupBy("lang", "term")
    ranked = top_k(counted.agg(F.count(F.lit(1)).alias("n")), ["lang"], [F.desc("n"), F.asc("term")], 10)
    return ranked.select("lang", "term", "rank")


# ---------------------------------------------------------------- evidence

_COMPANY = f"""SELECT count(*) AS customers, {rnd(mean('Churn') + ' * 100', 2)} AS churn,
    {rnd(total('MonthlyCharges'), 2)} AS mrr, {rnd(total('MonthlyCharges') + ' * 12', 2)} AS year_revenue,
    {rnd(mean('tenure'), 1)} AS months, {rnd(mean('MonthlyCharges'), 2)} AS arpu FROM {{features}}"""
_BY_CONTRACT = f"""SELECT Contract, count(*) AS customers, {rnd(mean('Churn') + ' * 100', 2)} AS churn,
    {rnd(total('annual_margin_at_risk'), 2)} AS margin FROM {{features}} GROUP BY Contract"""
_KPI_TEXT = f"""SELECT 'kpi::overall' AS doc_id, format('Company-wide metrics: {{:,}} active customers; churn rate ', customers)
        || CAST(churn AS VARCHAR) || format('%; monthly recurring revenue ${{:,.0f}}; annualised revenue ${{:,.0f}}; average tenure ',
        mrr, year_revenue) || CAST(months AS VARCHAR) || ' months; ARPU $' || CAST(arpu AS VARCHAR) || '.' AS text,
        'kpi' AS source FROM ({_COMPANY}) company
    UNION ALL
    SELECT 'kpi::contract::' || Contract, format('Contract segment ''{{}}'': {{:,}} customers, churn rate ', Contract, customers)
        || CAST(churn AS VARCHAR) || format('%, ${{:,.0f}} of annual gross margin at risk.', margin), 'kpi'
    FROM ({_BY_CONTRACT}) contracts"""
_TOPIC_TEXT = """SELECT 'topic::' || CAST(topic_id AS VARCHAR) AS doc_id,
        format('Feedback theme ''{}'': {:,} messages from {:,} customers, {:.0f}% negative, average rating {:.2f}/5, average sentiment {:.2f}.',
               topic_label, documents, customers_affected, negative_share * 100, avg_rating, avg_sentiment) AS text,
        'topic_summary' AS source FROM {topic_summary}"""
_REVIEW_TEXT = """SELECT 'review::' || review_id AS doc_id,
        '[' || channel || ', rating ' || CAST(rating AS VARCHAR) || '/5] ' || review_text AS text, 'review' AS source
    FROM {sentiment}"""


def _shown(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", "source")


@register("r1_x6_kpi_evidence", _KPI_TEXT)
def _(f: Frames) -> DataFrame:
    return _shown(evidence.kpi_documents(f.features))


@register("r2_topic_evidence", _TOPIC_TEXT)
def _(f: Frames) -> DataFrame:
    return _shown(evidence.topic_documents(f.topic_summary))


@register("r4_review_evidence", _REVIEW_TEXT)
def _(f: Frames) -> DataFrame:
    return _shown(evidence.review_documents(f.sentiment))


@register("r5_u1_corpus", f"{_KPI_TEXT} UNION ALL {_TOPIC_TEXT} UNION ALL {_REVIEW_TEXT}")
def _(f: Frames) -> DataFrame:
    parts = [
        evidence.kpi_documents(f.features),
        evidence.topic_documents(f.topic_summary),
        None,  # no model, so no driver evidence: a missing part is left out
        evidence.review_documents(f.sentiment),
    ]
    return _shown(evidence.build_corpus(parts))


_DRIVER_TEXT = f"""SELECT 'driver::' || feature AS doc_id,
        format('Churn model driver #{{}}: ''{{}}'' with mean absolute SHAP contribution {{:.4f}}. Model: linear, test ROC-AUC 0.750.',
               rank, feature, importance) AS text, 'model_driver' AS source
    FROM (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rank
          FROM (SELECT feature, {mean('abs(contribution)', 10)} AS importance FROM {{contributions}} GROUP BY feature) i)
    WHERE rank <= 10"""


@register(
    "u1_r3_r5_corpus_with_drivers",
    f"{_KPI_TEXT} UNION ALL {_DRIVER_TEXT} UNION ALL {_TOPIC_TEXT} UNION ALL {_REVIEW_TEXT}",
)
def _(f: Frames) -> DataFrame:
    drivers = evidence.ranked_importance(explain.global_importance(f.explained, 10))
    reviews = keep(f.topics, "topics")  # read for the themes and the reviews, cleaned once
    parts = [
        evidence.kpi_documents(f.features),
        evidence.driver_documents(drivers, "linear", 0.75),
        evidence.topic_documents(kpi.topic_summary(reviews)),
        evidence.review_documents(reviews.drop("topic_id", "topic_label")),
    ]
    return _shown(evidence.build_corpus(parts))


@register(
    "x17_metadata_map",
    """SELECT 'topic::' || CAST(topic_id AS VARCHAR) AS doc_id, CAST(negative_share AS VARCHAR) AS negative_share,
              topic_label, CAST(documents AS VARCHAR) AS documents FROM {topic_summary}""",
)
def _(f: Frames) -> DataFrame:
    fields = [F.col("metadata")[c].alias(c) for c in ("negative_share", "topic_label", "documents")]
    return evidence.topic_documents(f.topic_summary).select("doc_id", *fields)


# ---------------------------------------------------------------- retrieval

_INDEX = f"""SELECT term, df, {rnd('idf', 8)} AS idf, {rnd(total('weight', 10), 6)} AS weight
    FROM {{vocabulary}} JOIN {{postings}} USING (term) GROUP BY term, df, idf"""


@register("r6_lexical_index", _INDEX)
def _(f: Frames) -> DataFrame:
    return _term_weights(f.term_model.table(f.spark), f.postings)


@register("s8_k9_index_saved_and_loaded", _INDEX)
def _(f: Frames) -> DataFrame:
    folder = scratch(f)
    tables.save_index({"postings": f.postings, "terms": f.term_model.table(f.spark)}, folder)
    saved = tables.load_index(f.spark, folder, ("postings", "terms"))
    return _term_weights(saved["terms"], saved["postings"])


@register("j7_lexical_scores", "SELECT question_id, doc_id, lexical FROM {lexical}")
def _(f: Frames) -> DataFrame:
    return f.lexical


@register(
    "r8_dense_top",
    f"""SELECT question_id, doc_id, source, dense FROM (
          SELECT *, row_number() OVER (PARTITION BY question_id, source ORDER BY dense DESC, doc_id) AS rn
          FROM (SELECT a.question_id, b.doc_id, b.source,
                       {rnd('list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))', 8)}
                           AS dense
                FROM {{questions}} a CROSS JOIN {{vectors}} b) pairs) ranked WHERE rn <= 3""",
)
def _(f: Frames) -> DataFrame:
    return retrieval.dense_top(f.views.vectors, f.views.questions, k=3)


_HIT = "question_id, doc_id, source, dense, lexical, score, CAST(rank AS INTEGER) AS rank"


@register("r9_t8_flat_hybrid_search", f"""SELECT {_HIT} FROM (SELECT *, row_number() OVER (PARTITION BY question_id
          ORDER BY score DESC, doc_id) AS rank FROM {{hybrid}}) ranked WHERE rank <= 6""")
def _(f: Frames) -> DataFrame:
    return retrieval.search(f.indexed_evidence, f.encoded_questions, f.overlap, k=6)


@register(
    "r12_p4_source_restricted_search",
    f"""SELECT {_HIT} FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank
        FROM {{hybrid}} WHERE source IN ('review', 'topic_summary')) ranked WHERE rank <= 6""",
)
def _(f: Frames) -> DataFrame:
    return retrieval.search(
        f.indexed_evidence, f.encoded_questions, f.overlap, k=6, sources=["review", "topic_summary"]
    )


@register("r10_w4_u2_t9_stratified_search", f"SELECT {_HIT} FROM {{hits}}")
def _(f: Frames) -> DataFrame:
    return retrieval.search_stratified(
        f.indexed_evidence, f.encoded_questions, f.overlap, retrieval.DEFAULT_QUOTAS
    )


@register(
    "r11_quota_scaling",
    """SELECT question_id, source, CAST(CASE WHEN coalesce(k, 0) = 0 THEN quota
              ELSE greatest(1, round_even(quota * (k / 16e0), 0)) END AS INTEGER) AS quota
       FROM (SELECT question_id, nullif(question_id % 27, 26) AS k FROM {questions}) asked CROSS JOIN {quotas}""",
)
def _(f: Frames) -> DataFrame:
    top = F.nullif(F.col("question_id") % 27, F.lit(26))
    return retrieval.quota_table(f.views.questions.select("question_id", top.alias("top_k"))).select(
        "question_id", "source", "quota"
    )


@register(
    "r11_r12_own_budget_and_sources",
    f"""WITH asked AS (SELECT question_id, nullif(question_id % 27, 26) AS k, question_id % 3 = 0 AS named FROM {{questions}}),
    budget AS (SELECT question_id, source, CASE WHEN coalesce(k, 0) = 0 THEN quota
                      ELSE greatest(1, round_even(quota * (k / 16e0), 0)) END AS quota, NULL AS total
               FROM asked CROSS JOIN {{quotas}} WHERE NOT named
               UNION ALL
               SELECT question_id, source, NULL, CASE WHEN coalesce(k, 0) = 0 THEN 6 ELSE k END
               FROM asked CROSS JOIN (VALUES ('review'), ('topic_summary')) given(source) WHERE named),
    placed AS (SELECT *, row_number() OVER (PARTITION BY question_id, source ORDER BY score DESC, doc_id) AS place
               FROM {{hybrid}}),
    taken AS (SELECT question_id, doc_id, source, dense, lexical, score, total,
                     row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank
              FROM placed JOIN budget USING (question_id, source) WHERE quota IS NULL OR place <= quota)
    SELECT {_HIT} FROM taken WHERE total IS NULL OR rank <= total""",
)
def _(f: Frames) -> DataFrame:
    asked = f.encoded_questions.select(
        "*",
        F.nullif(F.col("question_id") % 27, F.lit(26)).cast("int").alias("top_k"),
        F.when(F.col("question_id") % 3 == 0, F.array(F.lit("review"), F.lit("topic_summary"))).alias("sources"),
    )
    return retrieval.search_requested(f.indexed_evidence, asked, f.overlap)


_EXPANSIONS = "".join(
    f" || CASE WHEN contains(lower(question), '{key}') THEN ' {extra}' ELSE '' END"
    for key, extra in lx.QUERY_EXPANSIONS.items()
)


@register(
    "x5_expanded_questions",
    f"""SELECT question_id, CASE WHEN added = '' THEN question ELSE trim(question || added) END AS expanded
        FROM (SELECT question_id, question, ''{_EXPANSIONS} AS added FROM {{questions}}) extras""",
)
def _(f: Frames) -> DataFrame:
    return f.views.questions.select("question_id", tx.expand_query(F.col("question")).alias("expanded"))


@register(
    "r13_w5_citations",
    f"""SELECT question_id, 'E' || CAST(rank AS VARCHAR) AS id, doc_id, source, {rnd('score', 4)} AS score,
               substring(text, 1, 400) AS text FROM {{hits}}""",
)
def _(f: Frames) -> DataFrame:
    return answers.citations(f.hits)


_SECTION_ROWS = ", ".join(
    f"('{source}', {i}, {items}, '{heading}')" for i, (source, items, heading) in enumerate(answers.SECTIONS)
)
_ANSWERS = f"""WITH sections(source, section, items, heading) AS (VALUES {_SECTION_ROWS}),
    placed AS (SELECT h.question_id, section, items, heading, source, text, rank,
                      row_number() OVER (PARTITION BY question_id, source ORDER BY
                          CASE WHEN source = 'topic_summary' THEN -negative_share ELSE 0 END, rank) AS place
               FROM {{hits}} h JOIN sections USING (source)),
    lines AS (SELECT question_id, section, heading, place, '- ' || CASE WHEN source = 'review'
                     THEN '“' || substring(text, 1, 220) || '”' ELSE text END
                     || ' [E' || CAST(rank AS VARCHAR) || ']' AS line
              FROM placed WHERE place <= items),
    blocks AS (SELECT question_id, section, chr(10) || any_value(heading) || chr(10)
                      || string_agg(line, chr(10) ORDER BY place) AS block
               FROM lines GROUP BY question_id, section),
    bodies AS (SELECT question_id, string_agg(block, chr(10) ORDER BY section) AS body FROM blocks GROUP BY question_id),
    counts AS (SELECT question_id, count(*) AS n FROM {{hits}} GROUP BY question_id)
    SELECT q.question_id, question,
           CASE WHEN n IS NULL THEN '{answers.NO_EVIDENCE}' ELSE
             '**Answer** — Based on ' || CAST(n AS VARCHAR) || ' retrieved evidence items for: “' || question || '”.'
             || chr(10) || body || chr(10) || chr(10) || '{answers.CAVEAT}' END AS answer,
           coalesce(n, 0) AS evidence_items, 'deterministic' AS generated_by
    FROM {{questions}} q LEFT JOIN bodies USING (question_id) LEFT JOIN counts USING (question_id)"""


@register("r14_j10_p7_cited_answers", _ANSWERS)
def _(f: Frames) -> DataFrame:
    return answers.answers(f.views.questions.select("question_id", "question"), f.hits)
