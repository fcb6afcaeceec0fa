"""Text normalisation, sentiment, TF-IDF, topics, retrieval and answers."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.functions import lexicons as lx
from tidemark.functions import text as tx
from tidemark.operators import answers, embedding, evidence, feedback, retrieval, tfidf, topics
from tidemark.plans import answering_run, feedback_run
from tidemark.sources import tables


def column(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    return [r[1] for r in sorted(df.select("i", build(F.col("t"))).collect())]


def test_normalise(spark):
    texts = [
        "Email me at jane.doe@example.com about order #AB12345 — see https://x.co/abc",
        "Price went up 24% last month",
        "My refunded ORDER number is 1,234.50!",
        "don't  STOP\n\tnow",
        "ﬁbre ① www.site.org café",
        "",
        None,
    ]
    assert column(spark, texts, tx.normalise) == [
        "email me at <email> about <ref> see <url>",
        "price went up <num> last month",
        "my <ref> <ref> is <num>",
        "don't stop now",
        "fibre <num> <url> caf",
        "",
        "",
    ]


def test_token_count_and_filter(spark):
    df = spark.createDataFrame([("ok",), ("this is fine",), ("",), (None,)], "review_text string")
    assert [r["token_count"] for r in feedback.clean_corpus(df).collect()] == [3]
    assert column(spark, ["", "a b"], tx.token_count) == [0, 2]


def reference_sentiment(text):
    """The rule, spelled out on one text."""
    tokens, total, weight = text.split(" "), 0.0, 0.0
    for i, token in enumerate(tokens):
        value = lx.POSITIVE_WORDS.get(token, 0.0) - lx.NEGATIVE_WORDS.get(token, 0.0)
        if set(tokens[max(0, i - 2) : i]) & set(lx.NEGATORS):
            value *= -0.8
        total, weight = total + value, weight + abs(value)
    return total / weight if weight else 0.0


def test_sentiment(spark):
    assert column(spark, ["this is great", "this is not great", "plain words", ""], tx.lexicon_sentiment) == [1.0, -1.0, 0.0, 0.0]
    rng = random.Random(1)
    words = [*lx.POSITIVE_WORDS, *lx.NEGATIVE_WORDS, *lx.NEGATORS, "the", "agent", "was"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(60)]
    for text, got in zip(texts, column(spark, texts, tx.lexicon_sentiment), strict=True):
        assert got == pytest.approx(reference_sentiment(text), abs=1e-9) and -1 <= got <= 1


def test_sentiment_takes_no_lambda_per_word(spark):
    texts = ["not  great", "great not", " not a great", None, "never ever awful awful", "great\tgreat"]
    want = [0.0 if t is None else reference_sentiment(t) for t in texts]
    assert column(spark, texts, tx.lexicon_sentiment) == pytest.approx(want, abs=1e-9)
    scored = spark.createDataFrame([("a",)], "t string").select(tx.lexicon_sentiment(F.col("t")).alias("s"))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_addresses_and_blanks_are_replaced_as_by_one_pattern_each(spark):
    texts = ["a@b.c", "x @ y.z", "@a.b", "@@a.b c", "a@b", "k\u00a0\u2003j@\u00fc.de\u3000m", "1\u00e4\u2028\t'q'", "\U0001f600 a\U0001f600b"]

    def spelled_out(text):
        text = re.sub(r"(?<!\S)\S+@\S+\.\S+", " <email> ", text).lower()
        text = re.sub(r"\b\d[\d,]*(?:\.\d+)?\b", " <num> ", text)
        return re.sub(r"\s+", " ", re.sub(r"[^a-z<>\s']", " ", text)).strip(" ")

    got = column(spark, texts, lambda c: tx.normalise(c, nfkc=False))
    assert got == [spelled_out(t) for t in texts]
    plan = spark.createDataFrame([("a",)], "t string").select(tx.normalise(F.col("t"), nfkc=False).alias("clean"))
    optimised = plan._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("regexp_replace(") == 5 and "Contains(" in optimised


def test_sentiment_labels_and_backend(spark):
    df = spark.createDataFrame([("a", 0.15), ("b", 0.16), ("c", -0.16)], "clean_text string, s double")
    out = feedback.score_sentiment(df, backend=lambda text: F.col("s"), backend_name="given").collect()
    assert [(r["sentiment_label"], r["sentiment_backend"]) for r in out] == [
        ("neutral", "given"), ("positive", "given"), ("negative", "given")
    ]


def test_query_expansion(spark):
    texts = ["why are customers leaving?", "what is the tenure distribution", "Is it RISKY?"]
    out = column(spark, texts, tx.expand_query)
    assert out[0] == "why are customers leaving? churn cancel cancelled attrition switch left"
    assert out[1] == texts[1]
    assert out[2].endswith("churn probability high-risk retention")


def test_topic_names(spark):
    df = spark.createDataFrame(
        [(["support fixed", "fixed issue", "fixed", "billing", "is", "late delivery"],), (["is", "a b"],)], "terms array<string>"
    )
    assert [r[0] for r in df.select(tx.topic_name(F.col("terms"))).collect()] == ["support · fixed · billing", "misc"]


def test_driver_narratives(spark):
    rows = [("tenure", 1.0), ("Contract_Two year", -1.0), ("Contract_One year", 1.0), ("charge_drift", 0.0), ("tenure_bucket", 2.0), ("odd", -1.0)]
    df = spark.createDataFrame(rows, "f string, c double")
    f, c = F.col("f"), F.col("c")
    got = df.select(tx.driver_reason(f, c), tx.driver_direction(c), tx.driver_action(f, c)).collect()
    assert got[0][0] == "short tenure with the company" and got[0][1] == "increases risk"
    assert got[1][0] == "two-year contract" and got[1][2] == "—"
    assert got[2][0] == "Contract = One year" and got[2][2] == "Review with the segment owner"
    assert got[3][1] == "reduces risk" and got[3][2] == "—"
    assert got[4][0] == "short tenure with the company (bucket)"
    assert got[5][0] == "low odd"


TEXTS = [
    "the router stopped working and the agent was late",
    "late delivery of the router, late again",
    "billing was wrong and billing support was slow",
    "Über-fast fibre, great fibre",
    "billing error on my bill",
    "",
]


def brute_terms(text, stop):
    words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def test_tfidf_matches_brute_force(spark):
    stop = ("the", "and", "was")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string").repartition(3)
    model = tfidf.fit_terms(docs, "text", tfidf.TermRules(stop_words=stop))
    counted = [Counter(brute_terms(t, stop)) for t in TEXTS]
    df = Counter(term for c in counted for term in c)
    assert model.n_docs == 6 and dict(zip(model.terms, model.document_frequency, strict=True)) == dict(df)
    got = {(r["doc_id"], model.terms[r["term_id"]]): r["weight"]
           for r in tfidf.postings(tfidf.vectorise(docs, "text", model), "doc_id").collect()}
    want = {}
    for i, c in enumerate(counted):
        raw = {t: n * (math.log(7 / (1 + df[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want |= {(i, t): v / norm for t, v in raw.items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_vocabulary_limits(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    few = tfidf.fit_terms(docs, "text", tfidf.TermRules(max_features=2))
    assert set(few.terms) == {"billing", "late"} or set(few.terms) == {"the", "was"}
    common = tfidf.fit_terms(docs, "text", tfidf.TermRules(min_df=2))
    assert min(common.document_frequency) >= 2
    rare = tfidf.fit_terms(docs, "text", tfidf.TermRules(max_df=0.2))
    assert max(rare.document_frequency) == 1
    with pytest.raises(ValueError):
        tfidf.fit_terms(docs, "text", tfidf.TermRules(min_df=100))


THEMES = {
    "billing": "billing invoice charged refund statement payment".split(),
    "network": "router outage signal speed connection fibre".split(),
    "agents": "agent support helpful call answered friendly".split(),
}


@pytest.fixture(scope="module")
def themed(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        theme = list(THEMES)[i % 3]
        rows.append((f"r{i:03d}", theme, " ".join(rng.choices(THEMES[theme], k=12)), f"c{i % 40}", 1 + i % 5, "email"))
    rows.append(("r999", "none", "zzz qqq", "c1", 3, "email"))
    schema = "review_id string, theme string, review_text string, customerID string, rating int, channel string"
    return spark.createDataFrame(rows, schema).repartition(4)


def test_topics_separate_themes(spark, themed):
    corpus = themed.withColumnRenamed("review_text", "clean_text")
    model = topics.fit_topics(corpus, topics=3, max_passes=25)
    assert (model.components >= 0).all()
    assigned = topics.assign_topics(corpus, model)
    assert assigned.count() == 121
    rows = {r["review_id"]: r for r in assigned.collect()}
    by_theme = {}
    for r in themed.collect():
        by_theme.setdefault(r["theme"], Counter())[rows[r["review_id"]]["topic_id"]] += 1
    leading = [by_theme[t].most_common(1)[0] for t in THEMES]
    assert len({topic for topic, _ in leading}) == 3 and all(n >= 36 for _, n in leading)
    assert (rows["r999"]["topic_id"], rows["r999"]["topic_strength"]) == (0, 0.0)
    terms = {r["topic_id"]: r["terms"] for r in topics.top_terms(model.term_table(spark)).collect()}
    assert all(len(t) == 10 for t in terms.values())


def test_topic_fit_does_not_depend_on_partitions(spark, themed):
    corpus = themed.withColumnRenamed("review_text", "clean_text")
    one = topics.fit_topics(corpus.repartition(1), topics=3, max_passes=4)
    many = topics.fit_topics(corpus.repartition(7), topics=3, max_passes=4)
    order_one, order_many = np.argsort(one.term_model.terms), np.argsort(many.term_model.terms)
    assert np.allclose(one.components[:, order_one], many.components[:, order_many], atol=1e-6)


def test_feedback_run(spark, themed, tmp_path):
    run = feedback_run.run_feedback(themed, n_topics=3, max_passes=10)
    summary = run.summary.collect()
    assert sum(r["documents"] for r in summary) == run.reviews.count() == 120  # two tokens are too few
    shares = [r["negative_share"] for r in summary]
    assert shares == sorted(shares, reverse=True)
    feedback_run.write_feedback(run, folder=str(tmp_path), json_path=str(tmp_path / "topics"))
    assert spark.table("fct_review_nlp").count() == 120
    assert "terms" in spark.read.json(str(tmp_path / "topics")).columns


def test_dominant_topic_ties_and_zero(spark):
    df = spark.createDataFrame([([0.2, 0.2, 0.1],), ([0.0, 0.0, 0.0],), ([0.0, 0.0, 3.0],)], "w array<double>")
    got = df.select(*topics.dominant_topic(F.col("w"))).collect()
    assert [tuple(r) for r in got] == [(0, 0.4), (0, 0.0), (2, 1.0)]


# ---------------------------------------------------------------- retrieval


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    docs = [(f"d{i:03d}", "abc"[i % 3] if i % 9 else "hot", rng.normal(size=6).round(1).tolist()) for i in range(150)]
    docs += [(f"e{i:03d}", "hot", docs[0][2]) for i in range(60)]  # many equal documents in one source
    asked = [(i, rng.normal(size=6).round(1).tolist()) for i in range(7)]
    overlaps = [(q, d[0], round(float(rng.random()), 3)) for q in range(7) for d in docs if rng.random() < 0.2]
    return (
        spark.createDataFrame(docs, "doc_id string, source string, embedding array<float>").repartition(6),
        spark.createDataFrame(asked, "question_id int, embedding array<float>"),
        spark.createDataFrame(overlaps, "question_id int, doc_id string, lexical double").repartition(3),
    )


def brute_hybrid(vectors, alpha=0.65):
    docs, asked, lexical = (df.collect() for df in vectors)
    overlap = {(r["question_id"], r["doc_id"]): r["lexical"] for r in lexical}
    rows = []
    for q in asked:
        for d in docs:
            a, b = np.array(q["embedding"]), np.array(d["embedding"])
            dense = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            score = alpha * dense + (1 - alpha) * overlap.get((q["question_id"], d["doc_id"]), 0.0)
            rows.append((q["question_id"], d["source"], d["doc_id"], score))
    return rows


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_search_matches_brute_force(vectors, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(retrieval, "QUESTIONS_PER_BLOCK", 3)
    monkeypatch.setattr(retrieval, "DOCUMENTS_PER_CELL", 40)
    monkeypatch.setattr(retrieval, "TILE_DOCUMENTS", 16)
    monkeypatch.setattr(retrieval, "TILE_QUESTIONS", 2)
    rows = brute_hybrid(vectors)
    docs, asked, lexical = vectors
    flat = retrieval.search(docs, asked, lexical, k=5, broadcast_bytes=broadcast_bytes).collect()
    for q in range(7):
        want = sorted((r for r in rows if r[0] == q), key=lambda r: (-round(r[3], 8), r[2]))[:5]
        got = sorted((r for r in flat if r["question_id"] == q), key=lambda r: r["rank"])
        assert [r["doc_id"] for r in got] == [r[2] for r in want]
        assert [r["score"] for r in got] == pytest.approx([r[3] for r in want], abs=1e-7)
    quotas = {"a": 2, "hot": 4, "b": 0, "absent": 3}
    hits = retrieval.search_stratified(docs, asked, lexical, quotas, broadcast_bytes=broadcast_bytes).collect()
    for q in range(7):
        want = []
        for source, k in quotas.items():
            pool = sorted((r for r in rows if r[0] == q and r[1] == source), key=lambda r: (-round(r[3], 8), r[2]))
            want += pool[:k]
        want.sort(key=lambda r: (-round(r[3], 8), r[2]))
        got = sorted((r for r in hits if r["question_id"] == q), key=lambda r: r["rank"])
        assert [r["doc_id"] for r in got] == [r[2] for r in want]


def test_every_question_has_its_own_budget_and_sources(vectors):
    rows = brute_hybrid(vectors)
    docs, asked, lexical = vectors
    spark = docs.sparkSession
    own = {0: (None, None), 1: (2, ["a"]), 2: (0, ["a", "hot", "hot"]), 3: (12, None), 4: (3, []), 5: (1, ["absent"]), 6: (9, ["b", "hot"])}
    requests = spark.createDataFrame([(q, *v) for q, v in own.items()], "question_id int, top_k int, sources array<string>")
    quotas = {"a": 2, "hot": 4, "b": 1}
    hits = retrieval.search_requested(docs, asked.join(requests, "question_id"), lexical, quotas).collect()
    for q, (k, sources) in own.items():
        pool = sorted((r for r in rows if r[0] == q), key=lambda r: (-round(r[3], 8), r[2]))
        if sources:
            want = [r for r in pool if r[1] in sources][: k or 6]
        else:
            budget = retrieval.scale_quotas(quotas, k)
            want = [r for s in quotas for r in [p for p in pool if p[1] == s][: budget[s]]]
            want.sort(key=lambda r: (-round(r[3], 8), r[2]))
        got = sorted((r for r in hits if r["question_id"] == q), key=lambda r: r["rank"])
        assert [r["doc_id"] for r in got] == [r[2] for r in want]
        assert [r["rank"] for r in got] == list(range(1, len(want) + 1))


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_overlap_in_the_tile_equals_the_table_of_pairs(spark, vectors, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(retrieval, "QUESTIONS_PER_BLOCK", 3)
    monkeypatch.setattr(retrieval, "DOCUMENTS_PER_CELL", 40)
    rng = random.Random(6)

    def entries(i):
        if i % 11 == 3:
            return (None, None) if i % 2 else ([], [])
        terms = sorted(rng.sample(range(1, 12), rng.randint(1, 6)) + [0])  # a term that all share
        return terms, [rng.random() for _ in terms]

    docs, asked, _ = vectors
    schema = "indices array<int>, values array<double>"
    ids = sorted(r["doc_id"] for r in docs.collect())
    sides = [
        spark.createDataFrame([(d, *entries(i)) for i, d in enumerate(ids)], f"doc_id string, {schema}"),
        spark.createDataFrame([(q, *entries(q + 5)) for q in range(7)], f"question_id int, {schema}"),
    ]
    listed = [
        side.select(side.columns[0], F.inline(F.arrays_zip("indices", "values")))
        .withColumnsRenamed({"indices": "term_id", "values": "weight"}) for side in sides
    ]
    pairs = retrieval.lexical_scores(*listed)
    rich, questions = docs.join(sides[0], "doc_id").repartition(5), asked.join(sides[1], "question_id")
    rich = spark.createDataFrame(rich.collect(), rich.schema).repartition(5)  # without the join of this test
    overlap = retrieval.TermOverlap(rich)
    for own in ({"sources": ["a", "hot"]}, {}):
        want = retrieval.search(docs, asked, pairs, 9, broadcast_bytes=broadcast_bytes, **own).collect()
        hits = retrieval.search(rich, questions, overlap, 9, broadcast_bytes=broadcast_bytes, **own)
        assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, want))
        assert any(r["lexical"] > 0 for r in want)
        if broadcast_bytes:
            assert "Join" not in hits._jdf.queryExecution().executedPlan().toString()
    nothing = rich.where("false")
    assert retrieval.search(nothing, questions, retrieval.TermOverlap(nothing), broadcast_bytes=broadcast_bytes).count() == 0


def test_term_products_do_not_depend_on_tiles_and_slices(monkeypatch):
    rng = np.random.default_rng(2)
    weights = [np.where(rng.random((n, 9)) < 0.5, rng.random((n, 9)), 0.0) for n in (13, 7)]
    sides = []
    for w in weights:
        lists = [np.flatnonzero(row).tolist() for row in w], [row[row > 0].tolist() for row in w]
        sides.append((pa.array(lists[0], pa.list_(pa.int32())), pa.array(lists[1], pa.list_(pa.float64()))))
    part = pa.RecordBatch.from_arrays(list(sides[0]), names=["indices", "values"])
    want = weights[0] @ weights[1].T
    for tile, slice_size in ((1024, 1 << 20), (3, 1), (2, 10)):
        monkeypatch.setattr(retrieval, "TILE_QUESTIONS", tile)
        monkeypatch.setattr(retrieval, "TILE_DOCUMENTS", tile)
        monkeypatch.setattr(retrieval, "PRODUCTS_PER_SLICE", slice_size)
        terms = retrieval._AskedTerms(*sides[1])
        got = np.hstack([terms.raw(part, first) for first in range(0, 7, tile)])
        assert got == pytest.approx(want)
        assert terms.raw(part.slice(4, 5), 0) == pytest.approx(want[4:9, :tile])
        assert terms.largest(part) == pytest.approx(want.max(axis=0))


def test_products_of_a_batch_do_not_depend_on_its_slices(monkeypatch):
    rng = np.random.default_rng(3)
    rows = [rng.choice(50, size=n, replace=False) for n in (0, 7, 0, 50, 1, 12, 0)]
    batch = pd.DataFrame({"indices": rows, "values": [rng.random(len(r)) for r in rows]})
    matrix = rng.normal(size=(50, 4))
    want = np.array([(v[:, None] * matrix[i]).sum(axis=0) for i, v in zip(rows, batch["values"], strict=True)])
    for size in (1, 10, 1_000):
        monkeypatch.setattr(embedding, "ENTRIES_PER_SLICE", size)
        np.testing.assert_allclose(embedding.batch_products(batch, matrix)[0], want, atol=1e-12)


def test_source_filter_comes_after_scaling(spark):
    postings = spark.createDataFrame([("a", 0, 0.9), ("b", 0, 0.3)], "doc_id string, term_id int, weight double")
    terms = spark.createDataFrame([(1, 0, 1.0), (2, 5, 1.0)], "question_id int, term_id int, weight double")
    got = {r["doc_id"]: r["lexical"] for r in retrieval.lexical_scores(postings, terms).collect()}
    assert got == {"a": 1.0, "b": pytest.approx(1 / 3, abs=1e-8)}


def test_quota_scaling(spark):
    quotas = retrieval.DEFAULT_QUOTAS
    assert retrieval.scale_quotas(quotas, None) == quotas
    assert retrieval.scale_quotas(quotas, 1) == {k: 1 for k in quotas}
    df = spark.createDataFrame([(k,) for k in [None, 0, 1, 3, 4, 8, 20, 25]], "top_k int")
    for r in retrieval.quota_table(df).collect():
        assert r["quota"] == retrieval.scale_quotas(quotas, r["top_k"])[r["source"]]


DOCS = [
    ("d1", "kpi", "Company-wide metrics: churn rate 26%", {}),
    ("d2", "topic_summary", "Feedback theme 'praise': fast and helpful", {"negative_share": "0.1"}),
    ("d3", "review", "late delivery of my router again", {}),
    ("d4", "topic_summary", "Feedback theme 'billing errors': 80% negative", {"negative_share": "0.8"}),
    ("d5", "model_driver", "Churn model driver #1: 'tenure'", {}),
]


def test_answers_over_a_small_corpus(spark, tmp_path):
    corpus = spark.createDataFrame(DOCS, "doc_id string, source string, text string, metadata map<string,string>")
    index = answering_run.build_index(corpus)
    questions = spark.createDataFrame([(1, "late delivery of my router"), (2, "why are customers leaving?")], "question_id int, question string")
    hits = answering_run.retrieve(index, questions)
    rows = [r for r in hits.orderBy("question_id", "rank").collect() if r["question_id"] == 1]
    assert rows[0]["doc_id"] == "d3"
    assert {r["source"] for r in rows} == {"kpi", "topic_summary", "review", "model_driver"}
    only = answering_run.retrieve(index, questions, sources=["review"]).collect()
    assert {r["source"] for r in only} == {"review"}
    own = questions.selectExpr("*", "1 AS top_k", "if(question_id = 1, array('review', 'kpi'), null) AS sources")
    asked = answering_run.retrieve(index, own).collect()
    assert [r["doc_id"] for r in asked if r["question_id"] == 1] == ["d3"]
    assert sorted(r["source"] for r in asked if r["question_id"] == 2) == ["kpi", "model_driver", "review", "topic_summary"]
    out = {r["question_id"]: r for r in answering_run.answer_questions(index, questions).collect()}
    text = out[2]["answer"]
    assert text.startswith("**Answer** — Based on 5 retrieved evidence items for: “why are customers leaving?”.")
    assert text.index("billing errors") < text.index("praise") and "**Confidence & caveats**" in text
    assert len(re.findall(r"\[E\d\]", text)) == 5
    none = answering_run.answer_questions(index, questions, sources=["absent"]).collect()
    assert {r["answer"] for r in none} == {answers.NO_EVIDENCE}
    tables.save_index({"documents": index.documents, "postings": index.postings}, str(tmp_path))
    saved = tables.load_index(spark, str(tmp_path), ("documents", "postings"))
    assert saved["documents"].count() == 5 and tables.load_index(spark, str(tmp_path / "no"), ("documents",)) is None


def test_evidence_lines_and_citations(spark):
    hits = spark.createDataFrame(
        [(1, "d1", "kpi", 0.98765, 1, "x" * 500), (1, "d2", "review", 0.5, 2, "short")],
        "question_id int, doc_id string, source string, score double, rank int, text string",
    )
    cited = answers.citations(hits).collect()
    assert [r["id"] for r in cited] == ["E1", "E2"] and len(cited[0]["text"]) == 400 and cited[0]["score"] == 0.9877
    assert answers.evidence_lines(hits).first()["evidence"].endswith("[E2] (review) short")


def test_empty_corpus_is_an_error():
    with pytest.raises(ValueError):
        evidence.build_corpus([None])


def test_unscored_reviews_are_sampled_repeatably(spark):
    reviews = spark.createDataFrame([(f"r{i}", "t", 3, "email") for i in range(50)], "review_id string, review_text string, rating int, channel string")
    a = {r["review_id"] for r in evidence.select_reviews(reviews, 10).collect()}
    assert a == {r["review_id"] for r in evidence.select_reviews(reviews.repartition(5), 10).collect()} and len(a) == 10
    doc = evidence.review_documents(reviews, 1).first()
    assert doc["text"] == "[email, rating 3/5] t" and doc["metadata"]["channel"] == "email"


def test_projection_keeps_neighbours(spark, themed):
    docs = themed.where("theme <> 'none'").withColumnRenamed("review_id", "doc_id")
    model = tfidf.fit_terms(docs, "review_text", tfidf.TermRules())
    projection = embedding.fit_projection(docs, "review_text", model, dimensions=6)
    rows = embedding.embed(docs, "review_text", "doc_id", projection).join(docs, "doc_id").collect()
    matrix = np.array([r["embedding"] for r in rows])
    assert np.allclose(np.linalg.norm(matrix, axis=1), 1.0, atol=1e-5)
    same = np.array([[a["theme"] == b["theme"] for b in rows] for a in rows])
    product = matrix @ matrix.T
    assert product[same].mean() > product[~same].mean() + 0.3


def test_singular_vectors_equal_a_dense_solver_in_few_scans(spark, monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.random((300, 180)) * (rng.random((300, 180)) < 0.1)
    dense[:40] = dense[0]  # equal rows
    dense[40:44] = 0.0  # rows without terms
    cells = [(Vectors.sparse(180, {int(j): float(row[j]) for j in np.flatnonzero(row)}),) for row in dense]
    vectors = spark.createDataFrame(cells, ["tfidf"]).repartition(5)
    scans, product = [], embedding._gram_product
    monkeypatch.setattr(embedding, "_gram_product", lambda *a: scans.append(a) or product(*a))
    _, strength, right = np.linalg.svd(dense)
    for k, per_slice, per_sort in ((1, 1, 1), (8, 7, 100), (60, 1 << 13, 1 << 20)):
        monkeypatch.setattr(embedding, "ENTRIES_PER_SLICE", per_slice)
        monkeypatch.setattr(embedding, "ENTRIES_PER_SORT", per_sort)
        scans.clear()
        found, values = embedding.singular_vectors(vectors, k)
        assert np.allclose(values, strength[:k], rtol=1e-9) and len(scans) <= 6
        assert np.allclose(np.abs((found * right[:k].T).sum(axis=0)), 1.0, atol=1e-7)


def test_singular_vectors_of_a_low_rank_and_of_a_repeated_value():
    rng = np.random.default_rng(6)
    low = rng.random((500, 3))
    values, vectors = embedding._leading_pairs(lambda block: low @ (low.T @ block), 500, 10)
    assert np.allclose(values[:3], np.linalg.eigvalsh(low.T @ low)[::-1]) and np.allclose(values[3:], 0.0, atol=1e-9)
    weight = np.concatenate([np.full(100, 2.0), np.full(900, 1.0)])[:, None]  # more often than a block is wide
    values, vectors = embedding._leading_pairs(lambda block: weight * block, 1000, 90)
    assert np.allclose(values, 2.0) and np.allclose(vectors.T @ vectors, np.eye(90), atol=1e-9)
    falling = np.sort(rng.random(2000))[::-1][:, None]  # dense at the cut: the basis is filled and restarted
    values, _ = embedding._leading_pairs(lambda block: falling * block, 2000, 20)
    assert np.allclose(values, falling[:20, 0], rtol=1e-9)


def test_rows_keep_their_columns_and_number_through_topics_and_vectors(spark, themed):
    corpus = themed.withColumnRenamed("review_text", "clean_text")
    model = topics.fit_topics(corpus, topics=3, max_passes=5)
    twice = corpus.unionByName(corpus.where("review_id = 'r000'")).withColumn("topic_label", F.lit("old"))
    placed = topics.with_topics(twice, model)
    assert placed.columns == [c for c in twice.columns if c != "topic_label"] + list(topics.TOPIC_COLUMNS)
    rows = placed.collect()
    assert len(rows) == 122 and sum(r["review_id"] == "r000" for r in rows) == 2
    single = {r["review_id"]: r for r in topics.assign_topics(corpus, model).collect()}
    assert all(r["topic_id"] == single[r["review_id"]]["topic_id"] for r in rows)
    assert topics.with_topics(twice.where("false"), model).count() == 0
    projection = embedding.fit_projection(corpus, "clean_text", model.term_model, 4)
    vectors = embedding.with_embedding(twice, "clean_text", projection)
    assert vectors.columns == [*twice.columns, "embedding"] and vectors.count() == 122
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_a_model_is_loaded_once_in_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        sizes = []

        def predict(texts):
            sizes.append(len(texts))
            assert max(sizes) <= 8
            return np.array([len(t) / 100 for t in texts])

        return predict

    df = spark.range(200).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("clean_text"))
    scored = feedback.score_sentiment(
        df.repartition(4), backend=feedback.model_backend(load, batch_size=8), backend_name="length"
    )
    rows = {r["id"]: r for r in scored.collect()}
    assert len(rows) == 200 and rows[150]["sentiment_score"] == 1.5 and rows[7]["sentiment_score"] == 0
    assert rows[0]["sentiment_backend"] == "length"
    loaded = [name.split("-")[0] for name in os.listdir(folder)]
    assert 0 < len(loaded) == len(set(loaded))


def test_word_scores(spark):
    rows = [("good good fast", 5), ("good", 4), ("bad slow", 1), ("bad bad good", 2), ("unseen", 3), ("", 5)]
    df = spark.createDataFrame(rows, "clean_text string, rating int")
    rating = F.col("rating")
    model = feedback.fit_word_scores(df, F.when(rating != 3, rating >= 4))
    assert set(model.words) == {"good", "bad", "fast", "slow"} and model.prior == pytest.approx(np.log(4 / 3))
    assert model.words["good"] == pytest.approx(np.log(4 / 8) - np.log(2 / 9))
    scores = model.load()(np.array(["good", "bad", "", "unseen"]))
    assert scores[0] > 0 > scores[1] and scores[2] == scores[3] == pytest.approx(1 / 7)
    assert set(feedback.fit_word_scores(df, F.when(rating != 3, rating >= 4), max_words=2).words) == {"good", "bad"}


def test_terms_are_exact_where_pairs_are_ruled_out(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randint(0, 80))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id int, text string").repartition(3)
    total, df = Counter(), Counter()
    for text in texts:
        kept = [w for w in text.split() if w != "w3"]
        terms = kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]
        total.update(terms)
        df.update(set(terms))
    for most in (20, 70, 5_000):
        model = tfidf.fit_terms(docs, "text", tfidf.TermRules(stop_words=("w3",), max_features=most))
        best = sorted(total, key=lambda t: (-total[t], t))[:most]
        assert sorted(model.terms) == sorted(best) and model.n_docs == 120
        assert list(model.document_frequency) == [df[t] for t in model.terms]
    weights = {r["doc_id"]: r["tfidf"] for r in tfidf.vectorise(docs, "text", model).collect()}
    assert weights[120].numNonzeros() == 0  # a null text has no terms
    for i, text in enumerate(texts):
        kept = [w for w in text.split() if w != "w3"]
        times = Counter(kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])])
        raw = {t: n * (math.log(121 / (1 + df[t])) + 1) for t, n in times.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        found = {model.terms[j]: v for j, v in zip(weights[i].indices, weights[i].values)}
        assert found == pytest.approx({t: v / norm for t, v in raw.items()})


def test_only_pairs_in_full_counters_are_counted(spark):
    docs = spark.createDataFrame([("aa bb cc aa bb",), ("aa bb dd",)], "text string")
    counted = tfidf._word_counts(docs, ())
    for least, pairs in ((1, {"aa bb": 3, "bb cc": 1, "cc aa": 1, "bb dd": 1}), (2, {"aa bb": 3}), (4, {})):
        rows = tfidf._pair_counts(docs, (), tfidf._full_counters(counted, least)).groupBy("term").sum("total").collect()
        assert {r[0]: r[1] for r in rows} == pairs


def test_hits_are_written_before_they_meet_the_texts(spark):
    docs = spark.createDataFrame([("d1", "one"), ("d2", "two")], "doc_id string, text string")
    hits = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rank"))
    joined = answers.with_text(hits, docs, ("text",))
    assert "Aggregate" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in joined.collect()) == [("d1", 1, "one"), ("d2", 1, "two")]


def test_email_pattern_covers_the_run_of_non_blanks(spark):
    texts = ["x a@b.c, y", "@a.b", "@@a.b z@q", "p.q@r s@t.u@v", "a@b .c"]
    plain = [re.sub(r"\S+@\S+\.\S+", " <email> ", t) for t in texts]
    assert column(spark, texts, lambda c: F.regexp_replace(c, tx._UNICODE + tx.EMAIL_PATTERN, " <email> ")) == plain


def test_reviews_are_cleaned_once_for_their_tables(spark, monkeypatch):
    from tidemark.plans import catalog_text
    from tidemark.plans.registry import QUERIES

    kept = []
    monkeypatch.setattr(catalog_text, "keep", lambda df, name: kept.append(name) or df.checkpoint(), raising=False)
    for query in ("k6_feedback_tables", "u1_r3_r5_corpus_with_drivers", "n3_topic_tfidf"):
        QUERIES[query](spark, "/root/testdata/sf0.001")
    assert kept == ["topics", "topic-summary", "topics", "corpus"]
