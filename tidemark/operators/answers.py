"""Numbered evidence and rule-based answers for a table of questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_up
from tidemark.scratch import keep

# Lengths of quoted text.
CITATION_LENGTH = 400
QUOTE_LENGTH = 220
NO_EVIDENCE = "No relevant evidence was retrieved for that question."
CAVEAT = (
    "**Confidence & caveats** — This answer was assembled deterministically from retrieved "
    "records. Associations shown are not causal evidence."
)

# Sections in order, with the source they show and how many items.
SECTIONS = (
    ("kpi", 3, "**Portfolio position**"),
    ("model_driver", 4, "**What the churn model attributes risk to**"),
    ("topic_summary", 4, "**What customers are talking about (most negative themes first)**"),
    ("review", 3, "**Representative verbatims**"),
)


def citations(hits: DataFrame) -> DataFrame:
    """``E1, E2, …`` in rank order, with the rounded score and the start of the text."""
    return hits.select(
        "question_id",
        F.concat(F.lit("E"), F.col("rank").cast("string")).alias("id"),
        "doc_id",
        "source",
        round_half_up("score", 4).alias("score"),
        F.substring("text", 1, CITATION_LENGTH).alias("text"),
    )


def evidence_lines(hits: DataFrame) -> DataFrame:
    """The numbered evidence as one block of text per question."""
    line = F.concat(
        F.lit("[E"), F.col("rank").cast("string"), F.lit("] ("), F.col("source"), F.lit(") "), F.col("text")
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return hits.groupBy("question_id").agg(F.array_join(listed["line"], "\n").alias("evidence"))


def answer_lines(hits: DataFrame) -> DataFrame:
    """Hits that appear in an answer, with their section, place in it and cited line."""
    negative_share = F.coalesce(F.col("metadata")["negative_share"].try_cast("double"), F.lit(0.0))
    place = Window.partitionBy("question_id", "source").orderBy(
        F.desc(F.when(F.col("source") == "topic_summary", negative_share)), F.asc("rank")
    )
    section = F.lit(None).cast("int")
    quota = F.lit(0)
    for i, (source, items, _) in enumerate(SECTIONS):
        section = F.when(F.col("source") == source, i).otherwise(section)
        quota = F.when(F.col("source") == source, items).otherwise(quota)
    quoted = F.concat(F.lit("“"), F.substring("text", 1, QUOTE_LENGTH), F.lit("”"))
    shown = F.when(F.col("source") == "review", quoted).otherwise(F.col("text"))
    tag = F.concat(F.lit(" [E"), F.col("rank").cast("string"), F.lit("]"))
    return (
        hits.withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= quota)
        .select("question_id", section.alias("section"), "place", F.concat(F.lit("- "), shown, tag).alias("line"))
    )


def answers(questions: DataFrame, hits: DataFrame, caveat: str = CAVEAT) -> DataFrame:
    """One answer per question; a question without hits gets the fixed message.

    ``hits`` holds one question's budget of documents, so its lines fit in one row.
    """
    lines = answer_lines(hits).groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("section", "place", "line"))).alias("lines")
    )
    counts = hits.groupBy("question_id").agg(F.count(F.lit(1)).alias("n_hits"))
    found = questions.join(counts, "question_id", "left").join(lines, "question_id", "left")
    opening = F.concat(
        F.lit("**Answer** — Based on "), F.col("n_hits").cast("string"),
        F.lit(" retrieved evidence items for: “"), F.col("question"), F.lit("”."),
    )
    parts = [F.array(opening)]
    for i, (_, _, heading) in enumerate(SECTIONS):
        section_lines = _section(i)
        parts.append(
            F.when(F.size(section_lines) > 0, F.concat(F.array(F.lit("\n" + heading)), section_lines))
            .otherwise(F.array().cast("array<string>"))
        )
    parts.append(F.array(F.lit("\n" + caveat)))
    return found.select(
        "question_id",
        "question",
        F.when(F.col("n_hits").isNull(), NO_EVIDENCE)
        .otherwise(F.array_join(F.concat(*parts), "\n"))
        .alias("answer"),
        F.coalesce("n_hits", F.lit(0)).alias("evidence_items"),
        F.lit("deterministic").alias("generated_by"),
    )


def _section(i: int) -> Column:
    lines = F.coalesce("lines", F.array().cast("array<struct<section:int,place:int,line:string>>"))
    return F.transform(F.filter(lines, lambda x: x["section"] == i), lambda x: x["line"])


def with_text(hits: DataFrame, corpus: DataFrame, extra: Sequence[str] = ("text", "metadata")) -> DataFrame:
    """Attach document text to the few hits that survived retrieval.

    The hits are written first: their true size is known then, and few of them go to the
    texts, which need not be shuffled.
    """
    return keep(hits, "hits").join(corpus.select("doc_id", *extra), "doc_id")
