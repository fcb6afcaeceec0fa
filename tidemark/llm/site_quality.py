"""Document quality by hierarchical empirical Bayes over sites.

A document's own evidence is a calibrated classifier of its text. Host and path posteriors
pool the evidence of their other documents (a label where there is one, else the
classifier) and shrink it: a path towards its host, a host towards the corpus. How strongly
is estimated from how much hosts, and paths within hosts, differ beyond chance.

A null host or path is a group of its own. A null or empty text scores as the classifier's
intercept says. A document never counts in its own site's posterior.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import chunks
from tidemark.llm.linear import LinearModel, fit_on_sample, logits
from tidemark.scratch import keep

BITS = 18
#: The classifier is fitted on at most this many labelled rows.
MAX_LABELLED = 6_000
KEEP_FROM = 0.5
#: Bounds on the prior weight, in documents: never ignore a site wholly, never trust a
#: handful of documents alone.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1_000.0
_TINY = 1e-4


def classify(docs: DataFrame, model: LinearModel, host_col: str, path_col: str) -> DataFrame:
    """doc_id, host, path and the classifier's probability, without any text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits floats: a fixed size
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    source = docs.select(
        "doc_id", named(host_col).alias("host"), named(path_col).alias("path"), "text"
    )

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(3)):
                part = batch.slice(lo, hi - lo)
                p = m.probability(logits(texts, m))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(p)], ["doc_id", "host", "path", "own"])

    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {key}, host string, path string, own double")


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - _TINY)), F.lit(_TINY))
    return F.log(inside / (1 - inside))


def _prior_weight(groups: DataFrame, n: str, mean: str, centre: Column, spread: Column) -> float:
    """Beta prior weight by moments: within-group variance over variance between groups.

    ``spread`` is the variance of one document's evidence inside a group."""
    row = groups.where(F.col(n) > 1).agg(
        F.sum(F.col(n)).alias("n"),
        F.sum(F.col(n) * F.pow(F.col(mean) - centre, 2)).alias("between"),
        F.sum(spread).alias("chance"),
        F.sum(F.col(n) * spread).alias("within"),
    ).first()
    if not row["n"]:
        return MOST_WEIGHT
    tau = max(0.0, (row["between"] - row["chance"]) / row["n"])
    weight = (row["within"] / row["n"]) / tau if tau > 0 else MOST_WEIGHT
    return float(min(MOST_WEIGHT, max(LEAST_WEIGHT, weight)))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_col: str = "lang",
    max_rows: int = MAX_LABELLED,
) -> DataFrame:
    """Per row: doc_id, doc_score, host_score, path_score, score, kept."""
    model = fit_on_sample(docs, labels, "quality", BITS, max_rows)
    scored = keep(classify(docs, model, host_col, path_col), "site-scores")
    known = (
        labels.select("doc_id", F.col("quality").cast("double").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    seen = keep(
        scored.join(known, "doc_id", "left").withColumn("evidence", F.coalesce("y", "own")).drop("y"), "site-evidence"
    )
    # Sums per path first; hosts and the corpus are sums of those.
    paths = keep(
        seen.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n_p"), F.sum("evidence").alias("s_p"), F.sum(F.col("evidence") ** 2).alias("q_p")
        ),
        "site-paths",
    )
    hosts = keep(
        paths.groupBy("host").agg(F.sum("n_p").alias("n_h"), F.sum("s_p").alias("s_h"), F.sum("q_p").alias("q_h")),
        "site-hosts",
    )
    whole = hosts.agg(F.sum("n_h").alias("n"), F.sum("s_h").alias("s")).first()
    centre = (whole["s"] or 0.0) / whole["n"] if whole["n"] else 0.5

    def spread(n: str, s: str, q: str) -> Column:
        return F.greatest(F.col(q) / F.col(n) - F.pow(F.col(s) / F.col(n), 2), F.lit(0.0))

    host_means = hosts.withColumn("m_h", F.col("s_h") / F.col("n_h"))
    k_host = _prior_weight(host_means, "n_h", "m_h", F.lit(centre), spread("n_h", "s_h", "q_h"))
    sites = paths.join(host_means, "host")
    path_means = sites.withColumn("m_p", F.col("s_p") / F.col("n_p"))
    k_path = _prior_weight(path_means, "n_p", "m_p", F.col("m_h"), spread("n_p", "s_p", "q_p"))

    others = seen.join(sites, ["host", "path"])
    host = (F.col("s_h") - F.col("evidence") + k_host * centre) / (F.col("n_h") - 1 + k_host)
    path = (F.col("s_p") - F.col("evidence") + k_path * F.col("host_score")) / (F.col("n_p") - 1 + k_path)
    z = _logit(F.col("own")) + _logit(F.col("path_score")) - _logit(F.lit(centre))
    return (
        others.withColumn("host_score", host)
        .withColumn("path_score", path)
        .withColumn("score", 1 / (1 + F.exp(-z)))
        .select(
            "doc_id", F.col("own").alias("doc_score"), "host_score", "path_score", "score",
            (F.col("score") >= KEEP_FROM).alias("kept"),
        )
    )
