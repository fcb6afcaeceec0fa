"""Mixing sources to target weights by weighted fair queueing. Columns and joins only.

Every source is a queue of its documents in shuffled order, run through twice. A document's
virtual finish time is the words its source has sent by then over the source's target; the
queues are merged by finish time and cut at the total budget. Documents are taken whole.

A null text has no words and is taken 0 times. A null source is a source, the last one. Rows
that repeat an id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import with_global_rank, with_group_totals, with_running_totals
from tidemark.scratch import keep

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Budget as a multiple of all words, and how often a document can be taken at most.
BUDGET, PASSES = 1.5, 2
SEED = "mix"
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: rank, source_size, words of the sources before it, and target.

    Targets share the budget by weight; one that would pass its cap stops there and the
    excess goes to the others. In order of cap over weight, the capped sources come first,
    so two running totals settle it however many sources there are.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_rank(sources, [F.col("source").asc_nulls_last()], "rank")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = (
        ranked.withColumn("weight", F.element_at(weights, (F.col("rank") % len(WEIGHTS) + 1).cast("int")).cast("double"))
        .withColumn("cap", (PASSES * F.col("source_size")).cast("double"))
        .withColumn("level", F.col("cap") / F.col("weight"))
    )
    weighed = keep(with_running_totals(weighed, [F.col("level"), F.col("rank")], ["cap", "weight"]), "mix-levels")
    whole = weighed.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    budget, weight = BUDGET * (whole["n"] or 0), whole["w"] or 0.0
    left = F.lit(budget) - (F.col("cum_cap") - F.col("cap"))
    capped = left / (F.lit(weight) - (F.col("cum_weight") - F.col("weight"))) >= F.col("level")
    weighed = weighed.withColumn("capped", capped)
    fixed = weighed.where("capped").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w")).first()
    rest = weight - (fixed["w"] or 0.0)
    share = (budget - (fixed["c"] or 0.0)) / rest if rest > 0 else 0.0
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.lit(share) * F.col("weight"))
    placed = with_running_totals(weighed.withColumn("target", target), [F.col("rank")], ["source_size"])
    return placed.select(
        "source", "rank", "source_size", (F.col("cum_source_size") - F.col("source_size")).alias("before"), "target"
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, and the columns named in ``carry``.

    Queues hold ids and sizes only. Carried columns stay where they are: inside a source the
    finish time grows with the order of its queue, so a pass takes all documents up to one last
    one, and a row is compared with the last ones of its source. Of rows that repeat a last
    document's id and size as many are taken as the queue took.
    """
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    slim = [F.col(id_col).alias("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), key.alias("_key")]
    sized = keep(docs.select(F.monotonically_increasing_id().alias("_row"), *slim), "mix-sizes")
    targets = keep(source_targets(sized), "mix-targets")
    budget = BUDGET * (targets.agg(F.sum("source_size")).first()[0] or 0)
    order = ["rank", "_key", "doc_id", "size", "_row"]
    renamed = targets.withColumnRenamed("source", "_source")
    own_source = F.col("source").eqNullSafe(F.col("_source"))
    placed = sized.join(renamed, own_source)
    queued = keep(with_running_totals(placed, [F.col(c) for c in order], ["size"]), "mix-queue")
    sent = F.col("cum_size") - F.col("before")
    entry = lambda p: F.struct(
        ((sent + p * F.col("source_size")) / F.col("target")).alias("finish"), *order, F.lit(p).alias("pass")
    )
    entries = queued.where("size > 0 and target > 0").select(
        F.explode(F.array(*[entry(p) for p in range(PASSES)])).alias("e")
    ).select("e.*")
    merged = ["finish", *order, "pass"]
    cut = (
        with_running_totals(entries, [F.col(c) for c in merged], ["size"])
        .where(F.col("cum_size") <= F.lit(budget))
        .agg(F.max(F.struct(*merged)).alias("last"))
        .first()["last"]
    )
    taken = [F.lit(False)] * PASSES
    if cut is not None:
        last = F.struct(*[F.lit(cut[c]).cast(entries.schema[c].dataType) for c in merged])
        able = (F.col("size") > 0) & (F.col("target") > 0)
        taken = [able & (F.struct(*[entry(p)[c] for c in merged]) <= last) for p in range(PASSES)]
    if not carry:
        times = sum((t.cast("int") for t in taken), F.lit(0))
        return queued.select(
            "doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
        )
    lasts = keep(_last_taken(queued, taken), "mix-lasts")
    ends = targets.select(F.col("source").alias("_source"), "rank", "source_size", "target").join(lasts, "rank", "left")
    carried = [F.col(c).alias(f"_carry_{c}") for c in carry]
    met = docs.select(*slim, *carried).join(ends, own_source)
    return _up_to_the_last(met).select(
        "doc_id", "size", "source_size", "target", "taken", *[F.col(f"_carry_{c}").alias(c) for c in carry]
    )


def _last_taken(queued: DataFrame, taken: list[Column]) -> DataFrame:
    """Per source rank and pass p: last<p>, the last document taken, with the number of rows
    that are equal to it (all<p>) and of those the pass takes (some<p>)."""
    document = F.struct("_key", "doc_id", "size")
    flagged = queued.select("rank", document.alias("document"), *[t.alias(f"take{p}") for p, t in enumerate(taken)])
    lasts = flagged.groupBy("rank").agg(
        *[F.max(F.when(F.col(f"take{p}"), F.col("document"))).alias(f"last{p}") for p in range(PASSES)]
    )
    met = flagged.join(lasts, "rank")
    equal = [F.col("document").eqNullSafe(F.col(f"last{p}")) for p in range(PASSES)]
    counts = [F.count(F.when(e, 1)).alias(f"all{p}") for p, e in enumerate(equal)]
    counts += [F.count(F.when(e & F.col(f"take{p}"), 1)).alias(f"some{p}") for p, e in enumerate(equal)]
    return met.groupBy("rank").agg(*[F.first(f"last{p}").alias(f"last{p}") for p in range(PASSES)], *counts)


def _up_to_the_last(met: DataFrame) -> DataFrame:
    """``taken`` for rows that carry the last documents of their source."""
    document = F.struct("_key", "doc_id", "size")
    full = [F.col(f"last{p}").isNotNull() & (document < F.col(f"last{p}")) for p in range(PASSES)]
    equal = [F.col(f"last{p}").isNotNull() & document.eqNullSafe(F.col(f"last{p}")) for p in range(PASSES)]
    torn = F.lit(False)
    for p, e in enumerate(equal):
        torn = torn | (e & (F.col(f"some{p}") < F.col(f"all{p}")))
    torn = F.coalesce(torn, F.lit(False))
    words = lambda flags: (F.col("size") * sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0)))
    whole = met.where(~torn).withColumn("taken", words([f | e for f, e in zip(full, equal, strict=True)]).cast("long"))
    part = met.where(torn)
    if part.isEmpty():
        return whole
    rows = part.withColumn("_one", F.lit(1).cast("long")).withColumn("_at", F.monotonically_increasing_id())
    ranked = with_group_totals(keep(rows, "mix-torn"), ["rank", "_key", "size"], [F.col("_at")], ["_one"])
    first = [f | (e & (F.col("cum__one") <= F.col(f"some{p}"))) for p, (f, e) in enumerate(zip(full, equal, strict=True))]
    return whole.unionByName(ranked.withColumn("taken", words(first).cast("long")).drop("_one", "_at", "cum__one"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         (2 * source_size)::DOUBLE AS cap
  FROM ranked),
levels AS (
  SELECT *, cap / weight AS level,
         coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
         sum(weight) OVER () AS all_weight, 1.5 * sum(source_size) OVER ()::DOUBLE AS budget,
         coalesce(sum(source_size) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
settled AS (
  SELECT *, (budget - cap_before) / (all_weight - weight_before) >= level AS capped FROM levels),
shared AS (
  SELECT (max(budget) - coalesce(sum(cap) FILTER (capped), 0))
         / nullif(max(all_weight) - coalesce(sum(weight) FILTER (capped), 0), 0) AS share FROM settled),
targets AS (
  SELECT source, rank, source_size, before, budget,
         CASE WHEN capped THEN cap ELSE share * weight END AS target FROM settled, shared),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.budget, t.rank, s.k,
         sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, (sent + p * source_size)::DOUBLE / target AS finish
  FROM queued, (VALUES (0), (1)) AS passes(p) WHERE size > 0 AND target > 0),
merged AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, k, doc_id, size, p ROWS UNBOUNDED PRECEDING) AS total
  FROM entries),
taken AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM merged WHERE total <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t USING (doc_id)
"""
