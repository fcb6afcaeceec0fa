"""Secrets, with how widely each candidate is owned across the corpus. Columns and joins only.

A candidate value that stands with many owners or in many repositories is a copied example;
one that stands in few and looks random is likely live. Base spans are always reported. Owner-specific,
random-looking tokens without any telling context are added as spans of kind ``token``.

Null and empty texts have no spans. A null owner counts as one owner. Rows that repeat an
id count as one repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import keep

#: Kinds in their fixed order with pattern, group of the value and least length of it.
KINDS = (
    (
        "assign",
        r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("token", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
)
BASE = tuple(k for k, *_ in KINDS[:3])
#: From this many owners on a value is a widely copied example.
EXAMPLE_OWNERS = 4
#: So is one in this many repositories, even of one owner, who may use an own secret in a few.
EXAMPLE_REPOS = 10
#: A value looks random from this many different characters on.
RANDOM_CHARS = 8


def _match_lists(text: Column, kind: str, pattern: str) -> Column:
    """(kind, length of the gap before each match, matches); null when nothing matches."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(
        text.rlike(pattern), F.struct(F.lit(kind).alias("kind"), gaps.alias("gaps"), found.alias("found"))
    )


def scan_candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """One row per document: ``row``, its id, owner, and the match lists of every kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lists = F.array_compact(F.array(*[_match_lists(text, kind, pattern) for kind, pattern, *_ in KINDS]))
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        lists.alias("lists"),
    )
    return keep(scanned, "secret-candidates")


def candidate_spans(scanned: DataFrame) -> DataFrame:
    """One row per match that meets its kind's length: positions, value hash, looks."""
    per_kind = scanned.select("row", "doc_id", "owner", F.explode("lists").alias("l"))
    each = per_kind.select(
        "row", "doc_id", "owner", F.col("l.kind").alias("kind"),
        F.posexplode(F.arrays_zip(F.col("l.gaps").alias("gap"), F.col("l.found").alias("found"))).alias("i", "m"),
    ).where(F.col("m.found").isNotNull())
    size = F.length("m.found")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + size).over(upto)
    placed = each.select("row", "doc_id", "owner", "kind", "m.found", end.alias("end"), (end - size).alias("start"))
    value, least, number = F.lit(None).cast("string"), F.lit(0), F.lit(0)
    for n, (kind, pattern, group, shortest) in enumerate(KINDS):
        here = F.col("kind") == kind
        value = F.when(here, F.regexp_extract("found", pattern, group)).otherwise(value)
        least = F.when(here, shortest).otherwise(least)
        number = F.when(here, n).otherwise(number)
    out = placed.withColumn("value", value).withColumn("kind_no", number).where(F.length("value") >= least)
    varied = F.size(F.array_distinct(F.split(F.col("value"), ""))) >= RANDOM_CHARS
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    return out.withColumn("random", varied & ((F.col("kind") != "token") | mixed)).withColumn(
        "value_hash", F.sha2(F.lower("value"), 256).substr(1, 32)
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Per candidate value: distinct owners and repositories. Counted in steps, so a value
    found in a third of all rows meets as partial counts."""
    by_repo = spans.groupBy("value_hash", "owner", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos")
    )


def is_example(owners: Column, repos: Column) -> Column:
    return (owners >= EXAMPLE_OWNERS) | (repos >= EXAMPLE_REPOS)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source"
) -> DataFrame:
    """Per row: doc_id and ``spans``, an array sorted by start and kind of
    (start, kind_no, kind, end, owners, repos, live)."""
    scanned = scan_candidates(docs, id_col, text_col, owner_col)
    spans = keep(candidate_spans(scanned), "secret-spans")
    live = F.col("random") & ~is_example(F.col("owners"), F.col("repos"))
    judged = (
        spans.join(ownership(spans), "value_hash")
        .withColumn("live", live)
        .where(F.col("kind").isin(*BASE) | F.col("live"))
    )
    per_row = judged.groupBy("row").agg(
        F.sort_array(
            F.collect_list(F.struct("start", "kind_no", "kind", "end", "owners", "repos", "live"))
        ).alias("spans")
    )
    return (
        scanned.select("row", "doc_id")
        .join(per_row, "row", "left")
        .select("doc_id", F.coalesce("spans", F.array().cast(per_row.schema["spans"].dataType)).alias("spans"))
    )


def secrets_digest(docs: DataFrame) -> DataFrame:
    """The contract of ``op2``, with how many spans look live and how many are examples."""
    found = find_secrets(docs)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(F.concat_ws(",", F.transform(base, text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", text)).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: is_example(s["owners"], s["repos"]))).cast("long").alias("n_example"),
    )
