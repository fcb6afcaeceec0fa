"""Connected components of a table of links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import discard, keep


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is its component's least node.

    Every round takes the least label among neighbours, then the label's label, so a chain
    shortens by a power each time. Rounds end when no label changes.
    """
    both = keep(
        links.select(F.col("a").alias("node"), F.col("b").alias("neighbour"))
        .union(links.select("b", "a"))
        .where("node <> neighbour")
        .distinct(),
        "links",
    )
    labels = keep(both.groupBy("node").agg(F.least(F.col("node"), F.min("neighbour")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("neighbour"), "label"), "neighbour")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        met = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("via")
        )
        jumped = met.join(labels.select(F.col("node").alias("via"), F.col("label").alias("far")), "via", "left")
        after = keep(
            jumped.select("node", "old", F.least("via", F.coalesce("far", "via")).alias("label")), "labels"
        )
        discard(labels)
        labels = after
        if after.where("label <> old").isEmpty():
            found = keep(after.select("node", "label"), "labels")
            discard(both, after)
            return found


def merged_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after adding ``links`` (a, b): only links between components are followed."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    placed = keep(
        links.select("a", "b").distinct().join(of("a"), "a", "left").join(of("b"), "b", "left").select(
            "a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b")
        ),
        "new-links",
    )
    between = placed.where("label_a <> label_b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    merged = component_labels(between)
    moves = merged.select(F.col("node").alias("label"), F.col("label").alias("moved"))
    fresh = placed.select(F.col("a").alias("node"), F.col("label_a").alias("label")).union(
        placed.select("b", "label_b")
    )
    nodes = labels.union(fresh).distinct()
    found = keep(nodes.join(moves, "label", "left").select("node", F.coalesce("moved", "label").alias("label")), "labels")
    discard(placed, merged)
    return found
