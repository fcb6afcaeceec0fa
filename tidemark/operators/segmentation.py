"""Customer segments: K-Means with k chosen by silhouette, quality measures, names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import exact_avg
from tidemark.operators import kmeans
from tidemark.operators.kpi import cluster_centroids
from tidemark.operators.quantiles import exact_median
from tidemark.scratch import discard, keep

# Inputs and candidate numbers of segments.
SEGMENT_FEATURES = ("tenure", "MonthlyCharges", "TotalCharges", "avg_charge_per_month", "services_count")
K_RANGE = (3, 4, 5, 6, 7, 8)
SILHOUETTE_SAMPLE = 3_000

# Segment names by value, loyalty and number of products.
PREMIUM_LOYAL = "Premium Loyal"
HIGH_VALUE_AT_RISK = "High-Value At-Risk"
STEADY_LOW_SPEND = "Steady Low-Spend"
PRICE_SENSITIVE_NEW = "Price-Sensitive New"
EMERGING_MULTI_PRODUCT = "Emerging Multi-Product"


@dataclass(frozen=True)
class Segmentation:
    assignments: DataFrame  # id, segment_id, segment_name
    quality: DataFrame  # k, silhouette, davies_bouldin, calinski_harabasz
    k: int
    centres: np.ndarray  # one row per segment, in standardised inputs


def segment(
    features: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    inputs: Sequence[str] = SEGMENT_FEATURES,
    k_range: Sequence[int] = K_RANGE,
    n_init: int = 10,
    seed: int = 42,
    sample: int | None = None,
) -> Segmentation:
    """Cluster the standardised inputs for every k and keep the best silhouette.

    All numbers of segments and all starts are fitted in the same scans.
    The silhouette is the one over all rows, of squared distances; with ``sample`` it is
    the Euclidean one over so many rows.
    """
    spark = features.sparkSession
    inputs = [c for c in inputs if c in features.columns]
    points, medians = standardised_inputs(features, columns, inputs)
    chosen = {
        k: fit.centres
        for k, fit in kmeans.cheapest(kmeans.fit_all(points, k_range, n_init, seed, key=columns.id)).items()
    }
    spreads = kmeans.spreads(points, chosen)
    rows = []
    for k, centres in chosen.items():
        width = spreads[k].silhouette
        if sample is not None:
            names = [f"z{i}" for i in range(len(inputs))]
            spread = points.select(
                columns.id, kmeans.nearest(centres, F.col("scaled")).alias("segment_id"),
                *[F.col("scaled")[i].alias(n) for i, n in enumerate(names)],
            )
            width = mean_silhouette(spread, names, "segment_id", columns.id, sample, seed)
        rows.append((k, width, spreads[k].davies_bouldin, spreads[k].calinski_harabasz))
    best = max(rows, key=lambda r: r[1])[0]
    assigned = points.withColumn("segment_id", kmeans.nearest(chosen[best], F.col("scaled")))
    named = name_segments(cluster_centroids(assigned, inputs, "segment_id"), medians, columns)
    quality_table = spark.createDataFrame(
        rows, "k int, silhouette double, davies_bouldin double, calinski_harabasz double"
    )
    assignments = assigned.select(columns.id, "segment_id").join(F.broadcast(named), "segment_id")
    return Segmentation(assignments, quality_table, best, chosen[best])


def standardised_inputs(
    features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS, inputs: Sequence[str] = SEGMENT_FEATURES
) -> tuple[DataFrame, dict[str, float]]:
    """Written once: id, the inputs as they are and ``scaled``, gaps filled by the medians."""
    given = keep(features.select(columns.id, *inputs), "segment-inputs")  # read in four scans
    medians = exact_median(given, inputs)
    filled = given.select(columns.id, *[F.col(c).cast("double").alias(c) for c in inputs])
    complete = [F.coalesce(c, F.lit(medians[c])) for c in inputs]
    moments = filled.agg(
        *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(complete)],
        *[F.stddev_samp(x).alias(f"d_{i}") for i, x in enumerate(complete)],
    ).first()
    scaled = []
    for i, x in enumerate(complete):
        deviation = moments[f"d_{i}"]
        scaled.append((x - F.lit(moments[f"m_{i}"])) / F.lit(deviation) if deviation else F.lit(0.0))
    # One file is one task in every later scan, however large, so rows are dealt out evenly.
    spread = filled.withColumn("scaled", F.array(*scaled)).repartition(features.sparkSession.sparkContext.defaultParallelism)
    points = keep(spread, "segment-points")
    discard(given)
    return points, medians


def squared_silhouette(labelled: DataFrame, features: str = "scaled", cluster: str = "segment_id") -> float:
    """Spark's silhouette over all rows (squared distances, so another scale)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(labelled)


def mean_silhouette(
    points: DataFrame, names: Sequence[str], cluster: str, key: str, sample: int = SILHOUETTE_SAMPLE,
    seed: int = 42,
) -> float:
    """Euclidean silhouette over a seeded sample of at most ``sample`` points.

    The sample is the measure's definition and bounds what every task receives; the
    points themselves stay distributed and each batch meets the sample as a matrix.
    """
    chosen = (
        points.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample)
        .select(cluster, F.array(*names).alias("x"))
    )
    rows = chosen.collect()
    labels = np.array([r[cluster] for r in rows])
    matrix = np.array([r["x"] for r in rows], dtype=float)
    groups = np.unique(labels)
    if len(groups) < 2:
        return 0.0
    member = (labels[:, None] == groups[None, :]).astype(float)
    sizes = member.sum(axis=0)
    squares = (matrix**2).sum(axis=1)

    def widths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.array(batch["x"].tolist(), dtype=float)
            distance = (x**2).sum(axis=1)[:, None] + squares[None, :] - 2 * x @ matrix.T
            sums = np.sqrt(np.maximum(distance, 0.0)) @ member
            own = np.searchsorted(groups, batch[cluster].to_numpy())
            at = np.arange(len(x))
            own_size = sizes[own]
            inner = sums[at, own] / np.maximum(own_size - 1, 1)
            means = sums / sizes
            means[at, own] = np.inf
            outer = means.min(axis=1)
            width = np.where(own_size > 1, (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300), 0.0)
            yield pd.DataFrame({"width": width})

    return chosen.mapInPandas(widths, "width double").agg(F.avg("width")).first()[0]


def cluster_quality(points: DataFrame, names: Sequence[str], cluster: str) -> DataFrame:
    """Davies–Bouldin and Calinski–Harabasz of any assignment, as one row."""
    centroids = points.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[exact_avg(c, 10).alias(f"c_{c}") for c in names]
    )
    distance2 = sum(((F.col(c) - F.col(f"c_{c}")) * (F.col(c) - F.col(f"c_{c}")) for c in names), F.lit(0.0))
    spread = (
        points.join(centroids, cluster)
        .groupBy(cluster)
        .agg(F.avg(F.sqrt(distance2)).alias("scatter"), F.sum(distance2).alias("within"))
    )
    # One row per cluster from here on; they meet in one array.
    stats = (
        centroids.join(spread, cluster)
        .select(
            F.col(cluster).alias("id"), "n", "scatter", "within",
            F.array(*[F.col(f"c_{c}") for c in names]).alias("centre"),
        )
    )
    means = [
        (F.sum(F.col("n") * F.col("centre")[i]) / F.sum("n")).alias(f"m{i}") for i in range(len(names))
    ]
    packed = stats.agg(
        F.array_sort(F.collect_list(F.struct("id", "n", "scatter", "within", "centre"))).alias("clusters"),
        F.sum("n").alias("points"),
        F.sum("within").alias("within"),
        *means,
    ).withColumn("mean", F.array(*[f"m{i}" for i in range(len(names))]))

    def gap2(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)

    def worst(a: Column) -> Column:
        others = F.filter("clusters", lambda b: b["id"] != a["id"])
        return F.array_max(
            F.transform(
                others,
                lambda b: F.try_divide(
                    a["scatter"] + b["scatter"], F.sqrt(gap2(a["centre"], b["centre"]))
                ),
            )
        )

    k = F.size("clusters")
    add = lambda acc, v: acc + v
    between = F.aggregate(
        F.transform("clusters", lambda a: a["n"] * gap2(a["centre"], F.col("mean"))), F.lit(0.0), add
    )
    total_worst = F.aggregate(F.transform("clusters", worst), F.lit(0.0), add)
    return packed.select(
        k.alias("k"),
        (total_worst / k).alias("davies_bouldin"),
        F.try_divide(between / (k - 1), F.col("within") / (F.col("points") - k)).alias("calinski_harabasz"),
    )


def segment_name(
    monthly: Column, tenure: Column, services: Column, medians: dict[str, float],
    columns: s.AccountColumns = s.ACCOUNTS,
) -> Column:
    """Name of a centroid from its place relative to the medians of the base."""
    high_value = monthly >= F.lit(medians[columns.monthly])
    loyal = tenure >= F.lit(medians[columns.tenure])
    engaged = services >= F.lit(medians.get("services_count", 0.0))
    return (
        F.when(high_value & loyal, PREMIUM_LOYAL)
        .when(high_value, HIGH_VALUE_AT_RISK)
        .when(loyal, STEADY_LOW_SPEND)
        .when(engaged, EMERGING_MULTI_PRODUCT)
        .otherwise(PRICE_SENSITIVE_NEW)
    )


def unique_names(named: DataFrame, name: str = "segment_name", key: str = "segment_id") -> DataFrame:
    """The second, third … use of a name gets its number (one row per segment)."""
    use = F.row_number().over(Window.partitionBy(name).orderBy(key))
    return named.withColumn("_use", use).select(
        key,
        F.when(F.col("_use") > 1, F.concat_ws(" ", name, F.col("_use").cast("string")))
        .otherwise(F.col(name))
        .alias(name),
    )


def name_segments(
    centroids: DataFrame, medians: dict[str, float], columns: s.AccountColumns = s.ACCOUNTS
) -> DataFrame:
    services = F.col("services_count") if "services_count" in centroids.columns else F.lit(0.0)
    name = segment_name(F.col(columns.monthly), F.col(columns.tenure), services, medians, columns)
    return unique_names(centroids.select("segment_id", name.alias("segment_name")))
