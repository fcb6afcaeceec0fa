"""Churn model: split, encoding, candidates, cross-validation, calibration, scoring."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.operators.boosting import BoostedTrees, Boosting, Fit, Rules, fit_boosted
from tidemark.operators.cleaning import feature_types
from tidemark.operators.forest import ForestRules, GrownForest, fit_forest
from tidemark.operators.quantiles import exact_median
from tidemark.operators.ranking import with_global_rank
from tidemark.scratch import discard, keep
from tidemark.session import ensure_checkpoint_dir

SEED = 42
RARE = "infrequent"
#: A column with more rare levels has them in a table instead of a list.
_RARE_LEVEL_LIMIT = 10_000
#: Fits whose jobs the session runs at the same time.
FITS_AT_ONCE = 8
#: Nodes of all forests that the driver grows at the same time, unless one alone has more.
NODES_AT_ONCE = 2_000_000
#: Over so many rows, which a task holds, forests are grown by lots of trees; over fewer or more in Spark's passes.
FOREST_ROWS = range(5_001, 8_000_001)

T = TypeVar("T")


def at_once(jobs: Sequence[Callable[[], T]], spark: SparkSession, parallelism: int = FITS_AT_ONCE) -> list[T]:
    """The results of independent jobs in their order, ``parallelism`` of them at a time.

    One fit's passes wait for each other; other fits use the cores meanwhile."""
    if len(jobs) < 2 or parallelism < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(min(parallelism, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


# ---------------------------------------------------------------- split and folds


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Add ``stratum_rank``, the repeatable random position of a row within its label.

    Labels may be very unequal: the rows are ordered by label and hash together, so a
    frequent label spreads over many tasks.
    """
    hashed = df.withColumn("_hash", F.xxhash64(key, F.lit(seed)))
    ranked = with_global_rank(hashed, [F.asc(label), F.asc("_hash"), F.asc(key)], "_rank")
    sizes = ranked.groupBy(label).count().orderBy(label).collect()
    start, at = F.lit(None).cast("long"), 0
    size = F.lit(None).cast("long")
    for row in sizes:
        same = F.col(label).eqNullSafe(F.lit(row[label]))
        start, size = F.when(same, at).otherwise(start), F.when(same, row["count"]).otherwise(size)
        at += row["count"]
    return (
        ranked.withColumn("stratum_rank", F.col("_rank") - start)
        .withColumn("stratum_size", size)
        .drop("_hash", "_rank")
    )


def split_and_fold(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """Add ``is_test`` (the same share of every label) and ``fold`` for the training rows."""
    ranked = stratified_rank(df, label, key, seed)
    n_test = F.round(F.col("stratum_size") * test_size)
    is_test = F.col("stratum_rank") < n_test
    fold = F.when(~is_test, F.pmod(F.col("stratum_rank") - n_test, F.lit(folds)).cast("int"))
    return (
        ranked.withColumn("is_test", is_test)
        .withColumn("fold", fold)
        .drop("stratum_rank", "stratum_size")
    )


# ---------------------------------------------------------------- encoding


@dataclass(frozen=True)
class Encoding:
    """Fitted preprocessing: a model-sized set of numbers and level names.

    A column's rare levels are listed; where ``rare`` is None they are the rows of
    ``rare_table`` (column, level), which encoded rows are joined to.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str]
    levels: dict[str, tuple[str, ...]]
    rare: dict[str, tuple[str, ...] | None]
    rare_table: DataFrame | None = field(default=None, compare=False)

    @property
    def names(self) -> list[str]:
        out = list(self.numeric)
        for c in self.categorical:
            out += [f"{c}_{level}" for level in self.levels[c]]
            if self.rare[c] != ():
                out.append(f"{c}_{RARE}")
        return out

    def with_rare(self, df: DataFrame) -> DataFrame:
        """Mark the rows whose level is in the table of rare levels; ``values`` reads the marks.

        Rows with a level of its own match nothing and are spread by their inputs.
        """
        for c in self.categorical:
            if self.rare[c] is not None:
                continue
            level = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            own = level.isin(*self.levels[c])
            known = self.rare_table.where(F.col("column") == c).select(
                F.col("level").alias("_level"), F.lit(0).cast("long").alias("_spread"), F.lit(True).alias(f"_rare_{c}")
            )
            spread = F.when(own, F.xxhash64(*self.numeric, *self.categorical)).otherwise(F.lit(0).cast("long"))
            df = (
                df.withColumn("_spread", spread).withColumn("_level", F.when(~own, level))
                .join(known, ["_level", "_spread"], "left").drop("_level", "_spread")
            )
        return df

    def values(self) -> list[Column]:
        """Standardised numbers, then one 0/1 column per level; unknown levels are all zero."""
        out = []
        for c in self.numeric:
            filled = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            out.append((filled - F.lit(self.means[c])) / F.lit(self.deviations[c]))
        for c in self.categorical:
            level = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            out += [(level == value).cast("double") for value in self.levels[c]]
            if self.rare[c] is None:
                out.append(F.coalesce(F.col(f"_rare_{c}"), F.lit(False)).cast("double"))
            elif self.rare[c]:
                out.append(level.isin(*self.rare[c]).cast("double"))
        return out

    def encode(self, df: DataFrame, output: str = "features") -> DataFrame:
        encoded = self.with_rare(df).withColumn(output, array_to_vector(F.array(*self.values())))
        return encoded.drop(*[f"_rare_{c}" for c in self.categorical if self.rare[c] is None])


def fit_encoding(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], min_frequency: float = 0.01
) -> Encoding:
    """Medians, scales, modes and levels of the training rows.

    Levels rarer than ``min_frequency`` share one column, so at most 1 / min_frequency
    levels of a column have their own. Rare levels are remembered to tell them from
    unseen ones, in a list, or in a table where a column has more than 10,000 of them.
    """
    typed = train.select(
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[F.col(c).cast("string").alias(c) for c in categorical],
    )
    medians = {c: 0.0 if m is None else m for c, m in exact_median(typed, numeric).items()}
    filled = {c: F.coalesce(c, F.lit(medians[c])) for c in numeric}
    moments = typed.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.avg(v).alias(f"mean_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"dev_{c}") for c, v in filled.items()],
    ).first()
    n = moments["_n"]
    modes: dict[str, str] = {}
    levels: dict[str, tuple[str, ...]] = {}
    rare: dict[str, tuple[str, ...] | None] = {}
    table = None
    if categorical:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in categorical]
        )
        counts = (
            typed.select(F.inline(pairs))
            .groupBy("column", "level")
            .agg(F.count(F.lit(1)).alias("n"))
            .persist()
        )
        known = counts.where("level is not null")
        # The most frequent level, the first in order on ties, fills the nulls.
        best = known.groupBy("column").agg(F.max("n").alias("n"))
        top = known.join(best, ["column", "n"]).groupBy("column").agg(F.min("level").alias("mode")).collect()
        modes = {c: "" for c in categorical} | {r["column"]: r["mode"] for r in top}
        nulls = {r["column"]: r["n"] for r in counts.where("level is null").collect()}
        total = F.col("n")
        for c in categorical:
            filled_mode = (F.col("column") == c) & (F.col("level") == modes[c])
            total = F.when(filled_mode, F.col("n") + nulls.get(c, 0)).otherwise(total)
        frequent = total >= min_frequency * n
        own = known.where(frequent).collect()
        others = known.where(~frequent)
        many = {r["column"]: r["count"] for r in others.groupBy("column").count().collect()}
        listed = [c for c in categorical if 0 < many.get(c, 0) <= _RARE_LEVEL_LIMIT]
        seldom = others.where(F.col("column").isin(*listed)).collect() if listed else []
        tabled = [c for c in categorical if many.get(c, 0) > _RARE_LEVEL_LIMIT]
        if tabled:
            table = keep(others.where(F.col("column").isin(*tabled)).select("column", "level"), "rare-levels")
        counts.unpersist()
        for c in categorical:
            levels[c] = tuple(sorted(r["level"] for r in own if r["column"] == c))
            if c in tabled:
                rare[c] = None
            else:
                rare[c] = tuple(sorted(r["level"] for r in seldom if r["column"] == c))
    return Encoding(
        tuple(numeric),
        tuple(categorical),
        medians,
        {c: moments[f"mean_{c}"] for c in numeric},
        {c: moments[f"dev_{c}"] or 1.0 for c in numeric},
        modes,
        levels,
        rare,
        table,
    )


# ---------------------------------------------------------------- candidates


def with_class_weights(df: DataFrame, label: str, output: str = "class_weight") -> DataFrame:
    """Balanced weights: both classes weigh half of the rows."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for value, count in counts.items():
        weight = F.when(F.col(label) == value, n / (len(counts) * count)).otherwise(weight)
    return df.withColumn(output, weight)


def logistic_regression(n_rows: int, c: float = 1.0, max_iter: int = 2000) -> LogisticRegression:
    """L2 with penalty 1/C on the summed loss; Spark averages it, hence 1 / (C n)."""
    return LogisticRegression(
        labelCol="label", weightCol="class_weight", regParam=1.0 / (c * n_rows),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-6,
    )


def random_forest(trees: int = 400, depth: int = 12, min_leaf: int = 5) -> RandomForestClassifier:
    """Rows keep the node they reached in every tree, so a pass neither sends the trees nor walks
    them from the root; the trees are the same."""
    return RandomForestClassifier(
        labelCol="label", weightCol="class_weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=SEED, cacheNodeIds=True,
    )


def forest_rules(estimator: Estimator) -> ForestRules | None:
    """The rules of a forest that ``random_forest`` made; others have settings that only Spark's passes know."""
    if not isinstance(estimator, RandomForestClassifier):
        return None
    e = estimator
    plain = random_forest(e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode())
    settings = [{p.name: v for p, v in x.extractParamMap().items()} for x in (e, plain)]
    return ForestRules(e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode(), e.getMaxBins(), SEED) if settings[0] == settings[1] else None


#: Hyper-parameters of the two boosters (fixed values).
DEPTHWISE = Rules(
    rounds=400, rate=0.05, max_depth=4, least_hessian=8.0, penalty=2.0, row_share=0.9, column_share=0.8, seed=SEED
)
LEAFWISE = Rules(
    rounds=400, rate=0.05, max_leaves=31, least_rows=40, row_share=0.9, column_share=0.8, seed=SEED
)

def depthwise_boosting(rounds: int = 400) -> Boosting:
    """Newton boosting of trees of depth 4 with a penalty on leaf weights."""
    return Boosting(replace(DEPTHWISE, rounds=rounds))


def leafwise_boosting(rounds: int = 400) -> Boosting:
    """Best-first trees of up to 31 leaves."""
    return Boosting(replace(LEAFWISE, rounds=rounds))


CANDIDATES: dict[str, Callable[[int], Estimator | Boosting]] = {
    "logistic_regression": logistic_regression,
    "random_forest": lambda n: random_forest(),
    "boosting_depthwise": lambda n: depthwise_boosting(),
    "boosting_leafwise": lambda n: leafwise_boosting(),
}

_MODEL_CLASSES = {
    "LogisticRegressionModel": LogisticRegressionModel,
    "RandomForestClassificationModel": RandomForestClassificationModel,
}


def positive_probability(model: Model | BoostedTrees | GrownForest, encoded: DataFrame, output: str) -> DataFrame:
    if isinstance(model, BoostedTrees | GrownForest):
        return encoded.withColumn(output, model.probability("features"))
    scored = model.transform(encoded)
    produced = ("rawPrediction", "probability", "prediction")
    return scored.withColumn(output, vector_to_array("probability")[1]).drop(*produced)


def decision_value(model: Model, encoded: DataFrame, output: str) -> DataFrame:
    """What calibration reads: the margin of a linear model, else the probability."""
    if not isinstance(model, LogisticRegressionModel):
        return positive_probability(model, encoded, output)
    scored = model.transform(encoded)
    return scored.withColumn(output, vector_to_array("rawPrediction")[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def area_under_roc(scored: DataFrame, probability: str = "churn_probability") -> float:
    return BinaryClassificationEvaluator(
        rawPredictionCol=probability, labelCol="label", numBins=0
    ).evaluate(scored)


def cross_validate(
    train: DataFrame,
    build: Callable[[int], Estimator],
    numeric: Sequence[str],
    categorical: Sequence[str],
    folds: int = 5,
    fit_inside_fold: bool = True,
) -> list[float]:
    """ROC-AUC per held-out fold; the encoding is fitted without the held-out rows."""
    if isinstance(booster := build(1), Boosting):
        fitted = boosted_fits(train, {"": booster.rules}, numeric, categorical, folds, fit_inside_fold=fit_inside_fold)
        return fold_scores(train, fitted[""].folds)
    return scores_of_folds(train, build, fold_encodings(train, numeric, categorical, folds, fit_inside_fold))


def fold_encodings(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int = 5, fit_inside_fold: bool = True
) -> list[Encoding]:
    """The encoding of every fold's other rows, or one of all rows for every fold."""
    if not fit_inside_fold:
        return [fit_encoding(train, numeric, categorical)] * folds
    rest = [train.where(F.col("fold") != i) for i in range(folds)]
    return at_once([lambda r=r: fit_encoding(r, numeric, categorical) for r in rest], train.sparkSession)


def fits_at_once(build: Callable[[int], Estimator], n_rows: int) -> int:
    """How many fits over ``n_rows`` rows may run side by side: the driver holds the nodes of
    every forest that grows, at most two per smallest leaf of its rows."""
    estimator = build(1)
    if not isinstance(estimator, RandomForestClassifier):
        return FITS_AT_ONCE
    per_tree = min(2 ** (estimator.getMaxDepth() + 1), 2 * n_rows // estimator.getMinInstancesPerNode() + 1)
    return max(1, min(FITS_AT_ONCE, NODES_AT_ONCE // (per_tree * estimator.getNumTrees())))


def scores_of_folds(train: DataFrame, build: Callable[[int], Estimator], encodings: Sequence[Encoding]) -> list[float]:
    """ROC-AUC of a model without each fold on that fold's rows.

    A model is let go once it is scored, so the driver holds those at work, not all folds'."""

    def score(i: int) -> float:
        model = fit_model(encodings[i].encode(train.where(F.col("fold") != i)), build)
        return fold_score(train, encodings[i], model, i)

    parallel = fits_at_once(build, train.count())
    return at_once([lambda i=i: score(i) for i in range(len(encodings))], train.sparkSession, parallel)


@dataclass(frozen=True)
class BoostedFits:
    """A booster fitted without each fold, on all rows, and without each calibration fold."""

    folds: tuple[tuple[Encoding, BoostedTrees], ...]
    whole: BoostedTrees | None
    members: tuple[BoostedTrees, ...]


def boosted_fits(
    train: DataFrame,
    rules: Mapping[str, Rules],
    numeric: Sequence[str],
    categorical: Sequence[str],
    folds: int = 5,
    encoding: Encoding | None = None,
    calibration_folds: int = 0,
    fit_inside_fold: bool = True,
    encodings: Sequence[Encoding] = (),
) -> dict[str, BoostedFits]:
    """All fits that comparing and calibrating boosters needs, in the same passes over the rows.

    Folds have encodings of their own (unless ``fit_inside_fold`` is false), in ``encodings``
    if already fitted. With ``encoding`` there is also a fit on all rows and one without each
    value of ``calibration_fold``.
    """
    if not encodings:
        shared = encoding and not fit_inside_fold
        encodings = [encoding] * folds if shared else fold_encodings(train, numeric, categorical, folds, fit_inside_fold)
    rows = train.withColumn("_key", F.xxhash64(*numeric, *categorical))
    used = {}
    for e in [*encodings, *([encoding] if encoding else [])]:
        if id(e) not in used:
            used[id(e)] = f"_features{len(used)}"
            rows = e.encode(rows, used[id(e)])
    rows = rows.withColumn("_whole", F.lit(True))
    rows = rows.withColumns({f"_fold{i}": F.col("fold") != i for i in range(folds)})
    rows = rows.withColumns({f"_member{i}": F.col("calibration_fold") != i for i in range(calibration_folds)})
    insides = [f"_fold{i}" for i in range(folds)]
    jobs = [(used[id(e)], inside) for e, inside in zip(encodings, insides, strict=True)]
    if encoding:
        jobs += [(used[id(encoding)], i) for i in ("_whole", *[f"_member{k}" for k in range(calibration_folds)])]
    kept = keep(rows.select("_key", "label", *used.values(), *dict.fromkeys(i for _, i in jobs)), "boost-rows")
    fits = [Fit(features, inside, rule) for rule in rules.values() for features, inside in jobs]
    models = fit_boosted(kept, fits, key="_key")
    discard(kept)
    out = {}
    for n, name in enumerate(rules):
        own = models[n * len(jobs) : (n + 1) * len(jobs)]
        out[name] = BoostedFits(
            tuple(zip(encodings, own[:folds], strict=True)),
            own[folds] if encoding else None,
            tuple(own[folds + 1 :]),
        )
    return out


def fold_score(train: DataFrame, encoding: Encoding, model: Model | BoostedTrees, fold: int) -> float:
    """ROC-AUC of a fold's model on the rows it has not seen."""
    held_out = encoding.encode(train.where(F.col("fold") == fold))
    return area_under_roc(positive_probability(model, held_out, "churn_probability"))


def fold_scores(train: DataFrame, fitted: Sequence[tuple[Encoding, Model | BoostedTrees]]) -> list[float]:
    """ROC-AUC of every fold's model on the rows it has not seen."""
    jobs = [lambda i=i, e=e, m=m: fold_score(train, e, m, i) for i, (e, m) in enumerate(fitted)]
    return at_once(jobs, train.sparkSession)


def fit_model(encoded: DataFrame, build: Callable[[int], Estimator | Boosting]) -> Model | BoostedTrees | GrownForest:
    if isinstance(booster := build(1), Boosting):
        return booster.fit(encoded.select("features", "label"))
    weighted = with_class_weights(encoded, "label").select("features", "label", "class_weight").persist()
    try:
        n_rows = weighted.count()
        estimator = build(n_rows)
        rules = forest_rules(estimator)
        return fit_forest(weighted, rules) if rules and n_rows in FOREST_ROWS else estimator.fit(weighted)
    finally:
        weighted.unpersist()


# ---------------------------------------------------------------- calibration


@dataclass(frozen=True)
class Sigmoid:
    """Probability 1 / (1 + exp(-(slope × value + intercept)))."""

    slope: float
    intercept: float

    def apply(self, scored: DataFrame, value: str, output: str) -> DataFrame:
        z = F.lit(self.slope) * F.col(value) + F.lit(self.intercept)
        return scored.withColumn(output, 1.0 / (1.0 + F.exp(-z)))


@dataclass(frozen=True)
class Isotonic:
    model: IsotonicRegressionModel

    def apply(self, scored: DataFrame, value: str, output: str) -> DataFrame:
        fitted = self.model.copy({self.model.featuresCol: value, self.model.predictionCol: output})
        return fitted.transform(scored)


def fit_sigmoid(scored: DataFrame, value: str) -> Sigmoid:
    """Platt scaling: smoothed targets enter as two weighted rows per example."""
    counts = {r["label"]: r["count"] for r in scored.groupBy("label").count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    target = F.when(F.col("label") == 1, (positives + 1.0) / (positives + 2.0)).otherwise(
        1.0 / (negatives + 2.0)
    )
    both = F.array(
        F.struct(F.lit(1.0).alias("y"), target.alias("w")),
        F.struct(F.lit(0.0).alias("y"), (1.0 - target).alias("w")),
    )
    rows = scored.select(F.col(value).alias("v"), F.inline(both)).select(
        array_to_vector(F.array("v")).alias("features"), "y", "w"
    )
    model = LogisticRegression(labelCol="y", weightCol="w", regParam=0.0, tol=1e-9, maxIter=200).fit(rows)
    return Sigmoid(float(model.coefficients[0]), float(model.intercept))


def fit_isotonic(scored: DataFrame, value: str) -> Isotonic:
    model = IsotonicRegression(featuresCol=value, labelCol="label").fit(
        scored.select(value, F.col("label").cast("double").alias("label"))
    )
    return Isotonic(model)


@dataclass(frozen=True)
class ChurnModel:
    """Everything scoring needs; ``parts`` are the calibrated members of the ensemble."""

    name: str
    encoding: Encoding
    base: Model
    parts: tuple[tuple[Model, Sigmoid | Isotonic], ...]
    threshold: float = 0.5
    metrics: dict[str, float] = field(default_factory=dict)
    background: dict[str, float] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)

    def score(self, df: DataFrame, output: str = "churn_probability") -> DataFrame:
        """Add the (calibrated) probability; every row in comes out."""
        encoded = self.encoding.encode(df)
        if not self.parts:
            return positive_probability(self.base, encoded, output).drop("features")
        names = []
        for i, (model, calibrator) in enumerate(self.parts):
            encoded = decision_value(model, encoded, f"_value{i}")
            encoded = calibrator.apply(encoded, f"_value{i}", f"_p{i}")
            names.append(f"_p{i}")
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
        return encoded.withColumn(output, mean).drop(
            "features", *names, *[f"_value{i}" for i in range(len(names))]
        )


def calibrate(
    train: DataFrame,
    build: Callable[[int], Estimator],
    encoding: Encoding,
    method: str | None = "sigmoid",
    folds: int = 3,
    members: Sequence[BoostedTrees] = (),
) -> tuple[tuple[Model, Sigmoid | Isotonic], ...]:
    """Refit without each fold and calibrate on it; scoring averages the members.

    ``train`` carries its stratified folds in ``calibration_fold``. ``members`` are models
    already fitted without each fold.
    """
    if not method:
        return ()
    fit = {"sigmoid": fit_sigmoid, "isotonic": fit_isotonic}[method]
    encoded = encoding.encode(train)

    def part(i: int) -> tuple[Model, Sigmoid | Isotonic]:
        model = members[i] if members else fit_model(encoded.where(F.col("calibration_fold") != i), build)
        held_out = decision_value(model, encoded.where(F.col("calibration_fold") == i), "value")
        return model, fit(held_out.select("value", "label"), "value")

    parallel = FITS_AT_ONCE if members else fits_at_once(build, train.count())
    return tuple(at_once([lambda i=i: part(i) for i in range(folds)], train.sparkSession, parallel))


# ---------------------------------------------------------------- attribution inputs


def linear_weights(model: Model) -> list[float] | None:
    if isinstance(model, LogisticRegressionModel):
        return [float(x) for x in model.coefficients.toArray()]
    return None


def impurity_weights(model: Model) -> list[float] | None:
    found = getattr(model, "featureImportances", None)
    return None if found is None else [float(x) for x in found.toArray()]


def background_means(encoded_sample: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """Mean of each model input over the reference sample."""
    values = encoded_sample.select(vector_to_array("features").alias("x"))
    row = values.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(names))]).first()
    return {n: row[f"m{i}"] for i, n in enumerate(names)}


# ---------------------------------------------------------------- persistence


def save_model(model: ChurnModel, folder: str, spark: SparkSession) -> None:
    """Spark models as Spark saves them, everything else as a one-row JSON table."""
    _save(model.base, f"{folder}/base", spark)
    calibrators = []
    for i, (member, calibrator) in enumerate(model.parts):
        _save(member, f"{folder}/member{i}", spark)
        if isinstance(calibrator, Isotonic):
            calibrator.model.write().overwrite().save(f"{folder}/calibrator{i}")
            calibrators.append(None)
        else:
            calibrators.append(asdict(calibrator))
    if model.encoding.rare_table is not None:
        model.encoding.rare_table.write.mode("overwrite").parquet(f"{folder}/rare_levels")
    facts = {
        "name": model.name, "class": type(model.base).__name__,
        "encoding": asdict(replace(model.encoding, rare_table=None)),
        "calibrators": calibrators, "threshold": model.threshold, "metrics": model.metrics,
        "background": model.background, "medians": model.medians,
    }
    spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(
        f"{folder}/facts"
    )


def _save(model: Model | BoostedTrees | GrownForest, folder: str, spark: SparkSession) -> None:
    if isinstance(model, BoostedTrees | GrownForest):
        model.save(folder, spark)
    else:
        model.write().overwrite().save(folder)


def load_model(folder: str, spark: SparkSession) -> ChurnModel:
    facts = json.loads(spark.read.parquet(f"{folder}/facts").first()["facts"])
    own = {c.__name__: c for c in (BoostedTrees, GrownForest)}.get(facts["class"])
    load = (lambda at: own.load(at, spark)) if own else _MODEL_CLASSES[facts["class"]].load
    raw = facts["encoding"]
    encoding = Encoding(
        tuple(raw["numeric"]), tuple(raw["categorical"]), raw["medians"], raw["means"], raw["deviations"],
        raw["modes"], {c: tuple(v) for c, v in raw["levels"].items()},
        {c: None if v is None else tuple(v) for c, v in raw["rare"].items()},
        spark.read.parquet(f"{folder}/rare_levels") if None in raw["rare"].values() else None,
    )
    parts = []
    for i, calibrator in enumerate(facts["calibrators"]):
        fitted = (
            Sigmoid(**calibrator)
            if calibrator
            else Isotonic(IsotonicRegressionModel.load(f"{folder}/calibrator{i}"))
        )
        parts.append((load(f"{folder}/member{i}"), fitted))
    return ChurnModel(
        facts["name"], encoding, load(f"{folder}/base"), tuple(parts), facts["threshold"],
        facts["metrics"], facts["background"], facts["medians"],
    )


def summarise_scores(scores: Sequence[float]) -> tuple[float, float]:
    """Mean and population deviation."""
    mean = sum(scores) / len(scores)
    return mean, math.sqrt(sum((x - mean) ** 2 for x in scores) / len(scores))


def model_inputs(
    df: DataFrame, columns: s.AccountColumns = s.ACCOUNTS
) -> tuple[list[str], list[str]]:
    """Numeric and categorical inputs without the helper columns of training."""
    helpers = {"label", "fold", "is_test", "calibration_fold"}
    numeric, categorical = feature_types(df, columns)
    return [c for c in numeric if c not in helpers], [c for c in categorical if c not in helpers]


def prepare_training_frame(
    features: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    test_size: float = 0.2,
    folds: int = 5,
    calibration_folds: int = 3,
    seed: int = SEED,
) -> DataFrame:
    """Features with ``label``, ``is_test`` and both fold numbers, materialised once."""
    ensure_checkpoint_dir(features.sparkSession)
    labelled = features.withColumn("label", F.col(columns.target).cast("int"))
    split = split_and_fold(labelled, "label", columns.id, test_size, folds * calibration_folds, seed)
    return (
        split.withColumn("calibration_fold", F.floor(F.col("fold") / folds).cast("int"))
        .withColumn("fold", F.pmod("fold", F.lit(folds)))
    )

