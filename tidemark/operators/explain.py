"""Attributions of a churn model and their rendering as reasons and actions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.numbers import exact_avg, round_half_up


def linear_contributions(
    values: Column, names: Sequence[str], coefficients: Sequence[float], background: Sequence[float]
) -> Column:
    """coefficient × (value − background mean) per input, as ``array<struct<feature, contribution>>``."""
    known = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.lit(float(c)).alias("weight"), F.lit(float(m)).alias("mean"))
            for n, c, m in zip(names, coefficients, background, strict=True)
        ]
    )
    return F.zip_with(
        values,
        known,
        lambda x, k: F.struct(
            k["feature"].alias("feature"), (k["weight"] * (x - k["mean"])).alias("contribution")
        ),
    )


def top_drivers(explained: DataFrame, id_column: str, k: int = 4, contributions: str = "contributions") -> DataFrame:
    """The k largest contributions per customer with direction, reason and action.

    All contributions of a customer sit in one row, so they are ranked there.
    """
    ordered = F.array_sort(
        F.transform(
            contributions,
            lambda c: F.struct(
                (-F.abs(c["contribution"])).alias("order"),
                c["feature"].alias("feature"),
                c["contribution"].alias("contribution"),
            ),
        )
    )
    rows = explained.select(id_column, F.posexplode(F.slice(ordered, 1, k)).alias("rank", "driver"))
    feature, contribution = F.col("driver.feature"), F.col("driver.contribution")
    return rows.select(
        id_column,
        (F.col("rank") + 1).alias("rank"),
        feature.alias("feature"),
        round_half_up(contribution, 5).alias("contribution"),
        tx.driver_direction(contribution).alias("direction"),
        tx.driver_reason(feature, contribution).alias("reason"),
        tx.driver_action(feature, contribution).alias("recommended_action"),
    )


def packed_drivers(drivers: DataFrame, id_column: str) -> DataFrame:
    """Back to one row per customer: ``top_drivers array<struct>`` in rank order (k each)."""
    fields = ["rank", "feature", "contribution", "direction", "reason", "recommended_action"]
    listed = F.array_sort(F.collect_list(F.struct(*fields)))
    return drivers.groupBy(id_column).agg(listed.alias("top_drivers"))


def global_importance(
    explained: DataFrame,
    top_n: int = 20,
    contributions: str = "contributions",
    method: str = "mean_abs_contribution",
) -> DataFrame:
    """Mean absolute contribution per input, largest first."""
    return (
        explained.select(F.inline(contributions))
        .groupBy("feature")
        .agg(exact_avg(F.abs("contribution"), 10).alias("importance"))
        .withColumn("method", F.lit(method))
        .orderBy(F.desc("importance"), "feature")
        .limit(top_n)
    )


def model_importance(spark, names: Sequence[str], weights: Sequence[float], top_n: int = 20) -> DataFrame:
    """Fallback ranking without attributions: |coefficient| or impurity importance."""
    rows = [(n, abs(float(w)), "model_importance") for n, w in zip(names, weights, strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double, method string")
    return table.orderBy(F.desc("importance"), "feature").limit(top_n)


def background_sample(df: DataFrame, key: str, n: int = 200, seed: int = 42) -> DataFrame:
    """A repeatable reference sample, ordered by a hash of the key."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def tree_contributions(
    df: DataFrame, nodes: Mapping[int, Mapping[str, np.ndarray]], weights: Sequence[float],
    id_column: str, names: Sequence[str], features: str = "features",
) -> DataFrame:
    """Path attributions of a tree ensemble: the change of the node value along each path.

    ``nodes`` holds, per tree, arrays of feature, threshold, children and value; an
    ensemble is model-sized. Spark partitions the rows, each batch walks the trees.
    """
    from pyspark.ml.functions import vector_to_array

    arrays = df.select(id_column, vector_to_array(features).alias("x"))
    trees = [(nodes[t], w) for t, w in zip(sorted(nodes), weights, strict=True)]
    columns = list(names)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.array(batch["x"].tolist(), dtype=float)
            rows = np.arange(len(x))
            total = np.zeros_like(x)
            for tree, weight in trees:
                at = np.zeros(len(x), dtype=int)
                while True:
                    split = tree["feature"][at]
                    moving = split >= 0
                    if not moving.any():
                        break
                    column = np.where(moving, split, 0)
                    left = x[rows, column] <= tree["threshold"][at]
                    after = np.where(moving, np.where(left, tree["left"][at], tree["right"][at]), at)
                    step = weight * (tree["value"][after] - tree["value"][at])
                    np.add.at(total, (rows[moving], column[moving]), step[moving])
                    at = after
            yield pd.DataFrame(
                {
                    id_column: batch[id_column],
                    "contributions": [
                        [{"feature": c, "contribution": float(v)} for c, v in zip(columns, row, strict=True)]
                        for row in total
                    ],
                }
            )

    id_type = df.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, contributions array<struct<feature:string,contribution:double>>"
    return arrays.mapInPandas(explain, schema)


@dataclass(frozen=True)
class ShapleyTree:
    """Node arrays of one tree: feature is -1 at leaves, cover is the training weight of a node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def longest(self) -> int:
        """The most features on a path."""
        most, stack = 0, [(0, frozenset())]
        while stack:
            at, seen = stack.pop()
            if self.feature[at] < 0:
                most = max(most, len(seen))
            else:
                seen = seen | {int(self.feature[at])}
                stack += [(self.left[at], seen), (self.right[at], seen)]
        return most


def shapley_values(x: np.ndarray, trees: Sequence[ShapleyTree]) -> tuple[np.ndarray, float]:
    """Exact Shapley values of the sum of trees for every row, and the trees' expected value.

    A feature that is not in a coalition follows both branches by their cover. For a leaf with
    features j on its path, followed by o_j of the row (0 or 1) and by a share z_j of the
    cover, feature i gets value (o_i - z_i) times the integral over t of the product of
    z_j (1 - t) + o_j t over the other features; the subset weights are that integral's
    coefficients. Its degree is below the number of features, so a Gauss-Legendre rule of
    half as many points is exact. Leaves share the products of their common path: one walk of
    a tree multiplies on the way down and adds up on the way back, so the cost per row and
    edge is the number of points.
    """
    total = np.zeros((x.shape[1], len(x)))
    expected = 0.0
    for tree in trees:
        leaf = tree.feature < 0
        expected += float((tree.value[leaf] * tree.cover[leaf]).sum() / tree.cover[0])
        points, weights = _unit_rule(max((tree.longest() + 1) // 2, 1))
        walk = _ShapleyWalk(tree, points, weights)
        for lo in range(0, len(x), _WALKED_ROWS):
            walk.add(x[lo : lo + _WALKED_ROWS], total[:, lo : lo + _WALKED_ROWS])
    return total.T, expected


class _ShapleyWalk:
    """One walk of a tree for some rows; arrays are (point, row).

    ``held`` has, for every feature on the path, the factor of the last edge that splits on
    it, its share and who follows, and the sum of the leaves below a later edge of the
    feature, which that edge answers for."""

    def __init__(self, tree: ShapleyTree, points: np.ndarray, weights: np.ndarray):
        self.feature, self.left, self.right = tree.feature.tolist(), tree.left.tolist(), tree.right.tolist()
        self.value, self.cover = tree.value.tolist(), tree.cover.tolist()
        self.inner = np.flatnonzero(tree.feature >= 0)
        self.split = tree.feature[self.inner], tree.threshold[self.inner]
        self.place = dict(zip(self.inner.tolist(), range(len(self.inner)), strict=True))
        self.points, self.others, self.weights = points[:, None], 1 - points[:, None], weights

    def add(self, x: np.ndarray, total: np.ndarray) -> None:
        """Add the values of rows ``x`` to ``total`` (feature, row)."""
        if self.feature[0] < 0:
            return
        self.goes_left = (x[:, self.split[0]] <= self.split[1]).T.astype(float)
        self.total, self.held = total, {}
        self.below(0, np.ones((len(self.weights), len(x))))

    def below(self, at: int, product: np.ndarray) -> np.ndarray:
        """The sum of value times product over the leaves below an inner node."""
        f = self.feature[at]
        last = self.held.get(f)
        rest = product if last is None else product / last[0]
        goes_left, whole = self.goes_left[self.place[at]], None
        leaves = np.zeros(goes_left.shape)
        for child in (self.left[at], self.right[at]):
            share = self.cover[child] / self.cover[at]
            followed = goes_left if child == self.left[at] else 1 - goes_left
            if last is not None:
                share, followed = share * last[1], followed * last[2]
            factor = self.points * followed
            factor += share * self.others
            if self.feature[child] < 0:
                if self.value[child] == 0:
                    continue
                leaves += self.value[child] * (followed - share)
                factor *= rest
                factor *= self.value[child]
                found = factor
            else:
                own = [factor, share, followed, None]
                self.held[f] = own
                found = self.below(child, rest * factor)
                mine = found if own[3] is None else found - own[3]
                self.total[f] += (followed - share) * (self.weights @ (mine / factor))
            whole = found if whole is None else whole + found
        if leaves.any():
            self.total[f] += leaves * (self.weights @ rest)
        if whole is None:
            whole = np.zeros_like(product)
        if last is None:
            self.held.pop(f, None)
        else:
            self.held[f] = last
            last[3] = whole if last[3] is None else last[3] + whole
        return whole


@lru_cache(maxsize=64)
def _unit_rule(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points and weights on [0, 1]; exact up to degree 2 n - 1."""
    points, weights = np.polynomial.legendre.leggauss(n)
    return (points + 1) / 2, weights / 2


#: Rows explained at once, and rows of one walk, whose arrays (times points) stay in a core's cache.
_EXPLAINED_ROWS, _WALKED_ROWS = 4096, 1024


def shapley_contributions(
    df: DataFrame, trees: Sequence[ShapleyTree], base: float, id_column: str, names: Sequence[str],
    features: str = "features",
) -> DataFrame:
    """Per row: id, contributions, base_value and prediction; contributions sum to their difference.

    The trees are model-sized and broadcast; Spark partitions the rows.
    """
    from pyspark.ml.functions import vector_to_array

    shared = df.sparkSession.sparkContext.broadcast((list(trees), float(base)))
    columns = pa.array(list(names), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, _EXPLAINED_ROWS):
                part = batch.slice(lo, _EXPLAINED_ROWS)
                n = part.num_rows
                x = np.asarray(part.column(1).flatten(), float).reshape(n, -1)
                values, expected = shapley_values(x, own)
                width = values.shape[1]
                each = pa.array(np.tile(np.arange(width), n))
                listed = pa.StructArray.from_arrays([columns.take(each), pa.array(values.ravel())], ["feature", "contribution"])
                cells = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), listed)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), cells, pa.array(np.full(n, start + expected)), pa.array(start + _predictions(x, own))],
                    [id_column, "contributions", "base_value", "prediction"],
                )

    id_type = df.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {id_type}, contributions array<struct<feature:string,contribution:double>>, "
        "base_value double, prediction double"
    )
    # A row takes milliseconds where trees are many: few rows are dealt out to all cores as well.
    spread = df.select(id_column, vector_to_array(features).alias("x")).repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, schema)


def _predictions(x: np.ndarray, trees: Sequence[ShapleyTree]) -> np.ndarray:
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for t in trees:
        at = np.zeros(len(x), int)
        while (moving := t.feature[at] >= 0).any():
            low = x[rows, np.maximum(t.feature[at], 0)] <= t.threshold[at]
            at = np.where(moving, np.where(low, t.left[at], t.right[at]), at)
        total += t.value[at]
    return total


def tree_nodes(saved_nodes: DataFrame, classification: bool) -> dict[int, dict[str, np.ndarray]]:
    """Node arrays per tree from the node table that a saved tree model consists of.

    A classification node's value is its share of the positive class, a regression
    node's its prediction. Only continuous splits occur (inputs are one-hot encoded).
    """
    node = F.col("nodeData") if "nodeData" in saved_nodes.columns else F.struct("*")
    tree = F.col("treeID") if "treeID" in saved_nodes.columns else F.lit(0)
    inner = F.col("n.leftChild") >= 0
    stats = F.col("n.impurityStats")
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    limit = F.coalesce(F.try_element_at("n.split.leftCategoriesOrThreshold", F.lit(1)), F.lit(0.0))
    # Columns of numbers: a forest has millions of nodes, a row object of each would fill the driver.
    table = (
        saved_nodes.select(tree.alias("tree"), node.alias("n"))
        .select(
            "tree", F.col("n.id").alias("id"),
            F.when(inner, F.col("n.split.featureIndex")).otherwise(-1).alias("feature"),
            F.when(inner, limit).otherwise(0.0).alias("threshold"),
            F.col("n.leftChild").alias("left"), F.col("n.rightChild").alias("right"),
            # A classification node's stats are weighted counts, a regression node's begin with one.
            (stats[1] / weight if classification else F.col("n.prediction")).alias("value"),
            (weight if classification else stats[0]).alias("cover"),
        )
        .orderBy("tree", "id").drop("id").toArrow()
    )
    names = ("feature", "threshold", "left", "right", "value", "cover")
    columns = {name: table[name].to_numpy() for name in names}
    trees, starts = np.unique(table["tree"].to_numpy(), return_index=True)
    ends = [*starts[1:], table.num_rows]
    return {
        int(t): {name: column[lo:hi] for name, column in columns.items()}
        for t, lo, hi in zip(trees, starts, ends, strict=True)
    }
