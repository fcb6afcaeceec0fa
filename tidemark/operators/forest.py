"""Random forests of many rows: every task holds all rows, binned, and grows a lot of the trees.

The method is that of Spark's classifier: Poisson bootstrap counts, a new draw of features
for every node, at most 32 bins a feature, gini impurity of weighted rows, and siblings of the
same class merged at the end. Spark's own passes shuffle a histogram for every node, feature
and block of rows; here no histogram leaves its task, and a pass over the rows serves a level of
a tree. The draws differ from Spark's, whose own depend on how rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.boosting import Tree, _blocks, _edges, _Layout, spread_keys
from tidemark.scratch import discard, keep

#: Rows whose entries are counted at once.
_COUNTED_ROWS = 1 << 17
#: Cumulative shares of 0, 1, 2, ... copies of a row.
_COPIES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class ForestRules:
    trees: int = 400
    depth: int = 12
    least_rows: int = 5
    bins: int = 32
    seed: int = 42


_FIELDS = {"feature": np.int32, "threshold": float, "left": np.int32, "right": np.int32, "value": float, "gain": float, "weight": float}
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, weight double"


@dataclass(frozen=True)
class ForestTree:
    """Node arrays as in ``Tree``; value is the positive share, weight that of a node's rows."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    weight: np.ndarray

    leaves_of = Tree.leaves_of


@dataclass(frozen=True)
class GrownForest:
    """A fitted model: probability = mean of the leaves' positive shares."""

    trees: tuple[ForestTree, ...]
    width: int

    def shares(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in self.trees:
            total += tree.value[tree.leaves_of(x)]
        return total / len(self.trees)

    def probability(self, features: str = "features") -> Column:
        """The positive probability of a vector column, in Arrow batches."""
        model = self

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(model.shares(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

        return score(vector_to_array(features))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  the name of Spark's own models
        """Mean over the trees of a feature's share of the weighted gain."""
        total = np.zeros(self.width)
        for t in self.trees:
            inner = t.feature >= 0
            own = np.bincount(t.feature[inner], t.gain[inner] * t.weight[inner], self.width)
            total += own / own.sum() if own.sum() > 0 else own
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def save(self, folder: str, spark: SparkSession) -> None:
        parts = [[np.full(len(t.feature), n), np.arange(len(t.feature)), *[getattr(t, f) for f in _FIELDS]] for n, t in enumerate(self.trees)]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        table = pd.DataFrame(dict(zip(["tree", "node", *_FIELDS], columns, strict=True)))
        spark.createDataFrame(table, NODE_SCHEMA).write.mode("overwrite").parquet(f"{folder}/nodes")
        spark.createDataFrame([(self.width,)], "width int").write.mode("overwrite").parquet(f"{folder}/facts")

    @staticmethod
    def load(folder: str, spark: SparkSession) -> GrownForest:
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{folder}/nodes").toArrow()
        return GrownForest(_trees_of(nodes), spark.read.parquet(f"{folder}/facts").first()["width"])


def _trees_of(nodes: pa.Table) -> tuple[ForestTree, ...]:
    columns = {name: nodes[name].to_numpy() for name in nodes.column_names}
    order = np.lexsort((columns["node"], columns["tree"]))
    edge = np.flatnonzero(np.diff(columns["tree"][order], prepend=-1, append=-1))
    return tuple(
        ForestTree(*[columns[f][order[lo:hi]].astype(kind) for f, kind in _FIELDS.items()]) for lo, hi in zip(edge[:-1], edge[1:], strict=True)
    )


def grown_tree(
    bins: np.ndarray, y: np.ndarray, sizes: np.ndarray, class_weights: tuple[float, float], rules: ForestRules, rng: np.random.Generator
) -> dict[str, np.ndarray]:
    """Node arrays (``cut`` is the last bin that goes left) of one tree over rows of ``bins``
    (row, feature), each level by one pass over the rows that are still in open nodes."""
    n, d = bins.shape
    flat, most, width = bins.reshape(-1), int(sizes.max()), max(1, math.ceil(math.sqrt(d)))
    w0, w1 = class_weights
    copies = np.searchsorted(_COPIES, rng.random(n, np.float32), "right").astype(np.uint8)
    rows = np.flatnonzero(copies)
    copies, y = copies[rows].astype(float), y[rows].astype(np.int64)
    slot = np.zeros(len(rows), np.int64)
    levels, open_nodes, n_nodes = [], np.zeros(1, np.int64), 1
    counts = np.array([np.bincount(y, copies, 2)])  # copies of both labels by node
    for depth in range(rules.depth + 1):
        k = len(counts)
        level = {
            "feature": np.full(k, -1), "cut": np.zeros(k, np.int64), "left": np.full(k, -1), "right": np.full(k, -1),
            "gain": np.zeros(k), "counts": counts,
        }
        levels.append(level)
        may = (counts.min(axis=1) > 0) & (counts.sum(axis=1) >= 2 * rules.least_rows) & (depth < rules.depth)
        open_nodes = np.flatnonzero(may)
        if not len(open_nodes):
            break
        place = np.full(k, -1)
        place[open_nodes] = np.arange(len(open_nodes))
        slot = place[slot]
        staying = slot >= 0
        rows, copies, y, slot = rows[staying], copies[staying], y[staying], slot[staying]
        drawn = np.sort(np.argpartition(rng.random((len(open_nodes), d), np.float32), width - 1, axis=1)[:, :width], axis=1)
        first = (np.arange(len(open_nodes))[:, None] * width + np.arange(width)) * most * 2
        sums = np.zeros(len(open_nodes) * width * most * 2)
        for lo in range(0, len(rows), _COUNTED_ROWS):
            own = slice(lo, lo + _COUNTED_ROWS)
            s = slot[own]
            at = drawn[s]
            at += rows[own, None] * d
            keys = first[s]
            keys += flat[at].astype(np.int64) * 2
            keys += y[own, None]
            sums += np.bincount(keys.ravel(), np.repeat(copies[own], width), len(sums))
        low = sums.reshape(len(open_nodes), width, most, 2).cumsum(axis=2)[:, :, :-1]
        whole = counts[open_nodes][:, None, None, :]
        high = whole - low
        mixed = lambda c: 2 * w0 * w1 * c[..., 0] * c[..., 1] / np.maximum(w0 * c[..., 0] + w1 * c[..., 1], 1e-300)
        gain = (mixed(whole) - mixed(low) - mixed(high)) / (w0 * whole[..., 0] + w1 * whole[..., 1])
        able = (low.sum(axis=-1) >= rules.least_rows) & (high.sum(axis=-1) >= rules.least_rows)
        gain = np.where(able, np.round(gain, 12), 0.0).reshape(len(open_nodes), -1)
        best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(open_nodes), np.int64)
        found = gain[np.arange(len(best)), best] if gain.shape[1] else np.zeros(len(best))
        split = np.flatnonzero(found > 0)
        if not len(split):
            break
        which, cut = best[split] // (most - 1), best[split] % (most - 1)
        inner = open_nodes[split]
        level["feature"][inner], level["cut"][inner], level["gain"][inner] = drawn[split, which], cut, found[split]
        level["left"][inner] = n_nodes + 2 * np.arange(len(split))
        level["right"][inner] = level["left"][inner] + 1
        n_nodes += 2 * len(split)
        counts = np.stack([low[split, which, cut], high[split, which, cut]], axis=1).reshape(-1, 2)
        after = np.full(len(open_nodes), -1)
        after[split] = 2 * np.arange(len(split))
        staying = after[slot] >= 0
        rows, copies, y, slot = rows[staying], copies[staying], y[staying], slot[staying]
        at = open_nodes[slot]
        slot = after[slot] + (flat[rows * d + level["feature"][at]] > level["cut"][at])
    return _merged(levels, class_weights)


def _merged(levels: list[dict[str, np.ndarray]], class_weights: tuple[float, float]) -> dict[str, np.ndarray]:
    """All levels as node arrays, where sibling leaves of the same class became their parent."""
    nodes = {name: np.concatenate([level[name] for level in levels]) for name in levels[0]}
    weighted = nodes.pop("counts") * np.array(class_weights)
    positive = weighted[:, 1] > weighted[:, 0]
    end = np.cumsum([len(level["feature"]) for level in levels])
    for lo, hi in zip([0, *end[:-1]][::-1], end[::-1], strict=True):
        inner = lo + np.flatnonzero(nodes["feature"][lo:hi] >= 0)
        left, right = nodes["left"][inner], nodes["right"][inner]
        same = (nodes["feature"][left] < 0) & (nodes["feature"][right] < 0) & (positive[left] == positive[right])
        nodes["feature"][inner[same]], nodes["gain"][inner[same]] = -1, 0.0
    leaf = nodes["feature"] < 0
    nodes["left"][leaf] = nodes["right"][leaf] = -1
    kept = np.zeros(len(leaf), bool)
    kept[0] = True
    for lo, hi in zip([0, *end[:-1]], end, strict=True):
        inner = lo + np.flatnonzero(kept[lo:hi] & ~leaf[lo:hi])
        kept[nodes["left"][inner]] = kept[nodes["right"][inner]] = True
    number = np.append(np.cumsum(kept) - 1, -1)  # -1 stays -1
    nodes["left"], nodes["right"] = number[nodes["left"]], number[nodes["right"]]
    total = weighted.sum(axis=1)
    nodes |= {"value": weighted[:, 1] / np.where(total > 0, total, 1.0), "weight": total}
    return {name: column[kept] for name, column in nodes.items()}


def fit_forest(rows: DataFrame, rules: ForestRules, label: str = "label", weight: str = "class_weight") -> GrownForest:
    """Fit a forest over a ``features`` vector column. All rows of a label have the same weight.

    Tasks are lots of trees; each reads all rows, a byte a feature."""
    spark = rows.sparkSession
    found = {int(r[0]): float(r[1]) for r in rows.groupBy(label).agg(F.max(weight)).collect()}
    class_weights = found.get(0, 1.0), found.get(1, 1.0)
    edges = _edges(rows, ["features"], rules.bins)["features"]
    sizes = np.array([len(e) + 1 for e in edges])
    d = len(sizes)
    layout = _Layout(sizes, np.arange(d), np.ones(d, int), sizes)
    inside = rows.withColumn("_whole", F.lit(True))
    stored = keep(_blocks(inside, label, "features", ["features"], ["_whole"], {"features": edges}, [layout]), "forest-blocks")
    n_lots = min(rules.trees, 2 * spark.sparkContext.defaultParallelism)
    keys = spread_keys(spark, n_lots)
    lot_of = {key: lot for lot, key in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, lot = [], None
        for batch in batches:
            for row in batch.to_pylist():
                n, lot = row["n"], lot_of[row["key"]]
                bins = np.frombuffer(row["bins"], np.uint8).reshape(d, n).T.copy()
                y = np.frombuffer(row["y"]).astype(np.uint8)
                parts.append((row["ids"][:8], n, bins, y))
        if lot is None:
            return
        parts.sort(key=lambda p: (p[0], p[1]))  # blocks arrive in any order
        bins, y = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
        parts.clear()
        for tree in range(lot, rules.trees, n_lots):
            nodes = grown_tree(bins, y, sizes, class_weights, rules, np.random.default_rng([rules.seed, tree]))
            cut = nodes.pop("cut")
            nodes["threshold"] = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(nodes["feature"], cut, strict=True)])
            n = len(cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, tree, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                 *[pa.array(nodes[f].astype(kind)) for f, kind in _FIELDS.items()]],
                ["tree", "node", *_FIELDS],
            )

    chosen = stored.select("n", "bins", "y", "ids", F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
    nodes = chosen.repartition(n_lots, "key").mapInArrow(run, NODE_SCHEMA).toArrow()
    discard(stored)
    return GrownForest(_trees_of(nodes), d)
