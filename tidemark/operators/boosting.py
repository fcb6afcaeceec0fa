"""Gradient boosting of histogram trees, grown depth-wise or leaf-wise by distributed passes.

Rows are binned once and stay where they are, in blocks of arrays that Spark partitions;
features of few bins share a byte. A pass lets every block walk the trees grown so far and
counts gradients, Hessians and rows by (open node, feature, bin); tasks by (fit, lot of
features) add them up, hold them while their tree grows and return their best splits, the only
thing the driver sees. A split's smaller child is counted, the larger one is its parent minus
it. Any number of fits (folds, the full fit, candidates with rules of their own) share every
pass: a row takes part in the fits whose ``inside`` column is true for it.

Trees grow best-first: of all open leaves the one with the largest gain is split, up to
``max_leaves``. A pass evaluates all leaves that best-first growth over the known gains would
split, so a tree needs as many passes as it is deep, and the replay at the end is exact.
Depth-wise growth is the same with a depth limit and no limit of leaves.

Rows and columns are sampled by hash of (id, round), so a lost block is rebuilt as it was.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.scratch import discard, keep
from tidemark.session import ensure_checkpoint_dir

#: Rows a task holds, binned; one block is at most an Arrow batch.
ROWS_PER_TASK = 100_000
#: Rounds between two checkpoints of the margins.
CHECKPOINT_EVERY = 50


@dataclass(frozen=True)
class Rules:
    """How one fit grows its trees."""

    rounds: int = 400
    rate: float = 0.05
    max_depth: int | None = None
    max_leaves: int | None = None
    least_hessian: float = 1e-3
    least_rows: int = 1
    penalty: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = 255
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One model to fit: its features column, the boolean column of its rows, its rules."""

    features: str
    inside: str
    rules: Rules


@dataclass(frozen=True)
class Tree:
    """Node arrays; feature is -1 at leaves. A row goes left if its value <= threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray
    rows: np.ndarray

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while (moving := self.feature[at] >= 0).any():
            low = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(moving, np.where(low, self.left[at], self.right[at]), at)
        return at


_TREE_FIELDS = ("feature", "threshold", "left", "right", "value", "gain", "gradient", "hessian", "rows")
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, "
    "gradient double, hessian double, rows long"
)


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: probability = sigmoid(base + sum of leaf values)."""

    base: float
    trees: tuple[Tree, ...]
    width: int
    rules: Rules = field(default_factory=Rules)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.value[tree.leaves_of(x)]
        return total

    def probability(self, features: str = "features") -> Column:
        """The positive probability of a vector column, in Arrow batches."""
        model = self

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(1.0 / (1.0 + np.exp(-model.margins(np.stack(x.to_numpy())))))

        return score(vector_to_array(features))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  the name of Spark's own models
        """Share of the total gain by feature."""
        total = np.zeros(self.width)
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(total, t.feature[inner], t.gain[inner])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node, with the sums its value was made of."""
        rows = [
            (n, i, *[getattr(t, f)[i].item() for f in _TREE_FIELDS])
            for n, t in enumerate(self.trees)
            for i in range(len(t.feature))
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, folder: str, spark: SparkSession) -> None:
        self.node_table(spark).write.mode("overwrite").parquet(f"{folder}/nodes")
        facts = spark.createDataFrame([(self.base, self.width)], "base double, width int")
        facts.write.mode("overwrite").parquet(f"{folder}/facts")

    @staticmethod
    def load(folder: str, spark: SparkSession) -> BoostedTrees:
        facts = spark.read.parquet(f"{folder}/facts").first()
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{folder}/nodes").orderBy("tree", "node").toPandas()
        trees = tuple(
            Tree(*[part[f].to_numpy() for f in _TREE_FIELDS]) for _, part in nodes.groupby("tree", sort=True)
        )
        return BoostedTrees(facts["base"], trees, facts["width"])


# ---------------------------------------------------------------- bins and blocks


def _edges(rows: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[np.ndarray]]:
    """Cut points of every feature of every features column, from one aggregation."""
    shares = [(k + 1) / bins for k in range(bins)]
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), vector_to_array(c).alias("values")) for c in columns]
    )
    each = rows.select(F.inline(listed)).select("column", F.posexplode("values").alias("feature", "value"))
    found = each.groupBy("column", "feature").agg(F.percentile_approx("value", shares, 10_000).alias("cuts")).collect()
    out: dict[str, list] = {c: [] for c in columns}
    for r in sorted(found, key=lambda r: (r["column"], r["feature"])):
        out[r["column"]].append(np.unique(np.array(r["cuts"], float))[:-1])
    return out


@dataclass(frozen=True)
class _Layout:
    """Where the bins of a features column are: features of few bins share a byte.

    A feature's bin is byte // stride % size; a byte has ``spans`` values."""

    sizes: np.ndarray
    byte: np.ndarray
    stride: np.ndarray
    spans: np.ndarray

    @staticmethod
    def of(sizes: Sequence[int]) -> _Layout:
        byte, stride, spans = np.zeros(len(sizes), int), np.ones(len(sizes), int), [1]
        for f in np.argsort(sizes, kind="stable"):
            if spans[-1] * sizes[f] > 256:
                spans.append(1)
            byte[f], stride[f] = len(spans) - 1, spans[-1]
            spans[-1] *= int(sizes[f])
        return _Layout(np.array(sizes), byte, stride, np.array(spans))

    def packed(self, x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(self.spans), len(x)), np.uint8)
        for f, at in enumerate(edges):
            out[self.byte[f]] += (np.searchsorted(at, x[:, f]) * self.stride[f]).astype(np.uint8)
        return out

    def part(self, k: int, n: int) -> _Part:
        """The features of the k-th of n lots of bytes."""
        own = np.array_split(np.arange(len(self.spans)), n)[k]
        features = np.flatnonzero(np.isin(self.byte, own))
        sizes = self.sizes[features]
        return _Part(own, features, sizes, np.cumsum(sizes) - sizes)


@dataclass(frozen=True)
class _Part:
    """Some bytes of a layout, and their features with the places of their bins side by side."""

    bytes: np.ndarray
    features: np.ndarray
    sizes: np.ndarray
    offsets: np.ndarray

    @property
    def width(self) -> int:
        return int(self.sizes.sum())


def _blocks(rows: DataFrame, label: str, key: str, columns: Sequence[str], insides: Sequence[str], edges, layouts) -> DataFrame:
    """Binned rows, one row per block of them."""
    cuts = [edges[c] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            binned = [
                layout.packed(np.asarray(batch.column(2 + k).flatten()).reshape(n, -1), own)
                for k, (layout, own) in enumerate(zip(layouts, cuts, strict=True))
            ]
            inside = np.array([batch.column(2 + len(columns) + k).to_numpy(zero_copy_only=False) for k in range(len(insides))])
            y = np.asarray(batch.column(1)).astype(np.float64)
            ids = np.asarray(batch.column(0)).astype(np.int64)
            cells = [np.concatenate(binned).tobytes(), y.tobytes(), ids.tobytes(), inside.astype(np.uint8).tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), *[pa.array([c], pa.binary()) for c in cells]], ["n", "bins", "y", "ids", "inside"]
            )

    chosen = rows.select(
        F.xxhash64(key).alias("_id"), F.col(label).cast("double").alias("_y"),
        *[vector_to_array(c).alias(f"_x{k}") for k, c in enumerate(columns)],
        *[F.coalesce(c, F.lit(False)).alias(f"_in{k}") for k, c in enumerate(insides)],
    )
    return chosen.mapInArrow(run, "n long, bins binary, y binary, ids binary, inside binary")


@dataclass
class _Block:
    bins: np.ndarray  # byte of all layouts, row
    y: np.ndarray
    ids: np.ndarray
    inside: np.ndarray  # fit, row
    margin: np.ndarray  # fit, row

    @staticmethod
    def of(row, insides: Sequence[int], base: np.ndarray) -> _Block:
        n = row["n"]
        inside = np.frombuffer(row["inside"], np.uint8).reshape(-1, n).astype(bool)[list(insides)]
        return _Block(
            np.frombuffer(row["bins"], np.uint8).reshape(-1, n),
            np.frombuffer(row["y"], np.float64),
            np.frombuffer(row["ids"], np.int64).view(np.uint64),
            inside,
            np.repeat(base[:, None], n, axis=1),
        )

    @staticmethod
    def joined(parts: Iterator[_Block]) -> list[_Block]:
        """All rows of some blocks as one block."""
        parts = list(parts)
        join = lambda f, axis: np.concatenate([getattr(p, f) for p in parts], axis=axis)
        return [_Block(join("bins", 1), join("y", 0), join("ids", 0), join("inside", 1), join("margin", 1))] if parts else []


def _draw(x: np.ndarray | int, seed: int) -> np.ndarray:
    """A repeatable number in [0, 1) for every integer."""
    with np.errstate(over="ignore"):
        z = (np.asarray(x, np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(31)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(29)
    return (z >> np.uint64(11)).astype(np.float64) / (1 << 53)


@dataclass(frozen=True)
class _Walk:
    """One fit's tree of a round; ``slot`` marks the nodes to count.

    ``after`` is the next node by (node, value of the node's byte), a leaf follows itself."""

    byte: np.ndarray
    after: np.ndarray
    steps: int
    slot: np.ndarray
    value: np.ndarray

    def nodes_of(self, block: _Block) -> np.ndarray:
        rows = np.arange(len(block.y))
        if not self.steps:
            return np.zeros(len(rows), np.int64)
        flat, after = block.bins.reshape(-1), self.after.reshape(-1)
        first = self.byte * len(rows)
        at = self.after[0][block.bins[self.byte[0]]].astype(np.int64)
        for _ in range(self.steps - 1):
            at = after[at * 256 + flat[first[at] + rows]].astype(np.int64)
        return at


def _walk(first: int, layout: _Layout, feature, cut, left, right, slots: dict[int, int], value) -> _Walk:
    """The walk of node arrays; ``first`` is where the layout's bytes start in a block."""
    n = len(feature)
    byte, after = np.full(n, first), np.repeat(np.arange(n)[:, None], 256, axis=1)
    depth, slot = np.zeros(n, int), np.full(n, -1)
    for i in range(n):  # children come after their parent
        if feature[i] >= 0:
            f = feature[i]
            byte[i] = first + layout.byte[f]
            low = np.arange(256) // layout.stride[f] % layout.sizes[f] <= cut[i]
            after[i] = np.where(low, left[i], right[i])
            depth[[left[i], right[i]]] = depth[i] + 1
    for node, s in slots.items():
        slot[node] = s
    return _Walk(byte, after.astype(np.int32), int(depth.max()), slot, np.asarray(value, float))


def _histograms(
    block: _Block, k: int, walk: _Walk, n_slots: int, layout: _Layout, first: int, parts: Sequence[_Part], drawn: np.ndarray | None
) -> list[np.ndarray]:
    """For every lot of bytes [gradient, Hessian, rows] by (slot, bin of a feature)."""
    slot = walk.slot[walk.nodes_of(block)]
    taking = block.inside[k] & (slot >= 0)
    if drawn is not None:
        taking &= drawn
    row = np.flatnonzero(taking)
    whole = len(row) == len(slot)
    p = 1.0 / (1.0 + np.exp(-block.margin[k, row]))
    g, h, s = p - block.y[row], p * (1 - p), slot[row]
    out = []
    for part in parts:
        sums = np.zeros((3, n_slots, part.width))
        for b in part.bytes:
            own, span = block.bins[first + b], int(layout.spans[b])
            keys = s * span + (own if whole else own[row])
            found = np.array([
                np.bincount(keys, g, n_slots * span), np.bincount(keys, h, n_slots * span),
                np.bincount(keys, minlength=n_slots * span),
            ])
            for f in np.flatnonzero(layout.byte[part.features] == b):
                size, stride, lo = part.sizes[f], layout.stride[part.features[f]], part.offsets[f]
                sums[:, :, lo : lo + size] = found.reshape(3, n_slots, -1, size, stride).sum(axis=(2, 4))
        out.append(sums)
    return out


# ---------------------------------------------------------------- growing


def _may_split(rules: Rules, depth: int, total: np.ndarray) -> bool:
    return (
        (rules.max_depth is None or depth < rules.max_depth)
        and total[1] >= 2 * rules.least_hessian
        and total[2] >= 2 * max(rules.least_rows, 1)
    )


@dataclass(frozen=True)
class _Split:
    gain: float
    feature: int
    cut: int
    low: np.ndarray

    @property
    def order(self) -> tuple:
        return -self.gain, self.feature, self.cut


def _best_split(rules: Rules, part: _Part, usable: np.ndarray, sums: np.ndarray, total: np.ndarray, depth: int) -> _Split | None:
    """The best split among a part's features, the first on ties."""
    if not part.width or not _may_split(rules, depth, total):
        return None
    start, feature_of = np.repeat(part.offsets, part.sizes), np.repeat(np.arange(len(part.sizes)), part.sizes)
    running = np.cumsum(sums, axis=1)
    before = np.concatenate([np.zeros((3, 1)), running], axis=1)[:, start]
    low = running - before
    high = total[:, None] - low
    able = usable & (low[1] >= rules.least_hessian) & (high[1] >= rules.least_hessian)
    able &= (low[2] >= max(rules.least_rows, 1)) & (high[2] >= max(rules.least_rows, 1))
    if not able.any():
        return None
    score = lambda t: t[0] ** 2 / (t[1] + rules.penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        # Rounded: equal splits stay equal however the sums were added up.
        gain = np.where(able, np.round(score(low) + score(high) - score(total), 9), -np.inf)
    best = int(np.argmax(gain))
    if not gain[best] > 0:
        return None
    return _Split(float(gain[best]), int(part.features[feature_of[best]]), best - int(start[best]), low[:, best].copy())


@dataclass(frozen=True)
class _Ask:
    """A node whose histogram a pass counts: the root, or the smaller child of ``parent``,
    whose sibling is the parent minus it. ``totals`` has the sums of both children."""

    node: int
    depth: int
    parent: int | None = None
    sibling: int | None = None
    totals: tuple[np.ndarray, ...] = ()


#: node, its sums where they were not known, its best split
_Found = list[tuple[int, np.ndarray, "_Split | None"]]


class _Grower:
    """One fit's tree of one round, grown best-first over evaluated nodes."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.nodes: list[dict] = []
        self._add(0, np.zeros(3))

    def _add(self, depth: int, total: np.ndarray) -> int:
        self.nodes.append({"depth": depth, "total": total, "gain": 0.0, "left": -1})
        return len(self.nodes) - 1

    def evaluated(self, found: _Found) -> None:
        for i, total, split in found:
            self.nodes[i]["total"] = total
            if split is not None:
                self.nodes[i] |= {"gain": split.gain, "feature": split.feature, "cut": split.cut, "low": split.low}

    def replay(self) -> tuple[list[int], list[int]]:
        """The nodes best-first growth splits, by known gains, and those without children yet."""
        open_nodes = [(-n["gain"], i) for i, n in enumerate(self.nodes[:1]) if n["gain"] > 0]
        heapq.heapify(open_nodes)
        split, fresh = [], []
        limit = (self.rules.max_leaves or 1 << 30) - 1
        while open_nodes and len(split) < limit:
            _, i = heapq.heappop(open_nodes)
            split.append(i)
            if self.nodes[i]["left"] < 0:
                fresh.append(i)
                continue
            for child in (self.nodes[i]["left"], self.nodes[i]["right"]):
                if self.nodes[child]["gain"] > 0:
                    heapq.heappush(open_nodes, (-self.nodes[child]["gain"], child))
        return split, fresh

    def open_up(self, i: int) -> _Ask | None:
        """Make a node's children; what a pass must count for them, if anything."""
        node = self.nodes[i]
        low, high, depth = node["low"], node["total"] - node["low"], node["depth"] + 1
        node["left"], node["right"] = left, right = self._add(depth, low), self._add(depth, high)
        if not (_may_split(self.rules, depth, low) or _may_split(self.rules, depth, high)):
            return None
        if low[2] <= high[2]:
            return _Ask(left, depth, i, right, (low, high))
        return _Ask(right, depth, i, left, (high, low))

    def finished(self, edges: list[np.ndarray]) -> tuple[Tree, np.ndarray]:
        """The tree of the replayed splits, and the bin cuts of its nodes."""
        split = set(self.replay()[0])
        order, at = [0], {0: 0}
        for i in order:
            if i in split:
                for child in (self.nodes[i]["left"], self.nodes[i]["right"]):
                    at[child] = len(order)
                    order.append(child)
        r = self.rules
        inner = [i in split for i in order]
        pick = lambda key, other: [self.nodes[i][key] if s else other for i, s in zip(order, inner, strict=True)]
        feature, cut = np.array(pick("feature", -1)), np.array(pick("cut", 0))
        total = np.array([self.nodes[i]["total"] for i in order])
        value = np.where(inner, 0.0, -r.rate * total[:, 0] / np.maximum(total[:, 1] + r.penalty, 1e-12))
        threshold = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut, strict=True)])
        left = np.array([at[self.nodes[i]["left"]] if s else -1 for i, s in zip(order, inner, strict=True)])
        right = np.array([at[self.nodes[i]["right"]] if s else -1 for i, s in zip(order, inner, strict=True)])
        tree = Tree(
            feature, threshold, left, right, value, np.array(pick("gain", 0.0)), total[:, 0], total[:, 1],
            total[:, 2].astype(np.int64),
        )
        return tree, cut


@dataclass(frozen=True)
class _Plan:
    """What growing needs besides the rows: for every fit its features column and rules, for
    every features column its cuts and the layout of its bins in a block's bytes."""

    column: np.ndarray
    rules: list[Rules]
    edges: list[list[np.ndarray]]
    layouts: list[_Layout]

    @property
    def rounds(self) -> int:
        return max(r.rounds for r in self.rules)

    def first(self, k: int) -> int:
        """Where the bytes of a fit's features column start."""
        return sum(len(layout.spans) for layout in self.layouts[: self.column[k]])

    def layout(self, k: int) -> _Layout:
        return self.layouts[self.column[k]]

    def of_fit(self, k: int) -> _Plan:
        return _Plan(self.column[k : k + 1], self.rules[k : k + 1], self.edges, self.layouts)

    def count(self, block: _Block, walks: dict[int, _Walk], asked: dict[int, list[_Ask]], turn: int, lots: int):
        """The histograms of a walk's marked nodes in a block: (fit, lot of bytes, sums)."""
        draws: dict[tuple, np.ndarray | None] = {}
        for k, asks in asked.items():
            rule = self.rules[k]
            if (rule.seed, rule.row_share) not in draws:
                few = rule.row_share < 1
                draws[rule.seed, rule.row_share] = _draw(block.ids, rule.seed + 7919 * (turn + 1)) < rule.row_share if few else None
            layout = self.layout(k)
            parts = [layout.part(lot, lots) for lot in range(lots)]
            drawn = draws[rule.seed, rule.row_share]
            found = _histograms(block, k, walks[k], len(asks), layout, self.first(k), parts, drawn)
            yield from ((k, lot, sums) for lot, sums in enumerate(found))

    def evaluate(
        self, k: int, lot: int, lots: int, turn: int, asks: list[_Ask], sums: np.ndarray, held: dict[int, np.ndarray]
    ) -> tuple[dict[int, np.ndarray], _Found]:
        """The best splits of asked nodes and their siblings among a lot's features.

        ``held`` has the histograms of open nodes, which the first result carries on."""
        rule, layout = self.rules[k], self.layout(k)
        part, d = layout.part(lot, lots), len(layout.sizes)
        drawn = _draw(np.arange(d), rule.seed + 104_729 * (turn + 1)) < rule.column_share
        drawn = drawn if drawn.any() else np.ones(d, bool)
        usable = np.repeat(drawn[part.features], part.sizes)
        usable[part.offsets + part.sizes - 1] = False
        held, found = dict(held), []
        for slot, ask in enumerate(asks):
            own = sums[:, slot]
            if ask.parent is None:
                total = own[:, : part.sizes[0]].sum(axis=1) if part.width else np.zeros(3)
                nodes = [(ask.node, own, total)]
            else:
                whole = held.pop(ask.parent)
                nodes = [(ask.node, own, ask.totals[0]), (ask.sibling, whole - own, ask.totals[1])]
            for node, each, total in nodes:
                found.append((node, total, _best_split(rule, part, usable, each, total, ask.depth)))
                held[node] = each
        return held, found

    def grow(
        self, turn: int, evaluated: Callable[[dict[int, _Walk], dict[int, list[_Ask]]], dict[int, _Found]]
    ) -> tuple[list[Tree | None], dict[int, _Walk]]:
        """The trees of one round and the walks that add them to the margins.

        ``evaluated`` returns the best splits over all rows of what a fit asks for."""
        growers = {k: _Grower(rule) for k, rule in enumerate(self.rules) if turn < rule.rounds}
        asked = {k: [_Ask(0, 0)] for k in growers}
        while asked:
            walks = {k: self._walk_of(k, growers[k], asks) for k, asks in asked.items()}
            for k, found in evaluated(walks, asked).items():
                growers[k].evaluated(found)
            asked = {}
            for k, grower in growers.items():
                # Nodes whose children need no histogram may free others in the replay.
                while fresh := grower.replay()[1]:
                    if asks := [ask for i in fresh if (ask := grower.open_up(i)) is not None]:
                        asked[k] = asks
                        break
        trees: list[Tree | None] = [None] * len(self.rules)
        walks = {}
        for k, grower in growers.items():
            trees[k], cut = grower.finished(self.edges[self.column[k]])
            t = trees[k]
            walks[k] = _walk(self.first(k), self.layout(k), t.feature, cut, t.left, t.right, {}, t.value)
        return trees, walks

    def _walk_of(self, k: int, grower: _Grower, asks: list[_Ask]) -> _Walk:
        get = lambda key, fill: [n[key] if n["left"] >= 0 else fill for n in grower.nodes]
        slots = {ask.node: s for s, ask in enumerate(asks)}
        return _walk(
            self.first(k), self.layout(k), get("feature", -1), get("cut", 0), get("left", -1), get("right", -1), slots, []
        )


def _best_of_lots(lots: Sequence[_Found]) -> _Found:
    """One split per node of what the lots found; sums of a root are the first lot's."""
    out = []
    for each in zip(*lots, strict=True):
        splits = [split for _, _, split in each if split is not None]
        out.append((each[0][0], each[0][1], min(splits, key=lambda s: s.order) if splits else None))
    return out


def _moved(block: _Block, last: dict[int, _Walk]) -> _Block:
    margin = block.margin.copy()
    for k, walk in last.items():
        margin[k] += walk.value[walk.nodes_of(block)]
    return _Block(block.bins, block.y, block.ids, block.inside, margin)


def _fit_in_passes(stored: DataFrame, plan: _Plan, inside: list[int], base: np.ndarray, parts: int) -> list[list[Tree]]:
    """All fits together over blocks spread through the cluster, one job per pass.

    A pass adds up histograms by (fit, lot of bytes) in as many tasks, which hold those of
    open nodes and return the best splits of their features; no histogram leaves the executors."""
    # A few tasks: they are short, and starting them takes longer than adding up.
    lots = max(1, min(parts, stored.sparkSession.sparkContext.defaultParallelism) // (4 * len(plan.rules)))
    lots = min(lots, *[len(layout.spans) for layout in plan.layouts])
    blocks = stored.repartition(parts).rdd.map(lambda row: _Block.of(row, inside, base))
    blocks = blocks.mapPartitions(_Block.joined).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[list[Tree]] = [[] for _ in plan.rules]
    older = None
    for turn in range(plan.rounds):
        states: list[RDD] = []

        def evaluated(walks: dict, asked: dict, turn: int = turn, blocks: RDD = blocks, states: list = states) -> dict[int, _Found]:
            def count(own: Iterator[_Block]):
                for block in own:
                    for k, lot, sums in plan.count(block, walks, asked, turn, lots):
                        yield k * lots + lot, sums

            def total(_, sums):
                whole = None
                for _, each in sums:
                    whole = each if whole is None else np.add(whole, each, out=whole)
                yield whole

            def evaluate(at, pairs):
                for held, sums in pairs:
                    k, lot = divmod(at, lots)
                    if sums is None:
                        yield held, None
                    else:
                        yield plan.evaluate(k, lot, lots, turn, asked[k], sums, held)

            counted = blocks.mapPartitions(count).partitionBy(len(plan.rules) * lots, int)
            summed = counted.mapPartitionsWithIndex(total)
            held = states[-1].map(lambda state: state[0]).zip(summed) if states else summed.map(lambda sums: ({}, sums))
            state = held.mapPartitionsWithIndex(evaluate).persist(StorageLevel.MEMORY_AND_DISK)
            states.append(state)
            found = state.map(lambda s: s[1]).collect()
            return {k: _best_of_lots(found[k * lots : (k + 1) * lots]) for k in asked}

        grown, last = plan.grow(turn, evaluated)
        for k, tree in enumerate(grown):
            if tree is not None:
                trees[k].append(tree)
        for state in states:
            state.unpersist()
        if older is not None:
            older.unpersist()
        older, blocks = blocks, blocks.map(lambda b, last=last: _moved(b, last)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % CHECKPOINT_EVERY == CHECKPOINT_EVERY - 1:
            blocks.checkpoint()
    for rdd in (older, blocks):
        if rdd is not None:
            rdd.unpersist()
    return trees


def spread_keys(spark: SparkSession, n: int) -> list[int]:
    """Keys that a repartitioning by key into ``n`` deals out evenly: one key a partition."""
    key = F.col("id").cast("int")
    tried = spark.range(64 * n).select(key.alias("key"), F.pmod(F.hash(key), F.lit(n)).alias("part"))
    return sorted(r["key"] for r in tried.groupBy("part").agg(F.min("key").alias("key")).collect())


def _fit_side_by_side(stored: DataFrame, plan: _Plan, inside: list[int], base: np.ndarray) -> list[list[Tree]]:
    """Rows that one task holds: every fit is a task that makes the same passes over them."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = fit_of[key[0].as_py()]
        own = plan.of_fit(k)
        (block,) = _Block.joined(_Block.of(row, [inside[k]], base[k : k + 1]) for row in table.to_pylist())
        rows = []
        for turn in range(own.rounds):
            held: dict[int, np.ndarray] = {}

            def evaluated(walks: dict, asked: dict, turn: int = turn, block: _Block = block, held: dict = held) -> dict[int, _Found]:
                ((_, _, sums),) = own.count(block, walks, asked, turn, 1)
                kept, found = own.evaluate(0, 0, 1, turn, asked[0], sums, held)
                held.clear()
                held.update(kept)
                return {0: found}

            (tree,), last = own.grow(turn, evaluated)
            block = _moved(block, last)
            rows += [(k, turn, i, *[getattr(tree, f)[i].item() for f in _TREE_FIELDS]) for i in range(len(tree.feature))]
        return pa.table(dict(zip(names, zip(*rows, strict=True), strict=True)), kinds)

    spark = stored.sparkSession
    schema = f"fit int, {NODE_SCHEMA}"
    kinds = to_arrow_schema(spark.createDataFrame([], schema).schema)
    names = kinds.names
    keys = spread_keys(spark, len(plan.rules))
    fit_of = {key: k for k, key in enumerate(keys)}
    each = stored.withColumn("fit", F.explode(F.array(*[F.lit(key) for key in keys])))
    spread = each.repartition(len(plan.rules), "fit")
    found = spread.groupBy("fit").applyInArrow(run, schema).toPandas().sort_values(["fit", "tree", "node"])
    trees: list[list[Tree]] = [[] for _ in plan.rules]
    for (k, _), part in found.groupby(["fit", "tree"], sort=True):
        trees[k].append(Tree(*[part[f].to_numpy() for f in _TREE_FIELDS]))
    return trees


def fit_boosted(rows: DataFrame, fits: Sequence[Fit], label: str = "label", key: str = "features") -> list[BoostedTrees]:
    """Fit all models of ``fits`` over the same rows.

    Rows beyond ``ROWS_PER_TASK`` are spread through the cluster and every pass is a job that
    serves all fits; fewer rows go whole to one task per fit, which makes the same passes and
    the same trees. ``key`` is what row samples are drawn by, best a unique id. Features are
    vector columns without nulls. A fit without rows of both labels predicts its constant share.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    columns = list(dict.fromkeys(f.features for f in fits))
    insides = list(dict.fromkeys(f.inside for f in fits))
    edges = _edges(rows, columns, max(f.rules.bins for f in fits))
    n_rows = rows.count()
    if not n_rows:
        return [BoostedTrees(0.0, (), 0, f.rules) for f in fits]
    parts = math.ceil(n_rows / ROWS_PER_TASK)
    if parts > 1:
        parts = max(parts, spark.sparkContext.defaultParallelism)
    layouts = [_Layout.of([len(e) + 1 for e in edges[c]]) for c in columns]
    stored = keep(_blocks(rows.repartition(parts), label, key, columns, insides, edges, layouts), "boost-blocks")
    inside = [insides.index(f.inside) for f in fits]
    plan = _Plan(
        np.array([columns.index(f.features) for f in fits]), [f.rules for f in fits], [edges[c] for c in columns], layouts
    )
    counted = rows.agg(*[
        agg
        for i in insides
        for agg in (F.sum(F.when(F.col(i), F.col(label).cast("double"))), F.count(F.when(F.col(i), 1)))
    ]).first()
    shares = [(counted[2 * i] or 0.0) / max(counted[2 * i + 1], 1) for i in inside]
    base = np.array([math.log(p / (1 - p)) for p in (min(max(p, 1e-9), 1 - 1e-9) for p in shares)])
    if parts > 1:
        trees = _fit_in_passes(stored, plan, inside, base, parts)
    else:
        trees = _fit_side_by_side(stored, plan, inside, base)
    discard(stored)
    return [
        BoostedTrees(float(b), tuple(t), len(plan.layout(k).sizes), r)
        for k, (b, t, r) in enumerate(zip(base, trees, plan.rules, strict=True))
    ]


@dataclass(frozen=True)
class Boosting:
    """An estimator over ``features`` and ``label``, as the other candidates are."""

    rules: Rules

    def fit(self, rows: DataFrame) -> BoostedTrees:
        whole = rows.withColumn("_whole", F.lit(True))
        return fit_boosted(whole, [Fit("features", "_whole", self.rules)])[0]
