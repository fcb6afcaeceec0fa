"""K-Means for several numbers of clusters and several starts, all in the same scans.

Points are an array column next to an id. A scan meets the centres of every open fit as
one matrix and returns one row per (fit, centre) and task; sums are added in Spark. Only
numbers of clusters x starts rows ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERSAMPLING = 2  # expected draws of a round, as a multiple of the clusters
ROUNDS = 3
MOST_PASSES = 300
TOLERANCE = 1e-4  # a centre that moves less has settled

TILE = 2_048  # rows compared with a fit's centres at a time: their distances stay in the cache

_DRAWS = "fit int, centre array<double>"


@dataclass(frozen=True)
class Fit:
    k: int
    start: int
    centres: np.ndarray
    cost: float
    passes: int


@dataclass(frozen=True)
class Spread:
    """Quality of one assignment."""

    silhouette: float
    davies_bouldin: float | None
    calinski_harabasz: float | None


def fit_all(
    points: DataFrame,
    counts: Sequence[int],
    starts: int = 10,
    seed: int = 42,
    values: str = "scaled",
    key: str = "customerID",
    most_passes: int = MOST_PASSES,
) -> list[Fit]:
    """Every (number of clusters, start), in order. ``points`` should be a written table.

    Starts are drawn by k-means||: each point is taken with a probability that follows its
    squared distance, by a hash of its id, so that draws don't depend on the partitioning.
    Rows with the same id are drawn together. Fewer different points than clusters give
    fewer centres; a centre without points stays where it is. Null coordinates are not
    allowed; an empty table raises ``ValueError``.
    """
    table = points.select(F.col(values).alias("x"), F.xxhash64(F.col(key), F.lit(seed)).alias("draw"))
    fits = [(k, start) for k in counts for start in range(starts)]
    centres = _starting_centres(table, fits, seed)
    passes = np.zeros(len(fits), dtype=int)
    open_fits = list(range(len(fits)))
    while open_fits:
        sums = _cluster_sums(table, {f: centres[f] for f in open_fits}, squares=False)
        still = []
        for f in open_fits:
            moved = centres[f].copy()
            n, total, _ = sums[f]
            moved[n > 0] = total[n > 0] / n[n > 0, None]
            shift = np.sqrt(((moved - centres[f]) ** 2).sum(axis=1)).max()
            centres[f] = moved
            passes[f] += 1
            if shift > TOLERANCE and passes[f] < most_passes:
                still.append(f)
        open_fits = still
    costs = _cluster_sums(table, dict(enumerate(centres)))
    return [
        Fit(k, start, centres[f], float(costs[f][2].sum()), int(passes[f])) for f, (k, start) in enumerate(fits)
    ]


def cheapest(fits: Sequence[Fit]) -> dict[int, Fit]:
    """The fit of least cost per number of clusters, the first one among equals."""
    return {k: min((f for f in fits if f.k == k), key=lambda f: f.cost) for k in dict.fromkeys(f.k for f in fits)}


def nearest(centres: np.ndarray, values: Column) -> Column:
    """The number of the nearest centre, the first one among equals."""

    @F.pandas_udf("int")
    def label(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return pd.Series([], dtype="int32")
        return pd.Series(_distances(np.stack(batch.to_numpy()), centres).argmin(axis=1).astype("int32"))

    return label(values)


def spreads(points: DataFrame, chosen: Mapping[int, np.ndarray], values: str = "scaled") -> dict[int, Spread]:
    """Silhouette of squared distances, Davies-Bouldin and Calinski-Harabasz over all rows.

    Two scans for all assignments: one for the sums of every cluster, one for the rows'
    distances to them. With squared distances a row's mean distance to a cluster follows
    from the cluster's sums. Fewer than two clusters have silhouette 0 and no other figure.
    """
    table = points.select(F.col(values).alias("x"))
    first = _cluster_sums(table, chosen, about_origin=True)
    means = {}
    for name, (n, sums, squares) in first.items():
        used = np.maximum(n, 1)
        means[name] = (n, sums / used[:, None], squares / used)

    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {name: np.zeros(2 + len(n)) for name, (n, _, _) in means.items()}
        for x in _matrices(batches):
            for name, (n, mean, square) in means.items():
                own = _distances(x, chosen[name]).argmin(axis=1)
                at = np.arange(len(x))
                to_mean = _distances(x, mean)
                average = np.maximum(to_mean + (square - (mean**2).sum(axis=1))[None, :], 0.0)
                average[:, n == 0] = np.inf
                inner = average[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                average[at, own] = np.inf
                outer = average.min(axis=1)
                larger = np.maximum(inner, outer)
                width = np.zeros(len(x))
                counted = (n[own] > 1) & np.isfinite(outer) & (larger > 0)
                width[counted] = (outer - inner)[counted] / larger[counted]
                away = to_mean[at, own]
                found[name][0] += width.sum()
                found[name][1] += away.sum()
                found[name][2:] += np.bincount(own, weights=np.sqrt(away), minlength=len(n))
        for name, sums in found.items():
            yield _batch(["fit", "sums"], [pa.array([name], pa.int32()), pa.array([sums.tolist()])])

    rows = table.mapInArrow(widths, "fit int, sums array<double>")
    added = _added(rows, ["fit"], "sums")
    return {r["fit"]: _spread(*means[r["fit"]], np.array(r["sums"])) for r in added.collect()}


def _spread(n: np.ndarray, mean: np.ndarray, square: np.ndarray, sums: np.ndarray) -> Spread:
    rows, used = n.sum(), n > 0
    k = int(used.sum())
    if k < 2:
        return Spread(0.0, None, None)
    width, within, scatter = sums[0] / rows, sums[1], sums[2:][used] / n[used]
    gaps = np.sqrt(_distances(mean[used], mean[used]))
    np.fill_diagonal(gaps, np.inf)
    worst = ((scatter[:, None] + scatter[None, :]) / gaps).max(axis=1)
    middle = (n[:, None] * mean).sum(axis=0) / rows
    between = (n[used] * ((mean[used] - middle) ** 2).sum(axis=1)).sum()
    ratio = None if rows == k or within == 0 else float(between / (k - 1) / (within / (rows - k)))
    return Spread(float(width), float(worst.mean()), ratio)


def _starting_centres(table: DataFrame, fits: Sequence[tuple[int, int]], seed: int) -> list[np.ndarray]:
    """k-means||: one row of least hash, rounds of draws, then weighted draws among those."""
    candidates = _drawn(table, _least_hash(len(fits)), len(fits))
    if any(len(c) == 0 for c in candidates):
        raise ValueError("no rows to cluster")
    for turn in range(ROUNDS):
        sums = _cluster_sums(table, dict(enumerate(candidates)))
        cost = np.array([sums[f][2].sum() for f in range(len(fits))])
        drawn = _drawn(table, _by_distance(candidates, cost, [k for k, _ in fits], turn + 1), len(fits))
        candidates = [np.unique(np.vstack([c, d]), axis=0) if len(d) else c for c, d in zip(candidates, drawn, strict=True)]
    sums = _cluster_sums(table, dict(enumerate(candidates)))
    return [
        _weighted_choice(candidates[f], sums[f][0], k, np.random.default_rng([seed, k, start]))
        for f, (k, start) in enumerate(fits)
    ]


def _weighted_choice(candidates: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the candidates, each next one by weight times squared distance to those taken."""
    weight = np.maximum(weight, 1).astype(float)
    taken = [rng.choice(len(candidates), p=weight / weight.sum())]
    while len(taken) < min(k, len(candidates)):
        chance = weight * _distances(candidates, candidates[taken]).min(axis=1)
        chance[taken] = 0
        if chance.sum() == 0:
            break
        taken.append(rng.choice(len(candidates), p=chance / chance.sum()))
    return candidates[taken]


def _uniform(draw: np.ndarray, fit: int, turn: int) -> np.ndarray:
    """A number in [0, 1) per row, fit and round, from the row's hash."""
    mixed = draw.astype(np.uint64) ^ np.uint64((fit * 1_000_003 + turn * 7_919 + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def _least_hash(fits: int) -> Callable:
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, list[float]]] = {}
        for x, draw in _matrices(batches, with_draw=True):
            for f in range(fits):
                u = _uniform(draw, f, 0)
                at = u.argmin()
                if f not in best or (u[at], x[at].tolist()) < best[f]:
                    best[f] = (u[at], x[at].tolist())
        for f, (u, row) in best.items():
            yield _batch(["fit", "centre"], [pa.array([f], pa.int32()), pa.array([[u, *row]])])

    return take


def _by_distance(candidates: list[np.ndarray], cost: np.ndarray, counts: list[int], turn: int) -> Callable:
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, draw in _matrices(batches, with_draw=True):
            for f, (centres, total) in enumerate(zip(candidates, cost, strict=True)):
                if total <= 0:
                    continue
                chance = OVERSAMPLING * counts[f] * _distances(x, centres).min(axis=1) / total
                chosen = x[_uniform(draw, f, turn) < chance]
                if len(chosen):
                    rows = [[0.0, *row] for row in np.unique(chosen, axis=0).tolist()]
                    yield _batch(["fit", "centre"], [pa.array([f] * len(rows), pa.int32()), pa.array(rows)])

    return take


def _nearest(coordinates: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per column of ``coordinates`` the nearest centre, the first among equals, and its squared
    distance: as by ``_distances``, with rows side by side in memory."""
    distance = np.zeros((len(centres), coordinates.shape[1]))
    gap = np.empty_like(distance)
    for j, values in enumerate(coordinates):
        np.subtract(values, centres[:, j, None], out=gap)
        np.multiply(gap, gap, out=gap)
        distance += gap
    least, own = distance[0].copy(), np.zeros(coordinates.shape[1], dtype=np.int16)
    for c in range(1, len(centres)):
        np.copyto(own, c, where=distance[c] < least)
        np.minimum(least, distance[c], out=least)
    return own, least


def _drawn(table: DataFrame, take: Callable, fits: int) -> list[np.ndarray]:
    """Drawn rows per fit; of rows with a number in front only the least one stays."""
    rows = table.mapInArrow(take, _DRAWS)
    least = rows.groupBy("fit", F.element_at("centre", 1).alias("u")).agg(F.collect_set("centre").alias("centres"))
    out: list[np.ndarray] = [np.empty((0, 0))] * fits
    best = [np.inf] * fits
    for row in least.collect():
        if row["u"] < best[row["fit"]]:
            best[row["fit"]] = row["u"]
            out[row["fit"]] = np.array(sorted(row["centres"]))[:, 1:]
    return out


def _cluster_sums(
    table: DataFrame, centres: Mapping[int, np.ndarray], about_origin: bool = False, squares: bool = True
) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per fit: rows, coordinate sums and summed squares of each centre's rows, in one scan.

    Squares are of the distances to the centre, or ``about_origin`` of the rows' lengths; without
    ``squares`` they are zero."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {f: np.zeros((len(matrix), width)) for f, matrix in centres.items()}
        for whole in _matrices(batches):
            for lo in range(0, len(whole), TILE):
                x = whole[lo : lo + TILE]
                columns = np.zeros((len(x), width))  # rows, squares, coordinates
                columns[:, 0], columns[:, 2:] = 1, x
                if about_origin:
                    columns[:, 1] = (x**2).sum(axis=1)
                coordinates = np.ascontiguousarray(x.T)
                for f, matrix in centres.items():
                    own, least = _nearest(coordinates, matrix)
                    if squares and not about_origin:
                        columns[:, 1] = least
                    sums[f] += (np.arange(len(matrix))[:, None] == own).astype(float) @ columns
        for f, part in sums.items():
            at = np.flatnonzero(part[:, 0])
            columns = [pa.array(column) for column in part[at].T]
            yield _batch(names, [pa.array([f] * len(at), pa.int32()), pa.array(at, pa.int32()), *columns])

    width = next(iter(centres.values())).shape[1] + 2
    parts = [f"s{i}" for i in range(width)]
    names = ["fit", "centre", *parts]
    rows = table.mapInArrow(add, "fit int, centre int, " + ", ".join(f"{c} double" for c in parts))
    out = {f: np.zeros((len(matrix), width)) for f, matrix in sorted(centres.items())}
    for row in rows.groupBy("fit", "centre").agg(*[F.sum(c).alias(c) for c in parts]).collect():
        out[row["fit"]][row["centre"]] = row[2:]
    return {f: (part[:, 0], part[:, 2:], part[:, 1]) for f, part in out.items()}


def _added(rows: DataFrame, keys: list[str], sums: str) -> DataFrame:
    """Arrays of equal length added by position, in columns."""
    placed = rows.select(*keys, F.posexplode(sums).alias("place", "value"))
    totals = placed.groupBy(*keys, "place").agg(F.sum("value").alias("value"))
    parts = F.array_sort(F.collect_list(F.struct("place", "value")))
    return totals.groupBy(*keys).agg(F.transform(parts, lambda p: p["value"]).alias(sums))


def _matrices(batches: Iterator[pa.RecordBatch], with_draw: bool = False) -> Iterator:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(batch.num_rows, -1)
        yield (x, batch.column("draw").to_numpy(zero_copy_only=False)) if with_draw else x


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, one coordinate at a time: no cancellation."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - centres[None, :, j]) ** 2
    return out


def _batch(names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names)
