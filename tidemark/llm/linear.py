"""Hashed n-gram features of texts and a calibrated logistic regression over them.

A feature's value is its share among the text's features of the same family (words, word
pairs, character four-grams), so the length of a text does not move its score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import Texts, chunks, windows

FAMILIES = 3


@dataclass(frozen=True)
class LinearModel:
    """Weights by bucket, intercept, and the calibration logit -> logit."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * logit + self.offset, -40, 40)))


def features(texts: Texts, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of every occurrence, by family; sorted by text number."""
    start, end, doc = texts.words()
    words = texts.hashes(start, end)
    pairs, at = windows(words, doc, 2)
    shift = np.uint64(64 - bits)
    out = [((words >> shift).astype(np.int32), doc), ((pairs >> shift).astype(np.int32), doc[at])]
    d = texts.data
    n = len(d) - 3
    if n <= 0:
        return [*out, (np.zeros(0, np.int32), np.zeros(0, np.int64))]
    four = d[:n].astype(np.uint32)
    for k in (1, 2, 3):
        four |= d[k : n + k].astype(np.uint32) << np.uint32(8 * k)
    bucket = ((four * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
    inside = owner[:n] == owner[3:]
    return [*out, (bucket[inside], owner[:n][inside])]


def logits(texts: Texts, model: LinearModel) -> np.ndarray:
    """Raw scores; a text without any feature gets the intercept."""
    total = np.full(len(texts), model.bias)
    for bucket, doc in features(texts, model.bits):
        count = np.bincount(doc, minlength=len(texts))
        total += np.bincount(doc, weights=model.weights[bucket], minlength=len(texts)) / np.maximum(count, 1)
    return total


def _rows(texts: Texts, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct buckets and their values."""
    parts: list[tuple[list, list]] = [([], []) for _ in range(len(texts))]
    for bucket, doc in features(texts, bits):
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            own = bucket[edges[i] : edges[i + 1]]
            if len(own):
                ids, n = np.unique(own, return_counts=True)
                parts[i][0].append(ids)
                parts[i][1].append(n / len(own))
    return [
        (np.concatenate(a), np.concatenate(b).astype(np.float32)) if a else (np.zeros(0, np.int32), np.zeros(0, np.float32))
        for a, b in parts
    ]


def fit_rows(rows: list, y: np.ndarray, bits: int, passes: int = 6, rate: float = 0.5) -> LinearModel:
    """AdaGrad over four fifths of the rows; Platt scaling on the last fifth."""
    held = np.arange(len(rows)) % 5 == 4
    weights, power = np.zeros(1 << bits, np.float32), np.full(1 << bits, 1e-4, np.float32)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias, bias_power = np.log(mean / (1 - mean)), 1.0
    order = np.flatnonzero(~held)
    rng = np.random.default_rng(7)
    for _ in range(passes):
        for i in rng.permutation(order):
            ids, value = rows[i]
            z = bias + float(weights[ids] @ value)
            g = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y[i]
            grad = (g * value).astype(np.float32)
            power[ids] += grad * grad
            weights[ids] -= rate * grad / np.sqrt(power[ids])
            bias_power += g * g
            bias -= 0.05 * g / np.sqrt(bias_power)
    z = np.array([bias + float(weights[ids] @ value) for ids, value in rows])
    slope, offset = _platt(z[held], y[held])
    return LinearModel(weights, float(bias), slope, offset, bits)


def _platt(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by damped Newton steps; identity when one class is missing."""
    if len(z) < 10 or y.min() == y.max():
        return 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    scale = max(float(np.abs(z).max()), 1e-9)
    x = np.column_stack([z / scale, np.ones(len(z))])
    b = np.array([scale, 0.0])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b - np.clip(np.linalg.solve(h, x.T @ (p - target)), -5, 5)
    return max(float(b[0] / scale), 1e-3), float(b[1])


def fit_on_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, bits: int, max_rows: int
) -> LinearModel:
    """Fit on at most ``max_rows`` labelled rows, those with the smallest hash of their id.

    Rows with a null id or label are ignored; an id labelled twice counts once, with its
    larger label, and of rows that repeat an id one is used. The bound makes the fit one small
    task and its broadcast of ids safe.
    """
    picked = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("double").alias("_y"))
        .dropna()
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    sample = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(F.broadcast(picked), "_id")
        .select("_y", "_text", F.xxhash64("_id").alias("_order"))
    )

    def featurise(batches):
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                rows = _rows(texts, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        pa.array([ids.astype(np.int32).tobytes() for ids, _ in rows], pa.binary()),
                        pa.array([v.tobytes() for _, v in rows], pa.binary()),
                    ],
                    ["y", "order", "ids", "value"],
                )

    def train(batches):
        got = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if not got:
            return
        got.sort(key=lambda r: (r[1], r[0], r[2]))
        y = np.array([r[0] for r in got])
        rows = [(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in got]
        m = fit_rows(rows, y, bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.weights.tobytes()], pa.binary()), *[pa.array([v], pa.float64()) for v in (m.bias, m.slope, m.offset)]],
            ["weights", "bias", "slope", "offset"],
        )

    made = sample.mapInArrow(featurise, "y double, order long, ids binary, value binary")
    # Of rows that repeat an id one counts, the least by its features. The shuffle keeps scan,
    # join and features in as many tasks as the table has; only the bounded sample's features
    # reach the one task that fits.
    once = made.groupBy("y", "order").agg(F.min(F.struct("ids", "value")).alias("f")).select("y", "order", "f.*")
    got = once.repartition(1).mapInArrow(train, "weights binary, bias double, slope double, offset double").collect()
    if not got:
        return LinearModel(np.zeros(1 << bits, np.float32), 0.0, 1.0, 0.0, bits)
    m = got[0]
    return LinearModel(np.frombuffer(m["weights"], np.float32), m["bias"], m["slope"], m["offset"], bits)
