from __future__ import annotations

import heapq
import pickle
from dataclasses import replace

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import boosting as bo

LEAFWISE = bo.Rules(rounds=3, rate=0.3, max_leaves=9, least_rows=8, bins=200)
DEPTHWISE = bo.Rules(rounds=3, rate=0.3, max_depth=3, least_hessian=2.0, penalty=2.0, bins=200)


def plain_trees(x, y, rules):
    """Exact best-first growth over all rows and all thresholds, one leaf at a time."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    out = []

    def best(rows, depth):
        g, h = (p - y)[rows], (p * (1 - p))[rows]
        found = (0.0, None)
        if rules.max_depth is not None and depth >= rules.max_depth:
            return found
        score = lambda a, b: a.sum() ** 2 / (b.sum() + rules.penalty)
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f])[:-1]:
                low = x[rows, f] <= t
                if min(low.sum(), (~low).sum()) < rules.least_rows:
                    continue
                if min(h[low].sum(), h[~low].sum()) < rules.least_hessian:
                    continue
                gain = round(score(g[low], h[low]) + score(g[~low], h[~low]) - score(g, h), 9)
                if gain > found[0]:
                    found = (gain, (f, rows[low], rows[~low]))
        return found

    for _ in range(rules.rounds):
        p = 1 / (1 + np.exp(-margin))
        rows = np.arange(len(y))
        leaves, heap, count = [], [], 0
        gain, split = best(rows, 0)
        heapq.heappush(heap, (-gain, count, 0, rows, split))
        splits = 0
        while heap:
            gain, _, depth, rows, split = heapq.heappop(heap)
            if split is None or splits >= (rules.max_leaves or 10**9) - 1:
                leaves.append(rows)
                continue
            splits += 1
            for part in split[1:]:
                count += 1
                g, s = best(part, depth + 1)
                heapq.heappush(heap, (-g, count, depth + 1, part, s))
        step = np.zeros(len(y))
        for rows in leaves:
            step[rows] = -rules.rate * (p - y)[rows].sum() / ((p * (1 - p))[rows].sum() + rules.penalty)
        margin = margin + step
        out.append((len(leaves), step))
    return margin, out


def made(spark, n=200, d=5, parts=3, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 6)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=n) > 0).astype(float)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int, fold int").repartition(parts)
    return x, y, df.withColumn("features", array_to_vector("x")).withColumn("all", F.lit(True))


@pytest.mark.parametrize("rows", [70, bo.ROWS_PER_TASK], ids=["passes", "one task a fit"])
@pytest.mark.parametrize("rules", [LEAFWISE, DEPTHWISE], ids=["leafwise", "depthwise"])
def test_trees_equal_plain_best_first(spark, monkeypatch, rules, rows):
    monkeypatch.setattr(bo, "ROWS_PER_TASK", rows)
    x, y, df = made(spark)
    model = bo.fit_boosted(df, [bo.Fit("features", "all", rules)], key="id")[0]
    margin, steps = plain_trees(x, y, rules)
    assert np.allclose(model.margins(x), margin)
    for tree, (leaves, step) in zip(model.trees, steps, strict=True):
        assert (tree.feature < 0).sum() == leaves
        assert np.allclose(tree.value[tree.leaves_of(x)], step)


def test_folds_in_one_pass_equal_fits_apart(spark, monkeypatch):
    x, y, df = made(spark, n=300)
    df = df.withColumns({f"in{i}": F.col("fold") != i for i in range(3)})
    rules = [replace(LEAFWISE, row_share=0.7, column_share=0.6), replace(DEPTHWISE, row_share=0.8)]
    fits = [bo.Fit("features", f"in{i}", r) for r in rules for i in range(3)]
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 100)
    together = bo.fit_boosted(df, fits, key="id")
    monkeypatch.undo()
    for fit, model in zip(fits, together, strict=True):
        apart = bo.fit_boosted(df, [fit], key="id")[0]
        assert np.allclose(model.margins(x), apart.margins(x))


def test_leaf_values_come_from_their_sums(spark):
    _, _, df = made(spark)
    model = bo.fit_boosted(df, [bo.Fit("features", "all", DEPTHWISE)], key="id")[0]
    leaves = model.node_table(spark).where("feature < 0")
    made_of = F.lit(-DEPTHWISE.rate) * F.col("gradient") / (F.col("hessian") + DEPTHWISE.penalty)
    assert leaves.where(F.abs(F.col("value") - made_of) > 1e-9).count() == 0
    assert leaves.where(F.col("hessian") < DEPTHWISE.least_hessian).count() == 0


def test_saved_model_scores_the_same(spark, tmp_path):
    x, _, df = made(spark)
    model = bo.Boosting(LEAFWISE).fit(df.select("features", "label"))
    model.save(str(tmp_path), spark)
    again = bo.BoostedTrees.load(str(tmp_path), spark)
    assert np.allclose(again.margins(x), model.margins(x))
    scored = df.withColumn("p", again.probability()).orderBy("id").toPandas()
    assert np.allclose(scored["p"], 1 / (1 + np.exp(-model.margins(x))))
    assert abs(model.featureImportances.toArray().sum() - 1) < 1e-9


def test_one_label_and_no_rows(spark):
    _, _, df = made(spark, n=30)
    same = bo.Boosting(LEAFWISE).fit(df.withColumn("label", F.lit(1)).select("features", "label"))
    assert all((t.feature < 0).all() for t in same.trees)
    assert bo.Boosting(LEAFWISE).fit(df.limit(0).select("features", "label")).trees == ()


def test_passes_return_splits_not_histograms(spark, monkeypatch):
    """What the driver gets in a pass grows with the tree, neither with the bins nor with the tasks."""
    _, _, df = made(spark, n=600, parts=6)
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 100)
    sizes, collect = [], RDD.collect

    def measured(self):
        found = collect(self)
        sizes.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", measured)
    bo.fit_boosted(df, [bo.Fit("features", "all", DEPTHWISE)], key="id")
    assert len(sizes) == DEPTHWISE.rounds * DEPTHWISE.max_depth
    assert max(sizes) < 3 * 8 * 5 * 200  # one histogram of one node


@pytest.mark.parametrize("rows", [100, bo.ROWS_PER_TASK], ids=["passes", "one task a fit"])
def test_fits_may_have_features_of_different_number(spark, monkeypatch, rows):
    """An encoding without a fold's rows can lack a level."""
    x, _, df = made(spark)
    df = df.withColumn("fewer", array_to_vector(F.slice("x", 1, 3)))
    monkeypatch.setattr(bo, "ROWS_PER_TASK", rows)
    fits = [bo.Fit("features", "all", DEPTHWISE), bo.Fit("fewer", "all", LEAFWISE)]
    both = bo.fit_boosted(df, fits, key="id")
    for fit, model, width in zip(fits, both, (5, 3), strict=True):
        apart = bo.fit_boosted(df, [fit], key="id")[0]
        assert model.width == width
        assert np.allclose(model.margins(x[:, :width]), apart.margins(x[:, :width]))


def test_features_of_few_bins_share_a_byte():
    rng = np.random.default_rng(5)
    sizes = [2, 255, 2, 3, 1, 7, 2]
    x = np.stack([rng.integers(0, s, 500) for s in sizes], axis=1).astype(float)
    layout = bo._Layout.of(sizes)
    assert len(layout.spans) == 2
    packed = layout.packed(x, [np.arange(s - 1) for s in sizes])
    for f, size in enumerate(sizes):
        assert (packed[layout.byte[f]] // layout.stride[f] % size == x[:, f]).all()
