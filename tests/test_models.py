"""Split, encoding, training, calibration, attribution, segments, streams, run log."""

from __future__ import annotations

import gc
import math
import random
import weakref
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import boosting, explain, forest, kmeans, modelling, segmentation
from tidemark.plans import training_run
from tidemark.sources import files, tables
from tidemark.streaming import scoring


@pytest.fixture(scope="module")
def customers(spark):
    """Churn depends on tenure, price and contract, so a model can find it."""
    rng = random.Random(11)
    rows = []
    for i in range(600):
        tenure, monthly = rng.randrange(0, 73), rng.uniform(20, 120)
        contract = rng.choices(["Month-to-month", "One year", "Two year", f"odd {i}"], [60, 25, 15, 0.5])[0]
        z = 0.8 - 0.07 * tenure + 0.02 * (monthly - 60) + (1.5 if contract == "Month-to-month" else -0.5)
        rows.append((f"c{i:04d}", float(tenure) if i % 50 else None, monthly, contract, rng.choice(["DSL", "No", None]),
                     int(rng.random() < 1 / (1 + math.exp(-z)))))
    schema = "customerID string, tenure double, MonthlyCharges double, Contract string, InternetService string, Churn int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def run(customers):
    candidates = {
        "logistic_regression": modelling.logistic_regression,
        "random_forest": lambda n: modelling.random_forest(trees=5, depth=3),
    }
    return training_run.train(customers, candidates, folds=2)


def test_split_is_stratified_and_repeatable(customers):
    frame = modelling.prepare_training_frame(customers)
    again = modelling.prepare_training_frame(customers.repartition(2))
    key = ["customerID", "is_test", "fold", "calibration_fold"]
    assert sorted(map(tuple, frame.select(*key).collect()), key=str) == sorted(map(tuple, again.select(*key).collect()), key=str)
    for r in frame.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == round(r["n"] * 0.2)
    sizes = [r["count"] for r in frame.where(~F.col("is_test")).groupBy("label", "fold").count().orderBy("label").collect()]
    assert len(sizes) == 10 and max(sizes[:5]) - min(sizes[:5]) <= 5


def test_encoding(spark):
    rows = [("a", 1.0, "x")] * 150 + [("b", 3.0, "y")] * 49 + [("c", None, "rare")] + [("d", 2.0, None)] * 10
    train = spark.createDataFrame(rows, "id string, v double, k string")
    encoding = modelling.fit_encoding(train, ["v"], ["k"])
    assert encoding.medians == {"v": 1.0} and encoding.modes == {"k": "x"}
    assert encoding.names == ["v", "k_x", "k_y", "k_infrequent"]
    new = spark.createDataFrame([(1, None, None), (2, 3.0, "rare"), (3, 3.0, "unseen")], "id int, v double, k string")
    got = [list(r[0]) for r in encoding.encode(new).orderBy("id").select("features").collect()]
    assert got[0][1:] == [1.0, 0.0, 0.0] and got[1][1:] == [0.0, 0.0, 1.0] and got[2][1:] == [0.0, 0.0, 0.0]
    values = np.array([r[0].toArray() for r in encoding.encode(train).select("features").collect()])
    assert values[:, 0].mean() == pytest.approx(0, abs=1e-9) and values[:, 0].std() == pytest.approx(1)


def test_training_finds_the_signal(run):
    table = {r["name"]: r for r in run.candidates.collect()}
    assert run.model.name == max(table, key=lambda n: table[n]["cv_roc_auc_mean"])
    metrics = run.final_metrics.first()
    assert metrics["roc_auc"] > 0.70 and metrics["brier"] <= 0.25
    assert run.lift_table.count() == 10 and run.model.threshold == run.decision_policy.first()["threshold"]


def test_calibrated_probabilities_stay_inside(run, customers):
    row = run.model.score(customers).agg(F.min("churn_probability"), F.max("churn_probability"), F.count(F.lit(1))).first()
    assert 0 < row[0] and row[1] < 1 and row[2] == 600


def test_sigmoid_matches_newton(spark):
    rng = np.random.default_rng(0)
    value = rng.normal(size=300)
    label = (rng.random(300) < 1 / (1 + np.exp(-(1.5 * value - 0.4)))).astype(int)
    fitted = modelling.fit_sigmoid(spark.createDataFrame([(float(v), int(y)) for v, y in zip(value, label, strict=True)], "value double, label int"), "value")
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, beta = np.column_stack([value, np.ones(300)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (target - p))
    assert (fitted.slope, fitted.intercept) == pytest.approx(tuple(beta), abs=1e-4)


def test_logistic_regression_matches_newton(spark, customers):
    frame = customers.withColumn("label", F.col("Churn")).withColumn("t", F.coalesce("tenure", F.lit(30.0)) / 72)
    encoded = modelling.fit_encoding(frame, ["t", "MonthlyCharges"], []).encode(frame)
    model = modelling.fit_model(encoded, lambda n: modelling.logistic_regression(n).setTol(1e-10))
    rows = encoded.select("features", "label").collect()
    x = np.column_stack([np.array([r[0].toArray() for r in rows]), np.ones(600)])
    y = np.array([r[1] for r in rows])
    w = np.where(y == 1, 600 / (2 * y.sum()), 600 / (2 * (600 - y.sum())))
    penalty, beta = np.diag([1.0, 1.0, 0.0]), np.zeros(3)  # C = 1, free intercept
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (w * (y - p)) - penalty @ beta)
    assert list(model.coefficients) + [model.intercept] == pytest.approx(list(beta), abs=1e-4)


def test_isotonic_is_monotone(customers):
    frame = modelling.prepare_training_frame(customers)
    train = frame.where(~F.col("is_test"))
    encoding = modelling.fit_encoding(train, *modelling.model_inputs(train))
    base = modelling.fit_model(encoding.encode(train), modelling.logistic_regression)
    parts = modelling.calibrate(train, modelling.logistic_regression, encoding, "isotonic")
    scored = modelling.ChurnModel("m", encoding, base, parts).score(frame)
    assert scored.count() == 600 and scored.where("churn_probability not between 0 and 1").count() == 0


def test_saved_model_scores_the_same(spark, run, customers, tmp_path):
    modelling.save_model(run.model, str(tmp_path / "m"), spark)
    loaded = modelling.load_model(str(tmp_path / "m"), spark)
    a = {r[0]: r[1] for r in run.model.score(customers).select("customerID", "churn_probability").collect()}
    b = {r[0]: r[1] for r in loaded.score(customers).select("customerID", "churn_probability").collect()}
    assert a == b and loaded.threshold == run.model.threshold


def test_scoring_imputes_what_is_missing(run, spark):
    bare = spark.createDataFrame([("x", 5.0, 80.0), ("x", 5.0, 80.0)], "customerID string, tenure double, MonthlyCharges double")
    out = training_run.score_accounts(run.model, bare)
    assert out.count() == 2 and out.where("churn_probability is null").count() == 0


def test_linear_drivers_add_up(spark):
    names = ["tenure", "MonthlyCharges", "odd"]
    df = spark.createDataFrame([("a", [1.0, 2.0, 3.0])], "customerID string, x array<double>")
    explained = df.select("customerID", explain.linear_contributions(F.col("x"), names, [1.0, -2.0, 0.5], [0.0, 1.0, 3.0]).alias("contributions"))
    got = explain.top_drivers(explained, "customerID", 2).orderBy("rank").collect()
    assert [(r["feature"], r["contribution"], r["direction"]) for r in got] == [
        ("MonthlyCharges", -2.0, "reduces risk"), ("tenure", 1.0, "increases risk")
    ]
    packed = explain.packed_drivers(explain.top_drivers(explained, "customerID"), "customerID").first()
    assert [d["rank"] for d in packed["top_drivers"]] == [1, 2, 3]
    top = explain.global_importance(explained, 1).first()
    assert (top["feature"], top["importance"], top["method"]) == ("MonthlyCharges", 2.0, "mean_abs_contribution")


def test_tree_contributions_add_up_to_the_prediction(spark, customers):
    frame = customers.withColumn("label", F.col("Churn"))
    encoding = modelling.fit_encoding(frame, ["tenure", "MonthlyCharges"], ["Contract"])
    for build in (
        lambda n: modelling.random_forest(trees=4, depth=4),
        lambda n: modelling.depthwise_boosting(rounds=3),
        lambda n: modelling.leafwise_boosting(rounds=2),
    ):
        base = modelling.fit_model(encoding.encode(frame), build)
        model = modelling.ChurnModel("trees", encoding, base, ())
        rows = training_run.explained_accounts(model, frame).collect()
        scored = {r["customerID"]: r["p"] for r in model.score(frame, "p").collect()}
        for r in rows:
            total = sum(c["contribution"] for c in r["contributions"])
            assert abs(r["base_value"] + total - r["prediction"]) < 1e-9
            p = r["prediction"] if hasattr(base, "getNumTrees") else 1 / (1 + math.exp(-r["prediction"]))
            assert abs(p - scored[r["customerID"]]) < 1e-9


def test_shapley_values_equal_all_subsets():
    rng = np.random.default_rng(11)
    n, depth, inner = 6, 5, 31
    nodes = 2 * inner + 1
    feature = np.where(np.arange(nodes) < inner, rng.integers(0, n, nodes), -1)
    left, right = 2 * np.arange(nodes) + 1, 2 * np.arange(nodes) + 2
    cover = np.zeros(nodes)
    cover[inner:] = rng.integers(1, 50, inner + 1)
    for i in range(inner - 1, -1, -1):
        cover[i] = cover[left[i]] + cover[right[i]]
    tree = explain.ShapleyTree(
        feature, rng.normal(size=nodes) * 0.5, np.where(feature >= 0, left, -1), np.where(feature >= 0, right, -1),
        np.where(feature < 0, rng.normal(size=nodes), 0.0), cover,
    )
    x = rng.normal(size=(7, n))

    def value(row, known, at=0):
        if feature[at] < 0:
            return tree.value[at]
        if feature[at] in known:
            return value(row, known, left[at] if row[feature[at]] <= tree.threshold[at] else right[at])
        return sum(cover[c] / cover[at] * value(row, known, c) for c in (left[at], right[at]))

    got, expected = explain.shapley_values(x, [tree])
    assert abs(expected - value(x[0], set())) < 1e-9
    for row, own in zip(x, got, strict=True):
        for i in range(n):
            rest = [j for j in range(n) if j != i]
            want = 0.0
            for k in range(n):
                weight = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                want += sum(weight * (value(row, {*s, i}) - value(row, set(s))) for s in combinations(rest, k))
            assert abs(own[i] - want) < 1e-9


def test_forests_of_many_rows_are_grown_by_lots_of_trees(spark, customers, monkeypatch, tmp_path):
    frame = modelling.prepare_training_frame(customers)
    numeric, categorical = modelling.model_inputs(frame)
    encoding = modelling.fit_encoding(frame, numeric, categorical)
    encoded = encoding.encode(frame).persist()
    build = lambda n: modelling.random_forest(trees=20, depth=4)
    few = modelling.fit_model(encoded, build)
    assert type(few).__name__ == "RandomForestClassificationModel"
    monkeypatch.setattr(modelling, "FOREST_ROWS", range(1, 10**6))
    base = modelling.fit_model(encoded, build)
    again = modelling.fit_model(encoded, build)
    assert isinstance(base, forest.GrownForest) and len(base.trees) == 20
    for t, u in zip(base.trees, again.trees, strict=True):
        assert all(np.array_equal(getattr(t, f), getattr(u, f)) for f in forest._FIELDS)
        inner = np.flatnonzero(t.feature >= 0)
        assert (t.gain[inner] > 0).all() and np.allclose(t.weight[inner], t.weight[t.left[inner]] + t.weight[t.right[inner]])
        both = inner[(t.feature[t.left[inner]] < 0) & (t.feature[t.right[inner]] < 0)]
        assert ((t.value[t.left[both]] > 0.5) != (t.value[t.right[both]] > 0.5)).all()
        depth = np.zeros(len(t.feature), int)
        for i in inner:
            depth[[t.left[i], t.right[i]]] = depth[i] + 1
        assert depth.max() <= 4
    area = lambda m: modelling.area_under_roc(modelling.positive_probability(m, encoded, "churn_probability"))
    assert abs(area(base) - area(few)) < 0.05
    assert abs(base.featureImportances.toArray().sum() - 1) < 1e-9
    model = modelling.ChurnModel("random_forest", encoding, base, ())
    modelling.save_model(model, str(tmp_path / "forest"), spark)
    loaded = modelling.load_model(str(tmp_path / "forest"), spark)
    scored = {r["customerID"]: r["p"] for r in loaded.score(frame, "p").collect()}
    for r in training_run.explained_accounts(model, frame).collect():
        total = r["base_value"] + sum(c["contribution"] for c in r["contributions"])
        assert abs(total - r["prediction"]) < 1e-9 and abs(r["prediction"] - scored[r["customerID"]]) < 1e-9
    odd = lambda n: modelling.random_forest(trees=3, depth=3).setSubsamplingRate(0.5)
    assert modelling.forest_rules(odd(1)) is None and not isinstance(modelling.fit_model(encoded, odd), forest.GrownForest)


@pytest.mark.parametrize("weights", [(1.0, 1.0), (0.6, 3.0)])
def test_a_grown_tree_takes_the_best_splits(monkeypatch, weights):
    """Every split is the best one of a plain search, counted in several lots of rows."""
    monkeypatch.setattr(forest, "_COUNTED_ROWS", 64)
    rng = np.random.default_rng(2)
    n, rules = 400, forest.ForestRules(trees=1, depth=3, least_rows=5)
    bins = np.array([rng.integers(0, 6, n)], np.uint8).T  # one feature, so it is drawn at every node
    y = (rng.random(n) < 0.1 + 0.7 * (bins[:, 0] % 3 == 1)).astype(np.uint8)
    nodes = forest.grown_tree(bins, y, np.array([6]), weights, rules, np.random.default_rng(7))
    copies = np.searchsorted(forest._COPIES, np.random.default_rng(7).random(n, np.float32), "right")

    def mixed(rows):
        zero, one = (weights[k] * copies[rows][y[rows] == k].sum() for k in (0, 1))
        return 2 * zero * one / max(zero + one, 1e-300), zero + one

    def check(at, rows):
        impure, weight = mixed(rows)
        assert nodes["weight"][at] == pytest.approx(weight)
        if nodes["feature"][at] < 0:
            return 1
        gains = []
        for cut in range(5):
            low, high = rows & (bins[:, 0] <= cut), rows & (bins[:, 0] > cut)
            able = min(copies[low].sum(), copies[high].sum()) >= 5
            gains.append((impure - mixed(low)[0] - mixed(high)[0]) / weight if able else 0.0)
        assert nodes["cut"][at] == int(np.argmax(np.round(gains, 12))) and nodes["gain"][at] == pytest.approx(max(gains))
        sides = (nodes["left"][at], bins[:, 0] <= nodes["cut"][at]), (nodes["right"][at], bins[:, 0] > nodes["cut"][at])
        return sum(check(child, rows & side) for child, side in sides)

    assert check(0, np.ones(n, bool)) == (nodes["feature"] < 0).sum() > 2
    alike = forest.grown_tree(bins, np.zeros(n, np.uint8), np.array([6]), weights, rules, rng)
    assert alike["feature"].tolist() == [-1] and alike["value"].tolist() == [0.0]


def test_keys_are_dealt_out_one_a_partition(spark):
    keys = boosting.spread_keys(spark, 13)
    rows = spark.createDataFrame([(k,) for k in keys], "key int").repartition(13, "key")
    assert sorted(rows.rdd.glom().map(len).collect()) == [1] * 13


def test_leaves_share_the_products_of_their_path(monkeypatch):
    """A tree is walked once a lot of rows, and lots change no value."""
    rng = np.random.default_rng(5)
    depth, n = 6, 4  # features come again on a path
    inner = 2**depth - 1
    nodes = 2 * inner + 1
    feature = np.where(np.arange(nodes) < inner, rng.integers(0, n, nodes), -1)
    left, right = 2 * np.arange(nodes) + 1, 2 * np.arange(nodes) + 2
    cover = np.zeros(nodes)
    cover[inner:] = rng.integers(1, 50, inner + 1)
    for i in range(inner - 1, -1, -1):
        cover[i] = cover[left[i]] + cover[right[i]]
    children = [np.where(feature >= 0, side, -1) for side in (left, right)]
    value = np.where(feature < 0, rng.normal(size=nodes) * (rng.random(nodes) < 0.8), 0.0)
    tree = explain.ShapleyTree(feature, rng.normal(size=nodes) * 0.5, *children, value, cover)
    x = rng.normal(size=(10, n))
    whole, expected = explain.shapley_values(x, [tree])
    reached = explain._predictions(x, [tree])
    assert np.abs(whole.sum(axis=1) + expected - reached).max() < 1e-12
    calls, below = [], explain._ShapleyWalk.below
    monkeypatch.setattr(explain._ShapleyWalk, "below", lambda w, at, product: calls.append(at) or below(w, at, product))
    monkeypatch.setattr(explain, "_WALKED_ROWS", 4)
    parts, _ = explain.shapley_values(x, [tree])
    assert len(calls) == 3 * inner and np.abs(parts - whole).max() < 1e-12
    stump = explain.ShapleyTree(*(np.array([v]) for v in (-1, 0.0, -1, -1, 2.5, 10)))
    assert not explain.shapley_values(x, [stump])[0].any() and explain.shapley_values(x, [stump])[1] == 2.5


def test_impurity_fallback(spark, run):
    weights = modelling.linear_weights(run.model.base) or modelling.impurity_weights(run.model.base)
    table = explain.model_importance(spark, run.model.encoding.names, weights, 3).collect()
    assert len(table) == 3 and table[0]["method"] == "model_importance"


# ---------------------------------------------------------------- segments


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(8)
    centres = [(5, 30, 100), (60, 30, 1500), (5, 110, 400), (60, 110, 6000)]
    rows = []
    for i in range(200):
        t, m, v = centres[i % 4]
        rows.append((f"c{i:03d}", t + rng.normal(), m + rng.normal() * 3, v + rng.normal() * 20, int(i % 4 == 2), i % 4))
    return spark.createDataFrame(rows, "customerID string, tenure double, MonthlyCharges double, TotalCharges double, Churn int, segment_id int")


def test_segmentation_finds_the_groups(blobs):
    result = segmentation.segment(blobs, k_range=(3, 4, 5), n_init=3)
    assert result.k == 4 and result.assignments.count() == 200
    names = {r["segment_name"] for r in result.assignments.select("segment_name").distinct().collect()}
    assert len(names) == 4 and "Premium Loyal" in names and "High-Value At-Risk" in names
    quality = {r["k"]: r for r in result.quality.collect()}
    assert quality[4]["silhouette"] > 0.8


def test_cluster_quality_matches_brute_force(blobs):
    names = ["tenure", "MonthlyCharges"]
    rows = blobs.collect()
    x, label = np.array([[r[n] for n in names] for r in rows]), np.array([r["segment_id"] for r in rows])
    centre = np.array([x[label == k].mean(axis=0) for k in range(4)])
    scatter = np.array([np.linalg.norm(x[label == k] - centre[k], axis=1).mean() for k in range(4)])
    worst = [max((scatter[i] + scatter[j]) / np.linalg.norm(centre[i] - centre[j]) for j in range(4) if j != i) for i in range(4)]
    within = sum(((x[label == k] - centre[k]) ** 2).sum() for k in range(4))
    between = sum((label == k).sum() * ((centre[k] - x.mean(axis=0)) ** 2).sum() for k in range(4))
    got = segmentation.cluster_quality(blobs, names, "segment_id").first()
    assert got["davies_bouldin"] == pytest.approx(np.mean(worst))
    assert got["calinski_harabasz"] == pytest.approx((between / 3) / (within / 196))
    distance = np.linalg.norm(x[:, None] - x[None], axis=2)
    widths = []
    for i in range(200):
        inner = distance[i, label == label[i]].sum() / ((label == label[i]).sum() - 1)
        outer = min(distance[i, label == k].mean() for k in range(4) if k != label[i])
        widths.append((outer - inner) / max(inner, outer))
    assert segmentation.mean_silhouette(blobs, names, "segment_id", "customerID") == pytest.approx(np.mean(widths))


def test_colliding_names_get_numbers(spark):
    df = spark.createDataFrame([(0, "A"), (1, "B"), (2, "A"), (3, "A")], "segment_id int, segment_name string")
    got = {r["segment_id"]: r["segment_name"] for r in segmentation.unique_names(df).collect()}
    assert got == {0: "A", 1: "B", 2: "A 2", 3: "A 3"}


# ---------------------------------------------------------------- tables, files, streams


def test_tables(spark, tmp_path):
    df = spark.range(5)
    assert tables.write_table(df, "t_numbers", folder=str(tmp_path)) == 5
    assert tables.write_table(df, "t_numbers", "append", folder=str(tmp_path)) == 5
    assert tables.read_table(spark, "t_numbers").count() == 10
    assert tables.read_table(spark, "t_numbers", limit=3).count() == 3
    assert tables.read_table(spark, "t_numbers", limit=0).count() == 10
    assert tables.query(spark, "SELECT count(*) n FROM t_numbers WHERE id >= :low", low=3).first()["n"] == 4
    assert not tables.table_exists(spark, "t_missing")
    assert tables.read_optional(spark, "t_missing", "a int").count() == 0
    with pytest.raises(ValueError):
        tables.write_table(df, "t_numbers", "merge")


def test_runs_are_replaced_whole_and_read_only_when_complete(spark, tmp_path, monkeypatch):
    where = {"folder": str(tmp_path), "manifest": "t_manifest"}
    with pytest.raises(LookupError):
        tables.read_run(spark, "t_runs", manifest="t_manifest")
    df = spark.range(6).withColumn("text", F.lit("x"))
    assert tables.write_run(df, "t_runs", "a'b", **where) == 6
    assert tables.write_run(df.select("text", "id").where("id < 4"), "t_runs", "two", **where) == 4
    assert tables.write_run(df.where("id < 3"), "t_runs", "a'b", **where) == 3
    read = lambda run=None: tables.read_run(spark, "t_runs", run, "t_manifest")
    assert sorted(r["id"] for r in read("a'b").collect()) == [0, 1, 2] and read("two").count() == 4
    assert read().first()["run_id"] == "a'b"  # ended last
    assert tables.write_run(df.where("id < 0"), "t_runs", "two", **where) == 0
    assert read("two").count() == 0 and read("a'b").count() == 3
    failing = df.withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_run(failing, "t_runs", "a'b", **where)
    with pytest.raises(LookupError):
        read("a'b")
    assert {r["run_id"]: r["rows"] for r in tables.complete_runs(spark, "t_runs", "t_manifest").collect()} == {"two": 0}
    with pytest.raises(ValueError):
        tables.write_run(df.select("id"), "t_runs", "two", **where)
    with pytest.raises(ValueError):
        tables.write_run(df.withColumn("run_id", F.lit(1)), "t_runs", "two", **where)


def test_report_and_run_log(spark, run, tmp_path):
    tables.write_report(run.report, run.run_id, folder=str(tmp_path))
    tables.write_report(run.report, run.run_id, folder=str(tmp_path))  # again: replaced, not repeated
    back = tables.read_report(spark, run.run_id)
    assert set(back) == set(tables.REPORT_PARTS) and back["lift_table"].count() == 10
    assert tables.read_report(spark, "x", prefix="never_written") == {}
    assert tables.log_run(spark, "r1", {"m": {"auc": 0.8, "note": "x", "skip": None}}, "t_log", str(tmp_path))
    assert spark.table("t_log").count() == 2


def test_logging_can_never_fail_a_run(spark, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("disk")

    monkeypatch.setattr(tables, "write_table", broken)
    assert tables.log_run(spark, "r", {"m": {"a": 1}}) is False


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('customerID,TotalCharges,Churn,extra\na, ,Yes,1\nb,NA,No,null\n"c","1,5",,x\n')
    df = files.read_accounts(spark, [str(tmp_path / "none.csv"), str(path)])
    rows = {r["customerID"]: r for r in df.collect()}
    assert rows["a"]["TotalCharges"] == " " and rows["b"]["TotalCharges"] is None and rows["b"]["extra"] is None
    assert rows["c"]["TotalCharges"] == "1,5" and rows["c"]["Churn"] is None
    with pytest.raises(FileNotFoundError):
        files.read_accounts(spark, [str(tmp_path / "none.csv")])


def test_streamed_scoring_equals_batch(spark, run, customers, tmp_path):
    raw = customers.select("customerID", "tenure", "MonthlyCharges", "Contract", "InternetService")
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (
        scoring.score_stream(run.model, stream).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "out")).select("customerID", "churn_probability").collect()}
    batch = training_run.score_accounts(run.model, raw)
    assert got == {r[0]: r[1] for r in batch.select("customerID", "churn_probability").collect()}


def test_streamed_rollup(spark, frames, tmp_path):
    log = frames.views.requests
    log.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    query = (
        scoring.rollup_stream(stream).writeStream.format("memory").queryName("rollup").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    total = spark.table("rollup").agg(F.sum("requests"), F.sum("errors")).first()
    assert total[0] + total[1] == log.count()


def test_vectors_are_what_spark_models_read(spark, customers):
    encoding = modelling.fit_encoding(customers, ["tenure"], [])
    assert isinstance(encoding.encode(customers).first()["features"], type(Vectors.dense([1.0])))


def test_registered_fits_run_at_the_operator_defaults(frames, monkeypatch):
    from tidemark.plans import registry
    from tidemark.plans import catalog_models as cm

    seen, stop = {}, RuntimeError("seen")

    def validate(train, build, numeric, categorical, folds=5, fit_inside_fold=True):
        seen["cv"] = build(100), folds, fit_inside_fold, train.agg({"fold": "max"}).first()[0]
        return [0.5] * folds

    def fit(encoded, build):
        seen["fit"] = build(100)
        raise stop

    def train(features, candidates=modelling.CANDIDATES, *args, **kwargs):
        seen["train"] = candidates, args, kwargs
        raise stop

    monkeypatch.setattr(modelling, "cross_validate", validate)
    monkeypatch.setattr(modelling, "fit_model", fit)
    monkeypatch.setattr(training_run, "train", train)
    run = lambda name: registry.QUERIES[name](frames.spark, "/root/testdata/sf0.001")
    size = lambda e: (e.getNumTrees(), e.getMaxDepth()) if hasattr(e, "getNumTrees") else (e.rules.rounds, e.rules.max_depth or e.rules.max_leaves)
    for name, want in (("m4b_random_forest_cv", (400, 12)), ("m4c_depthwise_boosting_cv", (400, 4)), ("m4d_leafwise_boosting_cv", (400, 31))):
        assert run(name).count() == 5
        assert size(seen["cv"][0]) == want and seen["cv"][1:3] == (5, True)
    for name in ("m13_m14_tree_importance", "m14_impurity_fallback"):
        with pytest.raises(RuntimeError):
            run(name)
        assert size(seen["fit"]) == (400, 12)
    with pytest.raises(RuntimeError):
        run("m6_m7_m10_k7_training_report")
    assert set(seen["train"][0]) == set(modelling.CANDIDATES) and "folds" not in seen["train"][2]
    rules = {}
    monkeypatch.setattr(cm.tfidf, "TermRules", lambda *a, **k: rules.update(k) or (_ for _ in ()).throw(stop))
    with pytest.raises(RuntimeError):
        run("r7_svd_embedding")
    assert not rules


def test_many_rare_levels_mean_the_same_as_few(spark, customers, monkeypatch, tmp_path):
    odd = F.when(F.substring("customerID", 2, 4).cast("int") % 100 == 7, F.col("customerID")).otherwise(F.col("Contract"))
    customers = customers.withColumn("Contract", odd)
    train = customers.withColumn("label", F.col("Churn"))
    new = customers.unionByName(
        customers.limit(4).withColumn("customerID", F.concat(F.lit("n"), "customerID")).withColumn("Contract", F.lit("unseen"))
    )
    rows = lambda e: {r[0]: r[1] for r in e.encode(new).select("customerID", "features").collect()}
    listed = modelling.fit_encoding(train, ["tenure"], ["Contract", "InternetService"])
    assert len(listed.rare["Contract"]) > 1
    monkeypatch.setattr(modelling, "_RARE_LEVEL_LIMIT", 1)
    tabled = modelling.fit_encoding(train, ["tenure"], ["Contract", "InternetService"])
    assert tabled.rare["Contract"] is None and tabled.names == listed.names
    assert rows(tabled) == rows(listed) and len(rows(tabled)) == 604
    base = modelling.fit_model(tabled.encode(train), modelling.logistic_regression)
    modelling.save_model(modelling.ChurnModel("lr", tabled, base, ()), str(tmp_path / "m"), spark)
    assert rows(modelling.load_model(str(tmp_path / "m"), spark).encoding) == rows(listed)


def test_all_k_means_fits_share_their_scans(spark, blobs, monkeypatch):
    points, _ = segmentation.standardised_inputs(blobs, inputs=["tenure", "MonthlyCharges"])
    x = np.array([r["scaled"] for r in points.orderBy("customerID").collect()])
    raw = np.array([list(r) for r in blobs.orderBy("customerID").select("tenure", "MonthlyCharges").collect()])
    assert x == pytest.approx((raw - raw.mean(axis=0)) / raw.std(axis=0, ddof=1))
    scans = []
    monkeypatch.setattr(kmeans, "_cluster_sums", lambda *a, _of=kmeans._cluster_sums, **n: scans.append(1) or _of(*a, **n))
    fits = kmeans.fit_all(points, (2, 4, 6), 3)
    assert [(f.k, f.start) for f in fits] == [(k, i) for k in (2, 4, 6) for i in range(3)]
    assert len(scans) == kmeans.ROUNDS + 1 + max(f.passes for f in fits) + 1
    for fit in fits:  # settled: a centre is the mean of the rows that are nearest to it
        distance = ((x[:, None] - fit.centres[None]) ** 2).sum(axis=2)
        own = distance.argmin(axis=1)
        assert fit.cost == pytest.approx(distance.min(axis=1).sum())
        for c in range(len(fit.centres)):
            assert fit.centres[c] == pytest.approx(x[own == c].mean(axis=0), abs=1e-3)
    best = kmeans.cheapest(fits)
    assert best[4].cost == min(f.cost for f in fits if f.k == 4) < best[2].cost
    again = kmeans.fit_all(points.repartition(7), (2, 4, 6), 3)  # draws don't depend on partitions
    assert [f.cost for f in again] == pytest.approx([f.cost for f in fits])


def test_spreads_of_several_fits_equal_the_single_measures(blobs):
    names = ["tenure", "MonthlyCharges"]
    points, _ = segmentation.standardised_inputs(blobs, inputs=names)
    chosen = {k: f.centres for k, f in kmeans.cheapest(kmeans.fit_all(points, (3, 4), 2)).items()}
    got = kmeans.spreads(points, chosen)
    for k, centres in chosen.items():
        labelled = points.withColumn("segment_id", kmeans.nearest(centres, F.col("scaled")))
        own = labelled.withColumn("v", array_to_vector("scaled"))
        assert got[k].silhouette == pytest.approx(segmentation.squared_silhouette(own, "v"))
        spread = labelled.select("segment_id", *[F.col("scaled")[i].alias(n) for i, n in enumerate(names)])
        single = segmentation.cluster_quality(spread, names, "segment_id").first()
        assert got[k].davies_bouldin == pytest.approx(single["davies_bouldin"])
        assert got[k].calinski_harabasz == pytest.approx(single["calinski_harabasz"])


def test_fewer_points_than_clusters(spark):
    rows = [("a", [0.0, 1.0]), ("b", [0.0, 1.0]), ("c", [2.0, 1.0])]
    points = spark.createDataFrame(rows, "customerID string, scaled array<double>")
    fit = kmeans.fit_all(points, (4,), 1)[0]
    assert sorted(fit.centres.tolist()) == [[0.0, 1.0], [2.0, 1.0]] and fit.cost == 0
    one = kmeans.spreads(points.where("customerID < 'c'"), {1: np.array([[0.0, 1.0]])})[1]
    assert one.silhouette == 0 and one.davies_bouldin is None
    with pytest.raises(ValueError, match="no rows"):
        kmeans.fit_all(points.where("false"), (2,), 1)


def test_forests_of_folds_are_let_go_once_scored(spark, customers, monkeypatch):
    """The driver holds one forest at a time where it cannot hold all, with the same scores."""
    frame = customers.withColumns({"label": F.col("Churn"), "fold": F.pmod(F.xxhash64("customerID"), F.lit(3))})
    build = lambda n: modelling.random_forest(trees=3, depth=3)
    together = modelling.cross_validate(frame, build, ["tenure", "MonthlyCharges"], ["Contract"], folds=3)
    alive, most, fit = weakref.WeakSet(), [], modelling.fit_model

    def watched(encoded, build):
        gc.collect()
        most.append(len(alive))
        model = fit(encoded, build)
        alive.add(model)
        return model

    monkeypatch.setattr(modelling, "NODES_AT_ONCE", 1, raising=False)
    monkeypatch.setattr(modelling, "fit_model", watched)
    assert modelling.cross_validate(frame, build, ["tenure", "MonthlyCharges"], ["Contract"], folds=3) == together
    assert most == [0, 0, 0]


def test_number_of_forests_at_once():
    assert modelling.fits_at_once(modelling.logistic_regression, 10**9) == modelling.FITS_AT_ONCE
    assert modelling.fits_at_once(modelling.CANDIDATES["random_forest"], 1_200) == modelling.FITS_AT_ONCE
    assert modelling.fits_at_once(modelling.CANDIDATES["random_forest"], 10**6) == 1


def test_nodes_of_a_forest_come_as_columns(spark, customers, monkeypatch, tmp_path):
    frame = customers.withColumn("label", F.col("Churn"))
    encoding = modelling.fit_encoding(frame, ["tenure", "MonthlyCharges"], ["Contract"])
    forest = modelling.fit_model(encoding.encode(frame), lambda n: modelling.random_forest(trees=3, depth=3))
    forest.write().overwrite().save(str(tmp_path / "forest"))
    saved = spark.read.parquet(str(tmp_path / "forest" / "data"))
    rows = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in saved.collect()}

    def refuse(self):
        raise AssertionError("a row object per node")

    monkeypatch.setattr(type(saved), "collect", refuse)
    nodes = explain.tree_nodes(saved, classification=True)
    assert sorted(nodes) == [0, 1, 2] and sum(len(t["left"]) for t in nodes.values()) == len(rows)
    for (tree, i), row in rows.items():
        got = {name: column[i] for name, column in nodes[tree].items()}
        stats, inner = row["impurityStats"], row["leftChild"] >= 0
        assert (got["left"], got["right"]) == (row["leftChild"], row["rightChild"])
        assert got["feature"] == (row["split"]["featureIndex"] if inner else -1)
        assert got["threshold"] == (row["split"]["leftCategoriesOrThreshold"][0] if inner else 0.0)
        assert (got["value"], got["cover"]) == (stats[1] / sum(stats), sum(stats))


def test_forests_keep_the_nodes_of_rows_and_grow_the_same_trees(spark):
    rows = spark.range(300).select(
        array_to_vector(F.array(F.rand(1), F.rand(2), F.rand(3))).alias("features"), F.lit(1.0).alias("class_weight"),
        (F.rand(1) + F.rand(4) > 1).cast("double").alias("label"),
    ).persist()
    forest = modelling.random_forest(trees=4, depth=5)
    assert forest.getCacheNodeIds()
    walked = forest.copy({forest.cacheNodeIds: False})
    assert forest.fit(rows).toDebugString.split("\n")[1:] == walked.fit(rows).toDebugString.split("\n")[1:]
    rows.unpersist()
