"""The label network: gradient, learning, unknown labels, stopping, reruns."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.operators import network as nw
from parlance.plans import classify


def problem(spark, n=1200, parts=(0.7, 0.15)):
    """Two labels of which one is no linear function of the features; some are unknown."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 4))
    first = (x[:, 0] * x[:, 1] > 0).astype(int)
    second = (x[:, 2] > 0.3).astype(int)
    u = rng.random(n)
    part = np.where(u < parts[0], "train", np.where(u < parts[0] + parts[1], "validation", "test"))
    rows = [(i, str(p), [float(v) for v in r], int(a), None if i % 7 == 0 else int(b))
            for i, (p, r, a, b) in enumerate(zip(part, x, first, second))]
    return spark.createDataFrame(rows, "i long, part string, f array<double>, a int, b int")


def test_gradient_equals_a_numeric_one():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(9, 3)), rng.integers(0, 2, (9, 2)).astype(float)
    y[2, 0] = y[5, 1] = np.nan
    weights = [w if w.ndim == 2 else rng.normal(size=w.shape) for w in nw.initial_weights([3, 5, 4, 2], 3)]
    for drop in ((), (0.4, 0.25)):
        def loss(w):
            return nw.summed_gradient(w, x, y, drop, np.random.default_rng(7))[1].sum()
        gradient, _ = nw.summed_gradient(weights, x, y, drop, np.random.default_rng(7))
        for k, w in enumerate(weights):
            for at in list(np.ndindex(w.shape))[::3]:
                up, down = [v.copy() for v in weights], [v.copy() for v in weights]
                up[k][at] += 1e-6
                down[k][at] -= 1e-6
                assert gradient[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-5)


def test_log_loss_equals_the_plain_formula():
    z, y = np.array([[0.3, -2.0], [30.0, -40.0]]), np.array([[1.0, 0.0], [np.nan, 1.0]])
    p = 1 / (1 + np.exp(-z))
    want = np.array([[-np.log(p[0, 0]), -np.log(1 - p[0, 1])], [0.0, 40.0]])
    assert nw.losses(z, y) == pytest.approx(want)


def test_learns_what_a_linear_model_cannot(spark):
    rows = problem(spark)
    found = nw.fit_network(rows, "f", ["a", "b"], hidden=(32, 16), drop=(0.1,), steps=150, rate=0.02)
    assert found.steps[-1][0] < 0.5 * found.steps[0][0]
    scored = nw.with_chances(rows, found, "f").filter("part = 'test'").collect()
    assert np.mean([(r["chance_a"] >= 0.5) == (r["a"] == 1) for r in scored]) > 0.88
    assert np.mean([(r["chance_b"] >= 0.5) == (r["b"] == 1) for r in scored if r["b"] is not None]) > 0.93


def test_stops_by_the_validation_rows_and_keeps_the_best(spark):
    rows = problem(spark, 160).withColumn("a", F.when(F.col("part") == "validation", 1 - F.col("a")).otherwise(F.col("a")))
    found = nw.fit_network(rows, "f", ["a"], hidden=(16,), drop=(), steps=200, rate=0.05, patience=5)
    held = [h for _, h in found.steps]
    assert len(held) < 200 and len(held) - 1 - int(np.argmin(held)) == 5
    again = nw.fit_network(rows.repartition(3), "f", ["a"], hidden=(16,), drop=(), steps=200, rate=0.05, patience=5)
    assert [h for _, h in again.steps] == pytest.approx(held, rel=1e-6)


def test_edges(spark):
    rows = spark.createDataFrame([("train", [1.0, 0.0], 1), ("train", [0.0, 1.0], 0), ("train", None, 1), ("test", None, 1), ("test", [1.0, 0.0], None)],
                                 "part string, f array<double>, y int")
    found = nw.fit_network(rows, "f", ["y"], hidden=(4,), drop=(), steps=60, rate=0.1)
    scored = nw.with_chances(rows, found, "f").collect()
    assert [r["chance_y"] is None for r in scored] == [False, False, True, True, False]
    assert scored[0]["chance_y"] > 0.9 > 0.1 > scored[1]["chance_y"]
    with pytest.raises(ValueError):
        nw.fit_network(rows.filter("part = 'test'"), "f", ["y"])


def test_metrics_of_labels(spark):
    found = nw.Network([], ["y", "z"])
    scored = spark.createDataFrame([(1, 0.9, 0, 0.2), (1, 0.4, 0, 0.6), (0, 0.1, 1, 0.7), (None, 0.5, 1, 0.0)],
                                   "y int, chance_y double, z int, chance_z double")
    got = {r["label_name"]: r for r in classify.FittedLabels(found, scored).metrics().collect()}
    y, z = got["y"], got["z"]
    assert (y["rows"], y["accuracy"], y["precision"], y["recall"]) == (3, pytest.approx(2 / 3), 1.0, 0.5)
    assert y["loss"] == pytest.approx(-np.mean(np.log([0.9, 0.4, 0.9])))
    assert (z["rows"], z["accuracy"], z["precision"], z["recall"]) == (4, 0.5, 0.5, 0.5)
    assert z["loss"] == pytest.approx(-np.mean(np.log([0.8, 0.4, 0.7, 1e-7])))
