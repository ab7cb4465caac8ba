"""Linear models from moments: against numpy, the optimality conditions and the row-wise solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapengine.operators import linear as ln
from lapengine.operators import models as ml


def _rows(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [5, -3, 0]
    x[:, 2] += 0.02 * x[:, 1]
    c = rng.integers(0, 3, n)
    return x, c, x @ [2.0, 0.0, -30.0] + np.array([0.0, 4.0, -1.0])[c] + rng.normal(size=n)


def _moments(x, y):
    a = np.column_stack([np.ones(len(y)), x, y])
    return a.T @ a


def test_no_penalty_is_least_squares():
    x, _, y = _rows()
    m = ln.solve(_moments(x, y), ["a", "b", "c"], {"a", "b", "c"}, 0.0)
    want = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    assert np.allclose([m.intercept, *m.coef], want, atol=1e-8)


@pytest.mark.parametrize("l1", [0.01, 0.5, 3.0])
def test_penalised_solution_is_optimal(l1):
    x, _, y = _rows()
    m = ln.solve(_moments(x, y), ["a", "b", "c"], {"a", "b", "c"}, l1)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w = m.coef * x.std(axis=0)
    slope = z.T @ (y - y.mean() - z @ w) / len(y)
    assert np.all(np.abs(slope) <= l1 + 1e-9) and np.allclose(slope[w != 0], l1 * np.sign(w[w != 0]), atol=1e-9)


def test_constant_and_empty_columns():
    y = np.arange(6.0)
    m = ln.solve(_moments(np.column_stack([np.ones(6), np.zeros(6), y]), y), ["one", "none", "y"], {"one", "y"}, 0.0)
    assert np.allclose(m.coef, [0, 0, 1]) and abs(m.intercept) < 1e-9


def test_cross_validation_in_two_scans(spark):
    x, c, y = _rows()
    rows = [(str(i), *map(float, v), "pqr"[k], float(t)) for i, (v, k, t) in enumerate(zip(x, c, y, strict=True))] + [("n", None, 0.0, 0.0, "p", 1.0)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, k string, t double")
    got, models = ln.cross_validate_linear(df, {"Lasso": 0.1, "LeastSquares": 0.0}, ["a", "b", "c"], {"k": ["p", "q"]}, "id", "t", 4)
    folds = {r.id: r.fold for r in ml.with_fold(df, "id", 4).collect()}
    at = np.array([folds[str(i)] for i in range(len(y))])
    z = np.column_stack([np.ones(len(y)), x, c == 0, c == 1])
    for r in got.where("model = 'LeastSquares'").collect():
        w = np.linalg.lstsq(z[at != r.fold], y[at != r.fold], rcond=None)[0]
        e = z[at == r.fold] @ w - y[at == r.fold]
        assert r.n == len(e) and np.allclose([r.MAE, r.RMSE], [np.abs(e).mean(), np.sqrt((e**2).mean())], atol=1e-7)
    assert got.count() == 8 and set(models["Lasso"]) == {-1, 0, 1, 2, 3}
    spread = {r.feature: r.value for r in ln.mean_abs_attribution(df.where("a is not null"), models["Lasso"][-1], {"k": ["p", "q"]}).collect()}
    assert np.isclose(spread["a"], np.abs(models["Lasso"][-1].coef[0] * (x[:, 0] - x[:, 0].mean())).mean())
    assert ln.cross_validate_linear(df.limit(0), {"Lasso": 0.1}, ["a"], {}, "id", "t")[0].collect() == []


def test_unknown_levels_have_no_indicator(spark):
    df, names = ln.with_indicators(spark.createDataFrame([("p",), ("z",), (None,)], "k string"), {"k": ["p", "q"]})
    assert names == ["k_p", "k_q"] and [tuple(r)[1:] for r in df.orderBy(F.col("k").asc_nulls_last()).collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
