"""Linear models of several features from one matrix of moments a fold.

One pass over the rows gives, for each fold, the sums of products of all pairs
of columns (an intercept and the target included).  A training set's moments
are the totals minus its own fold's, so the models of all folds come out of k
matrices of d x d numbers, whatever the number of rows; a second pass measures
them, the coefficients being literals.  Partial matrices are summed by Spark,
entry by entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapengine.operators.aggregates import regression_metrics
from lapengine.operators.models import with_fold

MAX_SWEEPS, SETTLED = 10_000, 1e-13


@dataclass
class LinearModel:
    """``intercept + coef . x`` in the columns' own units; ``mean``: of each column in training."""

    names: list[str]
    intercept: float
    coef: np.ndarray
    mean: np.ndarray

    def predicted(self) -> Column:
        return reduce(Column.__add__, [F.col(c) * F.lit(float(w)) for c, w in zip(self.names, self.coef, strict=True)], F.lit(self.intercept))


def with_indicators(df: DataFrame, levels: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """0/1 columns of the given levels of categorical columns, as doubles; any other value has none."""
    own = {f"{c}_{v}": F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)) for c, vs in levels.items() for v in vs}
    return df.withColumns(own), list(own)


def moments(df: DataFrame, cols: list[str], fold: str = "fold") -> dict[int, np.ndarray]:
    """Fold -> sums of products of all pairs of (1, *cols) over its rows; rows with a null among them count nowhere."""
    d = len(cols) + 1

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                x = np.column_stack([np.ones(b.num_rows), *[c.to_numpy() for c in b.columns[1:]]])
                at = b.column(0).to_numpy()
                for f in np.unique(at).tolist():
                    own = x[at == f]
                    total[f] = total.get(f, 0) + own.T @ own
        for f, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, f), pa.int32()), pa.array(np.arange(d * d), pa.int32()), pa.array(m.ravel())], ["fold", "at", "s"])

    rows = df.select(F.col(fold).cast("int"), *[F.col(c).cast("double") for c in cols]).na.drop()
    out: dict[int, np.ndarray] = {}
    # k x (d + 1)^2 numbers
    for r in rows.mapInArrow(of, "fold int, at int, s double").groupBy("fold", "at").agg(F.sum("s").alias("s")).collect():
        out.setdefault(r.fold, np.zeros((d, d))).flat[r.at] = r.s
    return out


def solve(m: np.ndarray, names: list[str], scaled: set[str], l1: float) -> LinearModel:
    """Least squares with an l1 penalty by coordinate descent on d x d moments; columns in ``scaled`` are standardised first.

    ``m``: sums of products of (1, *names, target).  The objective is half the mean squared error plus ``l1`` times the sum
    of absolute coefficients (of standardised columns); the intercept is free.
    """
    n = m[0, 0]
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    var = np.diag(cov)[:-1]
    sd = np.array([np.sqrt(v) if c in scaled and v > 0 else 1.0 for c, v in zip(names, var, strict=True)])
    g, b = cov[:-1, :-1] / np.outer(sd, sd), cov[:-1, -1] / sd
    w = np.zeros(len(names))
    for _ in range(MAX_SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            rho = b[j] - g[j] @ w + g[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / g[j, j] if g[j, j] > 0 else 0.0
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved < SETTLED * max(1.0, np.abs(w).max(initial=0)):
            break
    coef = w / sd
    return LinearModel(list(names), float(mean[-1] - coef @ mean[:-1]), coef, mean[:-1])


def cross_validate_linear(df: DataFrame, penalties: dict[str, float], num: list[str], levels: dict[str, list[str]], key: str, target: str,
                          k: int = 5) -> tuple[DataFrame, dict[str, dict[int, LinearModel]]]:
    """F16 of linear models in two scans: ``model, fold, MAE, RMSE, R2, n`` and the model of each fold (-1: of all rows)."""
    data, extra = with_indicators(with_fold(df, key, k), levels)
    names = [*num, *extra]
    data = data.select("fold", *names, F.col(target).cast("double").alias("y_true")).na.drop()
    own = moments(data, [*names, "y_true"])
    total = sum(own.values(), np.zeros((len(names) + 2,) * 2))
    models = {p: {f: solve(total - own.get(f, 0), names, set(num), l1) for f in [*sorted(own), -1] if (total - own.get(f, 0))[0, 0] > 0}
              for p, l1 in penalties.items()}
    said = []
    for name, by_fold in models.items():
        y = F.lit(None).cast("double")
        for f, m in by_fold.items():
            y = F.when(F.col("fold") == f, m.predicted()).otherwise(y)
        said.append(F.struct(F.lit(name).alias("model"), y.alias("y_pred")))
    each = data.select("fold", "y_true", F.explode(F.array(*said)).alias("p")).select("fold", "y_true", "p.model", "p.y_pred").where(F.col("y_pred").isNotNull())
    return regression_metrics(each, by=["model", "fold"]), models


def mean_abs_attribution(df: DataFrame, model: LinearModel, levels: dict[str, list[str]]) -> DataFrame:
    """mean |Shapley value| of each column of a linear model under independence, ``|coef * (x - mean)|``, ranked; one pass."""
    data = with_indicators(df, levels)[0].na.drop(subset=model.names)
    each = data.agg(*[F.avg(F.abs(F.lit(float(w)) * (F.col(c) - F.lit(float(m))))).alias(f"a{i}")
                      for i, (c, w, m) in enumerate(zip(model.names, model.coef, model.mean, strict=True))])
    stack = ", ".join(f"'{c}', a{i}" for i, c in enumerate(model.names))
    return each.select(F.expr(f"stack({len(model.names)}, {stack}) AS (feature, value)")).orderBy(F.col("value").desc(), "feature")
