"""Lap-time regression on Spark ML.

K-fold evaluation fits ``k`` Spark ML pipelines on one checkpointed
DataFrame; fold membership is a hash of the row key (no random split state,
identical in every engine).  Every fit and every metric is a distributed job;
the driver loops only over folds and models.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import sqrt

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapengine.operators import boosting
from lapengine.operators.aggregates import regression_metrics
from lapengine.operators.clean import complete_cases
from lapengine.schemas import require_columns

TARGET = "LapTimeSeconds"
FOLD_SEED = 42
MODEL_ORDER = ["RandomForest", "GradientBoosting", "Lasso", "XGBoost", "LightGBM"]

# Request defaults for prediction (fixed values of the prediction request).
REQUEST_DEFAULTS = {
    "SessionType": "R", "Compound": "MEDIUM", "TyreLife": 5.0, "Avg_Speed_mps": 55.0, "Avg_Throttle": 40.0,
    "Brake_Aggression": 5.0, "MeanAbs_Jerk_Long": 2.0, "MeanAbs_Jerk_Lat": 2.0, "Max_Lateral_g": 3.0,
    "Max_Longitudinal_g": 2.0, "Energy_Index": 500.0, "PC1": 0.0, "PC2": 0.0, "PC3": 0.0, "Year": 2024,
    "Event": "Bahrain Grand Prix", "Driver": "11", "LapNumber": 1,
}


def model_dataset(feat: DataFrame, features: list[str], target: str = TARGET,
                  scores: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """F8 (+D4): complete rows of features and target; PCs joined by key when given."""
    x = feat
    if scores is not None:
        x = x.join(scores.select(*keys, "PC1", "PC2", "PC3"), keys, "left")
    cols = list(features) + [target]
    require_columns(x, cols)
    return complete_cases(x, cols)


def with_fold(df: DataFrame, key: Column | str, k: int = 5, seed: int = FOLD_SEED) -> DataFrame:
    """``fold = int(md5('<seed>:<key>')[:8], 16) % k`` - reproducible, engine-neutral."""
    kc = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), kc.cast("string"))), 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", F.pmod(h, F.lit(k)).cast("int"))


def with_exact_fold(df: DataFrame, key: str, k: int = 5, seed: int = FOLD_SEED) -> DataFrame:
    """F15 with fold sizes that differ by at most one: fold ``ntile(k)`` of the order by ``with_fold``'s hash, then key.

    Rows are range-partitioned and sorted by (hash, key) and written once; a row's global place is the number of rows in
    earlier partitions (one number a partition) plus its place in its own, so no task holds more than a partition.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    x = df.withColumn("_h", h).repartitionByRange("_h", key).sortWithinPartitions("_h", key).withColumn("_i", F.monotonically_increasing_id())
    x = _checkpointed(x)
    part = F.shiftright("_i", 33)
    sizes = sorted((r.p, r.n) for r in x.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    n, before = sum(c for _, c in sizes), 0
    starts = []
    for p, c in sizes:
        starts.append((p, before))
        before += c
    offsets = df.sparkSession.createDataFrame(starts, "_p long, _start long")       # a row a partition
    place = F.col("_start") + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1))
    q, r = divmod(n, k)                                         # the first r folds have one row more
    small = F.lit(r) + F.floor((place - r * (q + 1)) / max(q, 1))
    fold = F.when(place < r * (q + 1), F.floor(place / (q + 1))).otherwise(small)
    out = x.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn("fold", fold.cast("int"))
    return out.select(*df.columns, "fold")


def build_preprocessor(num_cols: list[str], cat_cols: list[str], n_rows: int, scale: bool = True) -> list:
    """numerics scaled by their population std + one-hot categoricals (unknown level -> zero vector).

    ``n_rows``: rows that the stages will be fitted on.  The library's scaler
    divides by the sample std, which a constant factor turns into the other.
    """
    stages = []
    onehots = []
    for c in cat_cols:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", dropLast=True))
        onehots.append(f"{c}__oh")
    stages.append(VectorAssembler(inputCols=list(num_cols), outputCol="_num", handleInvalid="keep"))
    if scale:
        factor = sqrt(n_rows / (n_rows - 1)) if n_rows > 1 else 1.0
        stages.append(StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True))
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(num_cols)), inputCol="_num_z", outputCol="_num_s"))
        num_out = "_num_s"
    else:
        num_out = "_num"
    stages.append(VectorAssembler(inputCols=[num_out] + onehots, outputCol="features"))
    return stages


MAX_TREE_DEPTH = 30  # the library's own limit; "unbounded" and deeper settings mean this


def _forest(trees: int, depth: int | None) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=min(depth or MAX_TREE_DEPTH, MAX_TREE_DEPTH), featureSubsetStrategy="all",
                                 seed=42, labelCol="label")


def _boosted(rounds: int, rate: float, depth: int, share: float = 1.0) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, stepSize=rate, maxDepth=min(depth, MAX_TREE_DEPTH), subsamplingRate=share,
                        featureSubsetStrategy="all" if share == 1.0 else str(share), seed=42, labelCol="label")


def model_zoo(custom: dict | None = None) -> dict[str, Callable[[], object]]:
    """The five regressors at the reference's settings (boosted-tree stand-ins for the two external libraries)."""
    c = custom or {}
    return {
        "RandomForest": lambda: _forest(c.get("n_estimators", 300), c.get("max_depth")),
        "GradientBoosting": lambda: _boosted(100, 0.1, 3),
        "Lasso": lambda: LinearRegression(regParam=0.01, elasticNetParam=1.0, standardization=False,
                                          maxIter=5000, labelCol="label"),
        "XGBoost": lambda: _boosted(c.get("n_estimators", 400), c.get("learning_rate", 0.05), c.get("max_depth", 4), 0.9),
        "LightGBM": lambda: _boosted(400, 0.05, 5, 0.9),
    }


def tree_zoo(custom: dict | None = None) -> dict[str, boosting.TreeSettings]:
    """F10, F11, F13, F14 on all rows of any table, at the reference's settings and the external libraries' own defaults.

    A forest's trees are not bounded in depth, but grow no more than ``FOREST_LEAVES`` leaves, best first: what a model
    holds must not grow with the table that it is fitted on.
    """
    c, tree = custom or {}, boosting.TreeSettings
    return {
        "RandomForest": tree(c.get("n_estimators", 300), depth=c.get("max_depth"), leaves=boosting.FOREST_LEAVES),
        "GradientBoosting": tree(100, 0.1, depth=3),
        "XGBoost": tree(c.get("n_estimators", 400), c.get("learning_rate", 0.05), depth=c.get("max_depth", 4), rows=0.9, columns=0.9, l2=1.0),
        "LightGBM": tree(400, 0.05, leaves=31, rows=0.9, columns=0.9, least_rows=20),
    }


def single_model(model_type: str, params: dict) -> Callable[[], object]:
    """F19's regressor: the library defaults of each type, overridden by ``params``; other types are a 100-tree forest."""
    p = params
    if model_type == "RandomForest":
        return lambda: _forest(p.get("n_estimators", 100), p.get("max_depth"))
    if model_type == "XGBoost":
        return lambda: _boosted(p.get("n_estimators", 100), p.get("learning_rate", 0.3), p.get("max_depth", 6))
    if model_type == "GradientBoosting":
        return lambda: _boosted(p.get("n_estimators", 100), p.get("learning_rate", 0.1), p.get("max_depth", 3))
    return lambda: _forest(100, None)


def make_pipeline(num_cols: list[str], cat_cols: list[str], estimator, n_rows: int) -> Pipeline:
    return Pipeline(stages=build_preprocessor(num_cols, cat_cols, n_rows) + [estimator])


def fit_pipeline(df: DataFrame, num_cols: list[str], cat_cols: list[str], estimator) -> PipelineModel:
    """Preprocessing and regressor fitted on all of ``df`` (column ``label``)."""
    n = df.count()
    pipeline = make_pipeline(num_cols, cat_cols, estimator, n)
    if not from_moments(estimator):
        return pipeline.fit(df)
    pre = Pipeline(stages=pipeline.getStages()[:-1]).fit(df)
    rows = rows_of_moments(df, pre, num_cols, cat_cols, n)
    return PipelineModel([*pre.stages, estimator.fit(pre.transform(df) if rows is None else rows)])


MAX_MOMENT_COLUMNS = 500


def from_moments(estimator) -> bool:
    """Whether the library solves ``estimator`` from the means and covariances of its rows alone, to the same coefficients.

    Without a penalty, columns that depend on each other leave the coefficients open, and rounding would choose them.
    """
    return (isinstance(estimator, LinearRegression) and estimator.getRegParam() > 0 and estimator.getLoss() == "squaredError" and estimator.getSolver() in ("auto", "normal")
            and estimator.getFeaturesCol() == "features" and estimator.getLabelCol() == "label" and not estimator.isDefined("weightCol"))


def rows_of_moments(df: DataFrame, pre: PipelineModel, num_cols: list[str], cat_cols: list[str], n: int) -> DataFrame | None:
    """A few rows of ``features`` and ``label`` with the same means and covariances as all ``n`` rows of ``df`` under ``pre``.

    The library takes a linear fit from those in one pass, but builds each row's vectors for it and once more for a summary; one
    scan of plain columns gives the same numbers.  The rows lie at the mean plus and minus each (scaled) principal axis.  None:
    there is no such scan (nulls, values that are not finite, a constant label, too many levels); then all rows are fitted.
    """
    from lapengine.operators import linear
    labels = {s.getInputCol(): list(s.labels) for s in pre.stages if isinstance(s, StringIndexerModel)}
    d = len(num_cols) + sum(map(len, labels.values()))
    if not n or d > MAX_MOMENT_COLUMNS:
        return None
    [scaler], [weights] = ([s for s in pre.stages if isinstance(s, kind)] for kind in (StandardScalerModel, ElementwiseProduct))
    scaled = [((F.col(c).cast("double") - F.lit(float(m))) * F.lit(float(w / sd) if sd > 0 else 0.0)).alias(f"_m{i}")
              for i, (c, m, sd, w) in enumerate(zip(num_cols, scaler.mean, scaler.std, weights.getScalingVec(), strict=True))]
    levels = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"_l{i}_{j}")
              for i, c in enumerate(cat_cols) for j, v in enumerate(labels[c])]
    x = df.select(F.lit(0).alias("fold"), *scaled, *levels, F.col("label").cast("double").alias("label"))
    m = linear.moments(x, x.columns[1:]).get(0)
    if m is None or m[0, 0] != n or not np.isfinite(m).all():
        return None
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    still = np.diag(cov) <= 1e-12 * np.maximum(np.diag(m)[1:] / n, 1e-300)     # constant but for rounding
    if still[-1]:
        return None
    cov[still] = cov[:, still] = 0.0
    size, axes = np.linalg.eigh(cov)
    axes = axes * np.sqrt(np.maximum(size, 0.0) * len(mean))
    axes[still] = 0.0
    points = np.concatenate([mean + axes.T, mean - axes.T]).tolist()
    return df.sparkSession.createDataFrame([(Vectors.dense(p[:-1]), p[-1]) for p in points], ["features", "label"])


@dataclass
class CvResult:
    name: str
    metrics: DataFrame          # one row: model, MAE, RMSE, R2 (means over folds)
    fold_metrics: DataFrame     # one row per fold
    predictions: DataFrame      # inputs + y_true, y_pred, fold
    model: PipelineModel | boosting.Ensemble | None


def _checkpointed(df: DataFrame) -> DataFrame:
    from lapengine.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` by columns in a fresh folder of the shared checkpoint directory: later passes read the columns that they need."""
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cross_validate(df: DataFrame, name: str, estimator_factory: Callable[[], object], num_cols: list[str],
                   cat_cols: list[str], key: str, target: str = TARGET, k: int = 5,
                   refit: bool = True, parallelism: int = 5) -> CvResult:
    """F16: K-fold: fit on k-1 folds (preprocessing included), predict the rest.

    The fold-tagged input is written to the cluster's checkpoint directory once
    (lineage cut, survives executor loss) and reused by all ``k`` fits and the
    final refit on all rows, each of which reads only the columns it needs.
    """
    data = _written(with_fold(df.withColumn("label", F.col(target).cast("double")), key, k), "cv")

    def fitted(rows: DataFrame) -> PipelineModel:
        return fit_pipeline(rows, num_cols, cat_cols, estimator_factory())

    def fold_predictions(f: int) -> DataFrame:
        m = fitted(data.where(F.col("fold") != f))
        return m.transform(data.where(F.col("fold") == f)).select(
            *df.columns, "fold", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))

    # the k fits are independent Spark jobs: submit them from a few driver
    # threads so their iterations interleave on the cluster (as CrossValidator's
    # ``parallelism`` does)
    with ThreadPoolExecutor(max_workers=max(1, min(k, parallelism))) as pool:
        parts = list(pool.map(fold_predictions, range(k)))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    fm = regression_metrics(preds, by=["fold"])
    mean = fm.agg(F.avg("MAE").alias("MAE"), F.avg("RMSE").alias("RMSE"), F.avg("R2").alias("R2")) \
             .select(F.lit(name).alias("model"), "MAE", "RMSE", "R2")
    final = fitted(data) if refit else None
    return CvResult(name, mean, fm, preds, final)


def cross_validate_trees(df: DataFrame, settings: dict[str, boosting.TreeSettings], num_cols: list[str], cat_cols: list[str], key: str,
                         target: str = TARGET, k: int = 5, refit: bool = False) -> dict[str, CvResult]:
    """F16 of tree models: every model is fitted on all rows of the other folds, all models and folds in the same passes.

    ``model`` of a result (with ``refit``) is an ``Ensemble`` over binned rows, see ``boosting.predicted``.
    """
    from lapengine.streaming.ingest import shared_dir
    data = _written(with_fold(df.withColumn("label", F.col(target).cast("double")), key, k), "cv")
    binning = boosting.find_bins(data, num_cols, cat_cols)
    blocks = boosting.blocks_of(data, binning, key, shared_dir(df.sparkSession, "bins"))
    folds = [*range(k), *([-1] if refit else [])]
    fitted = iter(boosting.fit(blocks, binning.sizes, [(s, f) for s in settings.values() for f in folds]))
    out = {}
    for name in settings:
        by_fold = {f: next(fitted) for f in folds}
        preds = data.select(*df.columns, "fold", F.col("label").alias("y_true"), boosting.predicted(data, binning, by_fold, F.col("fold")).alias("y_pred"))
        own = by_fold if boosting.jvm.supported(blocks.frame, binning.sizes, folds) else None
        fm = regression_metrics(preds if own is None else boosting.scored(blocks.frame, binning.sizes, {f: m for f, m in own.items() if f >= 0}), by=["fold"])
        mean = fm.agg(*[F.avg(c).alias(c) for c in ("MAE", "RMSE", "R2")]).select(F.lit(name).alias("model"), "MAE", "RMSE", "R2")
        out[name] = CvResult(name, mean, fm, preds, by_fold.get(-1))
    return out


def fit_trees(df: DataFrame, settings: boosting.TreeSettings, num_cols: list[str], cat_cols: list[str], key: str,
              target: str = TARGET) -> tuple[boosting.Ensemble, boosting.Binning]:
    """One tree model on all rows of ``df``, and the bins of its inputs."""
    from lapengine.streaming.ingest import shared_dir
    data = df.select(key, *num_cols, *cat_cols, F.col(target).cast("double").alias("label"), F.lit(0).alias("fold"))
    binning = boosting.find_bins(data, num_cols, cat_cols)
    blocks = boosting.blocks_of(data, binning, key, shared_dir(df.sparkSession, "bins"))
    return boosting.fit(blocks, binning.sizes, [(settings, -1)])[0], binning


def select_best(metrics: DataFrame, order: list[str] = MODEL_ORDER) -> DataFrame:
    """lowest MAE; a tie goes to the model listed first."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return metrics.orderBy(F.col("MAE"), rank).limit(1)


def validation_predictions(cv: CvResult, key: str) -> DataFrame:
    """model inputs + y_true, y_pred, fold.  The columns ``fold`` and ``key`` carry the order."""
    return cv.predictions


def train_single(df: DataFrame, model_type: str, params: dict, num_cols: list[str], cat_cols: list[str],
                 key: str, target: str = TARGET, k: int = 3) -> CvResult:
    """one model with custom settings, 3 folds (see ``single_model``)."""
    return cross_validate(df, model_type, single_model(model_type, params), num_cols, cat_cols, key, target, k)


def save_model(model: PipelineModel, path: str) -> None:
    """persist the winning pipeline (preprocessing + regressor)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_defaults(df: DataFrame, defaults: dict = REQUEST_DEFAULTS) -> DataFrame:
    """F21 input side: add missing request columns, fill nulls with defaults."""
    out = df
    for c, v in defaults.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
    fill = {c: v for c, v in defaults.items() if c in out.columns}
    return out.na.fill(fill)


def predict(df: DataFrame, model: PipelineModel, defaults: dict = REQUEST_DEFAULTS) -> DataFrame:
    """batch prediction with default injection (a stateless map, no shuffle)."""
    return model.transform(with_defaults(df, defaults))
