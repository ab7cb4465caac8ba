"""PCA golden values, fold/CV invariants, attribution properties."""

import json
import os
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapengine.operators import attribution as attr
from lapengine.operators import matrix as mx
from lapengine.operators import models as ml
from lapengine.operators import pca as pc
from lapengine.plans import fixtures as fx
from lapengine.plans.registry import QUERIES
from tests.conftest import SF_SMALL

DATA = os.path.join(os.path.dirname(__file__), "data")

# Golden values of the committed one-session PCA model (20 laps, 11 columns).
GOLDEN_RATIO = [0.38860613725439924, 0.22374291458483173, 0.12180327632095644]
GOLDEN_SINGULAR = [9.246261417241454, 7.015941933102286, 5.1765549152511126]
GOLDEN_FIRST_SCORES = [3.904785435966105, -2.7786839721850702, -1.0773958360173246]


def _session(spark):
    pdf = pd.read_csv(os.path.join(DATA, "session_lap_features.csv"))
    pdf["Driver"] = pdf["Driver"].astype(str)
    return spark.createDataFrame(pdf)


def test_session_pca_golden(spark):
    df = _session(spark)
    x, cols = mx.matrix_session(df, ["SOFT", "HARD"])
    m = pc.fit_pca(x, cols, 3)
    assert cols[-2:] == ["Compound_HARD", "Compound_SOFT"]
    assert np.allclose(m.explained_variance_ratio, GOLDEN_RATIO, atol=1e-10)
    assert np.allclose(m.singular_values, GOLDEN_SINGULAR, atol=1e-8)
    s = pc.apply_pca(x, m).where((F.col("Driver") == "1") & (F.col("LapNumber") == 39)).first()
    assert np.allclose([s.PC1, s.PC2, s.PC3], GOLDEN_FIRST_SCORES, atol=1e-8)


def test_pca_properties(spark):
    x, cols = mx.matrix_norm(fx.lap_features(spark, SF_SMALL), ["F", "O"])
    m = pc.fit_pca(x, cols, 3)
    comp = np.array(m.components)
    assert np.allclose(comp @ comp.T, np.eye(3), atol=1e-8)
    scores = pc.apply_pca(x, m).select("PC1", "PC2", "PC3").toPandas().to_numpy()
    c = np.corrcoef(scores.T)
    assert np.allclose(c - np.diag(np.diag(c)), 0, atol=1e-6)
    assert all(a >= b for a, b in zip(m.explained_variance_ratio, m.explained_variance_ratio[1:]))


def test_pca_record_roundtrip(spark, tmpdir_path):
    from lapengine.sources import sinks
    x, cols = mx.matrix_norm(fx.lap_features(spark, SF_SMALL), ["F", "O"])
    m = pc.fit_pca(x, cols, 3)
    path = os.path.join(tmpdir_path, "pca")
    sinks.save_pca(m.to_frame(spark), path)
    back = pc.PcaModel.from_row(sinks.load_pca(spark, path).first())
    assert back.feature_names == m.feature_names
    assert np.allclose(back.components, m.components)


def test_golden_regression_metrics(spark):
    from lapengine.operators.aggregates import regression_metrics
    pdf = pd.read_csv(os.path.join(DATA, "session_val_predictions.csv"))
    r = regression_metrics(spark.createDataFrame(pdf)).first()
    assert abs(r.MAE - 0.16194617700824665) < 1e-9
    assert abs(r.RMSE - 0.18260248276991806) < 1e-9
    assert abs(r.R2 - 0.9650318255477783) < 1e-9


NUM = ["Avg_Speed_mps", "Brake_Aggression", "Max_Longitudinal_g", "TyreLife"]


def _data(spark):
    return ml.model_dataset(fx.lap_features(spark, SF_SMALL), NUM + ["Compound"], "TargetTime")


def test_folds_partition_rows(spark):
    d = ml.with_fold(_data(spark), "lap_id", 5)
    counts = {r.fold: r["count"] for r in d.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4}
    assert sum(counts.values()) == d.count()


def test_lasso_cv_quality_and_coverage(spark):
    data = _data(spark)
    cv = ml.cross_validate(data, "Lasso", ml.model_zoo()["Lasso"], NUM, ["Compound"], "lap_id",
                           "TargetTime", 5)
    m = cv.metrics.first()
    assert m.R2 > 0.95
    preds = cv.predictions
    assert preds.count() == data.count()
    assert preds.select("lap_id").distinct().count() == data.count()
    assert cv.fold_metrics.count() == 5


def test_linear_attribution_sums_to_prediction(spark):
    data = _data(spark).withColumn("label", F.col("TargetTime"))
    model = ml.fit_pipeline(data, NUM, ["Compound"], ml.model_zoo()["Lasso"]())
    rows = attr.linear_shap_rows(model, data).select("shap", "prediction").toPandas()
    total = rows.shap.apply(sum) + rows.prediction.mean()
    assert np.allclose(total, rows.prediction, atol=1e-6)
    ranked = attr.linear_attribution(model, data, attr.feature_slot_names(model, NUM, ["Compound"])).collect()
    assert ranked[0].feature == "Avg_Speed_mps"


def test_save_load_predict(spark, tmpdir_path):
    data = _data(spark).withColumn("label", F.col("TargetTime"))
    model = ml.fit_pipeline(data, NUM, ["Compound"], ml.model_zoo()["Lasso"]())
    path = os.path.join(tmpdir_path, "model")
    ml.save_model(model, path)
    back = ml.load_model(path)
    req = spark.createDataFrame([("1", 10.0)], "lap_id string, Avg_Speed_mps double")
    p = ml.predict(req, back, {**ml.REQUEST_DEFAULTS, "Brake_Aggression": 0.05, "Max_Longitudinal_g": 1.0})
    assert p.count() == 1 and p.first().prediction is not None


def test_select_best_tie_goes_to_first(spark):
    m = spark.createDataFrame([("Lasso", 1.0, 1.0, 0.5), ("RandomForest", 1.0, 2.0, 0.4)],
                              "model string, MAE double, RMSE double, R2 double")
    assert ml.select_best(m).first().model == "RandomForest"


def test_zoo_has_the_reference_settings():
    zoo = {k: f() for k, f in ml.model_zoo().items()}
    assert list(zoo) == ml.MODEL_ORDER
    rf, gb, xg, lg = (zoo[k] for k in ("RandomForest", "GradientBoosting", "XGBoost", "LightGBM"))
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getFeatureSubsetStrategy()) == (300, 30, "all")
    assert (gb.getMaxIter(), gb.getStepSize(), gb.getMaxDepth(), gb.getSubsamplingRate()) == (100, 0.1, 3, 1.0)
    assert (xg.getMaxIter(), xg.getStepSize(), xg.getMaxDepth(), xg.getSubsamplingRate(), xg.getFeatureSubsetStrategy()) == (400, 0.05, 4, 0.9, "0.9")
    assert (lg.getMaxIter(), lg.getStepSize(), lg.getSubsamplingRate()) == (400, 0.05, 0.9)
    assert zoo["Lasso"].getRegParam() == 0.01 and zoo["Lasso"].getElasticNetParam() == 1.0


def test_single_model_rules():
    one = lambda kind, **p: ml.single_model(kind, p)()
    assert one("RandomForest").getNumTrees() == 100 and one("RandomForest", max_depth=50).getMaxDepth() == 30
    gb = one("GradientBoosting", n_estimators=7, learning_rate=0.2, max_depth=2)
    assert (gb.getMaxIter(), gb.getStepSize(), gb.getMaxDepth()) == (7, 0.2, 2)
    assert one("XGBoost", n_estimators=9).getMaxIter() == 9
    for kind in ("Lasso", "LightGBM", "other"):
        assert (one(kind).getNumTrees(), one(kind).getMaxDepth(), one(kind).getFeatureSubsetStrategy()) == (100, 30, "all")


def test_preprocessor_scales_by_population_std(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    data = _data(spark)
    n = data.count()
    x = Pipeline(stages=ml.build_preprocessor(NUM, [], n)).fit(data).transform(data).select(vector_to_array("features").alias("x")).collect()
    a = np.array([r.x for r in x])
    assert np.allclose(a.mean(axis=0), 0, atol=1e-9) and np.allclose(a.std(axis=0), 1, atol=1e-9)


def test_one_hot_of_unknown_levels(spark):
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "v string")
    got = {r.v: r.x for r in mx.one_hot(df, "v", "hot").select("v", vector_to_array("hot").alias("x")).collect()}
    assert got["a"][:3] == [1, 0, 0] and got["b"][:3] == [0, 1, 0] and got["c"][:3] == [0, 0, 1] and got[None][:3] == [0, 0, 0]


@pytest.mark.parametrize("n", [1])
def test_metrics_json(spark, n):
    from lapengine.sources.sinks import metrics_json
    m = spark.createDataFrame([("Lasso", 1.0, 1.0, 0.5), ("RandomForest", 2.0, 2.0, 0.4)],
                              "model string, MAE double, RMSE double, R2 double")
    doc = json.loads(metrics_json(m, ml.MODEL_ORDER).first().json)
    assert doc["best_model"] == "Lasso" and "RandomForest" in doc["models"]


def test_tree_importances_ranked(spark):
    data = _data(spark).withColumn("label", F.col("TargetTime"))
    model = ml.fit_pipeline(data, NUM, ["Compound"], ml.single_model("RandomForest", {"n_estimators": 20, "max_depth": 5})())
    imp = attr.tree_importances(spark, model, attr.feature_slot_names(model, NUM, ["Compound"])).collect()
    assert imp[0].feature in ("Avg_Speed_mps", "Brake_Aggression", "Max_Longitudinal_g")
    assert abs(sum(r.value for r in imp) - 1.0) < 1e-9


@pytest.fixture()
def small_zoo(monkeypatch):
    """The model queries with small models; gives the cross-validations that they ran and the rows that each fit was given."""
    from lapengine.operators import boosting as bo
    from lapengine.plans import queries_ml as qm
    run, trees, fit, fit_trees, cvs, fits = ml.cross_validate, ml.cross_validate_trees, ml.fit_pipeline, bo.fit, {}, []
    small = {n: replace(s, trees=3, leaves=8) for n, s in ml.tree_zoo().items()}

    def seen(df, name, *args, **kw):
        cvs[name] = run(df, name, *args, **kw)
        return cvs[name]

    def seen_trees(*args, **kw):
        cvs.update(out := trees(*args, **kw))
        return out

    def fitted(df, *args):
        fits.append(df.count())
        return fit(df, *args)

    def fitted_trees(blocks, *args, **kw):
        fits.append(blocks.map(lambda b: len(b.y)).sum())
        return fit_trees(blocks, *args, **kw)
    monkeypatch.setattr(ml, "tree_zoo", lambda: small)
    monkeypatch.setattr(ml, "cross_validate", seen)
    monkeypatch.setattr(ml, "cross_validate_trees", seen_trees)
    monkeypatch.setattr(ml, "fit_pipeline", fitted)
    monkeypatch.setattr(bo, "fit", fitted_trees)
    return qm, cvs, fits


def test_model_queries_fit_and_score_every_row(spark, small_zoo):
    qm, cvs, fits = small_zoo
    n = qm._model_data(spark, SF_SMALL).count()
    for query, name in (("f10_random_forest", "RandomForest"), ("f14_boosted_lgbm", "LightGBM"), ("f12_lasso", "Lasso")):
        fits.clear()
        assert QUERIES[query](spark, SF_SMALL).first().model == name
        assert cvs[name].predictions.count() == n and cvs[name].predictions.select("lap_id").distinct().count() == n
        assert sum(fits) == (4 * n if name == "Lasso" else n)   # trees: one matrix for all folds
    got = QUERIES["f13_boosted_xgb_folds"](spark, SF_SMALL).toPandas()
    p = cvs["XGBoost"].predictions.toPandas()
    want = {f: ((g.y_true - g.y_pred).abs().mean(), len(g)) for f, g in p.groupby("fold")}
    assert set(got.fold) == set(range(5)) and all(np.allclose((r.MAE, r.n), want[r.fold], atol=1e-6) for r in got.itertuples())


def test_model_zoo_gives_the_metrics_and_the_best(spark, small_zoo):
    qm, cvs, fits = small_zoo
    got = QUERIES["f10_f14_model_zoo"](spark, SF_SMALL).collect()
    assert {(r.model, r.metric) for r in got} == {(m, k) for m in ml.MODEL_ORDER for k in ("MAE", "RMSE", "R2")} and len(got) == 15
    for name in ("Lasso", "LightGBM"):
        p = cvs[name].predictions.toPandas()
        want = (p.y_true - p.y_pred).abs().groupby(p.fold).mean().mean()
        assert np.isclose(next(r.value for r in got if (r.model, r.metric) == (name, "MAE")), want, atol=1e-6)
    mae = {r.model: r.value for r in got if r.metric == "MAE"}
    assert {r.model for r in got if r.is_best} == {min(ml.MODEL_ORDER, key=mae.get)}
    assert len(fits) == 6                                   # all tree models share one matrix


def test_permutation_importance_query_measures_every_row(spark, small_zoo, monkeypatch):
    qm, _, fits = small_zoo
    n, run, seen = qm._model_data(spark, SF_SMALL).count(), attr.ensemble_permutation_importance, []
    monkeypatch.setattr(attr, "ensemble_permutation_importance", lambda m, b, df, *args: seen.append((m, b, df.count())) or run(m, b, df, *args))
    got = QUERIES["f22_permutation_importance"](spark, SF_SMALL).collect()
    assert fits == [n] and seen[0][2] == n and n // 1000 > 1    # several buckets
    assert got[0].feature == "Avg_Speed_mps" and len(got) == len(qm.NUM_MODEL)


def test_permutation_in_one_pass_equals_a_join_a_feature(spark):
    from lapengine.operators import boosting as bo
    data = _data(spark).withColumn("label", F.col("TargetTime"))
    model, binning = ml.fit_trees(data, bo.TreeSettings(5, 0.5, depth=3), NUM, ["Compound"], "lap_id", "TargetTime")

    class Scored:
        def transform(self, df):
            return df.withColumn("prediction", bo.predicted(df, binning, {0: model}, F.lit(0)))
    features = [NUM[1], "Compound", NUM[0]]
    once = attr.ensemble_permutation_importance(model, binning, data, features, "label", "lap_id", bucket_rows=300)
    each = attr.permutation_importance(Scored(), data, features, "label", "lap_id", bucket_rows=300)
    got, want = ({r.feature: r.value for r in x.collect()} for x in (once, each))
    assert set(got) == set(features) and all(np.isclose(got[c], want[c], atol=1e-9) for c in features) and max(got.values()) > 1


def test_queries_limit_the_generated_methods(spark):
    """HotSpot does not compile methods of more than 8,000 bytes."""
    from lapengine.plans.registry import load_all
    from lapengine.session import BASE_CONF, limit_method_size
    load_all()
    key = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(key)
    try:
        for mine, want in (("65535", "8000"), ("5000", "5000")):
            spark.conf.set(key, mine)
            QUERIES["f15_folds"](spark, SF_SMALL)
            assert spark.conf.get(key) == want
        spark.conf.set(key, "65535")
        limit_method_size(spark)
        assert spark.conf.get(key) == BASE_CONF[key]
    finally:
        spark.conf.set(key, was)


def test_cross_validation_reads_only_the_columns_it_needs(spark):
    df = spark.createDataFrame([(str(i), float(i), "much text", 2.0 * i) for i in range(50)], "id string, a double, other string, t double")
    cv = ml.cross_validate(df, "LeastSquares", lambda: ml.LinearRegression(solver="normal", labelCol="label"), ["a"], [], "id", "t", 3, refit=False)
    assert cv.predictions.columns == ["id", "a", "other", "t", "fold", "y_true", "y_pred"] and cv.predictions.count() == 50
    plan = cv.fold_metrics._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan and "a#" in plan


@pytest.mark.parametrize("l1", [0.0, 0.01, 0.3])
def test_linear_fits_take_moments_and_equal_fits_on_all_rows(spark, monkeypatch, l1):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(1e4 + b), 7.0, "xyz"[i % 3] if i % 7 else None, float(3 * a - 2 * b + (i % 3 == 1) + e))
            for i, (a, b, e) in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "a double, b double, still double, c string, label double")
    seen, fit = [], ml.LinearRegression._fit
    monkeypatch.setattr(ml.LinearRegression, "_fit", lambda self, data: seen.append(data.count()) or fit(self, data))

    def linear():
        return ml.LinearRegression(regParam=l1, elasticNetParam=1.0, standardization=False, maxIter=5000, tol=1e-10, labelCol="label")
    cols = (["a", "b", "still"], ["c"])
    whole = ml.make_pipeline(*cols, linear(), 400).fit(df).stages[-1]
    few = ml.fit_pipeline(df, *cols, linear()).stages[-1]
    assert seen == [400, 2 * 7 if l1 else 400]              # three numbers, three levels, the label
    assert np.allclose(few.coefficients, whole.coefficients, atol=1e-6) and np.isclose(few.intercept, whole.intercept, atol=1e-6)
    ml.fit_pipeline(df.withColumn("label", F.lit(2.0)), *cols, linear())        # a constant label: all rows
    assert seen[2:] == [400]
