"""Registered queries for E4, E5, E12, E16, D4, A15/A16 and F1-F22 (FX3 / FX4)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapengine.operators import aggregates as agg
from lapengine.operators import attribution as attr
from lapengine.operators import compare
from lapengine.operators import matrix as mx
from lapengine.operators import models as ml
from lapengine.operators import pca as pc
from lapengine.operators.matrix import one_row
from lapengine.plans import fixtures as fx
from lapengine.plans import sqltext as q
from lapengine.plans.registry import register
from lapengine.sources import sinks

R = q.round_sql
LF = {"lf": fx.SQL_LAP_FEATURES}
COMPOUNDS = ["F", "O"]
YEARS = [str(y) for y in range(1995, 2002)]
NUM_MODEL = ["Avg_Speed_mps", "Avg_Throttle", "Brake_Aggression", "MeanAbs_Jerk_Long", "MeanAbs_Jerk_Lat",
             "Max_Lateral_g", "Max_Longitudinal_g", "Energy_Index", "TyreLife", "LapNumber"]
CAT_MODEL = ["Compound", "Event"]
TARGET = "TargetTime"


def _z_sql(c: str, by: str, suffix: str = "_norm") -> str:
    sd = f"stddev_samp({c}) OVER (PARTITION BY {by})"
    return f"{R(f'({c} - avg({c}) OVER (PARTITION BY {by})) / (CASE WHEN {sd} = 0 THEN 1.0e0 ELSE {sd} END)')} AS {c}{suffix}"


def _std_sql(c: str, suffix: str = "") -> str:
    sd = f"stddev_pop({c}) OVER ()"
    return f"{R(f'({c} - avg({c}) OVER ()) / (CASE WHEN {sd} = 0 THEN 1.0e0 ELSE {sd} END)')} AS {c}{suffix}"


def _dummy_sql(col: str, prefix: str, levels: list[str]) -> list[str]:
    return [f"CASE WHEN CAST({col} AS VARCHAR) = '{v}' THEN 1 ELSE 0 END AS {prefix}_{v}" for v in levels]


# ------------------------------------------------------------------ E4, E5

_E4_COLS = ["LapTimeSeconds", "Avg_Speed_mps", "Brake_Aggression"]


@register("e4_zscore_by_event",
          q.with_(LF, "SELECT lap_id, " + ", ".join(_z_sql(c, "Year, Event") for c in _E4_COLS) + " FROM lf"))
def e4_zscore_by_event(spark, sf):
    """Per-event z-score with the sample std."""
    return agg.zscore_by(fx.lap_features(spark, sf), ["Year", "Event"], _E4_COLS).select(
        "lap_id", *[f"{c}_norm" for c in _E4_COLS])


@register("e4_zscore_small_groups",
          q.with_({"lf0": fx.SQL_LAP_FEATURES, "lf": "SELECT *, 1.0e0 AS Const FROM lf0"},
                  "SELECT lap_id, " + ", ".join(_z_sql(c, "Year, Event, Driver") for c in ["Avg_Speed_mps", "Const"])
                  + " FROM lf"))
def e4_zscore_small_groups(spark, sf):
    """E4 edge cases: one-row groups -> null, zero spread -> 0."""
    lf = fx.lap_features(spark, sf).withColumn("Const", F.lit(1.0))
    return agg.zscore_by(lf, ["Year", "Event", "Driver"], ["Avg_Speed_mps", "Const"]).select(
        "lap_id", "Avg_Speed_mps_norm", "Const_norm")


@register("e5_energy_per_m",
          q.with_(LF, f"SELECT lap_id, {R('Avg_Speed_mps * LapTimeSeconds')} AS Lap_Distance_est, "
                      f"{R('Energy_Index / nullif(Avg_Speed_mps * LapTimeSeconds, 0)')} AS Energy_per_m FROM lf"))
def e5_energy_per_m(spark, sf):
    """E5: estimated lap distance and energy per metre."""
    return agg.energy_per_m(fx.lap_features(spark, sf)).select("lap_id", "Lap_Distance_est", "Energy_per_m")


# ------------------------------------------------------------------ E12

@register("e12_regression_metrics",
          q.with_({**LF, "p": "SELECT Event, TargetTime AS y_true, 3.0e0 * Avg_Speed_mps + 10.0e0 AS y_pred FROM lf",
                   "s": "SELECT Event, avg(abs(y_pred - y_true)) AS MAE, avg((y_pred - y_true) * (y_pred - y_true)) AS mse, "
                        "sum((y_pred - y_true) * (y_pred - y_true)) AS sse, avg(y_true) AS ybar, count(*) AS n FROM p GROUP BY Event",
                   "t": "SELECT p.Event, sum((y_true - ybar) * (y_true - ybar)) AS sst FROM p JOIN s USING (Event) GROUP BY p.Event"},
                  f"SELECT s.Event, {R('MAE')} AS MAE, {R('sqrt(mse)')} AS RMSE, "
                  f"{R('CASE WHEN sst = 0 THEN NULL ELSE 1.0e0 - sse / sst END')} AS R2, n FROM s JOIN t USING (Event)"))
def e12_regression_metrics(spark, sf):
    """MAE, RMSE, R2 per group (two aggregate passes)."""
    lf = fx.lap_features(spark, sf)
    p = lf.select("Event", F.col("TargetTime").alias("y_true"),
                  (F.lit(3.0) * F.col("Avg_Speed_mps") + F.lit(10.0)).alias("y_pred"))
    return agg.regression_metrics(p, by=["Event"])


# ------------------------------------------------------------------ F1, F2, F5-F8

@register("f1_dummies", q.with_(LF, "SELECT lap_id, " + ", ".join(_dummy_sql("Compound", "Compound", COMPOUNDS))
                                    + " FROM lf"))
def f1_dummies(spark, sf):
    """one-hot indicators, sorted levels, null -> all zero."""
    x, names = mx.dummies(fx.lap_features(spark, sf), "Compound", "Compound", COMPOUNDS)
    return x.select("lap_id", *names)


@register("f2_standardize",
          q.with_(LF, "SELECT lap_id, " + ", ".join(_std_sql(c) for c in mx.BASE_FEATURES) + " FROM lf"))
def f2_standardize(spark, sf):
    """standard scaling with the population std."""
    lf = fx.lap_features(spark, sf).select("lap_id", *mx.BASE_FEATURES)
    return mx.standardize(lf, mx.BASE_FEATURES)


@register("f5_matrix_session",
          q.with_(LF, "SELECT lap_id, " + ", ".join(f"{R(c)} AS {c}" for c in mx.BASE_FEATURES) + ", "
                      + ", ".join(_dummy_sql("Compound", "Compound", COMPOUNDS)) + " FROM lf WHERE Event = 'A'"))
def f5_matrix_session(spark, sf):
    """one event's matrix (features + Compound dummies)."""
    x, cols = mx.matrix_session(fx.lap_features(spark, sf).where(F.col("Event") == "A"), COMPOUNDS)
    return x.select("lap_id", *cols)


@register("f6_matrix_global",
          q.with_(LF, "SELECT lap_id, " + ", ".join(f"{R(c)} AS {c}" for c in mx.BASE_FEATURES) + ", "
                      + ", ".join(_dummy_sql("Compound", "Compound", COMPOUNDS) + _dummy_sql("Year", "Year", YEARS))
                      + " FROM lf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in mx.BASE_FEATURES)))
def f6_matrix_global(spark, sf):
    """global matrix with Compound and Year dummies, complete rows."""
    x, cols = mx.matrix_global(fx.lap_features(spark, sf), COMPOUNDS, YEARS)
    return x.select("lap_id", *cols)


def _norm_parts() -> tuple[dict[str, str], str]:
    ctes = {**LF, "e5": "SELECT *, Energy_Index / nullif(Avg_Speed_mps * LapTimeSeconds, 0) AS Energy_per_m FROM lf",
            "z": "SELECT lap_id, Compound, " + ", ".join(
                f"(({c} - avg({c}) OVER (PARTITION BY Year, Event)) / (CASE WHEN stddev_samp({c}) OVER "
                f"(PARTITION BY Year, Event) = 0 THEN 1.0e0 ELSE stddev_samp({c}) OVER (PARTITION BY Year, Event) END)) "
                f"AS {c}_norm" for c in mx.ZSCORE_FEATURES + ["Energy_per_m", "TyreLife"]) + " FROM e5"}
    where = " AND ".join(f"{c} IS NOT NULL" for c in mx.NORM_FEATURES)
    return ctes, where


def _norm_sql() -> str:
    ctes, where = _norm_parts()
    body = ("SELECT lap_id, " + ", ".join(f"{R(c)} AS {c}" for c in mx.NORM_FEATURES) + ", "
            + ", ".join(_dummy_sql("Compound", "Compound", COMPOUNDS)) + f" FROM z WHERE {where}")
    return q.with_(ctes, body)


@register("f7_matrix_norm", _norm_sql())
def f7_matrix_norm(spark, sf):
    """per-event normalised matrix (E4 + E5 + F1 + B5)."""
    x, cols = mx.matrix_norm(fx.lap_features(spark, sf), COMPOUNDS)
    return x.select("lap_id", *cols)


@register("f15_folds",
          q.with_(LF, "SELECT lap_id, CAST(CAST('0x' || substr(md5('42:' || lap_id), 1, 8) AS BIGINT) % 5 AS INTEGER) "
                      "AS fold FROM lf"))
def f15_folds(spark, sf):
    """hash fold assignment, seed 42, 5 folds."""
    return ml.with_fold(fx.lap_features(spark, sf).select("lap_id"), "lap_id", 5)


@register("f15_exact_folds",
          q.with_(LF, "SELECT lap_id, CAST(ntile(5) OVER (ORDER BY CAST('0x' || substr(md5('42:' || lap_id), 1, 8) AS BIGINT), lap_id) - 1 AS INTEGER) AS fold FROM lf"))
def f15_exact_folds(spark, sf):
    """shuffled folds whose sizes differ by one row at most."""
    return ml.with_exact_fold(fx.lap_features(spark, sf).select("lap_id"), "lap_id", 5)


# ------------------------------------------------------------------ F16 / F17 (exact linear oracle)

def ols_cv(df, xs: list[str], y: str, key: str, k: int = 5):
    """K-fold one-feature least squares of each of ``xs`` from sufficient statistics (F16, exact).

    Two passes whatever the number of features: one grouped aggregate with
    every feature's sums (``k`` rows; the training statistics of a fold are the
    totals minus its own), and one with every feature's metrics, in which the
    fitted lines are literals.  Returns ``model, fold, slope, intercept, MAE, RMSE, R2, n``.
    """
    d = ml.with_fold(df.select(key, *xs, F.col(y).alias("y")), key, k).drop(key)

    def both(x, value):
        return F.when(F.col(x).isNotNull() & F.col("y").isNotNull(), value)

    names = ("n", "sx", "sy", "sxx", "sxy")
    sums = [F.sum(both(x, v)).alias(f"{n}_{x}") for x in xs
            for n, v in zip(names, (F.lit(1), F.col(x), F.col("y"), F.col(x) * F.col(x), F.col(x) * F.col("y")))]
    rows = d.groupBy("fold").agg(*sums).collect()  # at most k rows
    lines, aggs, stacked = {}, [], []
    for x in xs:
        total = [sum(r[f"{n}_{x}"] or 0 for r in rows) for n in names]
        for r in rows:
            n, sx, sy, sxx, sxy = [t - (r[f"{c}_{x}"] or 0) for t, c in zip(total, names)]
            spread = n * sxx - sx * sx
            if n and spread:
                slope = (n * sxy - sx * sy) / spread
                lines[x, r.fold] = slope, (sy - slope * sx) / n

        def line(part):
            out = F.lit(None).cast("double")
            for f in range(k):
                if (x, f) in lines:
                    out = F.when(F.col("fold") == f, F.lit(lines[x, f][part])).otherwise(out)
            return out
        e = both(x, line(1) + line(0) * F.col(x) - F.col("y"))
        sst = F.var_pop(both(x, F.col("y"))) * F.count(e)
        r2 = F.when(sst == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0) - F.sum(e * e) / sst)
        aggs += [F.avg(F.abs(e)).alias(f"MAE_{x}"), F.sqrt(F.avg(e * e)).alias(f"RMSE_{x}"), r2.alias(f"R2_{x}"), F.count(e).alias(f"n_{x}")]
        stacked.append(F.struct(F.lit(x).alias("model"), line(0).alias("slope"), line(1).alias("intercept"),
                                *[F.col(f"{c}_{x}").alias(c) for c in ("MAE", "RMSE", "R2", "n")]))
    m = d.groupBy("fold").agg(*aggs)
    return m.select("fold", F.explode(F.array(*stacked)).alias("r")).select("r.model", "fold", *[f"r.{c}" for c in ("slope", "intercept", "MAE", "RMSE", "R2", "n")]) \
            .where(F.col("n") > 0)


def _ols_cv_sql(x: str, y: str = TARGET, src: str = "lf") -> dict[str, str]:
    fold = "CAST(CAST('0x' || substr(md5('42:' || lap_id), 1, 8) AS BIGINT) % 5 AS INTEGER)"
    return {
        f"d_{x}": f"SELECT {fold} AS fold, {x} AS x, {y} AS y FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL",
        f"s_{x}": f"SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy "
                  f"FROM d_{x} GROUP BY fold",
        f"c_{x}": f"SELECT fold, t.n - s.n AS n, t.sx - s.sx AS sx, t.sy - s.sy AS sy, t.sxx - s.sxx AS sxx, "
                  f"t.sxy - s.sxy AS sxy FROM s_{x} s, (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, "
                  f"sum(sxx) AS sxx, sum(sxy) AS sxy FROM s_{x}) t",
        f"p_{x}": f"SELECT fold, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, "
                  f"(sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n AS intercept FROM c_{x}",
        f"q_{x}": f"SELECT fold, y AS y_true, intercept + slope * x AS y_pred FROM d_{x} JOIN p_{x} USING (fold)",
        f"m_{x}": f"SELECT fold, avg(abs(y_pred - y_true)) AS MAE, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS RMSE, "
                  f"sum((y_pred - y_true) * (y_pred - y_true)) AS sse, avg(y_true) AS ybar, count(*) AS n "
                  f"FROM q_{x} GROUP BY fold",
        f"r_{x}": f"SELECT q.fold, sum((y_true - ybar) * (y_true - ybar)) AS sst FROM q_{x} q JOIN m_{x} USING (fold) "
                  f"GROUP BY q.fold",
        f"f_{x}": f"SELECT fold, slope, intercept, MAE, RMSE, CASE WHEN sst = 0 THEN NULL ELSE 1.0e0 - sse / sst END AS R2, "
                  f"n FROM p_{x} JOIN m_{x} USING (fold) JOIN r_{x} USING (fold)",
    }


@register("f16_cv_least_squares",
          q.with_({**LF, **_ols_cv_sql("Avg_Speed_mps")},
                  "SELECT fold, " + ", ".join(f"{R(c)} AS {c}" for c in ("slope", "intercept", "MAE", "RMSE", "R2"))
                  + ", n FROM f_Avg_Speed_mps"))
def f16_cv_least_squares(spark, sf):
    """F16 (linear, exact): 5-fold one-feature least squares, metrics per fold."""
    return ols_cv(fx.lap_features(spark, sf), ["Avg_Speed_mps"], TARGET, "lap_id", 5).drop("model")


_F17_FEATURES = ["Avg_Speed_mps", "Brake_Aggression", "Max_Longitudinal_g", "Energy_Index"]


def _f17_sql() -> str:
    ctes = dict(LF)
    for x in _F17_FEATURES:
        ctes.update(_ols_cv_sql(x))
    ctes["all_m"] = " UNION ALL ".join(
        f"SELECT '{x}' AS model, {i + 1} AS rk, avg(MAE) AS MAE, avg(RMSE) AS RMSE, avg(R2) AS R2 FROM f_{x}"
        for i, x in enumerate(_F17_FEATURES))
    return q.with_(ctes, f"SELECT model, {R('MAE')} AS MAE, {R('RMSE')} AS RMSE, {R('R2')} AS R2 FROM all_m "
                         "ORDER BY MAE, rk LIMIT 1")


@register("f17_select_best", _f17_sql())
def f17_select_best(spark, sf):
    """best of several CV'd one-feature models by lowest mean MAE."""
    m = ols_cv(fx.lap_features(spark, sf), _F17_FEATURES, TARGET, "lap_id", 5)
    means = m.groupBy("model").agg(F.avg("MAE").alias("MAE"), F.avg("RMSE").alias("RMSE"), F.avg("R2").alias("R2"))
    return ml.select_best(means, _F17_FEATURES)


@register("f21_default_fill",
          q.with_(LF, "SELECT lap_id, coalesce(Compound, 'MEDIUM') AS Compound, 'R' AS SessionType, "
                      "0.0e0 AS PC1, 0.0e0 AS PC2, 0.0e0 AS PC3 FROM lf"))
def f21_default_fill(spark, sf):
    """F21 input side: missing request columns and null cells take the defaults."""
    d = ml.with_defaults(fx.lap_features(spark, sf).select("lap_id", "Compound"),
                         {k: ml.REQUEST_DEFAULTS[k] for k in ("Compound", "SessionType", "PC1", "PC2", "PC3")})
    return d.select("lap_id", "Compound", "SessionType", "PC1", "PC2", "PC3")


# ------------------------------------------------------------------ PCA (rows-only + properties in tests)

def _norm_pca(spark, sf):
    x, cols = mx.matrix_norm(fx.lap_features(spark, sf), COMPOUNDS)
    return x, cols, pc.fit_pca(x, cols, 3)


@register("f3_pca_norm_variance")
def f3_pca_norm_variance(spark, sf):
    """explained-variance ratio and singular values of the normalised matrix."""
    _, _, m = _norm_pca(spark, sf)
    return pc.variance_frame(spark, m)


@register("f3_pca_norm_loadings")
def f3_pca_norm_loadings(spark, sf):
    """loadings (sign-fixed) of the normalised matrix."""
    _, _, m = _norm_pca(spark, sf)
    return pc.loadings_frame(spark, m)


@register("f3_f4_pca_scores")
def f3_f4_pca_scores(spark, sf):
    """F3 + F4: PC scores of every complete lap."""
    x, _, m = _norm_pca(spark, sf)
    return pc.apply_pca(x, m).select("lap_id", "PC1", "PC2", "PC3")


@register("f3_pca_embeddings")
def f3_pca_embeddings(spark, sf):
    """F3 on FX4: 64-dimensional embeddings, explained variance."""
    e = fx.matrix(spark, sf)
    cols = [f"x{i}" for i in range(64)]
    x = e.select("vec_id", *[F.col("x")[i].alias(c) for i, c in enumerate(cols)])
    return pc.variance_frame(spark, pc.fit_pca(x, cols, 3))


# A stored model record with round numbers, so that scores can be written in SQL.
STORED_PCA = pc.PcaModel(
    feature_names=mx.NORM_FEATURES,
    mean=[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
    scale=[1.0, 1.25, 1.5, 1.75, 2.0, 2.25, 2.5, 2.75, 3.0],
    components=[[0.5, 0.25, 0.0, -0.25, -0.5, 0.125, 0.375, 0.625, -0.125],
                [0.25, 0.5, 0.125, 0.0, 0.25, -0.5, -0.25, 0.375, 0.5],
                [-0.125, 0.25, 0.5, 0.25, 0.0, 0.375, -0.5, 0.25, 0.125]],
    explained_variance_ratio=[0.5, 0.25, 0.125], singular_values=[8.0, 4.0, 2.0], n_rows=0)


def _pc_sql(i: int) -> str:
    m = STORED_PCA
    return " + ".join(f"({c} - {q.lit(a)}) / {q.lit(b)} * {q.lit(w)}" for c, a, b, w in zip(m.feature_names, m.mean, m.scale, m.components[i]))


def _scores_ctes() -> dict[str, str]:
    ctes, where = _norm_parts()
    ctes["scores"] = "SELECT lap_id, " + ", ".join(f"{_pc_sql(i)} AS PC{i + 1}" for i in range(3)) + f" FROM z WHERE {where}"
    return ctes


_PCS = ", ".join(f"{R(f'PC{i}')} AS PC{i}" for i in (1, 2, 3))


def _stored_scores(spark, sf):
    """Scores of every complete lap by a record that has been written and read back."""
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(spark, "pca-model")
    sinks.save_pca(STORED_PCA.to_frame(spark), path)
    x, _ = mx.matrix_norm(fx.lap_features(spark, sf), COMPOUNDS)
    return pc.apply_pca(x, pc.PcaModel.from_row(sinks.load_pca(spark, path).first()))


@register("f4_apply_stored_pca", q.with_(_scores_ctes(), f"SELECT lap_id, {_PCS} FROM scores"))
def f4_apply_stored_pca(spark, sf):
    """F4 + A15: a stored record reloaded and applied to all laps."""
    return _stored_scores(spark, sf).select("lap_id", "PC1", "PC2", "PC3")


@register("d4_attach_scores", q.with_(_scores_ctes(), f"SELECT lap_id, Driver, {_PCS} FROM lf LEFT JOIN scores USING (lap_id)"))
def d4_attach_scores(spark, sf):
    """PC scores joined to lap features by key (unmatched -> null)."""
    scores = _stored_scores(spark, sf).select("lap_id", "PC1", "PC2", "PC3")
    return compare.attach_scores(fx.lap_features(spark, sf).select("lap_id", "Driver"), scores, ["lap_id"])


@register("e16_latent_view",
          q.with_({**_scores_ctes(), "s": "SELECT scores.*, Driver, lf.LapNumber, lf.Compound FROM scores JOIN lf USING (lap_id)",
                   "first5": "SELECT DISTINCT Driver FROM s ORDER BY Driver LIMIT 5"},
                  f"SELECT lap_id, LapNumber, Driver, {_PCS}, Compound FROM s SEMI JOIN first5 USING (Driver)"))
def e16_latent_view(spark, sf):
    """Scores of the first five drivers with optional columns."""
    return agg.latent_view(_stored_scores(spark, sf), None, 5, ["Compound", "Missing"])


@register("f8_model_dataset",
          q.with_(LF, "SELECT lap_id, TargetTime, Compound, Event FROM lf WHERE "
                      + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET])))
def f8_model_dataset(spark, sf):
    """F8: complete model rows with the target split off."""
    d = ml.model_dataset(fx.lap_features(spark, sf), NUM_MODEL + CAT_MODEL, TARGET)
    return d.select("lap_id", "TargetTime", "Compound", "Event")


@register("f8_model_dataset_with_pcs",
          q.with_(_scores_ctes(), f"SELECT lap_id, TargetTime, Driver, Year, SessionType, {_PCS} FROM lf JOIN scores USING (lap_id) WHERE "
                  + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET])))
def f8_model_dataset_with_pcs(spark, sf):
    """F8 + D4 as the reference has it: principal components joined by key, incomplete rows dropped."""
    scores = _stored_scores(spark, sf).select("lap_id", "PC1", "PC2", "PC3")
    features = NUM_MODEL + CAT_MODEL + ["Driver", "Year", "SessionType", "PC1", "PC2", "PC3"]
    d = ml.model_dataset(fx.lap_features(spark, sf), features, TARGET, scores, ["lap_id"])
    return d.select("lap_id", "TargetTime", "Driver", "Year", "SessionType", "PC1", "PC2", "PC3")


# ------------------------------------------------------------------ models (rows-only)

def _model_data(spark, sf):
    return ml.model_dataset(fx.lap_features(spark, sf), NUM_MODEL + CAT_MODEL, TARGET)


@register("f16_cv_lasso")
def f16_cv_lasso(spark, sf):
    """F12 + F16: Lasso (alpha 0.01) 5-fold CV metrics."""
    cv = ml.cross_validate(_model_data(spark, sf), "Lasso", ml.model_zoo()["Lasso"], NUM_MODEL,
                           CAT_MODEL, "lap_id", TARGET, 5, refit=False)
    return cv.metrics


def _zoo_cv(spark, sf, names):
    """5-fold results of full-size models, fitted on all rows of the other folds; the tree models share their passes."""
    data, trees = _model_data(spark, sf), {n: s for n, s in ml.tree_zoo().items() if n in names}
    out = ml.cross_validate_trees(data, trees, NUM_MODEL, CAT_MODEL, "lap_id", TARGET, 5) if trees else {}
    if "Lasso" in names:
        out["Lasso"] = ml.cross_validate(data, "Lasso", ml.model_zoo()["Lasso"], NUM_MODEL, CAT_MODEL, "lap_id", TARGET, 5, refit=False)
    return out


def _beats_mean(spark, sf, name):
    """``model, beats_mean``: whether the model's 5-fold MAE is below that of predicting the mean, both over all rows."""
    data = _model_data(spark, sf)
    mean = one_row(data.agg(F.avg(TARGET).alias("m")))["m"]
    base = one_row(data.agg(F.avg(F.abs(F.col(TARGET) - F.lit(mean))).alias("m")))["m"]
    return _zoo_cv(spark, sf, [name])[name].metrics.select("model", (F.col("MAE") < F.lit(base)).alias("beats_mean"))


def _register_model(query: str, name: str) -> None:
    @register(query, f"SELECT '{name}' AS model, true AS beats_mean")
    def run(spark, sf):
        return _beats_mean(spark, sf, name)


MODEL_QUERIES = dict(zip(("f10_random_forest", "f11_gradient_boosting", "f12_lasso", "f13_boosted_xgb", "f14_boosted_lgbm"), ml.MODEL_ORDER))
for _query, _name in MODEL_QUERIES.items():
    _register_model(_query, _name)


def _register_folds(query: str, name: str) -> None:
    @register(query)
    def run(spark, sf):
        return _zoo_cv(spark, sf, [name])[name].fold_metrics.select(F.lit(name).alias("model"), "fold", "MAE", "RMSE", "R2", "n")


for _query, _name in (("f10_random_forest_folds", "RandomForest"), ("f11_gradient_boosting_folds", "GradientBoosting"),
                      ("f13_boosted_xgb_folds", "XGBoost"), ("f14_boosted_lgbm_folds", "LightGBM")):
    _register_folds(_query, _name)
    MODEL_QUERIES[_query] = _name
MODEL_QUERIES["f10_f14_model_zoo"] = "all"


@register("f10_f14_model_zoo")
def f10_f14_model_zoo(spark, sf):
    """F10-F14 + F16 + F17 + A16: metrics of every full-size model, fitted and scored on all rows, the best one flagged."""
    cvs = _zoo_cv(spark, sf, ml.MODEL_ORDER)
    return sinks.metrics_table(reduce(DataFrame.unionByName, [cvs[n].metrics for n in ml.MODEL_ORDER]), ml.MODEL_ORDER)


@register("a16_metrics_document")
def a16_metrics_document(spark, sf):
    """The metrics document of two cross-validated linear models."""
    data = _model_data(spark, sf)
    cvs = [ml.cross_validate(data, n, f, NUM_MODEL, [], "lap_id", TARGET, 5, refit=False).metrics
           for n, f in (("LeastSquares", _least_squares), ("Lasso", ml.model_zoo()["Lasso"]))]
    return sinks.metrics_json(cvs[0].unionByName(cvs[1]), ["LeastSquares", "Lasso"])


def _least_squares():
    return LinearRegression(regParam=0.0, solver="normal", labelCol="label")


ONE = ["Avg_Speed_mps"]


@register("f18_validation_predictions",
          q.with_({**LF, "lfc": "SELECT * FROM lf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET]),
                   "d": "SELECT lap_id, CAST(CAST('0x' || substr(md5('42:' || lap_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, "
                        f"Avg_Speed_mps AS x, {TARGET} AS y FROM lfc",
                   **{f"t{f}": f"SELECT {f} AS fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM d WHERE fold <> {f}" for f in range(5)},
                   "t": " UNION ALL ".join(f"SELECT * FROM t{f}" for f in range(5))},
                  f"SELECT lap_id, fold, {R('y')} AS y_true, {R('b + a * x')} AS y_pred FROM d JOIN t USING (fold)"))
def f18_validation_predictions(spark, sf):
    """F16 + F18: out-of-fold predictions of the cross-validated pipeline (one-feature least squares)."""
    cv = ml.cross_validate(_model_data(spark, sf), "LeastSquares", _least_squares, ONE, [], "lap_id", TARGET, 5, refit=False)
    return ml.validation_predictions(cv, "lap_id").select("lap_id", "fold", "y_true", "y_pred")


@register("f19_train_single")
def f19_train_single(spark, sf):
    """one forest with custom settings, 3 folds."""
    cv = ml.train_single(_model_data(spark, sf), "RandomForest", {"n_estimators": 10, "max_depth": 4},
                         NUM_MODEL, CAT_MODEL, "lap_id", TARGET, 3)
    return cv.metrics


_LINE = {**LF, "lfc": "SELECT * FROM lf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET]),
                   "line": f"SELECT regr_slope({TARGET}, Avg_Speed_mps) AS a, regr_intercept({TARGET}, Avg_Speed_mps) AS b FROM lfc"}


def _line_model(spark, sf):
    return ml.fit_pipeline(_model_data(spark, sf).withColumn("label", F.col(TARGET)), ONE, [], _least_squares())


@register("f21_predict",
          q.with_(_LINE, f"SELECT lap_id, {R('b + a * CASE WHEN Avg_Throttle > 50 THEN Avg_Speed_mps ELSE 55.0e0 END')} AS prediction FROM lf, line"))
def f21_predict(spark, sf):
    """score request rows, missing inputs filled with the defaults."""
    req = fx.lap_features(spark, sf).select("lap_id", F.when(F.col("Avg_Throttle") > 50, F.col("Avg_Speed_mps")).alias("Avg_Speed_mps"))
    return ml.predict(req, _line_model(spark, sf)).select("lap_id", "prediction")


@register("f22_linear_attribution",
          q.with_(_LINE, "SELECT 'Avg_Speed_mps' AS feature, " + R("avg(abs(a * (Avg_Speed_mps - m)))")
                  + " AS value FROM lfc, line, (SELECT avg(Avg_Speed_mps) AS m FROM lfc)"))
def f22_linear_attribution(spark, sf):
    """mean |Shapley| per input of a linear model, ranked."""
    data = _model_data(spark, sf).withColumn("label", F.col(TARGET))
    model = _line_model(spark, sf)
    return attr.linear_attribution(model, data, attr.feature_slot_names(model, ONE, []))


@register("f22_permutation_importance")
def f22_permutation_importance(spark, sf):
    """F22 for trees: permutation importance of every input of the full-size forest, fitted and measured on all rows."""
    data = _model_data(spark, sf)
    model, binning = ml.fit_trees(data, ml.tree_zoo()["RandomForest"], NUM_MODEL, CAT_MODEL, "lap_id", TARGET)
    return attr.ensemble_permutation_importance(model, binning, data, NUM_MODEL, TARGET, "lap_id")


# ------------------------------------------------------------------ streaming

@register("st2_stream_scoring", q.with_(_LINE, f"SELECT lap_id, {R('b + a * Avg_Speed_mps')} AS prediction FROM lf, line"))
def st2_stream_scoring(spark, sf):
    """ST2: lap rows arriving as a file stream, scored by a fitted pipeline."""
    from lapengine.streaming.scoring import score_stream
    schema = spark.read.parquet(f"{sf}/lineitem.parquet").schema

    def prepare(stream_df):
        return fx.lap_features(spark, None, lineitem=stream_df).select("lap_id", "Avg_Speed_mps")
    return score_stream(spark, f"{sf}/lineitem.parquet*", sf, schema, _line_model(spark, sf), prepare, ["lap_id"])


# ------------------------------------------------------------------ more explicit operator entries

@register("e8_gg_points",
          q.with_({**q.zoh_ctes(), **q.dynamics_ctes()},
                  f"SELECT Driver, LapNumber, tick, {R('AY_lat / ' + q.lit(9.81))} AS Lat_g, "
                  f"{R('AX_long / ' + q.lit(9.81))} AS Long_g FROM d5"))
def e8_gg_points(spark, sf):
    """E8 points form: lateral / longitudinal g per grid sample."""
    from lapengine.plans import telemetry as tp
    return agg.gg_points(tp.dynamics(spark, sf), tp.LAP_KEYS)


def _cov_sql() -> str:
    ctes, where = _norm_parts()
    cols = mx.NORM_FEATURES
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    ctes["m"] = f"SELECT {', '.join(cols)} FROM z WHERE {where}"
    ctes["zs"] = "SELECT " + ", ".join(
        f"({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0e0 "
        f"ELSE stddev_pop({c}) OVER () END) AS {c}" for c in cols) + " FROM m"
    sel = " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {R(f'covar_samp({a}, {b})')} AS cov "
                             f"FROM zs" for a, b in pairs)
    return q.with_(ctes, sel)


@register("f3_pca_covariance", _cov_sql())
def f3_pca_covariance(spark, sf):
    """F3's Gramian step: covariance of the standardised normalised matrix (one aggregate pass)."""
    x, cols = mx.matrix_norm(fx.lap_features(spark, sf), COMPOUNDS)
    cols = mx.NORM_FEATURES
    z = mx.standardize(x.select(*cols), cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = z.agg(*[F.covar_samp(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return one.select(F.expr(f"stack({len(pairs)}, {stack}) AS (feature_a, feature_b, cov)"))


@register("a14_partitioned_roundtrip",
          q.with_({"laps": fx.SQL_LAPS}, "SELECT Driver, LapNumber, Year, Event, SessionType FROM laps"))
def a14_partitioned_roundtrip(spark, sf):
    """One folder per session (partitioned Parquet, dynamic overwrite), read back."""
    from lapengine.streaming.ingest import shared_dir
    root = shared_dir(spark, "artefacts")
    lp = fx.laps(spark, sf).select("Driver", "LapNumber", "Year", "Event", "SessionType")
    sinks.write_artifact(lp, root, "laps")
    return sinks.read_partitioned(spark, root, "laps").select("Driver", "LapNumber", "Year", "Event", "SessionType")


@register("a15_pca_record",
          "SELECT * FROM (VALUES " + ", ".join(f"('PC{i + 1}', '{f}', {q.lit(w)})" for i, comp in enumerate(STORED_PCA.components)
                                               for f, w in zip(STORED_PCA.feature_names, comp)) + ") t(component, feature, loading)")
def a15_pca_record(spark, sf):
    """The PCA model record written as JSON and read back, as its loadings."""
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(spark, "pca-model")
    sinks.save_pca(STORED_PCA.to_frame(spark), path)
    return pc.loadings_frame(spark, pc.PcaModel.from_row(sinks.load_pca(spark, path).first()))


@register("a15_fitted_pca_record")
def a15_fitted_pca_record(spark, sf):
    """A15 of a fitted model: the whole record."""
    from lapengine.streaming.ingest import shared_dir
    x, cols = mx.matrix_norm(fx.lap_features(spark, sf), COMPOUNDS)
    path = shared_dir(spark, "pca-model")
    sinks.save_pca(pc.fit_pca(x, cols, 3).to_frame(spark), path)
    return sinks.load_pca(spark, path)


EVENTS = ["A", "N", "R"]


@register("f9_preprocessor",
          q.with_({**LF, "lfc": "SELECT * FROM lf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET])},
                  "SELECT lap_id, " + ", ".join([_std_sql(c) for c in NUM_MODEL] + [
                      f"CASE WHEN {c} = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS {c}_{v}" for c, own in (("Compound", COMPOUNDS), ("Event", EVENTS)) for v in own])
                  + " FROM lfc"))
def f9_preprocessor(spark, sf):
    """scaled numerics + one-hot categoricals, slot by slot."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    data = _model_data(spark, sf)
    pre = Pipeline(stages=ml.build_preprocessor(NUM_MODEL, CAT_MODEL, data.count())).fit(data)
    names = attr.feature_slot_names(pre, NUM_MODEL, CAT_MODEL)
    x = pre.transform(data).select("lap_id", vector_to_array("features").alias("x"))
    return x.select("lap_id", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])


@register("f9_unknown_levels",
          q.with_({**LF, "lfc": "SELECT * FROM lf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM_MODEL + CAT_MODEL + [TARGET]),
                   "st": "SELECT avg(Avg_Speed_mps) AS m, stddev_pop(Avg_Speed_mps) AS sd FROM lfc WHERE Event <> 'R'"},
                  f"SELECT lap_id, {R('(Avg_Speed_mps - m) / sd')} AS Avg_Speed_mps, "
                  + ", ".join(f"CASE WHEN Event = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS Event_{v}" for v in ("A", "N")) + " FROM lfc, st"))
def f9_unknown_levels(spark, sf):
    """F9 applied to rows of an event that was not there when it was fitted: no indicator is set, the statistics stay."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    data = _model_data(spark, sf)
    known = data.where(F.col("Event") != "R")
    pre = Pipeline(stages=ml.build_preprocessor(ONE, ["Event"], known.count())).fit(known)
    names = attr.feature_slot_names(pre, ONE, ["Event"])
    x = pre.transform(data).select("lap_id", vector_to_array("features").alias("x"))
    return x.select("lap_id", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])


@register("f20_model_roundtrip",
          q.with_(_LINE, f"SELECT lap_id, {R('b + a * Avg_Speed_mps')} AS prediction FROM lfc, line"))
def f20_model_roundtrip(spark, sf):
    """F20 + F21: persist the fitted pipeline, load it back, score every lap."""
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(spark, "model")
    ml.save_model(_line_model(spark, sf), path)
    return ml.predict(_model_data(spark, sf), ml.load_model(path)).select("lap_id", "prediction")
