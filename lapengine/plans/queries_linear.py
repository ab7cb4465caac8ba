"""Registered queries that are solved from moments: linear models of several features (F12, F16, F22) and PCA.

Their SQL solves the same small systems with recursive CTEs over lists: coordinate descent for the linear models, deflated
power iteration (by repeated squaring of the covariance) for the components.
"""

from __future__ import annotations

from lapengine.operators import linear as ln
from lapengine.plans import fixtures as fx
from lapengine.plans import queries_ml as qm
from lapengine.plans import sqltext as q
from lapengine.plans.registry import ORACLE, register

R = q.round_sql
LEVELS = {"Compound": qm.COMPOUNDS, "Event": qm.EVENTS}
NAMES = [*qm.NUM_MODEL, *[f"{c}_{v}" for c, vs in LEVELS.items() for v in vs]]
PENALTIES = {"Lasso": 0.01, "LeastSquares": 0.0}
SWEEPS = 150
LASSO = {"Lasso": 0.01}
NUM = ["Avg_Speed_mps", "Brake_Aggression", "MeanAbs_Jerk_Long", "Max_Lateral_g", "Energy_Index", "TyreLife"]


def _moments_sql(names: list[str], levels: dict[str, list[str]], folds: str) -> dict[str, str]:
    """CTEs up to ``g``: per fold the standardised moments of its training rows, as lists."""
    d = len(names)
    cols = [f"CAST({c} AS DOUBLE)" for c in names[:d - sum(map(len, levels.values()))]]
    cols += [f"CASE WHEN {c} = '{v}' THEN 1.0e0 ELSE 0.0e0 END" for c, vs in levels.items() for v in vs]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in qm.NUM_MODEL + qm.CAT_MODEL + [qm.TARGET])
    scaled = d - sum(map(len, levels.values()))
    return {
        **qm.LF,
        "d": f"SELECT lap_id, CAST(CAST('0x' || substr(md5('42:' || lap_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, [{', '.join(cols)}] AS x, "
             f"CAST({qm.TARGET} AS DOUBLE) AS y FROM lf WHERE {complete}",
        "v": "SELECT fold, list_concat([1.0e0], x, [y]) AS v FROM d",
        "s": f"SELECT fold, i, j, sum(v[i] * v[j]) AS s FROM v, range(1, {d + 3}) a(i), range(1, {d + 3}) b(j) GROUP BY ALL",
        "t": f"SELECT f.fold, i, j, sum(s) AS s FROM s, ({folds}) f(fold) WHERE s.fold <> f.fold GROUP BY ALL",
        "c": "SELECT t.fold, t.i, t.j, t.s / n.s - a.s / n.s * (b.s / n.s) AS c FROM t JOIN t n ON n.fold = t.fold AND n.i = 1 AND n.j = 1 "
             "JOIN t a ON a.fold = t.fold AND a.i = 1 AND a.j = t.i JOIN t b ON b.fold = t.fold AND b.i = 1 AND b.j = t.j WHERE t.i > 1 AND t.j > 1",
        "sd": f"SELECT fold, i, CASE WHEN i <= {scaled + 1} AND c > 0 THEN sqrt(c) ELSE 1.0e0 END AS sd FROM c WHERE i = j",
        "z": f"SELECT c.fold, c.i, c.j, c.c / a.sd / CASE WHEN c.j = {d + 2} THEN 1.0e0 ELSE b.sd END AS z FROM c "
             f"JOIN sd a ON a.fold = c.fold AND a.i = c.i JOIN sd b ON b.fold = c.fold AND b.i = c.j WHERE c.i <= {d + 1}",
        "zr": f"SELECT fold, i, list(z ORDER BY j) FILTER (j <= {d + 1}) AS row, max(z) FILTER (j = {d + 2}) AS b FROM z GROUP BY fold, i",
        "g": "SELECT fold, list(row ORDER BY i) AS g, list(b ORDER BY i) AS b FROM zr GROUP BY fold",
        "m": f"SELECT t.fold, list(t.s / n.s ORDER BY t.j) AS mean FROM t JOIN t n ON n.fold = t.fold AND n.i = 1 AND n.j = 1 "
             f"WHERE t.i = 1 AND t.j > 1 GROUP BY t.fold",
        "sds": f"SELECT fold, list(sd ORDER BY i) FILTER (i <= {d + 1}) AS sd FROM sd GROUP BY fold",
    }


def _descent_sql(d: int, penalties: dict[str, float]) -> dict[str, str]:
    """CTEs ``cd`` (one coordinate a step) and ``fit``: model, fold, coefficients and means in the columns' own units."""
    rho = "(g.b[k] - list_inner_product(g.g[k], w) + g.g[k][k] * w[k])"
    new = f"CASE WHEN g.g[k][k] > 0 THEN sign({rho}) * greatest(abs({rho}) - l1, 0.0e0) / g.g[k][k] ELSE 0.0e0 END"
    start = " UNION ALL ".join(f"SELECT '{n}' AS model, {q.lit(l1)} AS l1" for n, l1 in penalties.items())
    return {
        "cd": f"SELECT model, l1, fold, 0 AS it, [0.0e0 FOR u IN range({d})] AS w FROM g, ({start}) UNION ALL "
              f"SELECT model, l1, fold, it + 1, list_concat(w[1:k - 1], [{new}], w[k + 1:]) "
              f"FROM (SELECT cd.*, it % {d} + 1 AS k FROM cd WHERE it < {SWEEPS * d}) JOIN g USING (fold)",
        "fit": f"SELECT model, fold, [w[k] / sd[k] FOR k IN range(1, {d + 1})] AS coef, mean FROM cd JOIN sds USING (fold) JOIN m USING (fold) "
               f"WHERE it = {SWEEPS * d}",
    }


def _recursive(ctes: dict[str, str], body: str) -> str:
    return q.with_(ctes, body).replace("WITH ", "WITH RECURSIVE ", 1)


_FIVE = "SELECT unnest(range(5))"


def _cv_sql(body: str) -> str:
    d = len(NAMES)
    p = f"mean[{d + 1}] + list_inner_product(coef, [x[k] - mean[k] FOR k IN range(1, {d + 1})])"
    return _recursive({**_moments_sql(NAMES, LEVELS, _FIVE), **_descent_sql(d, PENALTIES),
                       "p": f"SELECT model, fold, y, {p} AS p FROM d JOIN fit USING (fold)",
                       "e": "SELECT model, fold, avg(abs(p - y)) AS MAE, sqrt(avg((p - y) * (p - y))) AS RMSE, "
                            "1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS R2, count(*) AS n FROM p GROUP BY model, fold"}, body)


ORACLE["f16_cv_lasso"] = _cv_sql(f"SELECT 'Lasso' AS model, {R('avg(MAE)')} AS MAE, {R('avg(RMSE)')} AS RMSE, {R('avg(R2)')} AS R2 FROM e WHERE model = 'Lasso'")


@register("f16_cv_linear_many", _cv_sql(f"SELECT model, fold, {R('MAE')} AS MAE, {R('RMSE')} AS RMSE, {R('R2')} AS R2, n FROM e"))
def f16_cv_linear_many(spark, sf):
    """F12 + F16: 5-fold metrics of Lasso (alpha 0.01) and least squares on all inputs, from one moment matrix a fold."""
    return ln.cross_validate_linear(qm._model_data(spark, sf), PENALTIES, qm.NUM_MODEL, LEVELS, "lap_id", qm.TARGET)[0]


@register("f12_lasso_coefficients",
          _recursive({**_moments_sql(NAMES, LEVELS, _FIVE), **_descent_sql(len(NAMES), LASSO)},
                     f"SELECT fold, feature, {R('c')} AS coef FROM (SELECT fold, unnest({NAMES!r}) AS feature, unnest(coef) AS c FROM fit)"))
def f12_lasso_coefficients(spark, sf):
    """the Lasso's coefficients in the inputs' own units, for each training set."""
    models = ln.cross_validate_linear(qm._model_data(spark, sf), LASSO, qm.NUM_MODEL, LEVELS, "lap_id", qm.TARGET)[1]["Lasso"]
    rows = [(f, c, float(w)) for f, m in models.items() if f >= 0 for c, w in zip(m.names, m.coef, strict=True)]
    return spark.createDataFrame(rows, "fold int, feature string, coef double")


@register("f22_linear_attribution_many",
          _recursive({**_moments_sql(NUM, {}, "SELECT -1"), **_descent_sql(len(NUM), LASSO)},
                     f"SELECT feature, {R('value')} AS value FROM (SELECT unnest({NUM!r}) AS feature, unnest(a) AS value FROM ("
                     "SELECT [" + ", ".join(f"avg(abs(coef[{k}] * (x[{k}] - mean[{k}])))" for k in range(1, len(NUM) + 1)) + "] AS a FROM d, fit))"))
def f22_linear_attribution_many(spark, sf):
    """mean |Shapley| of every input of a Lasso on six of them, ranked."""
    data = qm._model_data(spark, sf)
    model = ln.cross_validate_linear(data, LASSO, NUM, {}, "lap_id", qm.TARGET)[1]["Lasso"][-1]
    return ln.mean_abs_attribution(data, model, {})


# ------------------------------------------------------------------ PCA

SQUARINGS = 22


def _pca_ctes(matrix: str, key: str, d: int, k: int = 3) -> dict[str, str]:
    """CTEs ``pc1 .. pck`` (v: loadings, signs fixed, ev: eigenvalue), ``st`` (n, mean, sd) from rows ``(key, x)``.

    The covariance is squared again and again, each time divided by its trace, until its largest component is all that is
    left; that component is then subtracted from the covariance for the next one.
    """
    dot = "[[list_inner_product(a, b) FOR b IN m] FOR a IN m]"
    trace = f"list_sum([m[i][i] FOR i IN range(1, {d + 1})])"
    out = {
        "x0": matrix,
        "u": f"SELECT {key}, i, x[i] AS v FROM x0, range(1, {d + 1}) a(i)",
        "st": "SELECT list(mean ORDER BY i) AS mean, list(sd ORDER BY i) AS sd, max(n) AS n FROM (SELECT i, avg(v) AS mean, "
              "CASE WHEN stddev_pop(v) = 0 THEN 1.0e0 ELSE stddev_pop(v) END AS sd, count(*) AS n FROM u GROUP BY i)",
        "zz": f"SELECT {key}, [(x[i] - mean[i]) / sd[i] FOR i IN range(1, {d + 1})] AS z, n FROM x0, st",
        "cc": f"SELECT i, j, sum(z[i] * z[j]) / (max(n) - 1) AS c FROM zz, range(1, {d + 1}) a(i), range(1, {d + 1}) b(j) GROUP BY i, j",
        "c0": "SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM cc GROUP BY i)",
    }
    for p in range(1, k + 1):
        out |= {
            f"sq{p}": f"SELECT 0 AS it, [[y / {trace} FOR y IN a] FOR a IN m] AS m FROM c{p - 1} UNION ALL "
                      f"SELECT it + 1, [[y / t FOR y IN a] FOR a IN m] FROM (SELECT it, m, {trace} AS t FROM (SELECT it, {dot} AS m FROM sq{p} WHERE it < {SQUARINGS}))",
            # any column of what is left is the component; the one with the largest diagonal is never near zero
            f"w{p}": f"SELECT m[list_position([m[i][i] FOR i IN range(1, {d + 1})], list_max([m[i][i] FOR i IN range(1, {d + 1})]))] AS w FROM sq{p} WHERE it = {SQUARINGS}",
            f"n{p}": f"SELECT [y / sqrt(list_inner_product(w, w)) FOR y IN w] AS v FROM w{p}",
            f"pc{p}": f"SELECT [y * CASE WHEN v[list_position([abs(a) >= list_max([abs(b) FOR b IN v]) - 1e-12 FOR a IN v], true)] < 0 THEN -1 ELSE 1 END FOR y IN v] AS v, "
                      f"list_inner_product(v, [list_inner_product(a, v) FOR a IN m]) AS ev FROM n{p}, c{p - 1}",
            f"c{p}": f"SELECT [[m[i][j] - ev * v[i] * v[j] FOR j IN range(1, {d + 1})] FOR i IN range(1, {d + 1})] AS m FROM c{p - 1}, pc{p}",
        }
    out["total"] = f"SELECT list_sum([m[i][i] FOR i IN range(1, {d + 1})]) AS t FROM c0"
    return out


def _norm_matrix() -> tuple[dict[str, str], str, list[str]]:
    ctes, where = qm._norm_parts()
    names = [*qm.mx.NORM_FEATURES, *[f"Compound_{v}" for v in qm.COMPOUNDS]]
    dummies = [f"CASE WHEN Compound = '{v}' THEN 1.0e0 ELSE 0.0e0 END" for v in qm.COMPOUNDS]
    return ctes, f"SELECT lap_id, [{', '.join([*qm.mx.NORM_FEATURES, *dummies])}] AS x FROM z WHERE {where}", names


def _pca_sql(body: str) -> str:
    ctes, matrix, names = _norm_matrix()
    return _recursive({**ctes, **_pca_ctes(matrix, "lap_id", len(names))}, body)


_VARIANCE = " UNION ALL ".join(f"SELECT 'PC{p}' AS component, {R('ev / t')} AS explained_variance_ratio, {R('sqrt(ev * (n - 1))')} AS singular_value "
                               f"FROM pc{p}, total, st" for p in (1, 2, 3))
_PCA_NAMES = _norm_matrix()[2]
_MATRIX = "SELECT vec_id, x FROM mx"
ORACLE["f3_pca_norm_variance"] = _pca_sql(_VARIANCE)
ORACLE["f3_pca_norm_loadings"] = _pca_sql(" UNION ALL ".join(
    f"SELECT component, feature, {R('loading')} AS loading FROM (SELECT 'PC{p}' AS component, unnest({_PCA_NAMES!r}) AS feature, unnest(v) AS loading FROM pc{p})" for p in (1, 2, 3)))
ORACLE["f3_f4_pca_scores"] = _pca_sql("SELECT lap_id, " + ", ".join(f"{R(f'list_inner_product(z, pc{p}.v)')} AS PC{p}" for p in (1, 2, 3)) + " FROM zz, pc1, pc2, pc3")
ORACLE["f3_pca_embeddings"] = _recursive({"mx": fx.SQL_MATRIX, **_pca_ctes(_MATRIX, "vec_id", 64)}, _VARIANCE)
