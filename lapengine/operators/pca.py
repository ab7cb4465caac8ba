"""PCA fit and scoring (F3, F4) on Spark ML.

The covariance (Gramian) is a distributed ``treeAggregate`` inside
``pyspark.ml.feature.PCA``; only the ``d x d`` matrix (d = number of feature
columns, ~10-20 here) is decomposed on the driver.  Scores are plain column
expressions with the loadings inlined, so scoring stays in codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SIGN_TIE = 1e-12


@dataclass
class PcaModel:
    feature_names: list[str]
    mean: list[float]
    scale: list[float]
    components: list[list[float]]          # k x d, row i = loadings of PC(i+1)
    explained_variance_ratio: list[float]
    singular_values: list[float]
    n_rows: int

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """A15 record: one row of arrays."""
        from lapengine.schemas import PCA_MODEL
        row = (self.explained_variance_ratio, self.components, self.feature_names, self.mean, self.scale,
               self.singular_values)
        return spark.createDataFrame([row], PCA_MODEL)

    @staticmethod
    def from_row(row) -> "PcaModel":
        return PcaModel(list(row.feature_names), list(row.scaler_mean), list(row.scaler_scale),
                        [list(c) for c in row.components], list(row.explained_variance_ratio),
                        list(row.singular_values or []), 0)


def fix_signs(components: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude loading of each component positive.

    Magnitudes within 1e-12 of the maximum tie; the lowest feature index wins.
    """
    out = components.copy()
    for i in range(out.shape[0]):
        mags = np.abs(out[i])
        j = int(np.nonzero(mags >= mags.max() - SIGN_TIE)[0][0])
        if out[i, j] < 0:
            out[i] = -out[i]
    return out


def fit_pca(df: DataFrame, cols: list[str], k: int = 3) -> PcaModel:
    """standardise (population std), fit ``k`` components, fix signs.

    Input rows must be complete (see B5).  Explained-variance ratios are
    relative to the total variance of all standardised columns; singular
    values follow ``sqrt(eigenvalue * (n - 1))``.
    """
    from lapengine.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # the fit makes several passes (statistics, column summary, Gramian):
    # materialise the matrix once in the shared checkpoint directory
    x = df.select(*cols).checkpoint(eager=True)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    srow = x.agg(*aggs).first()
    n = int(srow["_n"])
    mean = [float(srow[f"_mean_{c}"]) for c in cols]
    sds = [float(srow[f"_sd_{c}"] or 0.0) for c in cols]
    scale = [sd if sd != 0.0 else 1.0 for sd in sds]
    zc = [f"{c}__z" for c in cols]
    z = x.select(*[((F.col(c) - F.lit(m)) / F.lit(s)).alias(zn) for c, m, s, zn in zip(cols, mean, scale, zc)])
    vec = VectorAssembler(inputCols=zc, outputCol="_v").transform(z.select(*zc))
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    pc = fix_signs(model.pc.toArray().T)          # k x d
    ratio = [float(v) for v in model.explainedVariance.toArray()]
    # total sample variance of the standardised columns: n/(n-1) for every
    # non-constant column, 0 for constant ones (their scale is forced to 1)
    nonconst = sum(1 for sd in sds if sd != 0.0)
    total = nonconst * n / (n - 1) if n > 1 else 0.0
    sing = [float(np.sqrt(r * total * (n - 1))) for r in ratio]
    return PcaModel(list(cols), mean, scale, pc.tolist(), ratio, sing, n)


def apply_pca(df: DataFrame, model: PcaModel, prefix: str = "PC") -> DataFrame:
    """scores ``sum_j (x_j - mean_j) / scale_j * loading_ij`` as column expressions."""
    scores = []
    for i, comp in enumerate(model.components):
        expr = None
        for c, m, s, w in zip(model.feature_names, model.mean, model.scale, comp):
            term = (F.col(c) - F.lit(m)) / F.lit(s) * F.lit(w)
            expr = term if expr is None else expr + term
        scores.append(expr.alias(f"{prefix}{i + 1}"))
    return df.select("*", *scores)


def loadings_frame(spark: SparkSession, model: PcaModel) -> DataFrame:
    """Loadings as a long table (component, feature, loading)."""
    rows = [(f"PC{i + 1}", f, float(w)) for i, comp in enumerate(model.components)
            for f, w in zip(model.feature_names, comp)]
    return spark.createDataFrame(rows, "component string, feature string, loading double")


def variance_frame(spark: SparkSession, model: PcaModel) -> DataFrame:
    rows = [(f"PC{i + 1}", r, s) for i, (r, s) in enumerate(zip(model.explained_variance_ratio,
                                                                 model.singular_values))]
    return spark.createDataFrame(rows, "component string, explained_variance_ratio double, singular_value double")
