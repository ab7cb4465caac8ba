"""Feature matrices (F1, F2, F5-F7) with E4/E5 normalisation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapengine.operators import aggregates as agg
from lapengine.operators.clean import complete_cases
from lapengine.schemas import require_columns

# Fixed column lists that must equal the reference's.
BASE_FEATURES = [
    "LapTimeSeconds", "Energy_Index", "MeanAbs_Jerk_Long", "MeanAbs_Jerk_Lat", "Avg_Speed_mps",
    "Brake_Aggression", "Max_Lateral_g", "Max_Longitudinal_g", "TyreLife",
]
ZSCORE_FEATURES = [
    "LapTimeSeconds", "Avg_Speed_mps", "MeanAbs_Jerk_Long", "MeanAbs_Jerk_Lat", "Max_Lateral_g",
    "Max_Longitudinal_g", "Brake_Aggression",
]
NORM_FEATURES = [
    "LapTimeSeconds_norm", "Energy_per_m_norm", "MeanAbs_Jerk_Long_norm", "MeanAbs_Jerk_Lat_norm",
    "Avg_Speed_mps_norm", "Brake_Aggression_norm", "Max_Lateral_g_norm", "Max_Longitudinal_g_norm",
    "TyreLife_norm",
]
EVENT_KEYS = ["Year", "Event"]
META = ["Driver", "LapNumber", "Compound", "Year", "Event", "SessionType"]


def dummies(df: DataFrame, col: str, prefix: str, levels: list) -> tuple[DataFrame, list[str]]:
    """0/1 indicator columns ``<prefix>_<value>`` of the given levels, in sorted order; null -> all 0.

    ``levels`` come from the schema or from a catalogue table: columns are part
    of a plan, so their list has to be known before it.  See ``one_hot`` for a
    column whose values are not.
    """
    levels = sorted(str(v) for v in levels)
    names = [f"{prefix}_{v}" for v in levels]
    cols = [F.when(F.col(col).cast("string") == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(n)
            for v, n in zip(levels, names)]
    return df.select("*", *cols), names


def one_hot(df: DataFrame, col: str, to: str) -> DataFrame:
    """F1 for any number of unknown levels: a sparse 0/1 vector in sorted level order; null -> no slot set."""
    text = df.withColumn("_level", F.col(col).cast("string"))
    index = StringIndexer(inputCol="_level", outputCol="_slot", handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCol="_slot", outputCol=to, dropLast=True, handleInvalid="keep")
    return Pipeline(stages=[index, hot]).fit(text).transform(text).drop("_level", "_slot")


def one_row(stats: DataFrame) -> dict:
    """The values of a one-row aggregate, to be used as literals."""
    return stats.first().asDict()


def standardize_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """F2 statistics: mean and population std; zero std -> scale 1 (one row)."""
    aggs = []
    for c in cols:
        aggs.append(F.avg(c).alias(f"_mean_{c}"))
        sd = F.stddev_pop(c)
        aggs.append(F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"_scale_{c}"))
    return df.agg(*aggs)


def standardize(df: DataFrame, cols: list[str], stats: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """``(x - mean) / std_pop`` per column (not ML StandardScaler: that uses the sample std)."""
    st = one_row(standardize_stats(df, cols) if stats is None else stats)
    scaled = [((F.col(c) - F.lit(st[f"_mean_{c}"]).cast("double")) / F.lit(st[f"_scale_{c}"]).cast("double")).alias(f"{c}{suffix}")
              for c in cols]
    keep = [c for c in df.columns if suffix or c not in cols]
    return df.select(*keep, *scaled)


def matrix_session(feat: DataFrame, compounds: list) -> tuple[DataFrame, list[str]]:
    """base features + Compound dummies (one session's laps)."""
    require_columns(feat, BASE_FEATURES + ["Compound"])
    x, names = dummies(feat, "Compound", "Compound", compounds)
    return x, BASE_FEATURES + names


def matrix_global(feat: DataFrame, compounds: list, years: list) -> tuple[DataFrame, list[str]]:
    """base features + Compound and Year dummies; complete rows only."""
    require_columns(feat, BASE_FEATURES + ["Compound", "Year"])
    x, cn = dummies(feat, "Compound", "Compound", compounds)
    x, yn = dummies(x, "Year", "Year", years)
    cols = BASE_FEATURES + cn + yn
    return complete_cases(x, cols), cols


def normalize_by_event(feat: DataFrame) -> DataFrame:
    """E4 + E5: per-event z-scores, energy per metre and its z-score."""
    x = agg.energy_per_m(feat)
    return agg.zscore_by(x, EVENT_KEYS, ZSCORE_FEATURES + ["Energy_per_m", "TyreLife"])


def matrix_norm(feat: DataFrame, compounds: list) -> tuple[DataFrame, list[str]]:
    """normalised features + Compound dummies; complete rows only."""
    require_columns(feat, BASE_FEATURES + ["Compound", *EVENT_KEYS])
    x = normalize_by_event(feat)
    x, cn = dummies(x, "Compound", "Compound", compounds)
    cols = NORM_FEATURES + cn
    return complete_cases(x, cols), cols
