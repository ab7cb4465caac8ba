"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapengine.functions.columns import KMH_PER_MPS, KMH_TO_MPS, STANDARD_GRAVITY, STANDSTILL_SPEED, all_not_null

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def select_numeric(df: DataFrame, wanted: list[str]) -> DataFrame:
    """B1: the wanted columns that exist (else every numeric one) as double.

    Text that is not a number becomes null (``try_cast``); booleans become 0/1.
    Driven by the schema only - no data is read to decide.
    """
    present = [c for c in wanted if c in df.columns]
    if not present:
        present = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]
    out = []
    for c in present:
        dt = df.schema[c].dataType
        if isinstance(dt, T.StringType):
            out.append(F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c))
        else:
            out.append(F.col(c).cast("double").alias(c))
    return df.select(*out)


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (default: all columns)."""
    return df.dropna(how="any", subset=cols)


def with_units(df: DataFrame, speed_kmh: str = "Speed", accel: list[str] = ()) -> DataFrame:
    """km/h -> m/s in both reference forms, m/s2 -> g."""
    out = df.select("*", (F.col(speed_kmh) * F.lit(KMH_TO_MPS)).alias(f"{speed_kmh}_mps"),
                    (F.col(speed_kmh) / F.lit(KMH_PER_MPS)).alias(f"{speed_kmh}_ms"),
                    *[(F.col(a) / F.lit(STANDARD_GRAVITY)).alias(f"{a}_g") for a in accel])
    return out


def guard_zeros(df: DataFrame, speed_ms: str, num: str, den: str, vx: str | None = None,
                vy: str | None = None) -> DataFrame:
    """Speed 0 -> 0.1; ``num / den`` with zero -> null; planar norm >= 1e-6."""
    cols = [F.when(F.col(speed_ms) == 0, F.lit(STANDSTILL_SPEED)).otherwise(F.col(speed_ms)).alias(f"{speed_ms}_guarded"),
            (F.col(num) / F.nullif(F.col(den), F.lit(0))).alias(f"{num}_per_{den}")]
    if vx and vy:
        cols.append(F.greatest(F.sqrt(F.col(vx) * F.col(vx) + F.col(vy) * F.col(vy)), F.lit(1e-6)).alias("speed_norm"))
    return df.select("*", *cols)


def pick_drivers(df: DataFrame, ids: list[str] | str, col: str = "Driver") -> DataFrame:
    """Equality / membership filter (pushed down to the scan)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.where(F.col(col) == ids[0]) if len(ids) == 1 else df.where(F.col(col).isin(ids))


def with_driver_code(df: DataFrame, drivers: DataFrame, key: str = "Driver", code: str = "DriverCode") -> DataFrame:
    """Driver number -> code (unknown numbers keep the number).

    A plain left join: AQE turns it into a broadcast join when the measured
    driver table is small and keeps a shuffle join otherwise.
    """
    d = drivers.select(F.col(key).alias("_k"), F.col(code).alias("_code")).dropDuplicates(["_k"])
    j = df.join(d, df[key] == d["_k"], "left")
    return j.select(*[F.coalesce(F.col("_code"), F.col(key)).alias(key) if c == key else F.col(c)
                      for c in df.columns], F.col(key).alias(f"{key}Number"))


def fill_lap_defaults(df: DataFrame) -> DataFrame:
    """Compound ``UNKNOWN``, lap number 0, tyre life 0 for missing values."""
    fills = {}
    if "Compound" in df.columns:
        fills["Compound"] = "UNKNOWN"
    if "LapNumber" in df.columns:
        fills["LapNumber"] = 0
    if "TyreLife" in df.columns:
        fills["TyreLife"] = 0
    return df.na.fill(fills)


def tag_samples(samples: DataFrame, meta: DataFrame, keys: list[str],
                attrs: tuple[str, ...] = ("Compound", "TyreLife")) -> DataFrame:
    """Attach lap attributes to every sample (left equi join on the lap key).

    ``meta`` holds one row per lap; AQE broadcasts it when measured small.
    """
    m = meta.select(*keys, *attrs)
    return samples.join(m, keys, "left")


def project_present(df: DataFrame, must: list[str], optional: list[str]) -> DataFrame:
    """Required columns plus the optional ones present in the schema."""
    return df.select(*must, *[c for c in optional if c in df.columns and c not in must])
