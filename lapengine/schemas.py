"""Explicit schemas of the artefact tables (FIXTURES.md §1)."""

from __future__ import annotations

from pyspark.sql import types as T

D, I, L, S, B = T.DoubleType(), T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SIGNALS = [("Speed", D), ("Throttle", D), ("Brake", B), ("nGear", I), ("RPM", D), ("DRS", I),
           ("Distance", D), ("RelativeDistance", D), ("X", D), ("Y", D)]

LAP_KEY = [("Driver", S), ("LapNumber", I)]

TELEMETRY_TIME = _s(("RelativeTime_s", D), *SIGNALS, *LAP_KEY, ("Compound", S), ("TyreLife", I))
TELEMETRY_DISTANCE = _s(("Distance_m", D), *[(n, D) for n, _ in SIGNALS], ("Distance_pct", D),
                        *LAP_KEY, ("Compound", S), ("TyreLife", I))
ENRICHED = _s(*[(f.name, f.dataType) for f in TELEMETRY_TIME.fields],
              ("Speed_mps", D), ("VX", D), ("VY", D), ("AX_long", D), ("AY_lat", D), ("Jerk_long", D),
              ("Jerk_lat", D), ("TireEnergyProxy", D))
LAPS_METADATA = _s(*LAP_KEY, ("Compound", S), ("TyreLife", I), ("LapTimeSeconds", D))
LAP_FEATURES = _s(*LAP_KEY, ("LapTimeSeconds", D), ("Compound", S), ("TyreLife", D),
                  ("Avg_Speed_mps", D), ("Avg_Throttle", D), ("Brake_Aggression", D),
                  ("MeanAbs_Jerk_Long", D), ("MeanAbs_Jerk_Lat", D), ("Max_Lateral_g", D),
                  ("Max_Longitudinal_g", D), ("Energy_Index", D))
WEATHER = _s(("Time", S), ("AirTemp", D), ("Humidity", D), ("Pressure", D), ("Rainfall", B),
             ("TrackTemp", D), ("WindDirection", I), ("WindSpeed", D))
TYRES = _s(("Driver", S), ("DriverNumber", S), ("Team", S), ("LapNumber", I), ("Compound", S),
           ("TyreLife", I), ("FreshTyre", S), ("LapTime", S), ("LapTimeSeconds", D), ("Stint", I),
           ("IsPersonalBest", S))
CALENDAR = _s(("RoundNumber", I), ("EventName", S), ("EventDate", T.DateType()), ("Location", S), ("Country", S))
EXTRACTION_LOG = _s(("timestamp", S), ("event", S), ("round", I), ("session", S), ("status", S), ("error", S),
                    ("has_laps", B), ("has_tires", B), ("has_weather", B), ("has_telemetry", B))
PCA_MODEL = _s(("explained_variance_ratio", T.ArrayType(D)), ("components", T.ArrayType(T.ArrayType(D))),
               ("feature_names", T.ArrayType(S)), ("scaler_mean", T.ArrayType(D)),
               ("scaler_scale", T.ArrayType(D)), ("singular_values", T.ArrayType(D)))

SCHEMAS = {
    "telemetry_time": TELEMETRY_TIME,
    "telemetry_distance": TELEMETRY_DISTANCE,
    "telemetry_enriched": ENRICHED,
    "laps_metadata": LAPS_METADATA,
    "lap_features": LAP_FEATURES,
    "weather": WEATHER,
    "tyres": TYRES,
    "calendar": CALENDAR,
    "extraction_log": EXTRACTION_LOG,
    "pca_model": PCA_MODEL,
}


def require_columns(df, cols) -> None:
    """Raise when required columns are missing (schema check, no data read)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
