"""Telemetry plans on FX1: time grid, distance grid, dynamics, lap features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from lapengine.operators import aggregates as agg
from lapengine.operators import series
from lapengine.plans import fixtures as fx

LAP_KEYS = ["Driver", "LapNumber"]
SIGNALS = ["Speed", "Throttle", "Brake", "X", "Y"]


def _of(tel: DataFrame, only: Column | None) -> DataFrame:
    """The samples of the laps wanted: laps do not touch each other, so a condition on the lap keys can come before the grid."""
    return tel if only is None else tel.where(only)


def time_grid(spark: SparkSession, sf_dir: str, *, null_value: bool = False, short_laps: bool = False,
              chunk_ticks: int = series.DEFAULT_CHUNK_TICKS, only: Column | None = None) -> DataFrame:
    """FX1 -> C1 (+C3): every lap (or those where ``only`` holds) on the fixed time grid."""
    tel = _of(fx.telemetry(spark, sf_dir, null_value=null_value, short_laps=short_laps), only)
    return series.resample_zoh(tel, LAP_KEYS, "SessionTime_us", SIGNALS, fx.FX1_STEP_US,
                               tiebreak=["event_id"], chunk_ticks=chunk_ticks)


def distance_grid(spark: SparkSession, sf_dir: str, *, null_value: bool = False,
                  chunk_ticks: int = series.DEFAULT_CHUNK_TICKS, only: Column | None = None) -> DataFrame:
    """FX1 -> C2 (+B3, B4, C3): every lap (or those where ``only`` holds) on the fixed distance grid."""
    tel = _of(fx.telemetry(spark, sf_dir, null_value=null_value), only)
    return series.interpolate_grid(tel, LAP_KEYS, "Distance_c", SIGNALS, fx.FX1_DIST_STEP,
                                   order=["SessionTime_us", "event_id"], scale=fx.FX1_DIST_SCALE,
                                   chunk_ticks=chunk_ticks)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that read it several times.

    The grids are artefacts that the reference persists too; every consumer
    then reads the grid instead of building it again from the raw samples.
    """
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dynamics(spark: SparkSession, sf_dir: str, *, short_laps: bool = False,
             chunk_ticks: int = series.DEFAULT_CHUNK_TICKS) -> DataFrame:
    g = time_grid(spark, sf_dir, short_laps=short_laps, chunk_ticks=chunk_ticks)
    return series.dynamics(g, LAP_KEYS, dt=fx.FX1_DT, chunk_ticks=chunk_ticks)


def enriched(spark: SparkSession, sf_dir: str, *, chunk_ticks: int = series.DEFAULT_CHUNK_TICKS, only: Column | None = None) -> DataFrame:
    g = materialised(time_grid(spark, sf_dir, chunk_ticks=chunk_ticks, only=only), "time-grid")
    return series.enrich(g, LAP_KEYS, dt=fx.FX1_DT, chunk_ticks=chunk_ticks)


def lap_feature_table(spark: SparkSession, sf_dir: str, *, short_laps: bool = False,
                      chunk_ticks: int = series.DEFAULT_CHUNK_TICKS) -> DataFrame:
    """Flagship: raw samples -> time grid -> smoothing/derivatives -> lap features + metadata."""
    dyn = dynamics(spark, sf_dir, short_laps=short_laps, chunk_ticks=chunk_ticks)
    meta = fx.telemetry_laps(spark, sf_dir)
    return agg.lap_features_from_dynamics(dyn, meta, LAP_KEYS)


def lap_features_of_events(events: DataFrame, chunk_ticks: int = series.DEFAULT_CHUNK_TICKS) -> DataFrame:
    """The flagship plan on any events frame (a table or a streamed micro-batch)."""
    spark = events.sparkSession
    tel = fx.telemetry(spark, None, events=events)
    g = series.resample_zoh(tel, LAP_KEYS, "SessionTime_us", SIGNALS, fx.FX1_STEP_US, tiebreak=["event_id"],
                            chunk_ticks=chunk_ticks)
    dyn = series.dynamics(g, LAP_KEYS, dt=fx.FX1_DT, chunk_ticks=chunk_ticks)
    return agg.lap_features_from_dynamics(dyn, fx.telemetry_laps(spark, None, tel=tel), LAP_KEYS)
