"""Registered queries: one Spark plan and one DuckDB oracle per operator id.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Double columns are rounded on both sides (magnitude-aware, see
``round_doubles``) so the two engines compare equal despite summation order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapengine.functions.columns import KMH_TO_MPS
from lapengine.operators import series
from lapengine.plans import fixtures as fx
from lapengine.plans import sqltext as q
from lapengine.plans import telemetry as tp

from lapengine.plans.registry import register

LAP = q.LAP
G_COLS = [("Driver", False), ("LapNumber", False), ("tick", False), ("RelativeTime_s", True),
          ("Speed", True), ("Throttle", True), ("Brake", True), ("X", True), ("Y", True)]

# ---------------------------------------------------------------- C1 / C3


@register("c1_resample_zoh",
          q.with_(q.zoh_ctes(null_value=True), f"SELECT {q.rounded_select(G_COLS)} FROM grid"))
def c1_resample_zoh(spark, sf):
    """C1+C3: zero-order-hold time grid with null fill (FX1 null variant)."""
    return tp.time_grid(spark, sf, null_value=True)


@register("c4_savgol_speed",
          q.with_({**q.zoh_ctes(), **q.dynamics_ctes()},
                  f"SELECT {LAP}, tick, {q.rounded_select([('Speed_mps', True)])} FROM d1"))
def c4_savgol_speed(spark, sf):
    """C4: Savitzky-Golay smoothed speed (m/s) on the time grid."""
    g = tp.time_grid(spark, sf)
    g = g.withColumn("Speed", F.col("Speed") * F.lit(KMH_TO_MPS))
    return series.smooth(g, tp.LAP_KEYS, "tick", "Speed", "Speed_mps").select(*tp.LAP_KEYS, "tick", "Speed_mps")


@register("c5_c6_dynamics",
          q.with_({**q.zoh_ctes(), **q.dynamics_ctes()},
                  f"SELECT {LAP}, tick, " + q.rounded_select(
                      [(c, True) for c in ("Speed_mps", "VX", "VY", "AX_long", "AY_lat", "Jerk_long", "Jerk_lat")])
                  + " FROM d5"))
def c5_c6_dynamics(spark, sf):
    """C5+C6: gradients and planar kinematics on the time grid."""
    d = tp.dynamics(spark, sf)
    return d.select(*tp.LAP_KEYS, "tick", "Speed_mps", "VX", "VY", "AX_long", "AY_lat", "Jerk_long", "Jerk_lat")


@register("c7_c8_enrich",
          q.with_({**q.zoh_ctes(), **q.dynamics_ctes(), **q.energy_cte()},
                  f"SELECT {LAP}, tick, " + q.rounded_select(
                      [(c, True) for c in ("RelativeTime_s", "Speed", "Speed_mps", "AX_long", "AY_lat",
                                           "TireEnergyProxy")]) + " FROM d6"))
def c7_c8_enrich(spark, sf):
    """C7+C8: enriched telemetry with cumulative tyre-energy proxy."""
    e = tp.enriched(spark, sf)
    return e.select(*tp.LAP_KEYS, "tick", "RelativeTime_s", "Speed", "Speed_mps", "AX_long", "AY_lat",
                    "TireEnergyProxy")


def _e1_sql(short_laps: bool = False) -> str:
    ctes = {**q.zoh_ctes(short_laps=short_laps), **q.dynamics_ctes(),
            "feat": f"SELECT {LAP}, {q.feature_aggs_sql('sum(e)')} FROM d5 GROUP BY {LAP}",
            "meta": fx.SQL_TELEMETRY_LAPS}
    body = (f"SELECT f.Driver, f.LapNumber, {q.round_sql('m.LapTimeSeconds')} AS LapTimeSeconds, "
            f"CASE WHEN m.Driver IS NULL THEN '' ELSE m.Compound END AS Compound, m.TyreLife, "
            + ", ".join(f"{q.round_sql('f.' + c)} AS {c}" for c in q.FEATURE_COLS)
            + f" FROM feat f LEFT JOIN meta m ON f.Driver = m.Driver AND f.LapNumber = m.LapNumber")
    return q.with_(ctes, body)


@register("e1_lap_features", _e1_sql())
def e1_lap_features(spark, sf):
    """E1 (+D1): lap features from raw samples - the flagship query."""
    return tp.lap_feature_table(spark, sf)


@register("e1_lap_features_short", _e1_sql(short_laps=True))
def e1_lap_features_short(spark, sf):
    """E1 on one-day laps: window 5 for 5..10 samples, null physics under 5."""
    return tp.lap_feature_table(spark, sf, short_laps=True)




@register("st1_stream_ingest", _e1_sql())
def st1_stream_ingest(spark, sf):
    """ST1: events arriving in two batches of files; the second run reads only what the first has not."""
    from lapengine.streaming.ingest import ingest_available, shared_dir
    ev = spark.read.parquet(f"{sf}/events.parquet")
    source, sink, checkpoint = (shared_dir(spark, f"ingest-{n}") for n in ("src", "out", "ckpt"))
    for half in range(2):  # a driver's laps arrive together
        ev.where(F.pmod(F.xxhash64("user_id"), F.lit(2)) == half).write.parquet(f"{source}/arrival{half}")
        out = ingest_available(spark, f"{source}/arrival*", source, ev.schema, tp.lap_features_of_events, sink, checkpoint)
    return out


def _open_laps(root, schema):
    """FX1 events as samples of laps that arrive in pieces."""
    from datetime import date

    from lapengine.functions.columns import floor_div
    from lapengine.streaming.open_laps import OpenLaps
    day = F.datediff(F.to_date("ts"), F.lit(date(2024, 1, 1)))
    return OpenLaps(root, schema, F.col("user_id"), floor_div(day, fx.FX1_LAP_DAYS), F.unix_micros(F.col("ts").cast("timestamp")),
                    tp.lap_features_of_events, tp.LAP_KEYS, grace=24 * 3600 * 1_000_000)


@register("st1_laps_in_pieces", _e1_sql())
def st1_laps_in_pieces(spark, sf):
    """ST1: three arrivals that cut laps apart, one event in sixteen coming with the last one however old it is."""
    from lapengine.streaming.ingest import shared_dir
    from lapengine.streaming.open_laps import ingest_in_pieces
    ev = spark.read.parquet(f"{sf}/events.parquet")
    # days 13 and 19 lie within laps of ten days, so every driver's lap there is cut
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    arrival = F.when((F.pmod(F.xxhash64("event_id"), F.lit(16)) == 0) | (day >= 19), 2).when(day >= 13, 1).otherwise(0)
    laps = ingest_in_pieces([ev.where(arrival == i) for i in range(3)], _open_laps(shared_dir(spark, "pieces"), ev.schema))
    return laps.drop("is_open")
