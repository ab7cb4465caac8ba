"""Registered queries for A*, B*, C2/C9-C13, D*, E2-E15 (FX1 / FX2 / FX3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapengine import schemas
from lapengine.operators import aggregates as agg
from lapengine.operators import clean, compare, series
from lapengine.plans import fixtures as fx
from lapengine.plans import sqltext as q
from lapengine.plans import telemetry as tp
from lapengine.plans.registry import register
from lapengine.sources import artifacts as src

LAP = q.LAP
R = q.round_sql
STEP = fx.FX1_DIST_STEP
SC = q.lit(fx.FX1_DIST_SCALE)
SIG = ["Speed", "Throttle", "Brake", "X", "Y"]
D1_DRIVER, D2_DRIVER = "8", "46"

# ------------------------------------------------------------------ SQL CTEs


def dist_ctes(null_value: bool = False) -> dict[str, str]:
    ff = ", ".join(f"coalesce({c}, last_value({c} IGNORE NULLS) OVER wp, first_value({c} IGNORE NULLS) OVER wn) AS {c}"
                   for c in SIG)
    leads = ", ".join(f"lead({c}) OVER w AS n_{c}" for c in SIG)
    interp = ", ".join(
        f"CASE WHEN nd IS NULL THEN {c} ELSE (n_{c} - {c}) / CAST(nrel - rel AS DOUBLE) "
        f"* CAST(tick * {STEP} - rel AS DOUBLE) + {c} END AS {c}" for c in SIG)
    return {
        "tel": fx.sql_telemetry(null_value=null_value),
        "b0": f"SELECT {LAP}, Distance_c AS d, SessionTime_us, event_id, Speed, Throttle, "
              f"CAST(Brake AS DOUBLE) AS Brake, X, Y FROM tel WHERE Distance_c IS NOT NULL",
        "l0": f"SELECT {LAP}, min(d) AS d0, max(d) AS d1 FROM b0 GROUP BY {LAP}",
        "dd0": f"SELECT * FROM b0 QUALIFY row_number() OVER (PARTITION BY {LAP}, d ORDER BY SessionTime_us, event_id) = 1",
        "f0": f"SELECT {LAP}, d, {ff} FROM dd0 "
              f"WINDOW wp AS (PARTITION BY {LAP} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
              f"wn AS (PARTITION BY {LAP} ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
        "s0": f"SELECT f0.*, d0, d1, d - d0 AS rel, lead(d) OVER w AS nd, lead(d) OVER w - d0 AS nrel, {leads} "
              f"FROM f0 JOIN l0 USING ({LAP}) WINDOW w AS (PARTITION BY {LAP} ORDER BY d)",
        "t0": f"SELECT *, (rel + {STEP} - 1) // {STEP} AS lo, CASE WHEN nd IS NULL THEN (rel + {STEP} - 1) // {STEP} "
              f"ELSE (nrel + {STEP} - 1) // {STEP} - 1 END AS hi FROM s0",
        "dgrid": f"SELECT {LAP}, tick, CAST(tick * {STEP} AS DOUBLE) / {SC} AS Distance_m, {interp}, "
                 f"CASE WHEN d1 = d0 THEN 0.0 ELSE (CAST(tick * {STEP} AS DOUBLE) / {SC}) / "
                 f"(CAST(d1 - d0 AS DOUBLE) / {SC}) END AS Distance_pct "
                 f"FROM (SELECT *, unnest(range(lo, hi + 1)) AS tick FROM t0 WHERE hi >= lo)",
    }


def tfs_ctes() -> dict[str, str]:
    dd = (f"CASE WHEN tick = 0 THEN 0.0 ELSE CAST(tick * {STEP} AS DOUBLE) / {SC} - "
          f"CAST((tick - 1) * {STEP} AS DOUBLE) / {SC} END")
    v = f"(CASE WHEN Speed / {q.lit(3.6)} = 0 THEN {q.lit(0.1)} ELSE Speed / {q.lit(3.6)} END)"
    return {**dist_ctes(),
            "tfs": f"SELECT *, sum(dt) OVER (PARTITION BY {LAP} ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING "
                   f"AND CURRENT ROW) AS RelativeTime_s FROM (SELECT *, {dd} / {v} AS dt FROM dgrid)"}


def _trace(grid):
    return compare.time_from_speed(grid, tp.LAP_KEYS, step=STEP, scale=fx.FX1_DIST_SCALE)


def _time_dist(spark, sf):
    return _trace(tp.materialised(tp.distance_grid(spark, sf), "distance-grid"))


# ------------------------------------------------------------------ C2, C9, D2, D5

@register("c2_interpolate_distance",
          q.with_(dist_ctes(null_value=True),
                  f"SELECT {LAP}, tick, " + ", ".join(f"{R(c)} AS {c}" for c in ["Distance_m", *SIG, "Distance_pct"])
                  + " FROM dgrid"))
def c2_interpolate_distance(spark, sf):
    """C2 (+B3, B4, C3): linear interpolation on the distance grid (null variant)."""
    return tp.distance_grid(spark, sf, null_value=True)


@register("c9_time_from_speed",
          q.with_(tfs_ctes(), f"SELECT {LAP}, tick, {R('Distance_m')} AS Distance_m, {R('RelativeTime_s')} AS RelativeTime_s FROM tfs"))
def c9_time_from_speed(spark, sf):
    """Lap time rebuilt from speed on the distance grid."""
    return _time_dist(spark, sf).select(*tp.LAP_KEYS, "tick", "Distance_m", "RelativeTime_s")


@register("d2_ghost_delta",
          q.with_(tfs_ctes(),
                  f"SELECT a.tick, {R('a.Distance_m')} AS Distance_m, {R('a.RelativeTime_s')} AS RelativeTime_s_1, "
                  f"{R('b.RelativeTime_s')} AS RelativeTime_s_2, {R('a.Speed')} AS Speed_1, {R('b.Speed')} AS Speed_2, "
                  f"{R('b.RelativeTime_s - a.RelativeTime_s')} AS Delta_s "
                  f"FROM tfs a JOIN tfs b ON a.tick = b.tick "
                  f"WHERE a.Driver = '{D1_DRIVER}' AND a.LapNumber = 1 AND b.Driver = '{D2_DRIVER}' AND b.LapNumber = 1"))
def d2_ghost_delta(spark, sf):
    """Time delta of two drivers' laps on the shared distance ticks."""
    two = F.col("Driver").isin(D1_DRIVER, D2_DRIVER) & (F.col("LapNumber") == 1)
    return compare.ghost_delta(_trace(tp.distance_grid(spark, sf, only=two)), (D1_DRIVER, 1), (D2_DRIVER, 1))


@register("d5_ghost_delta_all",
          q.with_(tfs_ctes(),
                  f"SELECT a.Driver, a.LapNumber, a.tick, {R('a.Distance_m')} AS Distance_m, "
                  f"{R('a.RelativeTime_s - r.RelativeTime_s')} AS Delta_s FROM tfs a JOIN "
                  f"(SELECT tick, RelativeTime_s FROM tfs WHERE Driver = '{D1_DRIVER}' AND LapNumber = 1) r "
                  f"ON a.tick = r.tick"))
def d5_ghost_delta_all(spark, sf):
    """Every lap's time delta to one reference lap."""
    return compare.ghost_delta_all(tp.materialised(_time_dist(spark, sf), "traces"), (D1_DRIVER, 1))


@register("e15_speed_trace",
          q.with_(dist_ctes(), f"SELECT {LAP}, tick, {R('Distance_m')} AS Distance_m, {R('Speed')} AS Speed "
                               f"FROM dgrid WHERE Driver IN ('{D1_DRIVER}', '{D2_DRIVER}')"))
def e15_speed_trace(spark, sf):
    """Speed over distance for two drivers."""
    return agg.speed_trace(tp.distance_grid(spark, sf), tp.LAP_KEYS, [D1_DRIVER, D2_DRIVER])


# ------------------------------------------------------------------ C10-C13

SESSION_DRIVER = ["Year", "Event", "SessionType", "Driver"]


@register("c10_every_nth",
          q.with_(q.zoh_ctes(), f"SELECT {LAP}, tick, {R('Speed')} AS Speed FROM grid WHERE tick % 10 = 0"))
def c10_every_nth(spark, sf):
    """Every 10th grid row of each lap."""
    return series.every_nth(tp.time_grid(spark, sf), tp.LAP_KEYS, "tick", 10).select(*tp.LAP_KEYS, "tick", "Speed")


@register("c10_every_nth_samples",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {LAP}, event_id FROM tel QUALIFY (row_number() OVER (PARTITION BY {LAP} "
                  f"ORDER BY SessionTime_us, event_id) - 1) % 10 = 0"))
def c10_every_nth_samples(spark, sf):
    """C10 on raw samples: every 10th sample from the first of each lap."""
    t = fx.telemetry(spark, sf)
    return series.every_nth_rows(t, tp.LAP_KEYS, ["SessionTime_us", "event_id"], 10).select(*tp.LAP_KEYS, "event_id")


@register("c11_fastest_laps",
          q.with_({"laps": fx.SQL_LAPS},
                  f"SELECT Year, Event, SessionType, Driver, LapNumber, {R('LapTimeSeconds')} AS LapTimeSeconds FROM laps "
                  f"WHERE LapTimeSeconds IS NOT NULL QUALIFY row_number() OVER "
                  f"(PARTITION BY Year, Event, SessionType, Driver ORDER BY LapTimeSeconds, LapNumber) <= 3"))
def c11_fastest_laps(spark, sf):
    """C11: three fastest laps per driver of each session."""
    return series.fastest_laps(fx.laps(spark, sf), SESSION_DRIVER, n=3).select(*SESSION_DRIVER, "LapNumber", "LapTimeSeconds")


@register("c12_fastest_lap",
          q.with_({"laps": fx.SQL_LAPS},
                  f"SELECT Year, Event, SessionType, Driver, LapNumber, {R('LapTimeSeconds')} AS LapTimeSeconds, Compound, TyreLife FROM laps "
                  f"WHERE LapTimeSeconds IS NOT NULL QUALIFY row_number() OVER "
                  f"(PARTITION BY Year, Event, SessionType, Driver ORDER BY LapTimeSeconds, LapNumber) = 1"))
def c12_fastest_lap(spark, sf):
    """Fastest lap per driver of each session (grouped min of a struct)."""
    lp = fx.laps(spark, sf).select(*SESSION_DRIVER, "LapNumber", "LapTimeSeconds", "Compound", "TyreLife")
    return series.fastest_lap(lp, SESSION_DRIVER)


@register("c13_first_lap",
          q.with_({"laps": fx.SQL_LAPS},
                  f"SELECT Year, Event, SessionType, Driver, LapNumber, {R('LapTimeSeconds')} AS LapTimeSeconds, Compound FROM laps "
                  f"QUALIFY row_number() OVER (PARTITION BY Year, Event, SessionType, Driver ORDER BY LapNumber) = 1"))
def c13_first_lap(spark, sf):
    """First lap per driver of each session."""
    lp = fx.laps(spark, sf).select(*SESSION_DRIVER, "LapNumber", "LapTimeSeconds", "Compound")
    return series.first_lap(lp, SESSION_DRIVER)


# ------------------------------------------------------------------ D1, D3, D6

@register("d1_join_metadata",
          q.with_({"tel": fx.sql_telemetry(), "meta": fx.SQL_TELEMETRY_LAPS,
                   "f": f"SELECT {LAP}, count(*) AS n_samples, avg(Speed) AS Avg_Speed FROM tel GROUP BY {LAP}"},
                  f"SELECT f.Driver, f.LapNumber, {R('m.LapTimeSeconds')} AS LapTimeSeconds, "
                  f"CASE WHEN m.Driver IS NULL THEN '' ELSE m.Compound END AS Compound, m.TyreLife, f.n_samples, "
                  f"{R('f.Avg_Speed')} AS Avg_Speed FROM f LEFT JOIN meta m USING ({LAP})"))
def d1_join_metadata(spark, sf):
    """Lap aggregates left-joined with lap metadata."""
    t = fx.telemetry(spark, sf)
    f = t.groupBy(*tp.LAP_KEYS).agg(F.count(F.lit(1)).alias("n_samples"), F.avg("Speed").alias("Avg_Speed"))
    return agg.join_metadata(f, fx.telemetry_laps(spark, sf), tp.LAP_KEYS)


@register("d3_telemetry_of_fastest",
          q.with_({"tel": fx.sql_telemetry(), "meta": fx.SQL_TELEMETRY_LAPS,
                   "best": "SELECT Driver, LapNumber FROM meta QUALIFY row_number() OVER "
                           "(PARTITION BY Driver ORDER BY LapTimeSeconds, LapNumber) = 1"},
                  f"SELECT {LAP}, event_id, {R('Speed')} AS Speed FROM tel SEMI JOIN best USING ({LAP})"))
def d3_telemetry_of_fastest(spark, sf):
    """D3: raw samples of each driver's fastest lap only."""
    best = series.fastest_lap(fx.telemetry_laps(spark, sf), ["Driver"])
    return compare.telemetry_of(best, fx.telemetry(spark, sf), tp.LAP_KEYS).select(*tp.LAP_KEYS, "event_id", "Speed")


_D6 = ("10", "20")


@register("d6_compare_laps",
          q.with_({"laps": fx.SQL_LAPS,
                   "fl": "SELECT Driver, LapNumber, LapTimeSeconds, Compound, TyreLife FROM laps "
                         f"WHERE Driver IN ('{_D6[0]}', '{_D6[1]}') "
                         "QUALIFY row_number() OVER (PARTITION BY Driver ORDER BY LapNumber) = 1"},
                  "SELECT a.Driver AS Driver_1, a.LapNumber AS LapNumber_1, "
                  f"{R('a.LapTimeSeconds')} AS LapTimeSeconds_1, a.Compound AS Compound_1, a.TyreLife AS TyreLife_1, "
                  f"b.Driver AS Driver_2, b.LapNumber AS LapNumber_2, {R('b.LapTimeSeconds')} AS LapTimeSeconds_2, "
                  f"b.Compound AS Compound_2, b.TyreLife AS TyreLife_2, {R('a.LapTimeSeconds - b.LapTimeSeconds')} AS Diff_s "
                  f"FROM fl a JOIN fl b ON a.Driver = '{_D6[0]}' AND b.Driver = '{_D6[1]}'"))
def d6_compare_laps(spark, sf):
    """Comparison card of two drivers' first laps."""
    return compare.compare_laps(fx.laps(spark, sf), *_D6)


# ------------------------------------------------------------------ B*

@register("b1_select_numeric",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {R('Speed')} AS Speed, {R('Throttle')} AS Throttle, {R('CAST(Brake AS DOUBLE)')} AS Brake, "
                  f"{R('X')} AS X FROM tel"))
def b1_select_numeric(spark, sf):
    """B1: wanted numeric columns that exist, as double."""
    return clean.select_numeric(fx.telemetry(spark, sf), ["Speed", "Throttle", "Brake", "RPM", "X"])


@register("b2_relative_time",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {LAP}, event_id, {R('CAST(SessionTime_us - min(SessionTime_us) OVER (PARTITION BY Driver, LapNumber) AS DOUBLE) / 1e6')} "
                  f"AS RelativeTime_s FROM tel"))
def b2_relative_time(spark, sf):
    """B2: seconds since the lap's first sample."""
    t = fx.telemetry(spark, sf).select(*tp.LAP_KEYS, "event_id", "SessionTime_us")
    return series.with_relative_time(t, tp.LAP_KEYS, "SessionTime_us").drop("SessionTime_us")


@register("b3_rebase_distance",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {LAP}, event_id, Distance_c - min(Distance_c) OVER (PARTITION BY Driver, LapNumber) AS Distance_c "
                  f"FROM tel WHERE Distance_c IS NOT NULL"))
def b3_rebase_distance(spark, sf):
    """Distance minus the lap minimum."""
    t = fx.telemetry(spark, sf).select(*tp.LAP_KEYS, "event_id", "Distance_c")
    return series.rebase_distance(t, tp.LAP_KEYS, "Distance_c")


@register("b4_dedupe_first",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {LAP}, event_id, Distance_c // 100 AS d FROM tel QUALIFY row_number() OVER "
                  f"(PARTITION BY {LAP}, Distance_c // 100 ORDER BY SessionTime_us, event_id) = 1"))
def b4_dedupe_first(spark, sf):
    """First sample per (lap, coarse distance) by time."""
    t = fx.telemetry(spark, sf).select(*tp.LAP_KEYS, "event_id", "SessionTime_us",
                                       series.floor_div(F.col("Distance_c"), 100).alias("d"))
    return series.dedupe_first(t, tp.LAP_KEYS, ["d"], ["SessionTime_us", "event_id"]).select(
        *tp.LAP_KEYS, "event_id", "d")


@register("b5_complete_cases",
          q.with_({"lf": fx.SQL_LAP_FEATURES}, "SELECT lap_id, Compound FROM lf WHERE Compound IS NOT NULL "
                                               "AND LapTimeSeconds IS NOT NULL"))
def b5_complete_cases(spark, sf):
    """Rows without nulls in the chosen columns."""
    return clean.complete_cases(fx.lap_features(spark, sf), ["Compound", "LapTimeSeconds"]).select("lap_id", "Compound")


@register("b6_units",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT event_id, {R('Speed * ' + q.lit(1000 / 3600))} AS Speed_mps, {R('Speed / ' + q.lit(3.6))} AS Speed_ms, "
                  f"{R('X / ' + q.lit(9.81))} AS X_g FROM tel"))
def b6_units(spark, sf):
    """km/h -> m/s (both forms) and m/s2 -> g."""
    t = clean.with_units(fx.telemetry(spark, sf), "Speed", ["X"])
    return t.select("event_id", "Speed_mps", "Speed_ms", "X_g")


@register("b7_zero_guards",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT event_id, {R('CASE WHEN Throttle = 0 THEN ' + q.lit(0.1) + ' ELSE Throttle END')} AS Throttle_guarded, "
                  f"{R('Speed / nullif(Throttle, 0)')} AS Speed_per_Throttle, "
                  f"{R('greatest(sqrt(X * X + Y * Y), ' + q.lit(1e-6) + ')')} AS speed_norm FROM tel"))
def b7_zero_guards(spark, sf):
    """Zero guards (0 -> 0.1, divide by zero -> null, norm floor)."""
    t = clean.guard_zeros(fx.telemetry(spark, sf), "Throttle", "Speed", "Throttle", "X", "Y")
    return t.select("event_id", "Throttle_guarded", "Speed_per_Throttle", "speed_norm")


@register("b8_pick_drivers",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT {LAP}, event_id FROM tel WHERE Driver IN ('{D1_DRIVER}', '{D2_DRIVER}', '100')"))
def b8_pick_drivers(spark, sf):
    """Membership filter on drivers."""
    return clean.pick_drivers(fx.telemetry(spark, sf), [D1_DRIVER, D2_DRIVER, "100"]).select(*tp.LAP_KEYS, "event_id")


@register("b9_driver_code",
          q.with_({"laps": fx.SQL_LAPS,
                   "codes": "SELECT CAST(c_custkey AS VARCHAR) AS k, c_name FROM customer"},
                  "SELECT coalesce(c_name, Driver) AS Driver, LapNumber, Driver AS DriverNumber FROM laps "
                  "LEFT JOIN codes ON Driver = k"))
def b9_driver_code(spark, sf):
    """Driver number -> code; unknown numbers stay."""
    codes = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("Driver"), F.col("c_name").alias("DriverCode"))
    return clean.with_driver_code(fx.laps(spark, sf).select("Driver", "LapNumber"), codes)


@register("b10_fill_lap_defaults",
          q.with_({"laps": fx.SQL_LAPS},
                  "SELECT Driver, LapNumber, coalesce(Compound, 'UNKNOWN') AS Compound, coalesce(TyreLife, 0) AS TyreLife "
                  "FROM laps"))
def b10_fill_lap_defaults(spark, sf):
    """Defaults for missing lap attributes."""
    return clean.fill_lap_defaults(fx.laps(spark, sf).select("Driver", "LapNumber", "Compound", "TyreLife"))


@register("b11_tag_samples",
          q.with_({"tel": fx.sql_telemetry(), "meta": fx.SQL_TELEMETRY_LAPS},
                  f"SELECT t.Driver, t.LapNumber, t.event_id, m.Compound, m.TyreLife FROM tel t LEFT JOIN meta m "
                  f"USING ({LAP})"))
def b11_tag_samples(spark, sf):
    """Lap attributes attached to every sample."""
    t = fx.telemetry(spark, sf).select(*tp.LAP_KEYS, "event_id")
    return clean.tag_samples(t, fx.telemetry_laps(spark, sf), tp.LAP_KEYS)


@register("b12_project_present",
          q.with_({"lf": fx.SQL_LAP_FEATURES}, "SELECT lap_id, Driver, Compound FROM lf"))
def b12_project_present(spark, sf):
    """Required plus present optional columns."""
    return clean.project_present(fx.lap_features(spark, sf), ["lap_id", "Driver"], ["PC1", "Compound", "Nope"])


# ------------------------------------------------------------------ A*

@register("a1_scan_laps", q.with_({"laps": fx.SQL_LAPS},
                                  f"SELECT Driver, LapNumber, {R('LapTimeSeconds')} AS LapTimeSeconds FROM laps "
                                  f"WHERE SessionDate >= TIMESTAMP '1996-01-01' AND SessionDate < TIMESTAMP '1997-01-01'"))
def a1_scan_laps(spark, sf):
    """A1: one season's laps - column-pruned scan, date range pushed into the Parquet reader."""
    lp = fx.laps(spark, sf)
    lo, hi = F.expr("TIMESTAMP_NTZ'1996-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'")
    season = (F.col("SessionDate") >= lo) & (F.col("SessionDate") < hi)
    return lp.where(season).select("Driver", "LapNumber", "LapTimeSeconds")


@register("a1_read_artifact", q.with_({"laps": fx.SQL_LAPS},
                                      f"SELECT Driver, CAST(LapNumber AS INTEGER) AS LapNumber, Compound, TyreLife, {R('LapTimeSeconds')} AS LapTimeSeconds FROM laps"))
def a1_read_artifact(spark, sf):
    """A1: an artefact kind written and read with its declared schema."""
    from lapengine.streaming.ingest import shared_dir
    path = shared_dir(spark, "laps-metadata")
    _as(fx.laps(spark, sf), "laps_metadata").write.parquet(path)
    return src.read_artifact(spark, path, "laps_metadata")


def _as(df, kind, **extra):
    """``df`` with the columns and types of an artefact kind, and ``extra`` columns under new names."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SCHEMAS[kind].fields], *[F.col(c).alias(n) for n, c in extra.items()])


@register("a4_merge_sessions",
          q.with_({"lf": fx.SQL_LAP_FEATURES},
                  f"SELECT 2024 AS Year, 'Event_' || Event AS Event, 'R' AS SessionType, Driver, LapNumber, {R('Energy_Index')} AS Energy_Index FROM lf"))
def a4_merge_sessions(spark, sf):
    """A4: one folder per session, and one that is none, merged by a single scan; keys from the folder names."""
    from lapengine.streaming.ingest import shared_dir
    root, lf = shared_dir(spark, "sessions"), fx.lap_features(spark, sf)
    for event in ("A", "N", "R"):
        _as(lf.where(F.col("Event") == event), "lap_features").write.parquet(f"{root}/2024_Event_{event}_R/lap_features")
    _as(lf, "lap_features").write.parquet(f"{root}/backup/lap_features")
    return src.merge_sessions(spark, root).select("Year", "Event", "SessionType", "Driver", "LapNumber", "Energy_Index")


@register("a17_first_available", q.with_({"laps": fx.SQL_LAPS}, "SELECT Driver, LapNumber FROM laps"))
def a17_first_available(spark, sf):
    """Of a missing source, an empty one and a full one, the full one."""
    from lapengine.streaming.ingest import shared_dir
    root, lp = shared_dir(spark, "candidates"), fx.laps(spark, sf).select("Driver", "LapNumber")
    lp.limit(0).write.parquet(f"{root}/empty")
    lp.write.parquet(f"{root}/full")
    return src.first_available(spark, [f"{root}/missing", f"{root}/empty", f"{root}/full"])


_A2_SQL = ("CASE WHEN len(string_split(label, '_')) > 2 THEN array_to_string(string_split(label, '_')"
           "[2:len(string_split(label, '_')) - 1], '_') ELSE 'UnknownEvent' END")


@register("a2_parse_session_label",
          q.with_({"laps": fx.SQL_LAPS, "lab": fx.SQL_SESSION_LABELS},
                  f"SELECT LapNumber, label, CAST(string_split(label, '_')[1] AS INTEGER) AS Year, {_A2_SQL} AS Event, "
                  f"string_split(label, '_')[-1] AS SessionType FROM lab "
                  f"WHERE len(string_split(label, '_')) >= 2 AND regexp_matches(string_split(label, '_')[1], '^[0-9]+$')"))
def a2_parse_session_label(spark, sf):
    """A2: session label -> Year, Event, SessionType; malformed labels rejected."""
    return src.with_session_keys(fx.session_labels(spark, sf), "label")


@register("a3_session_label",
          q.with_({"laps": fx.SQL_LAPS}, f"SELECT LapNumber, {fx.SQL_LABEL} AS label FROM laps"))
def a3_session_label(spark, sf):
    """A3: session label from its parts."""
    from lapengine.functions.columns import session_label
    return fx.laps(spark, sf).select("LapNumber", session_label("Year", "Event", "SessionType").alias("label"))


@register("a4_union_sessions",
          q.with_({"laps": fx.SQL_LAPS},
                  "SELECT Driver, LapNumber, SessionType, TyreLife FROM laps WHERE SessionType = 'F' "
                  "UNION ALL BY NAME SELECT Driver, LapNumber, SessionType FROM laps WHERE SessionType = 'O' "
                  "UNION ALL BY NAME SELECT LapNumber, TyreLife, SessionType FROM laps WHERE SessionType NOT IN ('F', 'O')"))
def a4_union_sessions(spark, sf):
    """A4: UNION ALL of sessions with drifted schemas (missing column -> null)."""
    lp = fx.laps(spark, sf)
    a = lp.where(F.col("SessionType") == "F").select("Driver", "LapNumber", "SessionType", "TyreLife")
    b = lp.where(F.col("SessionType") == "O").select("Driver", "LapNumber", "SessionType")
    c = lp.where(~F.col("SessionType").isin("F", "O")).select("LapNumber", "TyreLife", "SessionType")
    return src.union_sessions([a, b, c])


@register("a5_list_sessions",
          q.with_({"laps": fx.SQL_LAPS, "lab": fx.SQL_SESSION_LABELS},
                  "SELECT DISTINCT label FROM lab WHERE regexp_matches(label, '^[0-9]')"))
def a5_list_sessions(spark, sf):
    """A5: session catalogue (names starting with a digit, newest first)."""
    return src.list_sessions(fx.session_labels(spark, sf))


@register("a6_race_calendar",
          q.with_({"cal": fx.SQL_CALENDAR},
                  "SELECT Year, EventName, RoundNumber FROM cal WHERE RoundNumber > 0 "
                  "AND NOT contains(EventName, 'Test') AND NOT contains(EventName, 'Pre-Season')"))
def a6_race_calendar(spark, sf):
    """Calendar without test / pre-season / round 0."""
    return src.race_calendar(fx.calendar(spark, sf))


_A7_TYPES = ["F", "O", "P"]


@register("a7_pending_sessions",
          q.with_({"laps": fx.SQL_LAPS, "cal0": fx.SQL_CALENDAR,
                   "cal": "SELECT * FROM cal0 WHERE RoundNumber > 0 AND NOT contains(EventName, 'Test') "
                          "AND NOT contains(EventName, 'Pre-Season')",
                   "done": fx.SQL_DONE_LABELS,
                   "ct": "SELECT Year, EventName, SessionType FROM cal, (VALUES ('F'), ('O'), ('P')) t(SessionType)"},
                  "SELECT label, Year, EventName, SessionType FROM (SELECT *, concat_ws('_', CAST(Year AS VARCHAR), "
                  "replace(EventName, ' ', '_'), replace(SessionType, ' ', '_')) AS label FROM ct) "
                  "ANTI JOIN done USING (label)"))
def a7_pending_sessions(spark, sf):
    """Calendar x session types minus sessions already done."""
    cal = src.race_calendar(fx.calendar(spark, sf))
    return src.pending_sessions(cal, fx.done_labels(spark, sf), _A7_TYPES)


@register("a8_pending_signals",
          q.with_({"laps": fx.SQL_LAPS, "done": fx.SQL_DONE_LABELS,
                   "inv": f"SELECT DISTINCT {fx.SQL_LABEL} AS label FROM laps",
                   "tl": f"SELECT DISTINCT {fx.SQL_LABEL} AS label FROM laps WHERE SessionType IN ('F', 'O')"},
                  "SELECT label FROM inv SEMI JOIN tl USING (label) ANTI JOIN done USING (label)"))
def a8_pending_signals(spark, sf):
    """Sessions with telemetry but without lap features."""
    from lapengine.functions.columns import session_label
    lp = fx.laps(spark, sf)
    lab = session_label("Year", "Event", "SessionType").alias("label")
    inv = lp.select(lab).distinct()
    tel = lp.where(F.col("SessionType").isin("F", "O")).select(lab).distinct()
    return src.pending_signals(inv, tel, fx.done_labels(spark, sf))


@register("a9_extract_laps",
          q.with_({"events": "SELECT * FROM events"},
                  "SELECT CAST(user_id AS VARCHAR) AS Driver, "
                  "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 + 1 AS INTEGER) AS LapNumber, "
                  f"{R('CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1e6')} AS LapTimeSeconds "
                  "FROM events GROUP BY 1, 2"))
def a9_extract_laps(spark, sf):
    """Lap time interval -> seconds."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    lap = (series.floor_div(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")), 10) + 1).cast("int")
    raw = ev.groupBy(F.col("user_id").cast("string").alias("Driver"), lap.alias("LapNumber")).agg(
        (F.max("ts") - F.min("ts")).alias("LapTime"))
    return src.extract_laps(raw).drop("LapTime")


@register("a10_extract_weather",
          q.with_({"tel": fx.sql_telemetry()},
                  "SELECT event_id, printf('%d days %02d:%02d:%02d.%06d', SessionTime_us // 86400000000, "
                  "(SessionTime_us // 1000000) % 86400 // 3600, (SessionTime_us // 1000000) % 3600 // 60, "
                  "(SessionTime_us // 1000000) % 60, SessionTime_us % 1000000) AS Time, "
                  f"{R('CAST(SessionTime_us AS DOUBLE) / 1e6')} AS TimeSeconds, {R('Speed')} AS AirTemp FROM tel"))
def a10_extract_weather(spark, sf):
    """A10: weather time text -> seconds (text built from FX1 and parsed back)."""
    from lapengine.functions.columns import interval_text
    t = fx.telemetry(spark, sf)
    w = t.select("event_id", interval_text("SessionTime_us").alias("Time"), F.col("Speed").alias("AirTemp"))
    return src.extract_weather(w).select("event_id", "Time", "TimeSeconds", "AirTemp")


@register("a11_tyre_table",
          q.with_({"laps": fx.SQL_LAPS},
                  "SELECT DriverCode AS Driver, Driver AS DriverNumber, 'N/A' AS Team, CAST(LapNumber AS INTEGER) AS LapNumber, "
                  "coalesce(Compound, 'UNKNOWN') AS Compound, coalesce(TyreLife, 0) AS TyreLife, 'N/A' AS FreshTyre, "
                  f"{R('LapTimeSeconds')} AS LapTimeSeconds, 0 AS Stint, 'false' AS IsPersonalBest FROM laps"))
def a11_tyre_table(spark, sf):
    """Tyre table with per-column defaults and safe casts."""
    lp = fx.laps(spark, sf).select(F.col("DriverCode").alias("Driver"), F.col("Driver").alias("DriverNumber"),
                                   "LapNumber", "Compound", "TyreLife", "LapTimeSeconds")
    return src.tyre_table(lp)


@register("a12_stringify",
          q.with_({"laps": fx.SQL_LAPS},
                  "SELECT Driver, CAST(LapNumber AS VARCHAR) AS LapNumber, CAST(TyreLife AS VARCHAR) AS TyreLife, "
                  "CAST(Year AS VARCHAR) AS Year, SessionType FROM laps"))
def a12_stringify(spark, sf):
    """Text normalisation of columns for export."""
    lp = fx.laps(spark, sf).select("Driver", "LapNumber", "TyreLife", "Year", "SessionType")
    return src.stringify(lp, ["LapNumber", "TyreLife", "Year"])


@register("a13_results_table",
          q.with_({"laps": fx.SQL_LAPS}, "SELECT Driver, LapNumber, SessionType FROM laps WHERE SessionType IN ('F', 'P')"))
def a13_results_table(spark, sf):
    """Results only for the result-bearing session types."""
    return src.results_table(fx.laps(spark, sf), ("F", "P")).select("Driver", "LapNumber", "SessionType")


# ------------------------------------------------------------------ E2-E14

@register("e2_event_summary",
          q.with_({"log": fx.SQL_EXTRACTION_LOG},
                  "SELECT event, count(*) FILTER (WHERE status = 'success') AS n_success, count(*) AS n_total, "
                  + ", ".join(f"CAST(sum(CAST({f} AS INTEGER)) AS BIGINT) AS n_{f}"
                              for f in ("has_laps", "has_tires", "has_weather", "has_telemetry"))
                  + " FROM log GROUP BY event"))
def e2_event_summary(spark, sf):
    """Per-event successful sessions and flag counts."""
    return agg.event_summary(fx.extraction_log(spark, sf), "event",
                             ["has_laps", "has_tires", "has_weather", "has_telemetry"])


@register("e3_extraction_totals",
          q.with_({"log": fx.SQL_EXTRACTION_LOG},
                  "SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success, "
                  "count(*) - count(*) FILTER (WHERE status = 'success') AS failed, "
                  "printf('%.1f%%', round(count(*) FILTER (WHERE status = 'success') * 100.0e0 / count(*), 1)) "
                  "AS success_rate FROM log"))
def e3_extraction_totals(spark, sf):
    """Totals and success rate text."""
    return agg.extraction_totals(fx.extraction_log(spark, sf))


@register("e6_distinct_drivers", q.with_({"tel": fx.sql_telemetry()}, "SELECT DISTINCT Driver FROM tel"))
def e6_distinct_drivers(spark, sf):
    """Distinct drivers."""
    return agg.distinct_sorted(fx.telemetry(spark, sf), "Driver")


_DYN = {**q.zoh_ctes(), **q.dynamics_ctes()}


@register("e7_box_stats",
          q.with_({**_DYN,
                   "qs": "SELECT Driver, quantile_cont(Jerk_long, 0.25) AS q1, quantile_cont(Jerk_long, 0.5) AS median, "
                         "quantile_cont(Jerk_long, 0.75) AS q3 FROM d5 WHERE Jerk_long IS NOT NULL GROUP BY Driver",
                   "b": "SELECT d5.Driver, Jerk_long, q1, median, q3, q1 - 1.5e0 * (q3 - q1) AS lo, "
                        "q3 + 1.5e0 * (q3 - q1) AS hi FROM d5 JOIN qs USING (Driver) WHERE Jerk_long IS NOT NULL"},
                  f"SELECT Driver, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3, "
                  f"{R('min(Jerk_long) FILTER (WHERE Jerk_long >= lo AND Jerk_long <= hi)')} AS whisker_low, "
                  f"{R('max(Jerk_long) FILTER (WHERE Jerk_long >= lo AND Jerk_long <= hi)')} AS whisker_high, "
                  "count(*) FILTER (WHERE NOT (Jerk_long >= lo AND Jerk_long <= hi)) AS n_outliers, count(*) AS n "
                  "FROM b GROUP BY Driver, q1, median, q3"))
def e7_box_stats(spark, sf):
    """Longitudinal-jerk box statistics per driver."""
    return agg.box_stats(tp.dynamics(spark, sf), "Driver", "Jerk_long")


_GG_BIN = 100.0


def _gg_sql(c):
    return f"CAST(floor(({c} / {q.lit(9.81)}) / {q.lit(_GG_BIN)}) AS BIGINT)"


@register("e8_gg_hist",
          q.with_(_DYN, f"SELECT {_gg_sql('AY_lat')} AS lat_bin, {_gg_sql('AX_long')} AS lon_bin, count(*) AS count "
                        "FROM d5 WHERE AY_lat IS NOT NULL AND AX_long IS NOT NULL GROUP BY 1, 2"))
def e8_gg_hist(spark, sf):
    """Friction-diagram histogram."""
    return agg.gg_hist(tp.dynamics(spark, sf), bin_g=_GG_BIN)


@register("e9_jerk_map",
          q.with_(_DYN, f"SELECT {LAP}, tick, {R('X')} AS X, {R('Y')} AS Y, {R('Jerk_long')} AS Jerk_long FROM d5 "
                        f"WHERE Driver = '{D1_DRIVER}' AND abs(Jerk_long) > 5.0e0"))
def e9_jerk_map(spark, sf):
    """Abrupt points (|jerk| > 5) of one driver."""
    return agg.jerk_map(tp.dynamics(spark, sf), tp.LAP_KEYS, D1_DRIVER, 5.0)


@register("e10_threshold_counts",
          q.with_(_DYN, f"SELECT {LAP}, count(*) FILTER (WHERE Throttle > 10.0e0) AS n_throttle_on, "
                        "count(*) FILTER (WHERE Brake * 100.0e0 > 5.0e0) AS n_brake_on, "
                        "count(*) FILTER (WHERE abs(Jerk_long) > 5.0e0) AS n_high_jerk, count(*) AS n_samples "
                        f"FROM d5 GROUP BY {LAP}"))
def e10_threshold_counts(spark, sf):
    """Per-lap throttle-on, brake-on and high-jerk counts."""
    d = tp.dynamics(spark, sf).withColumn("Brake", F.col("Brake") * F.lit(100.0))
    return agg.threshold_counts(d, tp.LAP_KEYS, 10.0, 5.0, 5.0)


@register("e11_energy_curve",
          q.with_({**_DYN, **q.energy_cte()},
                  f"SELECT {LAP}, {R('RelativeTime_s')} AS RelativeTime_s, {R('TireEnergyProxy')} AS TireEnergyProxy "
                  f"FROM d6 WHERE Driver IN ('{D1_DRIVER}', '{D2_DRIVER}')"))
def e11_energy_curve(spark, sf):
    """Cumulative energy over time for two drivers."""
    own = tp.enriched(spark, sf, only=F.col("Driver").isin(D1_DRIVER, D2_DRIVER))
    return agg.energy_curve(own, tp.LAP_KEYS, [D1_DRIVER, D2_DRIVER])


@register("e13_value_range",
          q.with_({"lf": fx.SQL_LAP_FEATURES},
                  f"SELECT {R('least(min(LapTimeSeconds), min(TargetTime))')} AS lo, "
                  f"{R('greatest(max(LapTimeSeconds), max(TargetTime))')} AS hi FROM lf"))
def e13_value_range(spark, sf):
    """Common axis range of two columns."""
    return agg.value_range(fx.lap_features(spark, sf), "LapTimeSeconds", "TargetTime")


@register("e14_top_k",
          q.with_({"lf": fx.SQL_LAP_FEATURES},
                  f"SELECT lap_id, {R('Energy_Index')} AS Energy_Index FROM lf "
                  "ORDER BY Energy_Index DESC NULLS LAST, lap_id LIMIT 15"))
def e14_top_k(spark, sf):
    """Top 15 rows by a value, name as tie-break."""
    return agg.top_k(fx.lap_features(spark, sf).select("lap_id", "Energy_Index"), "Energy_Index", "lap_id", 15)


# ---------------------------------------------------------------- further forms of A4, A11, C1, E7

_TEXT_US = ("printf('%d days %02d:%02d:%02d', us // 86400000000, us // 1000000 % 86400 // 3600, us // 1000000 % 3600 // 60, us // 1000000 % 60) "
            "|| CASE WHEN us % 1000000 = 0 THEN '' ELSE printf('.%06d', us % 1000000) END")


@register("a11_tyre_table_lap_time",
          "WITH l AS (SELECT CAST(user_id AS VARCHAR) AS Driver, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 + 1 AS INTEGER) AS LapNumber, "
          "CASE WHEN count(*) % 4 > 0 THEN epoch_us(max(ts)) - epoch_us(min(ts)) // 1000000 * 1000000 END AS us FROM events GROUP BY 1, 2) "
          "SELECT Driver, 'N/A' AS DriverNumber, 'N/A' AS Team, LapNumber, 'UNKNOWN' AS Compound, 0 AS TyreLife, 'N/A' AS FreshTyre, "
          f"CASE WHEN us IS NULL THEN 'NaT' ELSE {_TEXT_US} END AS LapTime, {R('CAST(us AS DOUBLE) / 1e6')} AS LapTimeSeconds, 0 AS Stint, 'false' AS IsPersonalBest FROM l")
def a11_tyre_table_lap_time(spark, sf):
    """Lap times as text and as seconds, from intervals of which some are null."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    lap = (series.floor_div(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")), 10) + 1).cast("int")
    span = F.when(F.count(F.lit(1)) % 4 > 0, F.max("ts") - F.date_trunc("second", F.min("ts")).cast("timestamp_ntz"))
    return src.tyre_table(ev.groupBy(F.col("user_id").cast("string").alias("Driver"), lap.alias("LapNumber")).agg(span.alias("LapTime")))


@register("a4_merge_drifted_sessions",
          q.with_({"lf": fx.SQL_LAP_FEATURES},
                  f"SELECT 2024 AS Year, 'Event_' || Event AS Event, Driver, LapNumber, CASE WHEN Event <> 'A' THEN {R('Energy_Index')} END AS Energy_Index, "
                  f"CASE WHEN Event = 'N' THEN {R('Avg_Throttle')} END AS Grip, CASE WHEN Event = 'R' THEN Compound END AS Tyre, "
                  "TyreLife FROM lf WHERE Event IN ('A', 'N', 'R')"))
def a4_merge_drifted_sessions(spark, sf):
    """A4: folders that lack a declared column or have columns of their own, merged by one scan."""
    from lapengine.streaming.ingest import shared_dir
    root, lf = shared_dir(spark, "sessions"), fx.lap_features(spark, sf)
    shapes = {"A": lambda x: _as(x, "lap_features").drop("Energy_Index"), "N": lambda x: _as(x, "lap_features", Grip="Avg_Throttle"),
              "R": lambda x: _as(x, "lap_features", Tyre="Compound")}
    for event, shape in shapes.items():
        shape(lf.where(F.col("Event") == event)).write.parquet(f"{root}/2024_Event_{event}_R/lap_features")
    return src.merge_sessions(spark, root, evolve=True).select("Year", "Event", "Driver", "LapNumber", "Energy_Index", "Grip", "Tyre", "TyreLife")


_HOUR = 3_600_000_000


@register("c1_dropped_samples",
          q.with_({"tel": fx.sql_telemetry()},
                  f"SELECT Driver, LapNumber, count(*) AS samples, count(*) - count(DISTINCT SessionTime_us // {6 * _HOUR}) AS dropped FROM tel GROUP BY Driver, LapNumber"))
def c1_dropped_samples(spark, sf):
    """Samples of each lap that share their time with an earlier one, times being kept to six hours."""
    tel = fx.telemetry(spark, sf).withColumn("at", series.floor_div(F.col("SessionTime_us"), 6 * _HOUR))
    return series.dropped_samples(tel, tp.LAP_KEYS, "at")


_PROBS = [0.25, 0.5, 0.75]


@register("e7_box_sketch",
          q.with_({"lf": fx.SQL_LAP_FEATURES},
                  "SELECT Event, p, count(*) AS n, true AS within FROM lf, (SELECT unnest([0.25e0, 0.5e0, 0.75e0]) AS p) WHERE Energy_Index IS NOT NULL GROUP BY Event, p"))
def e7_box_sketch(spark, sf):
    """E7's quartiles from the sketch: whether each is within the stated rank error of the exact one, counted on all rows."""
    lf = fx.lap_features(spark, sf).select("Event", "Energy_Index")
    found = agg.sketch_quantiles(lf, "Event", "Energy_Index", _PROBS)
    errors = agg.rank_errors(lf, "Event", "Energy_Index", found, _PROBS)
    return errors.select("Event", "p", "n", (F.col("error") <= 1 / agg.SKETCH_ACCURACY + 1 / F.col("n")).alias("within"))
