"""DuckDB SQL text for the oracle side of each registered query.

Built from the same constants as the Spark plans so both engines evaluate the
same arithmetic in the same order.  Not used by the Spark plans themselves.
"""

from __future__ import annotations

from lapengine.functions.columns import KMH_TO_MPS, MIN_SPEED_NORM, STANDARD_GRAVITY, round_sql
from lapengine.functions.savgol import savgol_sql, sql_literal
from lapengine.operators.series import SAVGOL_POLY, SAVGOL_WINDOW
from lapengine.plans import fixtures as fx

LAP = "Driver, LapNumber"


def lit(v: float) -> str:
    return sql_literal(v)


def rounded_select(cols: list[tuple[str, bool]]) -> str:
    """``[(name, is_double)]`` -> select list with magnitude-aware rounding."""
    return ", ".join(f"{round_sql(n)} AS {n}" if d else n for n, d in cols)


def zoh_ctes(null_value: bool = False, short_laps: bool = False, step: int = fx.FX1_STEP_US) -> dict[str, str]:
    """CTEs ``tel, lap0, raw0, grid0, zoh, grid`` - C1 + C3 on FX1 via ASOF JOIN."""
    return {
        "tel": fx.sql_telemetry(null_value=null_value, short_laps=short_laps),
        "lap0": f"SELECT {LAP}, min(SessionTime_us) AS t0, max(SessionTime_us) AS t1 FROM tel GROUP BY {LAP}",
        "raw0": f"SELECT tel.*, SessionTime_us - t0 AS rel FROM tel JOIN lap0 USING ({LAP})",
        "grid0": f"SELECT {LAP}, tick, tick * {step} AS tus FROM "
                 f"(SELECT {LAP}, unnest(range(0, (t1 - t0) // {step} + 1)) AS tick FROM lap0)",
        "zoh": f"""SELECT g.Driver, g.LapNumber, g.tick, r.Speed, r.Throttle, CAST(r.Brake AS DOUBLE) AS Brake, r.X, r.Y
FROM grid0 g ASOF JOIN raw0 r ON g.Driver = r.Driver AND g.LapNumber = r.LapNumber AND g.tus >= r.rel""",
        "grid": f"""SELECT {LAP}, tick, CAST(tick * {step} AS DOUBLE) / 1e6 AS RelativeTime_s,
  {', '.join(_bfill_ffill(c) for c in ('Speed', 'Throttle', 'Brake', 'X', 'Y'))}
FROM zoh
WINDOW wn AS (PARTITION BY {LAP} ORDER BY tick ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
       wp AS (PARTITION BY {LAP} ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    }


def _bfill_ffill(c: str) -> str:
    return (f"coalesce({c}, first_value({c} IGNORE NULLS) OVER wn, last_value({c} IGNORE NULLS) OVER wp) AS {c}")


def _shift(c: str, w: str = "w"):
    def f(d: int) -> str:
        if d > 0:
            return f"lead({c}, {d}) OVER {w}"
        if d < 0:
            return f"lag({c}, {-d}) OVER {w}"
        return c
    return f


def gradient_sql(c: str, dt: float, k: str = "tick", n: str = "n", w: str = "w") -> str:
    return (f"(CASE WHEN {n} < 2 THEN NULL "
            f"WHEN {k} = 0 THEN (lead({c}, 1) OVER {w} - {c}) / {lit(dt)} "
            f"WHEN {k} = {n} - 1 THEN ({c} - lag({c}, 1) OVER {w}) / {lit(dt)} "
            f"ELSE (lead({c}, 1) OVER {w} - lag({c}, 1) OVER {w}) / {lit(2.0 * dt)} END)")


def dynamics_ctes(src: str = "grid", dt: float = fx.FX1_DT) -> dict[str, str]:
    """CTEs ``dn, d1 .. d5`` - C4-C6 (+ energy increment ``e``) over a grid CTE."""
    win = f"WINDOW w AS (PARTITION BY {LAP} ORDER BY tick)"
    sav = lambda c: savgol_sql(_shift(c), "tick", "n", SAVGOL_WINDOW, SAVGOL_POLY)
    return {
        "dn": f"SELECT g.*, n, Speed * {lit(KMH_TO_MPS)} AS sp FROM {src} g JOIN "
              f"(SELECT {LAP}, count(*) AS n FROM {src} GROUP BY {LAP}) USING ({LAP})",
        "d1": f"SELECT *, {sav('sp')} AS Speed_mps, {sav('X')} AS xs, {sav('Y')} AS ys FROM dn {win}",
        "d2": f"SELECT *, {gradient_sql('xs', dt)} AS VX, {gradient_sql('ys', dt)} AS VY FROM d1 {win}",
        "d3": f"SELECT *, {gradient_sql('VX', dt)} AS ax, {gradient_sql('VY', dt)} AS ay, "
              f"greatest(sqrt(VX * VX + VY * VY), {lit(MIN_SPEED_NORM)}) AS vn FROM d2 {win}",
        "d4": "SELECT *, (ax * VX + ay * VY) / vn AS AX_long, (ax * VY - ay * VX) / vn AS AY_lat FROM d3",
        "d5": f"SELECT *, {gradient_sql('AX_long', dt)} AS Jerk_long, {gradient_sql('AY_lat', dt)} AS Jerk_lat, "
              f"(abs(AX_long) + abs(AY_lat)) * vn * {lit(dt)} AS e FROM d4 {win}",
    }


def energy_cte(src: str = "d5") -> dict[str, str]:
    return {"d6": f"SELECT *, sum(e) OVER (PARTITION BY {LAP} ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING "
                  f"AND CURRENT ROW) AS TireEnergyProxy FROM {src}"}


def feature_aggs_sql(energy: str) -> str:
    return (f"avg(Speed_mps) AS Avg_Speed_mps, avg(Throttle) AS Avg_Throttle, "
            f"stddev_samp(Brake) AS Brake_Aggression, avg(abs(Jerk_long)) AS MeanAbs_Jerk_Long, "
            f"avg(abs(Jerk_lat)) AS MeanAbs_Jerk_Lat, max(abs(AY_lat)) / {lit(STANDARD_GRAVITY)} AS Max_Lateral_g, "
            f"max(abs(AX_long)) / {lit(STANDARD_GRAVITY)} AS Max_Longitudinal_g, {energy} AS Energy_Index")


FEATURE_COLS = ["Avg_Speed_mps", "Avg_Throttle", "Brake_Aggression", "MeanAbs_Jerk_Long", "MeanAbs_Jerk_Lat",
                "Max_Lateral_g", "Max_Longitudinal_g", "Energy_Index"]


def with_(ctes: dict[str, str], body: str) -> str:
    return fx.with_ctes(body, **ctes)
