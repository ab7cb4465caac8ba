"""Comparison queries over aligned laps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapengine.functions.columns import KMH_PER_MPS, STANDSTILL_SPEED
from lapengine.operators import series


def time_from_speed(dist: DataFrame, keys: list[str], tick: str = "tick", step: float = 1.0,
                    scale: float = 1.0, speed_kmh: str = "Speed",
                    chunk_ticks: int = series.DEFAULT_CHUNK_TICKS) -> DataFrame:
    """Rebuild lap time on a distance grid: ``cumsum(d_dist / v)``.

    ``v = Speed / 3.6`` with 0 replaced by 0.1; ``d_dist`` is the distance
    step to the previous tick (0 at the first).  On a dense grid the previous
    distance is a function of the tick, so no window is needed for it; the
    running sum is chunked (see ``series.running_sum``).
    """
    v = F.col(speed_kmh) / F.lit(KMH_PER_MPS)
    v = F.when(v == 0, F.lit(STANDSTILL_SPEED)).otherwise(v)
    d_here = (F.col(tick) * F.lit(step)).cast("double") / F.lit(float(scale))
    d_prev = ((F.col(tick) - 1) * F.lit(step)).cast("double") / F.lit(float(scale))
    dd = F.when(F.col(tick) == 0, F.lit(0.0)).otherwise(d_here - d_prev)
    x = dist.withColumn("_dt", dd / v)
    x = series.running_sum(x, keys, tick, "_dt", "RelativeTime_s", chunk_ticks=chunk_ticks)
    return x.drop("_dt")


def ghost_delta(dist: DataFrame, first: tuple, second: tuple, keys: list[str] = ("Driver", "LapNumber"),
                tick: str = "tick") -> DataFrame:
    """Two laps joined on the integer distance tick; ``Delta_s = t2 - t1``.

    ``first`` / ``second`` are lap-key tuples, e.g. ``("8", 1)``.
    """
    keys = list(keys)

    def pick(lap, sfx):
        cond = None
        for k, v in zip(keys, lap):
            c = F.col(k) == F.lit(v)
            cond = c if cond is None else cond & c
        return dist.where(cond).select(tick, "Distance_m", F.col("RelativeTime_s").alias(f"RelativeTime_s_{sfx}"),
                                       F.col("Speed").alias(f"Speed_{sfx}"))
    a, b = pick(first, 1), pick(second, 2)
    j = a.join(b.drop("Distance_m"), tick)
    return j.select(tick, "Distance_m", "RelativeTime_s_1", "RelativeTime_s_2", "Speed_1", "Speed_2",
                    (F.col("RelativeTime_s_2") - F.col("RelativeTime_s_1")).alias("Delta_s"))


def ghost_delta_all(dist: DataFrame, ref: tuple, keys: list[str] = ("Driver", "LapNumber"),
                    tick: str = "tick") -> DataFrame:
    """Every lap against one reference lap on the distance tick.

    An equi join on ``tick``: the join key has high cardinality, so even a
    very long reference lap spreads over all partitions; AQE broadcasts the
    reference trace when its measured size is small.
    """
    keys = list(keys)
    cond = None
    for k, v in zip(keys, ref):
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    r = dist.where(cond).select(tick, F.col("RelativeTime_s").alias("_ref_t"))
    j = dist.join(r, tick)
    return j.select(*keys, tick, "Distance_m", (F.col("RelativeTime_s") - F.col("_ref_t")).alias("Delta_s"))


def telemetry_of(laps: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """D3: samples of the selected laps only (left semi join on the lap key)."""
    return samples.join(laps.select(*keys), keys, "left_semi")


def attach_scores(feat: DataFrame, scores: DataFrame, keys: list[str],
                  pcs: tuple[str, ...] = ("PC1", "PC2", "PC3")) -> DataFrame:
    """PC scores by key (not by position); unmatched rows get nulls."""
    return feat.join(scores.select(*keys, *pcs), keys, "left")


def compare_laps(feat: DataFrame, d1: str, d2: str, lap_no: str = "LapNumber") -> DataFrame:
    """The first lap of two drivers side by side, with the time difference.

    One grouped pass: the first lap per driver is a ``min`` of a struct, the
    two resulting rows are folded into one with conditional aggregates.
    """
    cols = ["LapTimeSeconds", "Compound", "TyreLife"]
    firsts = series.first_lap(feat.where(F.col("Driver").isin(d1, d2)).select("Driver", lap_no, *cols),
                              ["Driver"], lap_no)
    aggs = []
    for d, sfx in ((d1, 1), (d2, 2)):
        for c in ["Driver", lap_no] + cols:
            aggs.append(F.max(F.when(F.col("Driver") == d, F.col(c))).alias(f"{c}_{sfx}"))
    card = firsts.agg(*aggs).where(F.col("Driver_1").isNotNull() & F.col("Driver_2").isNotNull())
    return card.select("*", (F.col("LapTimeSeconds_1") - F.col("LapTimeSeconds_2")).alias("Diff_s"))
