"""Aggregations (E1-E16): lap features, summaries, distributions, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapengine.functions.columns import STANDARD_GRAVITY, safe_div

LAP_FEATURE_COLUMNS = [
    "Avg_Speed_mps", "Avg_Throttle", "Brake_Aggression", "MeanAbs_Jerk_Long", "MeanAbs_Jerk_Lat",
    "Max_Lateral_g", "Max_Longitudinal_g", "Energy_Index",
]


def _feature_aggs(energy: Column) -> list[Column]:
    return [
        F.avg("Speed_mps").alias("Avg_Speed_mps"),
        F.avg("Throttle").alias("Avg_Throttle"),
        F.stddev_samp(F.col("Brake").cast("double")).alias("Brake_Aggression"),
        F.avg(F.abs("Jerk_long")).alias("MeanAbs_Jerk_Long"),
        F.avg(F.abs("Jerk_lat")).alias("MeanAbs_Jerk_Lat"),
        (F.max(F.abs("AY_lat")) / F.lit(STANDARD_GRAVITY)).alias("Max_Lateral_g"),
        (F.max(F.abs("AX_long")) / F.lit(STANDARD_GRAVITY)).alias("Max_Longitudinal_g"),
        energy.alias("Energy_Index"),
    ]


def join_metadata(feat: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    """Left join lap metadata; unmatched laps get null time/life, ``''`` compound.

    ``meta`` is one row per lap; the planner (AQE) broadcasts it when its
    measured size is small and otherwise runs a shuffle join.
    """
    m = meta.select(*keys, "LapTimeSeconds", "Compound", "TyreLife", F.lit(True).alias("_hit"))
    j = feat.join(m, keys, "left")
    return j.select(
        *keys, "LapTimeSeconds",
        F.when(F.col("_hit"), F.col("Compound")).otherwise(F.lit("")).alias("Compound"),
        "TyreLife", *[c for c in feat.columns if c not in keys])


def lap_features(enriched: DataFrame, meta: DataFrame | None, keys: list[str], tick: str = "tick") -> DataFrame:
    """One row per lap from enriched telemetry (+ D1 metadata join).

    ``Energy_Index`` is the energy at the last tick (``max_by``); partial
    aggregation keeps the shuffle at one row per lap and task.
    """
    feat = enriched.groupBy(*keys).agg(*_feature_aggs(F.max_by("TireEnergyProxy", tick)))
    return join_metadata(feat, meta, keys) if meta is not None else feat


def lap_features_from_dynamics(dyn: DataFrame, meta: DataFrame | None, keys: list[str]) -> DataFrame:
    """E1 straight from the window chain: last cumulative energy = total energy.

    Skips the running sum (and its chunk carry) entirely: the sum of the
    per-row increments is an ordinary aggregate.
    """
    feat = dyn.groupBy(*keys).agg(*_feature_aggs(F.sum("_e")))
    return join_metadata(feat, meta, keys) if meta is not None else feat


def event_summary(log: DataFrame, by: str = "event", flags: list[str] = ()) -> DataFrame:
    """Per event, successful extractions and the count of each flag."""
    aggs = [F.count_if(F.col("status") == "success").alias("n_success"),
            F.count(F.lit(1)).alias("n_total")]
    aggs += [F.sum(F.col(f).cast("int")).cast("long").alias(f"n_{f}") for f in flags]
    return log.groupBy(by).agg(*aggs)


def extraction_totals(log: DataFrame) -> DataFrame:
    """Totals and success rate as ``'%.1f%%'`` text."""
    t = log.agg(F.count(F.lit(1)).alias("total"),
                F.count_if(F.col("status") == "success").alias("success"))
    rate = F.when(F.col("total") > 0, F.col("success") * F.lit(100.0) / F.col("total")).otherwise(F.lit(0.0))
    return t.select("total", "success", (F.col("total") - F.col("success")).alias("failed"),
                    F.format_string("%.1f%%", F.round(rate, 1)).alias("success_rate"))


SKETCH_ACCURACY = 10_000
# At most so many groups' statistics are broadcast; more are joined by salted keys.
MAX_BROADCAST_GROUPS = 10_000
JOIN_SALTS = 64


def _with_group_stats(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of one statistics row per group, without moving the rows of a large group to one task.

    The statistics are materialised and counted.  Up to MAX_BROADCAST_GROUPS
    rows are broadcast, so ``df`` is not shuffled at all; beyond that every
    group is dealt over JOIN_SALTS keys and its statistics row is repeated.
    """
    from lapengine.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    stats = stats.checkpoint(eager=True)
    if stats.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS:
        return df.join(F.broadcast(stats), keys, "left")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(JOIN_SALTS))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(JOIN_SALTS - 1).cast("bigint")))
    return df.withColumn("_salt", salt).join(stats.withColumn("_salt", salts), [*keys, "_salt"], "left").drop("_salt")


def zscore_by(df: DataFrame, keys: list[str], cols: list[str], suffix: str = "_norm") -> DataFrame:
    """Per-group z-score with the sample std; 0 spread -> divide by 1.

    One-row groups have an undefined std and give null (the row is dropped
    later by complete-case filtering).  Statistics are grouped aggregates
    (partial aggregation; no window over a possibly huge group) attached by
    ``_with_group_stats``.
    """
    stats = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                  *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = _with_group_stats(df, stats, keys)
    out = []
    for c in cols:
        sd = F.col(f"_s_{c}")
        div = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out.append(((F.col(c) - F.col(f"_m_{c}")) / div).alias(f"{c}{suffix}"))
    return j.select(*df.columns, *out)


def energy_per_m(df: DataFrame) -> DataFrame:
    """E5: estimated lap distance and energy per metre (zero distance -> null)."""
    dist = F.col("Avg_Speed_mps") * F.col("LapTimeSeconds")
    return df.select("*", dist.alias("Lap_Distance_est"),
                     safe_div(F.col("Energy_Index"), dist).alias("Energy_per_m"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (sorted for a stable listing)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def ranged_pairs(df: DataFrame, by: str, col: str) -> DataFrame:
    """Non-null ``(by, col)`` pairs sorted over the cluster, with their partition number, written once.

    Ranks are computed from this one copy, so they don't depend on whether
    Spark reuses an exchange or computes it again.  A row number is the last
    range column: any number of equal values is spread over partitions too.
    """
    from lapengine.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    pairs = df.select(by, col).where(F.col(col).isNotNull() & F.col(by).isNotNull())
    return (pairs.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(by, col, "_tie")
                 .select(by, col, F.spark_partition_id().alias("_pid")).checkpoint(eager=True))


def _ranked(x: DataFrame, by: str, col: str) -> tuple[DataFrame, DataFrame]:
    """Rank of every row inside its group over ``ranged_pairs``, and per-group counts.

    The rank is the number of group rows in earlier partitions (small table of
    per-partition counts) plus the row's position in its own partition, so a
    group never has to sit in one task.
    """
    from pyspark.sql import Window
    local = x.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid", by).orderBy(col)) - 1)
    cnt = x.groupBy("_pid", by).agg(F.count(F.lit(1)).alias("_c"))
    off = cnt.select("_pid", by, F.coalesce(F.sum("_c").over(
        Window.partitionBy(by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    ranked = local.join(off, ["_pid", by]).select(by, col, (F.col("_off") + F.col("_lr")).alias("_rank"))
    return ranked, cnt.groupBy(by).agg(F.sum("_c").alias("_n"))


def exact_quantiles(df: DataFrame, by: str, col: str, probs: list[float],
                    ranged: DataFrame | None = None) -> DataFrame:
    """Linear-interpolation quantiles per group, without gathering a group in one task.

    The two order statistics around ``p * (n - 1)`` are picked from the
    ranked rows by one equi join on ``(group, rank)``.  Output: ``by, q0, q1, ...``.
    """
    x = ranged if ranged is not None else ranged_pairs(df, by, col)
    ranked, n = _ranked(x, by, col)
    pos = n.select(by, F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_qi", "_p"), "_n") \
           .select(by, "_qi", (F.col("_p") * (F.col("_n") - 1)).alias("_pos"))
    pos = pos.select("*", F.floor("_pos").cast("long").alias("_lo"), F.ceil("_pos").cast("long").alias("_hi"))
    wanted = pos.select(by, "_qi", "_pos", "_lo", "_hi", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_rank"))
    j = wanted.join(ranked, [by, "_rank"])
    picked = j.groupBy(by, "_qi", "_pos", "_lo", "_hi").agg(
        F.max(F.when(F.col("_rank") == F.col("_lo"), F.col(col))).alias("_vlo"),
        F.max(F.when(F.col("_rank") == F.col("_hi"), F.col(col))).alias("_vhi"))
    val = F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi"))
    return picked.groupBy(by).agg(*[F.max(F.when(F.col("_qi") == i, val)).alias(f"q{i}") for i in range(len(probs))])


def sketch_quantiles(df: DataFrame, by: str, col: str, probs: list[float], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Quantiles per group from a mergeable sketch: ``by, q0, q1, ...``.

    Each task summarises its own rows and the summaries are merged, so nothing is sorted or gathered; memory a group is
    about ``accuracy`` numbers.  Each result is a value of the group whose rank is at most ``n / accuracy`` off.
    """
    q = F.percentile_approx(F.col(col), probs, accuracy).alias("_q")
    return (df.where(F.col(col).isNotNull() & F.col(by).isNotNull()).groupBy(by).agg(q)
              .select(by, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))]))


def rank_errors(df: DataFrame, by: str, col: str, quantiles: DataFrame, probs: list[float]) -> DataFrame:
    """How far each quantile's rank is from the one wanted, as a share of its group: ``by, p, n, error`` (exact, one join)."""
    x = _with_group_stats(df.select(by, col).where(F.col(col).isNotNull()), quantiles, [by])
    n = F.count(F.lit(1))
    each = x.groupBy(by).agg(n.alias("n"), F.array(*[
        F.struct(F.lit(p).alias("p"), F.greatest(F.lit(0.0), F.count_if(F.col(col) < F.col(f"q{i}")) / n - p, p - F.count_if(F.col(col) <= F.col(f"q{i}")) / n).alias("error"))
        for i, p in enumerate(probs)]).alias("e"))
    return each.select(by, "n", F.explode("e").alias("e")).select(by, "e.p", "n", "e.error")


def box_stats(df: DataFrame, by: str, col: str, exact: bool = True, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (1.5 IQR), outliers.

    ``exact`` ranks rows with a distributed sort (see ``exact_quantiles``);
    otherwise ``sketch_quantiles`` does without any sort.  Both keep every group
    spread over many tasks and read pairs that were written once.
    """
    probs = [0.25, 0.5, 0.75]
    if exact:
        x = ranged_pairs(df, by, col)
        qs = exact_quantiles(df, by, col, probs, ranged=x)
    else:
        from lapengine.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        x = df.select(by, col).where(F.col(col).isNotNull() & F.col(by).isNotNull()).checkpoint(eager=True)
        qs = sketch_quantiles(x, by, col, probs, accuracy)
    qs = qs.select(by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    qs = qs.select("*", (F.col("q1") - F.lit(1.5) * iqr).alias("_lo"), (F.col("q3") + F.lit(1.5) * iqr).alias("_hi"))
    j = _with_group_stats(x.select(by, col), qs, [by])
    inside = (F.col(col) >= F.col("_lo")) & (F.col(col) <= F.col("_hi"))
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_low"),
        F.max(F.when(inside, F.col(col))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def gg_hist(df: DataFrame, lat: str = "AY_lat", lon: str = "AX_long", bin_g: float = 0.5) -> DataFrame:
    """Friction diagram as a 2-D histogram of (lateral g, longitudinal g).

    ``floor(g / bin)`` bins of all points; partial aggregation.  An axis range
    is the reader's choice, as a filter on the bins.
    """
    def b(c):
        return F.floor(F.col(c) / F.lit(STANDARD_GRAVITY) / F.lit(bin_g))
    return (df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .groupBy(b(lat).alias("lat_bin"), b(lon).alias("lon_bin")).count())


def gg_points(df: DataFrame, keys: list[str], tick: str = "tick") -> DataFrame:
    """E8 points form: lateral / longitudinal g per sample."""
    return df.select(*keys, tick, (F.col("AY_lat") / F.lit(STANDARD_GRAVITY)).alias("Lat_g"),
                     (F.col("AX_long") / F.lit(STANDARD_GRAVITY)).alias("Long_g"))


def jerk_map(df: DataFrame, keys: list[str], driver: str | None = None, threshold: float | None = None,
             tick: str = "tick", x: str = "X", y: str = "Y", jerk: str = "Jerk_long") -> DataFrame:
    """X, Y, jerk of one driver (all points) or only abrupt ones (|jerk| > thr)."""
    out = df
    if driver is not None:
        out = out.where(F.col("Driver") == driver)
    if threshold is not None:
        out = out.where(F.abs(jerk) > threshold)
    return out.select(*keys, tick, x, y, jerk)


def threshold_counts(df: DataFrame, keys: list[str], throttle_on: float, brake_on: float,
                     jerk_high: float) -> DataFrame:
    """Per lap, samples with throttle on, brake on and high jerk."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col("Throttle") > throttle_on).alias("n_throttle_on"),
        F.count_if(F.col("Brake") > brake_on).alias("n_brake_on"),
        F.count_if(F.abs("Jerk_long") > jerk_high).alias("n_high_jerk"),
        F.count(F.lit(1)).alias("n_samples"))


def energy_curve(df: DataFrame, keys: list[str], drivers: list[str] | None = None,
                 time_col: str = "RelativeTime_s") -> DataFrame:
    """Energy over time for chosen drivers (ordered by the caller)."""
    out = df if drivers is None else df.where(F.col("Driver").isin(drivers))
    return out.select(*keys, time_col, "TireEnergyProxy")


def regression_metrics(pred: DataFrame, y: str = "y_true", yhat: str = "y_pred",
                       by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, R2 (optionally per group) in one aggregate.

    The total sum of squares is the population variance times the count.
    """
    by = list(by or [])
    e, n = F.col(yhat) - F.col(y), F.count(F.lit(1))
    sst = F.var_pop(y) * n
    r2 = F.when(sst == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0) - F.sum(e * e) / sst)
    return pred.groupBy(*by).agg(F.avg(F.abs(e)).alias("MAE"), F.sqrt(F.avg(e * e)).alias("RMSE"), r2.alias("R2"), n.alias("n"))


def value_range(df: DataFrame, a: str, b: str) -> DataFrame:
    """Common axis range of two columns."""
    return df.agg(F.least(F.min(a), F.min(b)).alias("lo"), F.greatest(F.max(a), F.max(b)).alias("hi"))


def top_k(df: DataFrame, value: str, name: str, k: int = 15) -> DataFrame:
    """The ``k`` largest values (nulls last, name breaks ties).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``k``; only ``k * tasks`` rows reach the final merge.
    """
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(name)).limit(k)


def speed_trace(dist: DataFrame, keys: list[str], drivers: list[str]) -> DataFrame:
    """Speed over distance for the chosen drivers."""
    return dist.where(F.col("Driver").isin(drivers)).select(*keys, "tick", "Distance_m", "Speed")


def latent_view(scores: DataFrame, drivers: list[str] | None = None, n_default: int = 5,
                optional: list[str] = ()) -> DataFrame:
    """PC scores of chosen drivers (default: the first five by id) + present optional columns."""
    if drivers is None:
        first = scores.select("Driver").distinct().orderBy("Driver").limit(n_default)
        sel = scores.join(F.broadcast(first), "Driver", "left_semi")  # at most n_default rows
    else:
        sel = scores.where(F.col("Driver").isin(drivers))
    keep = ["Driver", "PC1", "PC2", "PC3"] + [c for c in optional if c in scores.columns]
    extra = [c for c in ("lap_id", "LapNumber") if c in scores.columns and c not in keep]
    return sel.select(*extra, *keep)
