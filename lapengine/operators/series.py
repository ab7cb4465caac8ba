"""Ordered-series operators over laps.

Every operator works on one DataFrame holding all sessions, drivers and laps.
Windows are never partitioned by the lap key alone: a single lap may hold a
large share of all samples, and a window partition cannot be split by AQE.
Instead rows are assigned to *chunks* of the order key (a fixed span of time,
distance or grid ticks) and windows run over ``(lap keys, chunk)``.  State
that crosses a chunk border (the next sample, the last non-null value, a
running sum) is taken from a chunk-level table - one row per chunk, orders of
magnitude smaller than the data - and joined back on ``(lap keys, chunk)``,
which the data is already partitioned by.  Bounded windows on grids (the
smoother and the gradients) read their neighbours from a halo: rows near a
chunk border are copied into the neighbouring chunk and dropped again after
the window.

With the default chunk sizes a normal lap is one chunk; the machinery then
costs one small aggregate and a broadcastable join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapengine.functions.columns import (
    KMH_TO_MPS,
    MIN_SPEED_NORM,
    all_not_null,
    ceil_div_nonneg,
    floor_div,
)
from lapengine.functions.savgol import savgol_column

# Fixed values that must equal the reference's for equal results.
TIME_SAMPLE_RATE_HZ = 10          # time grid, samples per second
DISTANCE_STEP_M = 1.0             # distance grid step, metres
SAVGOL_WINDOW = 11
SAVGOL_POLY = 2

DEFAULT_CHUNK_TICKS = 1 << 16     # grid ticks per chunk (~1.8 h at 10 Hz)
HALO = 13                         # smoother reach 10 + three chained gradients

_UNB_PRE = Window.unboundedPreceding
_UNB_FOL = Window.unboundedFollowing


# --------------------------------------------------------------------------
# chunk-level carries
# --------------------------------------------------------------------------

def chunk_carries(df: DataFrame, keys: list[str], chunk: str, order: list[str], *,
                  prev_last: list[str] = (), next_first: list[str] = (),
                  next_row: list[str] = (), prefix_sum: list[str] = (),
                  mask: Column | None = None) -> DataFrame:
    """One row per ``(keys, chunk)`` with state carried from other chunks.

    * ``_prev_<c>``: last non-null ``c`` (by ``order``) in earlier chunks
    * ``_next_<c>``: first non-null ``c`` in later chunks
    * ``_nr_<c>``: ``c`` on the first row of the next non-empty chunk
    * ``_pre_<c>``: sum of ``c`` over earlier chunks
    Only rows where ``mask`` holds take part.
    """
    m = mask if mask is not None else F.lit(True)
    aggs = []
    for c in prev_last:
        aggs.append(F.max(F.when(m & F.col(c).isNotNull(),
                                 F.struct(*[F.col(o) for o in order], F.col(c).alias("v")))).alias(f"_lnn_{c}"))
    for c in next_first:
        aggs.append(F.min(F.when(m & F.col(c).isNotNull(),
                                 F.struct(*[F.col(o) for o in order], F.col(c).alias("v")))).alias(f"_fnn_{c}"))
    if next_row:
        aggs.append(F.min(F.when(m, F.struct(*[F.col(o) for o in order],
                                             *[F.col(c).alias(f"v_{c}") for c in next_row]))).alias("_frow"))
    for c in prefix_sum:
        aggs.append(F.sum(F.when(m, F.col(c))).alias(f"_csum_{c}"))
    st = df.groupBy(*keys, chunk).agg(*aggs)
    w = Window.partitionBy(*keys).orderBy(chunk)
    before = w.rowsBetween(_UNB_PRE, -1)
    after = w.rowsBetween(1, _UNB_FOL)
    sel = [F.col(k) for k in keys] + [F.col(chunk)]
    for c in prev_last:
        sel.append(F.last(F.col(f"_lnn_{c}.v"), True).over(before).alias(f"_prev_{c}"))
    for c in next_first:
        sel.append(F.first(F.col(f"_fnn_{c}.v"), True).over(after).alias(f"_next_{c}"))
    if next_row:
        nr = F.first(F.col("_frow"), True).over(after)
        sel.append(nr.alias("_nrow"))
    for c in prefix_sum:
        sel.append(F.coalesce(F.sum(f"_csum_{c}").over(before), F.lit(0.0)).alias(f"_pre_{c}"))
    out = st.select(*sel)
    if next_row:
        out = out.select("*", *[F.col(f"_nrow.v_{c}").alias(f"_nr_{c}") for c in next_row]).drop("_nrow")
    return out


def _fill_exprs(keys, chunk, order_cols, cols, mask, mode):
    w = Window.partitionBy(*keys, chunk).orderBy(*order_cols)
    wprev = w.rowsBetween(_UNB_PRE, 0)
    wnext = w.rowsBetween(0, _UNB_FOL)
    out = {}
    for c in cols:
        mc = F.when(mask, F.col(c)) if mask is not None else F.col(c)
        p = F.coalesce(F.last(mc, True).over(wprev), F.col(f"_prev_{c}"))
        n = F.coalesce(F.first(mc, True).over(wnext), F.col(f"_next_{c}"))
        out[c] = F.coalesce(F.col(c), n, p) if mode == "bfill_ffill" else F.coalesce(F.col(c), p, n)
    return out


def _replace_cols(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])



TICK_BLOCK = 1 << 16              # ticks generated per array when a sample owns a long range


def explode_ticks(df: DataFrame, lo: str, hi: str, out: str = "tick", block: int = TICK_BLOCK) -> DataFrame:
    """One row per integer tick in ``[lo, hi]`` (rows with ``hi < lo`` give none).

    Two nested explodes - blocks of ``block`` ticks, then the ticks of each
    block - so a sample followed by a long gap never materialises one huge
    array; output is streamed row by row into the next operator.
    """
    b = df.where(F.col(hi) >= F.col(lo))
    b = b.select("*", F.explode(F.sequence(floor_div(F.col(lo), block), floor_div(F.col(hi), block))).alias("_blk"))
    first = F.greatest(F.col(lo), F.col("_blk") * F.lit(block))
    last = F.least(F.col(hi), F.col("_blk") * F.lit(block) + F.lit(block - 1))
    return b.select("*", F.explode(F.sequence(first, last)).alias(out)).drop("_blk")


# --------------------------------------------------------------------------
# Time alignment
# --------------------------------------------------------------------------

def with_relative_time(df: DataFrame, keys: list[str], t_us: str, out: str = "RelativeTime_s") -> DataFrame:
    """B2: seconds since the first sample of the lap (exact microsecond math).

    The lap start is a grouped minimum (partial aggregation, hot-key safe)
    joined back; AQE splits a skewed join partition.
    """
    start = df.groupBy(*keys).agg(F.min(t_us).alias("_t0"))
    return (df.join(start, keys)
              .withColumn(out, (F.col(t_us) - F.col("_t0")).cast("double") / F.lit(1e6))
              .drop("_t0"))


RAW_CHUNK_US = 3_600_000_000      # raw samples: at most one hour of a lap per window partition


def raw_chunk_span(step_us: int, chunk_ticks: int, raw_chunk_us: int | None = None) -> int:
    """Time span of one raw-sample chunk.

    Independent of the grid chunk: raw samples can be far denser than grid
    ticks, so the span is bounded by time (one hour, or one step if steps are
    longer) rather than by a tick count.
    """
    if raw_chunk_us is not None:
        return int(raw_chunk_us)
    return int(min(step_us * chunk_ticks, max(step_us, RAW_CHUNK_US)))


def resample_zoh(df: DataFrame, keys: list[str], t_us: str, cols: list[str], step_us: int,
                 tiebreak: list[str] = (), chunk_ticks: int = DEFAULT_CHUNK_TICKS,
                 fill: bool = True, time_col: str = "RelativeTime_s",
                 raw_chunk_us: int | None = None) -> DataFrame:
    """C1 (+C3): zero-order-hold resample of each lap on a fixed time grid.

    Tick ``k`` (``k = 0 .. floor(max rel / step)``) takes the whole row of the
    last sample with ``rel <= k * step``; then null cells take the next
    non-null grid value, trailing nulls the last one.  Sample ``i`` owns ticks
    ``ceil(rel_i / step) .. ceil(rel_{i+1} / step) - 1``: one ``explode`` of an
    integer ``sequence`` per sample, linear in the output.  Equal times keep
    the first sample by ``tiebreak``.

    Output: ``keys, tick (bigint), <time_col> (double s), cols (double)``.
    """
    keys = list(keys)
    tiebreak = list(tiebreak)
    span = raw_chunk_span(step_us, chunk_ticks, raw_chunk_us)
    base = (df.where(all_not_null(keys + [t_us]))
              .select(*keys, F.col(t_us).cast("long").alias("_t"), *tiebreak,
                      *[F.col(c).cast("double").alias(c) for c in cols]))
    base = base.withColumn("_c", floor_div(F.col("_t"), span))

    lapw = Window.partitionBy(*keys)
    cst = (base.groupBy(*keys, "_c").agg(F.min("_t").alias("_cmin"))
               .select(*keys, "_c",
                       F.min("_cmin").over(lapw).alias("_t0"),
                       F.lead("_cmin").over(lapw.orderBy("_c")).alias("_cnext")))
    x = base.join(cst, keys + ["_c"])
    order = [F.col("_t")] + [F.col(t).desc() for t in tiebreak]
    w = Window.partitionBy(*keys, "_c").orderBy(*order)
    nxt = F.coalesce(F.lead("_t").over(w), F.col("_cnext"))
    rel = F.col("_t") - F.col("_t0")
    x = x.select("*", nxt.alias("_nt"))
    lo = ceil_div_nonneg(rel, step_us)
    hi = F.when(F.col("_nt").isNull(), floor_div(rel, step_us)).otherwise(
        ceil_div_nonneg(F.col("_nt") - F.col("_t0"), step_us) - 1)
    x = x.select("*", lo.alias("_lo"), hi.alias("_hi"))
    if fill and cols:
        eff = F.col("_hi") >= F.col("_lo")
        car = chunk_carries(x, keys, "_c", ["_t"], prev_last=cols, next_first=cols, mask=eff)
        x = x.join(car, keys + ["_c"], "left")
        x = _replace_cols(x, _fill_exprs(keys, "_c", order, cols, eff, "bfill_ffill"))
    x = explode_ticks(x.select(*keys, "_lo", "_hi", *cols), "_lo", "_hi")
    return x.select(*keys, "tick",
                    ((F.col("tick") * F.lit(step_us)).cast("double") / F.lit(1e6)).alias(time_col),
                    *cols)


def dropped_samples(df: DataFrame, keys: list[str], t_us: str) -> DataFrame:
    """C1's quality count: ``keys, samples, dropped`` of each lap; ``dropped``: samples that ``resample_zoh`` leaves out because an
    earlier one has the same time.  Counted by (lap, time) first, so a lap of any length is summed up before it is shuffled."""
    at = df.where(all_not_null([*keys, t_us])).groupBy(*keys, t_us).agg(F.count(F.lit(1)).alias("_n"))
    return at.groupBy(*keys).agg(F.sum("_n").alias("samples"), F.sum(F.col("_n") - 1).alias("dropped"))


def align_time(df: DataFrame, keys: list[str], t_us: str, cols: list[str],
               hz: float = TIME_SAMPLE_RATE_HZ, **kw) -> DataFrame:
    """C1 with the reference's 10 Hz grid (``t_us`` in microseconds)."""
    return resample_zoh(df, keys, t_us, cols, int(round(1e6 / hz)), **kw)


# --------------------------------------------------------------------------
# Distance alignment
# --------------------------------------------------------------------------

def interpolate_grid(df: DataFrame, keys: list[str], d: str, cols: list[str], step: int,
                     order: list[str] = (), scale: float = 1.0,
                     chunk_ticks: int = DEFAULT_CHUNK_TICKS,
                     out_col: str = "Distance_m", pct_col: str = "Distance_pct") -> DataFrame:
    """C2 (+B3, B4, C3): linear interpolation of each lap on a fixed distance grid.

    ``d`` is an integer distance (e.g. hundredths of a metre) so grid ticks and
    joins stay exact; ``step`` is in the same unit and ``scale`` converts to
    ``out_col`` units (``Distance_m = tick * step / scale``).

    Rebase by the lap minimum (B3), drop null distances, keep the first sample
    per distance by ``order`` (B4), fill cells forward then backward (C3),
    then ``y0 + slope * (x - x0)`` per tick; ticks ``0 .. ceil(max / step)``,
    the tick past the maximum takes the last value.
    """
    keys = list(keys)
    order = list(order)
    span = int(step) * int(chunk_ticks)
    base = (df.where(all_not_null(keys + [d]))
              .select(*keys, F.col(d).cast("long").alias("_d"), *order,
                      *[F.col(c).cast("double").alias(c) for c in cols]))
    # B4 first: one sample per (lap, distance), hot distances collapse map-side
    base = dedupe_first(base, keys, ["_d"], order)
    base = base.withColumn("_c", floor_div(F.col("_d"), span))
    lapw = Window.partitionBy(*keys)
    cst = (base.groupBy(*keys, "_c").agg(F.min("_d").alias("_cmin"), F.max("_d").alias("_cmax"))
               .select(*keys, "_c", F.min("_cmin").over(lapw).alias("_d0"),
                       F.max("_cmax").over(lapw).alias("_d1")))
    x = base.join(cst, keys + ["_c"])
    ordc = [F.col("_d")] + [F.col(o) for o in order]
    w = Window.partitionBy(*keys, "_c").orderBy(*ordc)
    # one chunk table for everything that crosses a chunk border: fill carries
    # and the (filled) first row of the next non-empty chunk
    aggs = [F.min(F.struct(F.col("_d").alias("_k"), *[F.col(c).alias(f"v_{c}") for c in cols])).alias("_frow")]
    for c in cols:
        nn = F.when(F.col(c).isNotNull(), F.struct(F.col("_d").alias("_k"), F.col(c).alias("v")))
        aggs += [F.max(nn).alias(f"_lnn_{c}"), F.min(nn).alias(f"_fnn_{c}")]
    st = x.groupBy(*keys, "_c").agg(*aggs)
    cw = Window.partitionBy(*keys).orderBy("_c")
    before, after = cw.rowsBetween(_UNB_PRE, -1), cw.rowsBetween(1, _UNB_FOL)
    sel = [*keys, "_c", F.lead("_frow").over(cw).alias("_nrow")]
    for c in cols:
        sel += [F.col(f"_lnn_{c}.v").alias(f"_lnn_{c}"),
                F.last(F.col(f"_lnn_{c}.v"), True).over(before).alias(f"_prev_{c}"),
                F.first(F.col(f"_fnn_{c}.v"), True).over(after).alias(f"_next_{c}")]
    st = st.select(*sel)
    nxt = [F.col("_nrow._k").alias("_nr__d")]
    for c in cols:  # next chunk's first row, filled forward then backward
        nxt.append(F.coalesce(F.col(f"_nrow.v_{c}"), F.col(f"_lnn_{c}"), F.col(f"_prev_{c}"),
                              F.col(f"_next_{c}")).alias(f"_nr_{c}"))
    st = st.select(*keys, "_c", *nxt, *[F.col(f"_prev_{c}") for c in cols], *[F.col(f"_next_{c}") for c in cols])
    x = x.join(st, keys + ["_c"], "left")
    if cols:
        x = _replace_cols(x, _fill_exprs(keys, "_c", ordc, cols, None, "ffill_bfill"))
    x = x.select("*", F.coalesce(F.lead("_d").over(w), F.col("_nr__d")).alias("_nd"),
                 *[F.coalesce(F.lead(c).over(w), F.col(f"_nr_{c}")).alias(f"_n_{c}") for c in cols])
    rel = F.col("_d") - F.col("_d0")
    nrel = F.col("_nd") - F.col("_d0")
    lo = ceil_div_nonneg(rel, step)
    hi = F.when(F.col("_nd").isNull(), lo).otherwise(ceil_div_nonneg(nrel, step) - 1)
    x = explode_ticks(x.select("*", lo.alias("_lo"), hi.alias("_hi")), "_lo", "_hi")
    xt = F.col("tick") * F.lit(step)
    vals = []
    for c in cols:
        slope = (F.col(f"_n_{c}") - F.col(c)) / (nrel - rel).cast("double")
        vals.append(F.when(F.col("_nd").isNull(), F.col(c))
                    .otherwise(slope * (xt - rel).cast("double") + F.col(c)).alias(c))
    dist = xt.cast("double") / F.lit(float(scale))
    maxd = (F.col("_d1") - F.col("_d0")).cast("double") / F.lit(float(scale))
    pct = F.when(F.col("_d1") == F.col("_d0"), F.lit(0.0)).otherwise(dist / maxd)
    return x.select(*keys, "tick", dist.alias(out_col), *vals, pct.alias(pct_col))


def align_distance(df: DataFrame, keys: list[str], d_cm: str, cols: list[str],
                   step_m: float = DISTANCE_STEP_M, **kw) -> DataFrame:
    """C2 with the reference's 1 m grid (``d_cm``: distance in integer centimetres)."""
    return interpolate_grid(df, keys, d_cm, cols, int(round(step_m * 100)), scale=100.0, **kw)


def rebase_distance(df: DataFrame, keys: list[str], d: str) -> DataFrame:
    """Distance minus the lap minimum, null distances dropped."""
    start = df.where(F.col(d).isNotNull()).groupBy(*keys).agg(F.min(d).alias("_d0"))
    return (df.where(F.col(d).isNotNull()).join(start, keys)
              .withColumn(d, F.col(d) - F.col("_d0")).drop("_d0"))


def dedupe_first(df: DataFrame, keys: list[str], by: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per ``keys + by`` ordered by ``order``.

    A grouped ``min`` of a struct led by the order columns: partial
    aggregation collapses duplicates inside every task before the shuffle,
    so even a value repeated millions of times (a car standing still) never
    gathers in one task.
    """
    others = [c for c in df.columns if c not in keys and c not in by]
    first = F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                           *[F.col(c).alias(c) for c in others])).alias("_f")
    g = df.groupBy(*keys, *by).agg(first)
    return g.select(*keys, *by, *[F.col(f"_f.{c}").alias(c) for c in others]).select(*df.columns)


def fill_gaps(df: DataFrame, keys: list[str], order: str, cols: list[str], mode: str = "ffill_bfill",
              chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """Forward-then-backward (or backward-then-forward) null fill per lap.

    ``order`` must be an integer key (tick, microseconds); chunked by it.
    """
    x = df.withColumn("_c", floor_div(F.col(order), chunk_ticks))
    car = chunk_carries(x, keys, "_c", [order], prev_last=cols, next_first=cols)
    x = x.join(car, keys + ["_c"], "left")
    x = _replace_cols(x, _fill_exprs(keys, "_c", [F.col(order)], cols, None, mode))
    return x.select(*df.columns)


# --------------------------------------------------------------------------
# Smoothing, derivatives, planar dynamics, energy
# --------------------------------------------------------------------------

def _halo_frame(grid: DataFrame, keys: list[str], tick: str, chunk_ticks: int, halo: int = HALO) -> DataFrame:
    """Tag grid rows with their chunk and copy border rows into neighbours.

    Adds ``_pc`` (partition chunk), ``_own`` and ``_n`` and repartitions on
    ``(keys, _pc)``.  ``_n`` is ``max(tick) + 1`` over the partition - no
    join: the first ``halo`` rows of the next chunk are always copied in, so
    either the partition holds the lap's last tick (``_n`` is the lap length)
    or its maximum lies ``halo`` rows past every owned row, where the edge
    formulas cannot apply and any lap length that large gives the same result.
    """
    if chunk_ticks < 2 * halo:
        raise ValueError("chunk_ticks must be at least twice the halo")
    tc = floor_div(F.col(tick), chunk_ticks)
    r = F.pmod(F.col(tick), F.lit(chunk_ticks))
    g = grid.withColumn("_tc", tc)
    copies = F.filter(F.array(F.col("_tc"),
                              F.when((r < halo) & (F.col("_tc") > 0), F.col("_tc") - 1),
                              F.when(r >= chunk_ticks - halo, F.col("_tc") + 1)),
                      lambda e: e.isNotNull())
    g = g.withColumn("_pc", F.explode(copies)).withColumn("_own", F.col("_pc") == F.col("_tc")).drop("_tc")
    g = g.repartition(*keys, "_pc")
    part = Window.partitionBy(*keys, "_pc")
    return g.withColumn("_n", F.max(tick).over(part) + 1)


def _shift_name(c: str, d: int) -> str:
    return c if d == 0 else f"{c}__{'p' if d > 0 else 'm'}{abs(d)}"


def _with_shifts(df: DataFrame, cols: list[str], w: Window, reach: int) -> DataFrame:
    """Add ``lead``/``lag`` of each column by ``1..reach`` rows as named columns.

    One window operator computes each offset once; the smoother then is plain
    arithmetic on columns (codegen) instead of repeated window calls.
    """
    sel = []
    for c in cols:
        for d in range(1, reach + 1):
            sel.append(F.lead(c, d).over(w).alias(_shift_name(c, d)))
            sel.append(F.lag(c, d).over(w).alias(_shift_name(c, -d)))
    return df.select("*", *sel)


def _shift(c: str):
    return lambda d: F.col(_shift_name(c, d))


def _gradient(c: str, w: Window, k: Column, n: Column, dt: float) -> Column:
    """Central difference inside, one-sided at both ends (numpy rule)."""
    nxt = F.lead(c, 1).over(w)
    prv = F.lag(c, 1).over(w)
    cur = F.col(c)
    return (F.when(n < 2, F.lit(None).cast("double"))
            .when(k == 0, (nxt - cur) / F.lit(dt))
            .when(k == n - 1, (cur - prv) / F.lit(dt))
            .otherwise((nxt - prv) / F.lit(2.0 * dt)))


def _chain(g: DataFrame, keys: list[str], tick: str, speed: str, x: str, y: str, dt: float,
           window: int, poly: int, position_scale: float) -> DataFrame:
    """C4 -> C5 -> C6 window layers over a halo frame; returns owned rows only."""
    w = Window.partitionBy(*keys, "_pc").orderBy(tick)
    k, n = F.col(tick), F.col("_n")
    g = g.select("*", (F.col(speed) * F.lit(KMH_TO_MPS)).alias("_sp"),
                 (F.col(x) * F.lit(position_scale)).alias("_x"),
                 (F.col(y) * F.lit(position_scale)).alias("_y"))
    base_cols = g.columns
    g = _with_shifts(g, ["_sp", "_x", "_y"], w, window - 1)
    g = g.select(*base_cols, savgol_column(_shift("_sp"), k, n, window, poly).alias("Speed_mps"),
                 savgol_column(_shift("_x"), k, n, window, poly).alias("_xs"),
                 savgol_column(_shift("_y"), k, n, window, poly).alias("_ys"))
    g = g.select("*", _gradient("_xs", w, k, n, dt).alias("VX"), _gradient("_ys", w, k, n, dt).alias("VY"))
    g = g.select("*", _gradient("VX", w, k, n, dt).alias("_ax"), _gradient("VY", w, k, n, dt).alias("_ay"))
    vn = F.greatest(F.sqrt(F.col("VX") * F.col("VX") + F.col("VY") * F.col("VY")), F.lit(MIN_SPEED_NORM))
    g = g.select("*", vn.alias("_vn"))
    g = g.select("*", ((F.col("_ax") * F.col("VX") + F.col("_ay") * F.col("VY")) / F.col("_vn")).alias("AX_long"),
                 ((F.col("_ax") * F.col("VY") - F.col("_ay") * F.col("VX")) / F.col("_vn")).alias("AY_lat"))
    g = g.select("*", _gradient("AX_long", w, k, n, dt).alias("Jerk_long"),
                 _gradient("AY_lat", w, k, n, dt).alias("Jerk_lat"),
                 ((F.abs("AX_long") + F.abs("AY_lat")) * F.col("_vn") * F.lit(dt)).alias("_e"))
    return g.where("_own")


_PHYSICS = ["Speed_mps", "VX", "VY", "AX_long", "AY_lat", "Jerk_long", "Jerk_lat"]


def dynamics(grid: DataFrame, keys: list[str], tick: str = "tick", speed: str = "Speed",
             x: str = "X", y: str = "Y", dt: float = 1.0 / TIME_SAMPLE_RATE_HZ,
             window: int = SAVGOL_WINDOW, poly: int = SAVGOL_POLY, position_scale: float = 1.0,
             chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """C4 + C5 + C6 (+ per-row energy increment): window chain over a dense grid.

    Input: a grid with dense integer ticks ``0..n-1`` per lap (C1 output).
    Adds ``Speed_mps, VX, VY, AX_long, AY_lat, Jerk_long, Jerk_lat`` and
    ``_e = (|a_t| + |a_n|) * v * dt`` plus the internal chunk column ``_pc``.
    Laps with fewer rows than the smallest usable smoother window get null
    physics.  Speed is km/h; positions are used as given (``position_scale``).
    """
    keys = list(keys)
    g = _chain(_halo_frame(grid, keys, tick, chunk_ticks), keys, tick, speed, x, y, dt, window, poly,
               position_scale)
    return g.select(*grid.columns, *_PHYSICS, "_e", "_pc")


def enrich(grid: DataFrame, keys: list[str], tick: str = "tick", speed: str = "Speed", x: str = "X",
           y: str = "Y", dt: float = 1.0 / TIME_SAMPLE_RATE_HZ, window: int = SAVGOL_WINDOW,
           poly: int = SAVGOL_POLY, position_scale: float = 1.0,
           chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """C8 = C4 + C6 + C7: enriched telemetry with ``TireEnergyProxy``.

    Laps that fit in one chunk (nearly all) take the running sum inside their
    window partition.  Longer laps add the energy of all earlier chunks from
    the chunk table; only their rows pay for that join.
    """
    keys = list(keys)
    # The branches read the halo frame with different column sets, so Spark
    # does not reuse the exchange and recomputes the grid per branch.  That was
    # measured cheaper than a checkpoint of the whole halo grid here; at scale
    # the two cost about the same (two more grid passes vs. a full write+read).
    h = _halo_frame(grid, keys, tick, chunk_ticks)
    args = (keys, tick, speed, x, y, dt, window, poly, position_scale)
    w = Window.partitionBy(*keys, "_pc").orderBy(tick).rowsBetween(_UNB_PRE, 0)
    one = _chain(h.where(F.col("_n") <= chunk_ticks), *args)
    one = one.select(*grid.columns, *_PHYSICS, F.sum("_e").over(w).alias("TireEnergyProxy"))
    many = _chain(h.where(F.col("_n") > chunk_ticks), *args)
    car = chunk_carries(many, keys, "_pc", [tick], prefix_sum=["_e"])
    many = many.join(car, keys + ["_pc"], "left")
    many = many.select(*grid.columns, *_PHYSICS, (F.col("_pre__e") + F.sum("_e").over(w)).alias("TireEnergyProxy"))
    return one.unionByName(many)


def gradient(df: DataFrame, keys: list[str], tick: str, col: str, dt: float, out: str,
             chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """C5 standalone: numpy-style gradient of ``col`` over a dense tick grid."""
    g = _halo_frame(df, keys, tick, chunk_ticks)
    w = Window.partitionBy(*keys, "_pc").orderBy(tick)
    g = g.select("*", _gradient(col, w, F.col(tick), F.col("_n"), dt).alias(out)).where("_own")
    return g.select(*df.columns, out)


def smooth(df: DataFrame, keys: list[str], tick: str, col: str, out: str,
           window: int = SAVGOL_WINDOW, poly: int = SAVGOL_POLY,
           chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """C4 standalone: Savitzky-Golay (interp edges) of ``col`` over a dense grid."""
    g = _halo_frame(df, keys, tick, chunk_ticks)
    w = Window.partitionBy(*keys, "_pc").orderBy(tick)
    base_cols = g.columns
    g = _with_shifts(g, [col], w, window - 1)
    g = g.select(*base_cols, savgol_column(_shift(col), F.col(tick), F.col("_n"), window, poly).alias(out))
    return g.where("_own").select(*df.columns, out)


def running_sum(df: DataFrame, keys: list[str], order: str, col: str, out: str,
                chunk_ticks: int = DEFAULT_CHUNK_TICKS) -> DataFrame:
    """Running sum per lap (C7 / C9) over an integer order key, chunked."""
    x = df.withColumn("_c", floor_div(F.col(order), chunk_ticks))
    car = chunk_carries(x, keys, "_c", [order], prefix_sum=[col])
    x = x.join(car, keys + ["_c"], "left")
    w = Window.partitionBy(*keys, "_c").orderBy(order).rowsBetween(_UNB_PRE, 0)
    return x.select(*df.columns, (F.col(f"_pre_{col}") + F.sum(col).over(w)).alias(out))


# --------------------------------------------------------------------------
# Row selection
# --------------------------------------------------------------------------

def every_nth(df: DataFrame, keys: list[str], tick: str, n: int = 10) -> DataFrame:
    """Every n-th row of each lap from the first one.

    On a dense grid the row number is the tick itself, so this is a plain
    filter (no window, no shuffle).
    """
    return df.where(F.pmod(F.col(tick), F.lit(n)) == 0)


def every_nth_rows(df: DataFrame, keys: list[str], order: list[str], n: int = 10,
                   chunk_span: int = 3_600_000_000) -> DataFrame:
    """C10 for irregular samples: ``(row_number - 1) % n == 0`` per lap.

    The row number within the lap is the count of rows in earlier chunks of
    the integer order key ``order[0]`` (chunk table) plus the row number
    inside the chunk, so no window spans a whole lap.
    """
    x = df.withColumn("_c", floor_div(F.col(order[0]), chunk_span)).withColumn("_one", F.lit(1))
    car = chunk_carries(x, keys, "_c", [order[0]], prefix_sum=["_one"])
    x = x.join(car, keys + ["_c"], "left")
    w = Window.partitionBy(*keys, "_c").orderBy(*order)
    rn = F.col("_pre__one").cast("long") + F.row_number().over(w)
    return x.select("*", rn.alias("_rn")).where(((F.col("_rn") - 1) % n) == 0).select(*df.columns)


def fastest_laps(laps: DataFrame, driver_keys: list[str], lap_time: str = "LapTimeSeconds",
                 lap_no: str = "LapNumber", n: int = 3) -> DataFrame:
    """C11: the ``n`` fastest laps per driver, null lap times out, ties by lap number.

    ``row_number() <= n`` is planned as a WindowGroupLimit, which keeps only
    the top ``n`` per partition before the shuffle.
    """
    w = Window.partitionBy(*driver_keys).orderBy(F.col(lap_time), F.col(lap_no))
    return (laps.where(F.col(lap_time).isNotNull())
                .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn"))


def fastest_lap(laps: DataFrame, driver_keys: list[str], lap_time: str = "LapTimeSeconds",
                lap_no: str = "LapNumber") -> DataFrame:
    """The single fastest lap per driver as a grouped ``min`` of a struct.

    A plain aggregate: partial per task, so a driver with very many laps
    is no hot spot.
    """
    others = [c for c in laps.columns if c not in driver_keys and c not in (lap_time, lap_no)]
    best = (laps.where(F.col(lap_time).isNotNull())
                .groupBy(*driver_keys)
                .agg(F.min(F.struct(F.col(lap_time), F.col(lap_no), *[F.col(c) for c in others])).alias("_b")))
    return best.select(*driver_keys, *[F.col(f"_b.{c}").alias(c) for c in [lap_no, lap_time] + others]) \
               .select(*laps.columns)


def first_lap(df: DataFrame, driver_keys: list[str], lap_no: str = "LapNumber") -> DataFrame:
    """The first row (lowest lap number) per driver, as a grouped min."""
    others = [c for c in df.columns if c not in driver_keys and c != lap_no]
    first = df.groupBy(*driver_keys).agg(F.min(F.struct(F.col(lap_no), *[F.col(c) for c in others])).alias("_f"))
    return first.select(*driver_keys, *[F.col(f"_f.{c}").alias(c) for c in [lap_no] + others]).select(*df.columns)

