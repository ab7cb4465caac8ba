"""Scalar column helpers (all Catalyst built-ins, no Python UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for equal results.
KMH_TO_MPS = 1000 / 3600      # speed conversion used before smoothing
KMH_PER_MPS = 3.6             # speed conversion used when rebuilding time
STANDARD_GRAVITY = 9.81       # m/s2 per g
MIN_SPEED_NORM = 1e-6         # planar speed floor before dividing
STANDSTILL_SPEED = 0.1        # m/s substituted for 0 when rebuilding time


def safe_div(a, b) -> Column:
    """``a / b`` with a zero divisor giving null (pandas ``replace(0, NA)``)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return a / F.nullif(b, F.lit(0))


def all_not_null(cols) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in cols], F.lit(True))


def floor_div(c: Column, n: int) -> Column:
    """Exact integer floor division of a bigint column by a positive constant."""
    c = c.cast("long")
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n)) if n > 1 else c


def ceil_div_nonneg(c: Column, n: int) -> Column:
    """``ceil(c / n)`` for ``c >= 0`` without leaving integers."""
    return floor_div(c + F.lit(n - 1), n)


def session_label(year, event, session_type) -> Column:
    """``<year>_<event with spaces as _>_<type>`` (A3)."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return F.concat_ws("_", c(year).cast("string"),
                      F.regexp_replace(c(event), " ", "_"),
                      F.regexp_replace(c(session_type), " ", "_"))


def interval_text_seconds(c) -> Column:
    """Parse ``'<d> days HH:MM:SS[.ffffff]'`` into seconds; bad text -> null."""
    col = F.col(c) if isinstance(c, str) else c
    pat = r"^(-?\d+) days (\d{2}):(\d{2}):(\d{2})(\.\d+)?$"
    ok = col.rlike(pat)
    days = F.regexp_extract(col, pat, 1).cast("long")
    hh = F.regexp_extract(col, pat, 2).cast("long")
    mm = F.regexp_extract(col, pat, 3).cast("long")
    ss = F.regexp_extract(col, pat, 4).cast("long")
    frac = F.regexp_extract(col, pat, 5)
    micros = F.when(frac == "", F.lit(0)).otherwise(
        F.rpad(F.substring(frac, 2, 6), 6, "0").cast("long"))
    total_us = ((days * 86400 + hh * 3600 + mm * 60 + ss) * 1000000 + micros)
    return F.when(ok, total_us.cast("double") / F.lit(1e6))


def interval_text(us) -> Column:
    """Inverse of :func:`interval_text_seconds` for non-negative microseconds."""
    col = F.col(us) if isinstance(us, str) else us
    secs = floor_div(col, 1000000)
    return F.format_string("%d days %02d:%02d:%02d.%06d",
                           floor_div(secs, 86400), floor_div(F.pmod(secs, F.lit(86400)), 3600),
                           floor_div(F.pmod(secs, F.lit(3600)), 60), F.pmod(secs, F.lit(60)),
                           F.pmod(col, F.lit(1000000)))


def _round_at(c: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def round_doubles(df: DataFrame, scale: int = 6) -> DataFrame:
    """Round every double column for cross-engine comparison.

    Magnitude-aware: 6 decimals below 1e3, 4 below 1e6, 2 above, so sums that
    differ only in summation order compare equal.  Rounds ``x * 10^d`` to an
    integer (ties are exact binary values there, so every engine agrees) and
    adds ``0.0`` to turn ``-0.0`` into ``0.0``.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name).cast("double")
            a = F.abs(c)
            cols.append(F.when(a < 1e3, _round_at(c, scale))
                        .when(a < 1e6, _round_at(c, 4))
                        .otherwise(_round_at(c, 2)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def round_sql(expr: str, scale: int = 6) -> str:
    def at(d):
        return f"round(({expr}) * {float(10 ** d)!r}) / {float(10 ** d)!r} + 0.0e0"
    return (f"(CASE WHEN abs({expr}) < 1e3 THEN {at(scale)} "
            f"WHEN abs({expr}) < 1e6 THEN {at(4)} ELSE {at(2)} END)")
