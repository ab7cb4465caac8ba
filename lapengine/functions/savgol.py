"""Savitzky-Golay smoothing as window expressions.

The smoother with ``mode='interp'`` is a projection of each window of ``w``
samples onto polynomials of degree ``poly``: interior samples take the centre
row of the projection matrix ``H = A pinv(A)`` (``A`` the Vandermonde matrix of
the window), the first and last ``w // 2`` samples take the other rows of
``H`` applied to the first / last ``w`` samples.  One formula covers both:
row ``i`` of a series of length ``n`` starts its window at
``s = clip(i - w // 2, 0, n - w)`` and uses row ``o = i - s`` of ``H``.

``H`` is computed once on the driver (a ``w x w`` matrix, ``w`` <= 11) and
inlined as literals, so the whole filter stays a JVM expression.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def projection_matrix(window: int, poly: int) -> tuple[tuple[float, ...], ...]:
    if window % 2 != 1 or window <= poly:
        raise ValueError(f"window must be odd and larger than poly: {window}, {poly}")
    pos = np.arange(window, dtype=float)
    a = np.vander(pos, poly + 1, increasing=True)
    h = a @ np.linalg.pinv(a)
    return tuple(tuple(float(v) for v in row) for row in h)


def effective_windows(window: int, poly: int, short_window: int | None = None) -> list[tuple[int, int]]:
    """``[(min_n, w), ...]`` lap-length thresholds, longest first.

    Laps with ``n >= window`` use ``window``; shorter laps use the short
    window (``max(5, poly + 2)`` made odd); laps shorter than that get null.
    """
    if short_window is None:
        short_window = max(5, poly + 2)
    if short_window % 2 == 0:
        short_window += 1
    out = [(window, window)]
    if short_window < window:
        out.append((short_window, short_window))
    return out


def savgol_column(shift: Callable[[int], Column], k: Column, n: Column,
                  window: int = 11, poly: int = 2) -> Column:
    """Smoothed value of the series at row ``k`` of a lap of ``n`` rows.

    ``shift(d)`` must return the series value ``d`` rows after the current row
    (``lead``/``lag`` over the lap window).  Laps shorter than the smallest
    usable window give null.

    Written as ``sum_d c_d * x[k + d]`` over ``d = -(w-1) .. w-1`` where
    ``c_d`` is read from a literal array indexed by the row's window offset
    ``o``: compact generated code, and - since the extra coefficients are
    exact zeros multiplying null-guarded values - the same sum, term for term,
    as ``sum_j H[o][j] * x[s + j]``.
    """
    wins = effective_windows(window, poly)
    reach = max(w for _, w in wins) - 1
    expr = None
    for d in range(-reach, reach + 1):
        coef = None
        for min_n, w in reversed(wins):
            h = projection_matrix(w, poly)
            half = w // 2
            o = (F.when(k < half, k).when(k > n - 1 - half, k - (n - w)).otherwise(F.lit(half)))
            # coefficient of x[k + d] for each offset o: H[o][o + d] (0 outside the window)
            arr = F.array(*[F.lit(h[oo][oo + d] if 0 <= oo + d < w else 0.0) for oo in range(w)])
            c = F.element_at(arr, (o + 1).cast("int"))
            coef = F.when(n >= min_n, c) if coef is None else F.when(n >= min_n, c).otherwise(coef)
        val = shift(d) if d == 0 else F.coalesce(shift(d), F.lit(0.0))
        term = coef * val
        expr = term if expr is None else expr + term
    return expr


# --- SQL text of the same arithmetic (used by the DuckDB oracles) ---------

def sql_literal(v: float) -> str:
    return format(float(v), ".17e")


def savgol_sql(shift_sql: Callable[[int], str], k: str, n: str, window: int = 11, poly: int = 2) -> str:
    parts = []
    for min_n, w in effective_windows(window, poly):
        h = projection_matrix(w, poly)
        half = w // 2
        o = f"(CASE WHEN {k} < {half} THEN {k} WHEN {k} > {n} - 1 - {half} THEN {k} - ({n} - {w}) ELSE {half} END)"
        rows = []
        for row in range(w):
            terms = " + ".join(f"{sql_literal(h[row][j])} * {shift_sql(j - row)}" for j in range(w))
            rows.append(f"WHEN {o} = {row} THEN {terms}")
        parts.append(f"WHEN {n} >= {min_n} THEN (CASE {' '.join(rows)} END)")
    return f"(CASE {' '.join(parts)} END)"
