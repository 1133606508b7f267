"""Column expressions shared by recipes, preprocessing and scoring. All stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 1e-8  # smallest divisor used by every scaling


def interaction(a: Column, b: Column) -> Column:
    return a * b


def polynomial(x: Column, degree: float = 2) -> Column:
    """``x`` to the power ``degree``; small whole powers are products, far cheaper than ``pow``."""
    if degree in (1, 2, 3, 4):
        return reduce(mul, [x] * int(degree))
    return F.pow(x, F.lit(float(degree)))


def log_magnitude(x: Column, epsilon: float = 1e-8) -> Column:
    return F.ln(F.abs(x) + F.lit(float(epsilon)))


def standardize(x: Column, mean: float | None, std: float | None) -> Column:
    return (x - F.lit(mean)) / F.lit(max(std or 0.0, FLOOR))


def rescale(x: Column, start: float | None, stop: float | None) -> Column:
    """``(x - start) / (stop - start)``: min-max and robust scaling."""
    width = (stop - start) if start is not None and stop is not None else 0.0
    return (x - F.lit(start)) / F.lit(max(width, FLOOR))


def winsorize(x: Column, mean: float | None, std: float | None, threshold: float) -> Column:
    """Pull values beyond ``threshold`` standard deviations back to that distance."""
    scale = max(std or 0.0, FLOOR)
    far = F.abs(x - F.lit(mean)) / F.lit(scale) > F.lit(float(threshold))
    edge = F.lit(mean) + F.signum(x - F.lit(mean)) * F.lit(float(threshold)) * F.lit(scale)
    return F.when(far, edge).otherwise(x)


def drop_outlier(x: Column, mean: float | None, std: float | None, threshold: float) -> Column:
    """Values beyond ``threshold`` standard deviations become missing."""
    scale = max(std or 0.0, FLOOR)
    return F.when(F.abs(x - F.lit(mean)) / F.lit(scale) <= F.lit(float(threshold)), x)


def bin_edges(low: float, high: float, bins: int) -> list[float]:
    """Interior edges of ``bins`` equal-width bins; a constant column widens the range."""
    if low == high:
        margin = 0.001 * abs(low) if low != 0 else 0.001
        low, high = low - margin, high + margin
    step = (high - low) / bins
    return [low + i * step for i in range(1, bins)]


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """Zero-based bin of right-closed intervals: how many interior edges lie below ``x``."""
    if not edges:
        return F.when(x.isNotNull(), F.lit(0))
    if len(edges) <= 32:
        count = sum((F.when(x > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    else:
        table = F.array(*[F.lit(float(e)) for e in edges])
        count = F.size(F.filter(table, lambda e: e < x))
    return F.when(x.isNotNull(), count)


def linear_score(columns: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for c, w in zip(columns, weights, strict=True):
        total = total + c * F.lit(float(w))
    return total


def kolmogorov_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value ``2*sum((-1)^(k-1)*exp(-2*k^2*L^2))``, L = d*sqrt(nm/(n+m)).

    For small L the alternating series has not converged after ``terms`` terms, and the
    probability is 1 to double precision there.
    """
    lam = d * F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.15, F.lit(1.0)).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))
