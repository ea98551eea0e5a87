"""Statistics as column arithmetic (N-B Wilson interval)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: two-sided 95 % normal quantile used for the Wilson interval.
Z95 = 1.959963984540054


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wilson_bounds(k, n, z: float = Z95) -> tuple[Column, Column]:
    """Wilson score interval for k successes in n trials; n = 0 -> (null, null)."""
    k, n = _col(k).cast("double"), _col(n).cast("double")
    p = k / n
    z2 = z * z
    denom = 1.0 + z2 / n
    centre = (p + z2 / (2.0 * n)) / denom
    half = (z / denom) * F.sqrt(p * (1.0 - p) / n + z2 / (4.0 * n * n))
    ok = n > 0
    return F.when(ok, centre - half), F.when(ok, centre + half)
