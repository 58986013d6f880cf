"""Statistical column expressions (metrics, rounding, KS p-value)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest positive double; scikit-learn style MAPE divides by max(|y|, eps).
EPS = 2.220446049250313e-16


def r6(c: Column | str) -> Column:
    """Stable 6-digit rounding used on every double that is compared."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6)


def mape(y: str = "y", p: str = "prediction") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)) / F.greatest(F.abs(F.col(y)), F.lit(EPS)))


def rmse(y: str = "y", p: str = "prediction") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2)))


def mae(y: str = "y", p: str = "prediction") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 6) -> Column:
    """Asymptotic two-sample KS p-value Q(lambda).

    lambda = (sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * d,  ne = n*m/(n+m).
    Q = 1 - sqrt(2 pi)/lambda * sum exp(-(2k-1)^2 pi^2 / (8 lambda^2))  for lambda < 1.18,
    Q = 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)                          otherwise
    (both series converge in a few terms on their side of the split).
    """
    ne = n * m / (n + m)
    lam = (F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d
    small = None
    for k in range(1, terms + 1):
        t = F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
        small = t if small is None else small + t
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small
    large = None
    for k in range(1, terms + 1):
        t = F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
        large = t if large is None else large + t
    q = F.when(lam < F.lit(1e-3), F.lit(1.0)).when(lam < F.lit(1.18), small).otherwise(large)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n
