"""Scalar statistical expressions evaluated inside whole-stage codegen."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.kslaw import two_sample_pvalue

# Terms of the Kolmogorov limit series; 100 is far past double precision for
# every lambda where the series is used (small lambda is clamped to p = 1).
KS_SERIES_TERMS = 100
# Below this lambda the alternating series converges too slowly; p is 1 to
# double precision there.
KS_MIN_LAMBDA = 0.2


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den`` that yields ``default`` instead of failing on 0 (ANSI mode)."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def kolmogorov_sf(lam: Column) -> Column:
    """Survival function of the Kolmogorov distribution,
    ``Q(l) = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 l^2)``, clamped to [0, 1]."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    p = F.lit(2.0) * series
    return (
        F.when(lam.isNull(), F.lit(None).cast("double"))
        .when(lam < KS_MIN_LAMBDA, F.lit(1.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    )


def ks_pvalue(d: Column, n1: Column, n2: Column, method: str = "auto") -> Column:
    """Two-sided two-sample KS p-value from the statistic ``d``.

    ``auto`` (what SciPy's default computes): the exact law where neither sample has
    more than 10,000 values, else the finite-n one-sample law at the effective
    size ``round(n1 n2 / (n1 + n2))``.  It is evaluated in Python and meant for a
    report with one row per column.
    ``stephens``: Stephens' closed form of the latter,
    ``Q((sqrt(n) + 0.12 + 0.11/sqrt(n)) d)``, as a column expression.
    ``asymptotic``: the limit law ``Q(d sqrt(n1 n2/(n1+n2)))``.
    """
    if method == "auto":
        return _ks_pvalue_udf(d, n1, n2)
    en = n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double")
    if method == "asymptotic":
        lam = d * F.sqrt(en)
    elif method == "stephens":
        se = F.sqrt(F.greatest(F.bround(en, 0), F.lit(1.0)))
        lam = (se + F.lit(0.12) + F.lit(0.11) / se) * d
    else:
        raise ValueError(f"unknown KS p-value method {method!r}")
    return F.when((n1 > 0) & (n2 > 0), kolmogorov_sf(lam))


@F.pandas_udf(T.DoubleType())
def _ks_pvalue_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    rows = zip(d, n1.fillna(0).astype("int64"), n2.fillna(0).astype("int64"))
    return pd.Series([two_sample_pvalue(x, a, b) if pd.notna(x) and a > 0 and b > 0 else None for x, a, b in rows], dtype="float64")
