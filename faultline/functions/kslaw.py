"""Laws of the two-sided Kolmogorov-Smirnov statistic for finite samples.

Small NumPy helpers for the p-values of a drift report, which has one row per
column.  ``two_sample_exact`` counts orderings; ``one_sample_sf`` is the exact
one-sample law for moderate n and its Pelz-Good expansion beyond.
"""

from __future__ import annotations

import math

import numpy as np

EXACT_MAX = 10_000  # the larger sample up to which orderings are counted
MATRIX_MAX = 2_000  # n up to which Durbin's matrix is used


def two_sample_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) when every ordering of the n1 + n2 values is equally likely.

    ``f`` is the share of the orderings of the first s values, i of them from the first
    sample, whose statistic has stayed below d; it is carried along s."""
    if n1 > n2:
        n1, n2 = n2, n1
    i = np.arange(n1 + 1, dtype=np.float64)
    limit = round(d * n1 * n2) - 0.5  # |i n2 - j n1| is whole
    f = np.zeros(n1 + 1)
    f[0] = 1.0
    for s in range(1, n1 + n2 + 1):
        j = s - i
        nxt = f * np.maximum(j, 0) / s
        nxt[1:] += f[:-1] * i[1:] / s
        nxt[(j < 0) | (j > n2) | (np.abs(i * n2 - j * n1) > limit)] = 0.0
        f = nxt
    return float(min(1.0, max(0.0, 1.0 - f[n1])))


def _durbin_cdf(d: float, n: int) -> float:
    """P(D_n < d) by Durbin's matrix power."""
    k = math.ceil(n * d)
    m, h = 2 * k - 1, k - n * d
    row = np.arange(m)
    a = (row[:, None] - row[None, :] + 1 >= 0).astype(np.float64)
    powers = h ** np.arange(1, m + 1)
    a[:, 0] -= powers
    a[-1, :] -= powers[::-1]
    a[-1, 0] += max(2 * h - 1, 0.0) ** m
    fact = np.cumprod(np.concatenate(([1.0], np.arange(1.0, min(m, 170) + 1))))
    gap = row[:, None] - row[None, :] + 1
    a /= np.where(gap > 0, fact[np.clip(gap, 0, len(fact) - 1)], 1.0)
    a[gap > 170] = 0.0
    out, shift, base, base_shift, e = np.eye(m), 0, a, 0, n
    while e:
        if e & 1:
            out, shift = out @ base, shift + base_shift
        base, base_shift, e = base @ base, 2 * base_shift, e >> 1
        top = base[k - 1, k - 1]
        if top > 1e140:
            base, base_shift = base * 1e-140, base_shift + 140
        if out[k - 1, k - 1] > 1e140:
            out, shift = out * 1e-140, shift + 140
    log = math.log(max(out[k - 1, k - 1], 1e-300)) + shift * math.log(10) + math.lgamma(n + 1) - n * math.log(n)
    return min(1.0, math.exp(log))


def _pelz_good_cdf(d: float, n: int) -> float:
    """P(D_n < d) by the expansion in 1/sqrt(n), up to 1/n."""
    z = math.sqrt(n) * d
    k = np.arange(-60, 61, dtype=np.float64)
    half = (k + 0.5) ** 2 * math.pi**2
    e_half = np.exp(-half / (2 * z * z))
    e_full = np.exp(-(k**2) * math.pi**2 / (2 * z * z))
    c = math.sqrt(math.pi / 2)
    k0 = 2 * c / z * e_half.sum() / 2
    k1 = c / (6 * z**4) * ((half - z * z) * e_half).sum()
    k2 = c / (72 * z**7) * (((6 * z**6 + 2 * z**4) + (2 * z**4 - 5 * z * z) * half + (1 - 2 * z * z) * half**2) * e_half).sum()
    k2 -= c / (36 * z**3) * (math.pi**2 * k**2 * e_full).sum()
    return min(1.0, max(0.0, k0 + k1 / math.sqrt(n) + k2 / n))


def one_sample_sf(d: float, n: int) -> float:
    """P(D_n >= d) for one sample of n values."""
    if d <= 0.5 / n:
        return 1.0
    if d >= 1:
        return 0.0
    z2 = n * d * d
    if z2 > 18:  # 2 exp(-36) and less
        return min(1.0, 2 * math.exp(-2 * z2))
    if n <= MATRIX_MAX:
        return max(0.0, 1.0 - _durbin_cdf(d, n))
    return max(0.0, 1.0 - _pelz_good_cdf(d, n))


def two_sample_pvalue(d: float, n1: int, n2: int) -> float:
    """Exact up to ``EXACT_MAX`` values a side, else the one-sample law at the
    effective size round(n1 n2 / (n1 + n2))."""
    if max(n1, n2) <= EXACT_MAX:
        return two_sample_exact(d, n1, n2)
    return one_sample_sf(d, max(1, round(n1 * n2 / (n1 + n2))))
