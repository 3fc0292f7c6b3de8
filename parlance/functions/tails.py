"""Exact distributions of test statistics, and the interval read from a bootstrap.

Plain numpy on one row per test; the samples themselves are reduced by Spark. The
functions are sent to workers by value.
"""
import math
import sys
from statistics import NormalDist

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many rows the Kolmogorov distribution is the exact one.
EXACT_KS_ROWS = 10_000
# The exact U distribution is used without ties, if the smaller sample has at most
# EXACT_U_ROWS rows and the product of the sizes is at most EXACT_U_PAIRS.
EXACT_U_ROWS, EXACT_U_PAIRS = 8, 100_000


def limiting_kolmogorov_tail(x: float) -> float:
    """P(sqrt(n) D > x) as n grows."""
    if x <= 0:
        return 1.0
    if x < 1.18:  # the theta-function form converges fast for small values
        below = math.sqrt(2 * math.pi) / x * sum(
            math.exp(-(k * math.pi) ** 2 / (8 * x * x)) for k in range(1, 40, 2))
        return min(1.0, max(0.0, 1.0 - below))
    return min(1.0, 2 * sum((-1) ** (j - 1) * math.exp(-2 * (j * x) ** 2) for j in range(1, 40)))


def _one_sided_tail(n: int, d: float) -> float:
    """P(D+ >= d) for n rows, a sum of positive terms."""
    j = np.arange(0, math.floor(n * (1 - d)) + 1)
    log_choose = math.lgamma(n + 1) - np.array([math.lgamma(k + 1) + math.lgamma(n - k + 1) for k in j])
    left, right = j / n + d, 1 - d - j / n
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = log_choose + (j - 1) * np.log(left) + np.where(j == n, 0.0, (n - j) * np.log(np.maximum(right, 0.0)))
    return float(d * np.exp(terms).sum())


def _two_sided_below(n: int, d: float) -> float:
    """P(D < d) for n rows, an entry of the n-th power of a band-like matrix."""
    k = math.floor(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    i, j = np.indices((m, m))
    matrix = (i - j + 1 >= 0).astype(float)
    powers = h ** np.arange(1, m + 1)
    matrix[:, 0] -= powers
    matrix[m - 1, :] -= powers[::-1]
    if 2 * h - 1 > 0:
        matrix[m - 1, 0] += (2 * h - 1) ** m
    steps = np.maximum(i - j + 1, 0)
    inverse = np.exp(-np.array([math.lgamma(x + 1) for x in range(m + 1)]))
    matrix *= inverse[steps]
    # The power by squaring; a common power of ten is kept apart.
    result, exponent, base, base_exponent, left = np.eye(m), 0, matrix, 0, n
    while left:
        if left & 1:
            result, exponent = result @ base, exponent + base_exponent
        base, base_exponent = base @ base, 2 * base_exponent
        for which in (0, 1):
            value = (result, base)[which]
            if value[k - 1, k - 1] > 1e140:
                if which == 0:
                    result, exponent = result * 1e-140, exponent + 140
                else:
                    base, base_exponent = base * 1e-140, base_exponent + 140
        left >>= 1
    log_factor = math.lgamma(n + 1) - n * math.log(n) + exponent * math.log(10)
    return float(result[k - 1, k - 1] * math.exp(log_factor))


def kolmogorov_tail(n: int, d: float) -> float:
    """P(D >= d) for the largest distance of n rows to a fully given distribution.

    Exact up to ``EXACT_KS_ROWS`` rows. Where n d^2 exceeds 4, twice the one-sided tail is
    taken, which differs by a relative part below 1e-10.
    """
    if n <= 0 or d != d:
        return math.nan
    if d >= 1:
        return 0.0
    if 2 * n * d <= 1:
        return 1.0
    if n > EXACT_KS_ROWS:
        return limiting_kolmogorov_tail(math.sqrt(n) * d)
    if n * d * d > 4:
        return min(1.0, 2 * _one_sided_tail(n, d))
    return min(1.0, max(0.0, 1 - _two_sided_below(n, d)))


def u_counts(n1: int, n2: int) -> list[int]:
    """In how many of the orders of two samples without ties U takes each value."""
    size = n1 * n2 + 1
    counts = [1] + [0] * (size - 1)
    for i in range(1, n1 + 1):
        far = n2 + i
        for u in range(size - 1, far - 1, -1):  # times 1 - q^(n2 + i)
            counts[u] -= counts[u - far]
        for u in range(i, size):  # over 1 - q^i
            counts[u] += counts[u - i]
    return counts


def exact_u_tail(n1: int, n2: int, u: float) -> float:
    """Two-sided p-value of U without ties: twice the larger side, at most 1."""
    few, many = sorted((int(n1), int(n2)))
    counts = u_counts(few, many)
    larger = math.ceil(max(u, few * many - u))
    return min(1.0, 2 * sum(counts[larger:]) / math.comb(few + many, few))


def uses_exact_u(n1: int, n2: int, tied: bool) -> bool:
    return not tied and 0 < min(n1, n2) <= EXACT_U_ROWS and n1 * n2 <= EXACT_U_PAIRS


def middle_without_one(low: float, mid: float, high: float, n: int) -> list[tuple[float, int]]:
    """(median, rows) of a sample when one of its n rows is left out.

    For odd n, ``mid`` is the median and the others are its neighbours; for even n, ``low``
    and ``high`` are the two middle rows.
    """
    if n < 2:
        return []
    half = n // 2
    if n % 2 == 0:
        return [(high, half), (low, half)]
    return [((mid + high) / 2, half), ((low + high) / 2, 1), ((low + mid) / 2, half)]


def acceleration(samples: list[list[tuple[float, int]]]) -> float:
    """Acceleration of a statistic from its (value, rows) when one row of a sample is left out."""
    cubes = squares = 0.0
    for sample in samples:
        n = sum(w for _, w in sample)
        if not n:
            continue
        mean = sum(v * w for v, w in sample) / n
        influence = [((n - 1) * (mean - v), w) for v, w in sample]
        cubes += sum(w * x ** 3 for x, w in influence) / n ** 3
        squares += sum(w * x ** 2 for x, w in influence) / n ** 2
    return cubes / squares ** 1.5 / 6 if squares > 0 else 0.0


def bootstrap_interval(replicates, estimate: float, accelerated: float | None, confidence: float) -> tuple[float, float]:
    """Bias-corrected and accelerated interval of sorted replicates; percentile if ``accelerated`` is None.

    Replicates equal to the estimate count half as below it. If all lie on one side of it,
    the correction is not finite and the percentile interval is returned.
    """
    replicates = np.asarray(replicates, float)
    if not len(replicates):
        return math.nan, math.nan
    tail, normal = (1 - confidence) / 2, NormalDist()
    levels = [tail, 1 - tail]
    share = float((replicates < estimate).mean() + (replicates <= estimate).mean()) / 2
    if accelerated is not None and 0 < share < 1:
        bias = normal.inv_cdf(share)
        z = [bias + normal.inv_cdf(p) for p in levels]
        levels = [normal.cdf(bias + x / (1 - accelerated * x)) for x in z]
    low, high = np.quantile(replicates, levels)
    return float(low), float(high)
