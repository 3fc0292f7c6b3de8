"""Exact distributions against published values, closed forms and enumeration."""
import itertools
import math

import numpy as np
import pytest

from parlance.functions import tails


@pytest.mark.parametrize("n,d,below", [
    (10, 0.274, 0.6284796154565043),  # published example of the matrix recursion
    (1, 0.75, 2 * 0.75 - 1), (2, 0.4, 2 * (2 * 0.4 - 0.5) ** 2), (2, 0.8, 1 - 2 * (1 - 0.8) ** 2),
    (5, 0.1, math.factorial(5) * (2 * 0.1 - 1 / 5) ** 5)])
def test_kolmogorov_values(n, d, below):
    assert tails.kolmogorov_tail(n, d) == pytest.approx(1 - below, abs=1e-12)


def test_kolmogorov_tails_join_and_tend_to_the_limit():
    for n in (20, 200, 5000):
        d = math.sqrt(4 / n)
        assert 2 * tails._one_sided_tail(n, d) == pytest.approx(1 - tails._two_sided_below(n, d), rel=1e-7)
    for x in (0.6, 1.0, 1.5):
        assert tails.kolmogorov_tail(10_000, x / 100) == pytest.approx(tails.limiting_kolmogorov_tail(x), abs=0.004)
    assert tails.kolmogorov_tail(50, 1.0) == 0.0 and tails.kolmogorov_tail(50, 0.01) == 1.0
    assert 0 < tails.kolmogorov_tail(9000, 0.3) < 1e-300 or tails.kolmogorov_tail(9000, 0.3) == 0.0


def test_kolmogorov_equals_simulation():
    rng = np.random.default_rng(0)
    for n, d in ((7, 0.35), (40, 0.15), (40, 0.34)):
        x = np.sort(rng.random((200_000, n)), axis=1)
        i = np.arange(1, n + 1)
        distance = np.maximum(i / n - x, x - (i - 1) / n).max(axis=1)
        assert tails.kolmogorov_tail(n, d) == pytest.approx((distance >= d).mean(), abs=0.004)


def test_u_counts_equal_enumeration():
    for n1, n2 in itertools.product(range(1, 9), range(1, 6)):
        seen = [0] * (n1 * n2 + 1)
        for first in itertools.combinations(range(n1 + n2), n1):
            seen[sum(p - i for i, p in enumerate(first))] += 1
        assert tails.u_counts(n1, n2) == seen
        total = sum(seen)
        for u in range(n1 * n2 + 1):
            side = max(u, n1 * n2 - u)
            assert tails.exact_u_tail(n1, n2, u) == pytest.approx(min(1, 2 * sum(seen[side:]) / total))
    assert sum(tails.u_counts(8, 12_500)) == math.comb(12_508, 8)


def test_jackknife_of_the_median():
    rng = np.random.default_rng(1)
    for n in (2, 3, 4, 9, 10):
        x = np.sort(rng.integers(0, 6, n)).astype(float)
        k = n // 2
        mid = (x[k - 1], x[k], x[min(k + 1, n - 1)]) if n % 2 else (x[k - 1], 0.0, x[k])
        want = sorted(np.median(np.delete(x, i)) for i in range(n))
        got = sorted(v for v, w in tails.middle_without_one(*mid, n) for _ in range(w))
        assert got == want


def test_intervals():
    draws = np.sort(np.random.default_rng(2).normal(size=4001))
    assert tails.bootstrap_interval(draws, 0.0, None, 0.9) == pytest.approx(np.quantile(draws, [0.05, 0.95]))
    assert tails.bootstrap_interval(draws, float(np.median(draws)), 0.0, 0.9) == pytest.approx(np.quantile(draws, [0.05, 0.95]), abs=0.01)
    low, high = tails.bootstrap_interval(draws, 0.5, 0.05, 0.9)
    assert low > np.quantile(draws, 0.05) and high > np.quantile(draws, 0.95)
    assert tails.bootstrap_interval([2.0] * 9, 2.0, 0.0, 0.95) == (2.0, 2.0)
    assert tails.bootstrap_interval([2.0] * 9, 5.0, 0.0, 0.95) == (2.0, 2.0)
    assert all(math.isnan(x) for x in tails.bootstrap_interval([], 0.0, 0.0, 0.95))
