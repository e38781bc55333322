"""Tail probabilities for result rows (one per feature or group), in plain Python."""

from __future__ import annotations

import math
from fractions import Fraction
from functools import lru_cache

_TINY = 1e-300


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _gamma_lower_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    n = a
    while abs(term) > abs(total) * 1e-16:
        n += 1.0
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def _gamma_upper_fraction(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_upper(statistic: float, freedom: int) -> float:
    """P(X >= statistic) of a chi-square with ``freedom`` degrees; 1 for zero freedom."""
    if freedom <= 0 or statistic <= 0:
        return 1.0
    a, x = freedom / 2.0, statistic / 2.0
    return 1.0 - _gamma_lower_series(a, x) if x < a + 1.0 else _gamma_upper_fraction(a, x)


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + num / c
            c = c if abs(c) > _TINY else _TINY
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_upper(t: float, freedom: float) -> float:
    """P(T >= t) for t >= 0."""
    return 0.5 * beta_regularised(freedom / 2.0, 0.5, freedom / (freedom + t * t))


@lru_cache(maxsize=65_536)
def t_quantile(p: float, freedom: float) -> float:
    """Student t quantile for p in (0.5, 1) by bisection."""
    if p == 0.5:
        return 0.0
    target, low, high = 1.0 - p, 0.0, 1.0
    while t_upper(high, freedom) > target:
        high *= 2.0
    for _ in range(200):
        mid = 0.5 * (low + high)
        if mid in (low, high):
            break
        if t_upper(mid, freedom) > target:
            low = mid
        else:
            high = mid
    return 0.5 * (low + high)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the probabilities of all tables as likely as, or less likely than, the
    observed one, with the margins fixed."""
    row, col, total = a + b, a + c, a + b + c + d
    low, high = max(0, row + col - total), min(row, col)

    def log_p(k: int) -> float:
        return (
            math.lgamma(row + 1) - math.lgamma(k + 1) - math.lgamma(row - k + 1)
            + math.lgamma(total - row + 1) - math.lgamma(col - k + 1)
            - math.lgamma(total - row - col + k + 1)
            - math.lgamma(total + 1) + math.lgamma(col + 1) + math.lgamma(total - col + 1)
        )

    limit = log_p(a) + 1e-7
    mode = min(max(int((row + 1) * (col + 1) / (total + 2)), low), high)
    kept = 0.0
    for steps in (range(mode, high + 1), range(mode - 1, low - 1, -1)):
        for k in steps:
            lp = log_p(k)
            if lp <= limit:
                kept += math.exp(lp)
                if math.exp(lp) < kept * 1e-18:
                    break
    return min(1.0, kept)


@lru_cache(maxsize=8)
def _partition_table(k: int) -> tuple[int, ...]:
    """Ways to write 0, 1, ... as a sum of parts 1, 1, 2, 3, ..., ``k`` (two kinds of 1).

    Long enough to continue exactly: on each residue of the common multiple of 1..k the
    counts are a polynomial of degree ``k``.
    """
    size = math.lcm(*range(1, k + 1)) * (k + 1)
    ways = [1] * size
    for part in range(1, k + 1):
        for total in range(part, size):
            ways[total] += ways[total - part]
    return tuple(ways)


def _partitions(total: int, k: int) -> int:
    """The same count for any ``total``, by Newton's forward differences."""
    if total < 0:
        return 0
    table, period = _partition_table(k), math.lcm(*range(1, k + 1))
    if total < len(table):
        return table[total]
    step, start = divmod(total, period)
    row, out = [table[start + period * j] for j in range(k + 1)], 0
    for i in range(k + 1):
        out += math.comb(step, i) * row[0]
        row = [b - a for a, b in zip(row, row[1:])]
    return out


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value without ties; the cost depends on the smaller group alone.

    Samples with statistic ``t`` are counted by a coefficient of the Gaussian binomial
    ``prod (1 - q^(n + i)) / (1 - q^i)``, i up to the smaller size; dividing by ``1 - q``
    sums them up.  The numerator has at most 2^k terms.
    """
    k, n = min(n1, n2), max(n1, n2)
    tail = math.floor(min(u, n1 * n2 - u))
    terms = {0: 1}
    for i in range(1, k + 1):
        for exponent, sign in list(terms.items()):
            terms[exponent + n + i] = terms.get(exponent + n + i, 0) - sign
    ways = sum(sign * _partitions(tail - exponent, k) for exponent, sign in terms.items())
    return float(min(Fraction(1), Fraction(2 * ways, math.comb(n + k, k))))


def mann_whitney_p(u: float, n1: int, n2: int, tie_term: float) -> float | None:
    """Exact when one group has at most 8 values and nothing is tied; otherwise the
    normal approximation with tie and continuity correction."""
    if n1 == 0 or n2 == 0:
        return None
    if tie_term == 0 and min(n1, n2) <= 8:
        return mann_whitney_exact(u, n1, n2)
    n = n1 + n2
    variance = n1 * n2 / 12.0 * ((n + 1) - tie_term / (n * (n - 1.0)))
    extreme = max(u, n1 * n2 - u)
    if variance <= 0:
        return 1.0
    z = (extreme - n1 * n2 / 2.0 - 0.5) / math.sqrt(variance)
    return min(1.0, math.erfc(z / math.sqrt(2.0)))
