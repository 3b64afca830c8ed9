"""Quantile of the standardized Pearson type III distribution.

Spark has no inverse of the incomplete gamma function, so this is an Arrow UDF on
frames that already hold one row per reach.
"""

from math import lgamma
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Below this skew the distribution is treated as normal.
NORMAL_SKEW = 1.6e-5
# Above this shape the gamma quantile is expanded around the normal one.
LARGE_SHAPE = 1e6


def _gamma_cdf(shape: np.ndarray, x: np.ndarray, log_norm: np.ndarray) -> np.ndarray:
    """Regularized lower incomplete gamma: power series left of the mean, else Lentz."""
    out = np.zeros_like(x)
    scale = np.exp(shape * np.log(np.maximum(x, 1e-300)) - x - log_norm)

    left = (x > 0) & (x < shape + 1)
    if left.any():
        a, y = shape[left], x[left]
        term = 1.0 / a
        total = term.copy()
        step = a.copy()
        while True:
            step += 1
            term *= y / step
            total += term
            if (term <= total * 1e-17).all():
                break
        out[left] = total * scale[left]

    right = x >= shape + 1
    if right.any():
        a, y = shape[right], x[right]
        b = y + 1 - a
        c = np.full_like(y, 1e300)
        d = 1 / b
        h = d.copy()
        k = 0
        while True:
            k += 1
            weight = -k * (k - a)
            b = b + 2
            d = weight * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + weight / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            change = c * d
            h *= change
            settled = np.abs(change - 1) < 1e-15
            if settled.all() or k > 100_000:
                break
        # What has not settled by then is no value.
        out[right] = np.where(settled, 1 - h * scale[right], np.nan)
    return out


def _gamma_quantile(shape: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Newton steps on the gamma distribution function, kept inside a bracket."""
    log_norm = np.array([lgamma(a) for a in shape])
    low = np.zeros_like(shape)
    high = shape + 1.0
    while True:
        short = _gamma_cdf(shape, high, log_norm) < p
        if not short.any():
            break
        low = np.where(short, high, low)
        high = np.where(short, 2 * high, high)
    z = np.array([NormalDist().inv_cdf(q) for q in p])
    guess = shape * (1 - 1 / (9 * shape) + z / (3 * np.sqrt(shape))) ** 3
    x = np.where((guess > low) & (guess < high), guess, (low + high) / 2)
    for _ in range(200):
        gap = _gamma_cdf(shape, x, log_norm) - p
        low = np.where(gap < 0, x, low)
        high = np.where(gap >= 0, x, high)
        with np.errstate(all="ignore"):
            slope = np.exp((shape - 1) * np.log(x) - x - log_norm)
            proposal = x - gap / slope
        inside = np.isfinite(proposal) & (proposal > low) & (proposal < high)
        proposal = np.where(inside, proposal, (low + high) / 2)
        done = np.abs(proposal - x) <= 1e-14 * np.maximum(np.abs(x), 1e-300)
        x = proposal
        if done.all():
            break
    return np.where(done, x, np.nan)


def pearson3_quantile(p: np.ndarray, skew: np.ndarray) -> np.ndarray:
    """Standard deviations from the mean at probability ``p``; ``p = 0`` gives minus infinity."""
    p, skew = np.asarray(p, float), np.asarray(skew, float)
    out = np.full(p.shape, np.nan)
    valid = np.isfinite(skew) & (p >= 0) & (p <= 1)
    out[valid & (p == 0)] = -np.inf
    out[valid & (p == 1)] = np.inf
    inner = valid & (p > 0) & (p < 1)
    z = np.array([NormalDist().inv_cdf(q) if ok else np.nan for q, ok in zip(p, inner)])
    shape = np.full(p.shape, np.inf)
    np.divide(4.0, skew**2, out=shape, where=inner & (np.abs(skew) >= NORMAL_SKEW))

    near = inner & (shape > LARGE_SHAPE)
    k = np.where(np.abs(skew) < NORMAL_SKEW, 0.0, skew) / 6
    out[near] = (z + (z**2 - 1) * k + (z**3 - 6 * z) * k**2 / 3)[near]

    exact = inner & (shape <= LARGE_SHAPE)
    if exact.any():
        g = skew[exact]
        # A negative skew mirrors the distribution.
        tail = np.where(g > 0, p[exact], 1 - p[exact])
        a = shape[exact]
        out[exact] = np.sign(g) * (_gamma_quantile(a, tail) - a) / np.sqrt(a)
    return out


@F.pandas_udf(DoubleType())
def frequency_factor(p: pd.Series, skew: pd.Series) -> pd.Series:
    return pd.Series(pearson3_quantile(p.to_numpy(float), skew.to_numpy(float)))
