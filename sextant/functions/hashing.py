"""Repeatable row randomness from key hashes.

Row randomness is a function of (key, seed) only, never of partitioning or
retry order (``rand()`` and ``monotonically_increasing_id()`` change when a
task is re-run on another executor). The hash is the first 32 bits of MD5,
which Spark and DuckDB compute identically, so every random draw has an exact
SQL twin:

    Spark : cast(conv(substr(md5(k || ':' || seed), 1, 8), 16, 10) as bigint)
    DuckDB: ('0x' || substr(md5(k || ':' || seed), 1, 8))::UBIGINT::BIGINT
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2 ** 32)


def _tag(*keys, seed) -> Column:
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    sep = [F.lit(":")]
    out = []
    for i, p in enumerate(parts):
        if i:
            out += sep
        out.append(p)
    if seed is None:
        return F.concat(*out)
    return F.concat(*out, F.lit(f":{seed}"))


def hash32(*keys, seed) -> Column:
    """Unsigned 32-bit hash of the key columns and a seed, as bigint."""
    return F.conv(F.substring(F.md5(_tag(*keys, seed=seed)), 1, 8), 16, 10).cast("bigint")


def uniform(*keys, seed) -> Column:
    """Hash-uniform in [0, 1)."""
    return hash32(*keys, seed=seed) / F.lit(TWO_32)


def uniform_open(*keys, seed) -> Column:
    """Hash-uniform in (0, 1), safe for logarithms."""
    return (hash32(*keys, seed=seed) + F.lit(0.5)) / F.lit(TWO_32)


def normal(*keys, seed) -> Column:
    """Standard normal by Box-Muller from two independent hash-uniforms."""
    u1 = uniform_open(*keys, seed=f"{seed}:a")
    u2 = uniform_open(*keys, seed=f"{seed}:b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def normals(keys: list[str], seeds: list[str]) -> np.ndarray:
    """``normal`` of each key (as text) for each seed, inside a task: one row a key."""
    tags = [f":{seed}:{x}".encode() for seed in seeds for x in "ab"]
    digests = bytearray()
    for key in keys:
        start = hashlib.md5(key.encode())
        for tag in tags:
            whole = start.copy()
            whole.update(tag)
            digests += whole.digest()[:4]
    u = (np.frombuffer(bytes(digests), ">u4").reshape(len(keys), len(seeds), 2) + 0.5) / TWO_32
    return np.sqrt(-2.0 * np.log(u[..., 0])) * np.cos(2.0 * math.pi * u[..., 1])


def beta_quantile_table(alpha: float, n_points: int = 1001) -> list[float]:
    """Inverse CDF of the symmetric Beta(alpha, alpha) on an even grid of
    probabilities, computed by integrating the density in numpy. The table is
    a fitted constant (n_points doubles), so it may ride in the plan."""
    # density on a fine grid, with the endpoint singularities handled by a
    # change of variable x = sin^2(theta), which makes the integrand smooth
    theta = np.linspace(0.0, math.pi / 2, 200_001)
    x = np.sin(theta) ** 2
    # dx = 2 sin cos dtheta; Beta density ~ x^(a-1) (1-x)^(a-1)
    s, c = np.sin(theta), np.cos(theta)
    with np.errstate(divide="ignore", invalid="ignore"):
        dens = np.power(s, 2 * alpha - 1) * np.power(c, 2 * alpha - 1) * 2.0
    dens[~np.isfinite(dens)] = 0.0
    cdf = np.concatenate([[0.0], np.cumsum((dens[1:] + dens[:-1]) / 2 * np.diff(theta))])
    cdf /= cdf[-1]
    probs = np.linspace(0.0, 1.0, n_points)
    return [float(v) for v in np.interp(probs, cdf, x)]


def beta_draw(u: Column, table: list[float]) -> Column:
    """Map a uniform column through a quantile table with linear interpolation."""
    n = len(table) - 1
    arr = F.array(*[F.lit(float(v)) for v in table])
    pos = F.least(F.greatest(u, F.lit(0.0)), F.lit(1.0)) * F.lit(float(n))
    lo = F.least(F.floor(pos).cast("int"), F.lit(n - 1))
    frac = pos - lo
    a = F.element_at(arr, lo + 1)
    b = F.element_at(arr, lo + 2)
    return a + (b - a) * frac
