"""Seeded, recompute-stable pseudo-random columns from md5 of (seed, key).

Unlike ``rand()`` or ``monotonically_increasing_id()``, these are pure functions of the row's
key, so a re-executed task (lost executor, second action) yields the same values, and the
DuckDB oracle can compute them too: ``('0x'||substr(md5(s),1,8))::BIGINT / 2^32``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]


def hash_text(seed: int | str, *cols) -> Column:
    """md5 hex of 'seed|c1|c2…' (the seed is always the first field)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *_cols(cols)))


def _hex_slice_uniform(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_uniform(seed: int | str, *cols) -> Column:
    """Uniform [0, 1) from the first 32 bits of md5(seed|key)."""
    return _hex_slice_uniform(hash_text(seed, *cols), 1)


def hash_normal(seed: int | str, *cols, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal(mean, std) by Box-Muller on two disjoint 32-bit slices of md5(seed|key)."""
    h = hash_text(seed, *cols)
    u1 = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    u2 = _hex_slice_uniform(h, 9)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(float(mean)) + F.lit(float(std)) * z


def surrogate_id(seed: int | str, *cols) -> Column:
    """Stable 60-bit id from md5(seed|key); use in place of monotonically_increasing_id."""
    return F.conv(F.substring(hash_text(seed, *cols), 1, 15), 16, 10).cast("long")


def hash_bucket(seed: int | str, n: int, *cols) -> Column:
    """Stable bucket in [0, n) from md5(seed|key)."""
    return F.floor(hash_uniform(seed, *cols) * F.lit(n)).cast("int")
