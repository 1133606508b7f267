"""Hash-based randomness: the same key always gets the same draw, on any partitioning.

A retried or recomputed task therefore repeats its draws exactly, which seeded
``rand``/``randn`` do only as long as the partitions stay the same.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 4294967296.0  # 2**32, the number of values of eight hex digits


def token(seed: int | str, *keys: Column) -> Column:
    """Hex digest of ``seed:key[:key...]``; its string order is the shuffled order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def _word(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("double")


def uniform(seed: int | str, *keys: Column) -> Column:
    """Uniform draw in [0, 1)."""
    return _word(token(seed, *keys), 1) / F.lit(_RANGE)


def normal(seed: int | str, *keys: Column) -> Column:
    """Standard normal draw from two words of one digest (Box-Muller)."""
    digest = token(seed, *keys)
    u1 = (_word(digest, 1) + 1.0) / F.lit(_RANGE)
    u2 = _word(digest, 9) / F.lit(_RANGE)
    return F.sqrt(-2.0 * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def driver_normal(seed: int | str, *keys: object) -> float:
    """The draw ``normal`` makes, for a handful of driver-side constants."""
    text = ":".join([str(seed), *[str(k) for k in keys]])
    digest = hashlib.md5(text.encode()).hexdigest()
    u1 = (int(digest[:8], 16) + 1.0) / _RANGE
    u2 = int(digest[8:16], 16) / _RANGE
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(2.0 * math.pi * u2)
