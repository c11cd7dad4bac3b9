"""Deterministic key-hash sampling.

``DataFrame.sample`` draws per partition, so its result changes with the
partition count and after a recomputed task lands on different input splits.
A hash of (seed, key) keeps the same rows on any cluster layout, and a
lost executor recomputes exactly the same sample.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_RESOLUTION = 1_000_000


def key_bucket(key: Column, seed: int) -> Column:
    """Stable bucket in ``[0, SAMPLE_RESOLUTION)`` from md5(seed:key)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SAMPLE_RESOLUTION


def in_sample(key: Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the distinct keys, the same keys every run."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    return key_bucket(key, seed) < int(round(fraction * SAMPLE_RESOLUTION))
