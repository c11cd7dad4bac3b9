"""Assertions and metrics that replace the workbook's printed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "input") -> DataFrame:
    """Raise when two rows share ``keys``; return ``df`` unchanged otherwise.

    One aggregation job with partial aggregation; only the first duplicate
    key found comes back to the driver.
    """
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{name}: key {dict(zip(keys, dup[0][:len(keys)]))} appears {dup[0]['count']} times")
    return df


UNIQUE_MODES = ("assert", "allow_fanout")


def require_unique(df: DataFrame, keys: Sequence[str], unique: str, name: str) -> None:
    """``assert_unique`` on rows with non-null keys when ``unique`` is "assert";
    nothing when it is "allow_fanout"."""
    if unique not in UNIQUE_MODES:
        raise ValueError(f"unique must be one of {UNIQUE_MODES}")
    if unique == "assert":
        assert_unique(df.select(*keys).dropna(), keys, name)


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric that is filled by whatever action later runs
    on the returned DataFrame (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
