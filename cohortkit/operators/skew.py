"""Hot keys: a bounded sketch names them, and only their rows are spread.

``find_hot_keys`` runs one aggregate over the key columns: a mergeable
frequent-items sketch of fixed size a task, whose at most ``MOST_KEYS`` items
reach the driver. ``join_spread`` joins plainly when no key is hot. Otherwise
hot keys' rows get a piece number from their hash and only the other side's
rows of hot keys are repeated, once a piece: the repetition depends on the
data's skew, never on the cluster's size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of all rows on, and never below HOT_ROWS rows.
HOT_SHARE = 1 / 512
HOT_ROWS = 100_000
# Items the sketch tracks (its error is 3.5 / SKETCH_ITEMS of the rows) and returns; pieces of the hottest key at most.
SKETCH_ITEMS = 16_384
MOST_KEYS = 1024
MOST_PIECES = 512


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys and the pieces each is spread over."""

    hashes: tuple[int, ...] = ()
    pieces: int = 1

    def has(self, keys: Sequence[str]) -> Column:
        return F.xxhash64(*keys).isin(list(self.hashes))


def find_hot_keys(df: DataFrame, keys: Sequence[str], least_rows: int = HOT_ROWS, share: float = HOT_SHARE) -> HotKeys:
    """Keys owning at least ``share`` of the rows with non-null keys, and ``least_rows`` rows."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    found = df.select(F.xxhash64(*keys).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {MOST_KEYS}, {SKETCH_ITEMS})").alias("top")
    ).first()
    least = max(least_rows, share * found["rows"], 1)
    error = 3.5 / SKETCH_ITEMS * found["rows"]
    hot = [(t["item"], t["count"]) for t in found["top"] or [] if t["count"] + error >= least]
    if not hot:
        return HotKeys()
    pieces = math.ceil(max(n for _, n in hot) / max(1, share * found["rows"]))
    return HotKeys(tuple(sorted(k for k, _ in hot)), max(2, min(MOST_PIECES, pieces)))


def join_spread(
    events: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    hot: HotKeys,
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    distinct_hot: bool = True,
    piece: str = "__piece",
) -> DataFrame:
    """Join (``inner`` or ``left_semi``) with the rows of hot keys spread over pieces.

    ``spread_by`` names the columns whose hash picks a row's piece (default:
    all). With ``distinct_hot`` equal rows of hot keys are first reduced to one
    inside the map tasks; use it where repeated rows change nothing. With hot
    keys the result keeps the ``piece`` column (0 for other rows).
    """
    keys = list(keys)
    if not hot.hashes:
        return events.join(side, keys, how)
    is_hot = hot.has(keys)
    cold = events.where(~is_hot).withColumn(piece, F.lit(0))
    warm = events.where(is_hot)
    warm = warm.distinct() if distinct_hot else warm
    by = list(spread_by or events.columns)
    warm = warm.withColumn(piece, F.pmod(F.xxhash64(*by), F.lit(hot.pieces)).cast("int"))
    pieces = F.when(is_hot, F.sequence(F.lit(0), F.lit(hot.pieces - 1))).otherwise(F.array(F.lit(0)))
    return cold.unionByName(warm).join(side.withColumn(piece, F.explode(pieces)), [*keys, piece], how)
