"""Joins against lookup tables, safe at scale.

* ``checked_broadcast`` broadcasts a side only after a count proves it has at
  most ``max_rows`` rows and, with its text and nested values measured, at
  most ``BROADCAST_BYTES``; otherwise the plan keeps a shuffle join (and adaptive
  execution may still convert it from measured sizes).
* ``join_lookup`` is the left / anti / semi join of a large table against a
  lookup. When the lookup is not broadcast, rows whose key is null (which can
  never match) get a salt so that they spread over the shuffle instead of all
  hashing to one reducer; a third of the rows with a null zip code or
  location must not become one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .checks import require_unique

# Default row bound for broadcasting a lookup (about tens of MB for the
# narrow lookups used here: concept ids, partner manifest, area tables).
DEFAULT_BROADCAST_ROWS = 200_000
# Row bound for broadcasting the cohort's (person_id, index dates) into scans
# of the event tables; above it, the event side is shuffled by person_id.
COHORT_BROADCAST_ROWS = 1_000_000
NULL_KEY_SALT_BUCKETS = 256
# Bytes of a broadcast side: rows times the width of fixed columns, and the measured bytes of the others.
BROADCAST_BYTES = 256 << 20
# Where even values of this size in every text or nested column would fit, none is measured.
ROOMY_VALUE = 16 << 10
VARIABLE_WIDTH = 32


def row_width(df: DataFrame) -> int:
    """Estimated bytes of a row; strings and nested values count 32 each."""
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}
    eight = (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)
    width = 16
    for f in df.schema:
        width += 8 if isinstance(f.dataType, eight) else fixed.get(type(f.dataType), VARIABLE_WIDTH)
    return width


def count_rows(dfs: Sequence[DataFrame]) -> list[int]:
    """Row counts of several inputs by one aggregate; one number each reaches the driver."""
    if not dfs:
        return []
    tagged = [df.select(F.lit(i).alias("__input")) for i, df in enumerate(dfs)]
    counts = {r["__input"]: r["count"] for r in reduce(DataFrame.unionAll, tagged).groupBy("__input").count().collect()}
    return [counts.get(i, 0) for i in range(len(dfs))]


def _fixed_width(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))


def stored_bytes(dfs: Sequence[DataFrame]) -> list[int]:
    """Bytes of the text and nested values of several inputs, by one aggregate
    over those columns (nested values as JSON); one number each reaches the driver."""
    parts = []
    for i, df in enumerate(dfs):
        sizes = [
            F.coalesce(F.octet_length(c if isinstance(k, (T.StringType, T.BinaryType)) else F.to_json(F.struct(c))), F.lit(0))
            for c, k in ((F.col(f.name), f.dataType) for f in df.schema if not _fixed_width(f.dataType))
        ]
        total = reduce(lambda a, b: a + b, [s.cast("long") for s in sizes], F.lit(0).cast("long"))
        parts.append(df.select(F.lit(i).alias("__input"), total.alias("__bytes")))
    found = reduce(DataFrame.unionAll, parts).groupBy("__input").agg(F.sum("__bytes").alias("b")).collect() if parts else []
    got = {r["__input"]: r["b"] for r in found}
    return [got.get(i, 0) for i in range(len(dfs))]


def within_bounds(dfs: Sequence[DataFrame], rows: Sequence[int], max_rows: Sequence[int],
                  max_bytes: int = BROADCAST_BYTES) -> list[bool]:
    """Whether inputs with these row counts are within both broadcast bounds.

    Only inputs within the row bound are measured, and of them only those that
    large values could push over the byte bound: so at most ``max_rows`` rows of
    an input are read for it.
    """
    out, ask = [False] * len(dfs), []
    for i, df in enumerate(dfs):
        variable = sum(not _fixed_width(f.dataType) for f in df.schema)
        fixed = row_width(df) - variable * VARIABLE_WIDTH
        if not 0 < max_rows[i] or rows[i] > max_rows[i] or rows[i] * fixed > max_bytes:
            continue
        if rows[i] * (fixed + variable * ROOMY_VALUE) <= max_bytes:
            out[i] = True
        else:
            ask.append((i, max_bytes - rows[i] * fixed))
    for (i, room), size in zip(ask, stored_bytes([dfs[i] for i, _ in ask]), strict=True):
        out[i] = size <= room
    return out


def fits(df: DataFrame, rows: int, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """``within_bounds`` of one input."""
    return within_bounds([df], [rows], [max_rows], max_bytes)[0]


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows, and their bytes are within
    the byte bound. A plain parquet scan is counted without reading columns."""
    return small_enough([df], max_rows)[0]


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the bounds hold, else ``(df, False)``.

    Use it on inputs whose count is cheap (scans, filters, projections,
    broadcast joins of those). Sides that are aggregates of large inputs are
    not checked (that would compute them twice): the join stays a shuffle
    join, which adaptive execution turns into a broadcast join from the
    measured size when that side is its own shuffle stage.
    """
    if max_rows > 0 and has_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False


def small_enough(dfs: Sequence[DataFrame], max_rows: int | Sequence[int] = DEFAULT_BROADCAST_ROWS) -> list[bool]:
    """``has_at_most`` for several inputs (one bound, or one per input) by one
    aggregate; inputs with a bound of 0 are not counted."""
    bounds = [max_rows] * len(dfs) if isinstance(max_rows, int) else list(max_rows)
    asked = [i for i, bound in enumerate(bounds) if bound > 0]
    counts = dict(zip(asked, count_rows([dfs[i] for i in asked])))
    return within_bounds(dfs, [counts.get(i, 0) for i in range(len(dfs))], [b if i in counts else 0 for i, b in enumerate(bounds)])


def _hashable(kind: T.DataType) -> bool:
    """Types that ``xxhash64`` takes (no maps or variants at any depth)."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str | None = None,
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    keep_lookup_key: bool = False,
    broadcast: bool | None = None,
    restrict_to: DataFrame | None = None,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Join ``df`` to ``lookup`` on ``df[key] == lookup[lookup_key]``.

    ``how`` is ``left``, ``left_anti`` or ``left_semi``. For ``left`` the
    result keeps ``df``'s columns in order followed by the lookup's columns
    in their order; the lookup key is dropped (as after an expression join)
    unless ``keep_lookup_key``, when it is null for unmatched rows. Lookup
    columns must not collide with ``df``'s; rename them first.

    ``broadcast`` passes an already-made size decision (see
    ``small_enough``); by default the lookup is checked here.

    ``restrict_to`` is a DataFrame of the probe's possible keys (column
    ``key``) that the caller has proven small (e.g. a cohort within the
    broadcast bound). A lookup too large to broadcast is then semi-joined to
    those broadcast keys first, so only its matching rows are shuffled.

    A repeated lookup key repeats the matching rows of ``df`` ("allow_fanout")
    or raises ``DuplicateKeyError`` ("assert", one aggregate job).
    """
    if how not in ("left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    lookup_key = lookup_key or key
    require_unique(lookup, [lookup_key], unique, "lookup")
    extra = [c for c in lookup.columns if c != lookup_key]
    if how == "left":
        shown = extra + ([lookup_key] if keep_lookup_key else [])
        clash = sorted(set(shown) & set(df.columns))
        if clash:
            raise ValueError(f"lookup columns collide with input columns: {clash}")
        out_lookup = [
            F.col("__lookup_key").alias(c) if c == lookup_key else F.col(c)
            for c in lookup.columns
            if c != lookup_key or keep_lookup_key
        ]
    else:
        extra, out_lookup = [], []
    right = lookup.select(F.col(lookup_key).alias("__lookup_key"), *extra)
    if broadcast is None:
        right, small = checked_broadcast(right, max_broadcast_rows)
    else:
        right, small = (F.broadcast(right), True) if broadcast else (right, False)
    if not small and restrict_to is not None:
        keys = F.broadcast(restrict_to.select(F.col(key).alias("__lookup_key")))
        right = right.join(keys, "__lookup_key", "left_semi")

    if small:
        joined = df.join(right, df[key] == right["__lookup_key"], how)
    else:
        # Salt only null keys: they cannot match, so any salt keeps the result
        # exact, and a hash of the row keeps it deterministic on recompute.
        hashed = [F.col(f.name) for f in df.schema if _hashable(f.dataType)]
        salt = F.when(
            F.col(key).isNull(),
            F.pmod(F.xxhash64(*hashed), F.lit(NULL_KEY_SALT_BUCKETS)) + 1,
        ).otherwise(F.lit(0).cast("bigint"))
        left = df.withColumn("__salt_l", salt)
        right = right.withColumn("__salt_r", F.lit(0).cast("bigint"))
        cond = (left[key] == right["__lookup_key"]) & (left["__salt_l"] == right["__salt_r"])
        joined = left.join(right, cond, how)
    return joined.select(*df.columns, *out_lookup)
