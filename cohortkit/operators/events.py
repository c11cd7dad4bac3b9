"""Keep one record per key: earliest or latest event.

The "first value over a window, then drop duplicates" idiom becomes one
grouped ``min(struct(order, tie-breaks, carried columns))``: a single shuffle
with map-side partial aggregation, so a key holding a third of all rows is
combined inside each map task before anything moves, and the carried
columns always come from the same (earliest) row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import require_columns


def first_event_per(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tie_break: Sequence[str] = (),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Earliest record per ``keys`` by ``order_by``; rows with a null
    ``order_by`` are skipped.

    Ties on ``order_by`` go to the smallest ``tie_break`` values, then the
    smallest remaining carried values (nulls first), so the result does not
    depend on partitioning. Output: ``keys`` and ``carry`` (default: all other
    columns) in the input's column order.
    """
    keys = list(keys)
    carry = [c for c in (carry if carry is not None else df.columns) if c not in keys]
    fields = [order_by, *[c for c in tie_break if c != order_by]]
    fields += [c for c in carry if c not in fields]
    best = F.min(F.struct(*[F.col(c) for c in fields])).alias("__first")
    picked = df.where(F.col(order_by).isNotNull()).groupBy(*keys).agg(best)
    out_cols = [c for c in df.columns if c in keys or c in carry]
    return picked.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in out_cols])


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """Whole first row per ``keys`` under ``order_by`` (columns or sort
    expressions, e.g. ``F.col("d").desc()``), by ``row_number() = 1``.

    For orderings ``first_event_per`` cannot express with one ascending
    struct (mixed directions, expressions). Add a unique column last in
    ``order_by`` to make the choice deterministic. Spark plans a partial
    group limit before the shuffle (each map task keeps its first row per
    key), so a hot key is reduced map-side here too.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_event(
    persons: DataFrame,
    events: DataFrame,
    key: str = "person_id",
    date_col: str = "death_date",
    flag_col: str = "death_recorded",
    keep_fanout: bool = False,
    restrict_to: DataFrame | None = None,
    restrict_to_small: bool = False,
) -> DataFrame:
    """Attach the latest event date per person and a 0/1 flag.

    Events are reduced per person before the join (partial aggregation), so
    the join sees one row per person. A person whose events all lack a date
    gets a null date and flag 0, like a person without events.

    ``keep_fanout=True`` repeats each person once per distinct event date
    (null counts as one value), each copy carrying the latest date: the
    row multiplication a window-without-dedupe formulation produces.

    ``restrict_to`` (the cohort the persons come from) with
    ``restrict_to_small`` (its size proven within a broadcast bound) filters
    the events map-side against the broadcast cohort keys; the per-person
    result, at most one row per cohort person, is then broadcast too.
    """
    require_columns(persons, [key], "persons")
    require_columns(events, [key, date_col], "events")
    ev = events.select(key, date_col)
    small = restrict_to is not None and restrict_to_small
    if small:
        ev = ev.join(F.broadcast(restrict_to.select(key)), key, "left_semi")
    if not keep_fanout:
        per_person = ev.groupBy(key).agg(F.max(date_col).alias(date_col))
        out = persons.join(F.broadcast(per_person) if small else per_person, key, "left")
    else:
        per_person = (
            ev.dropDuplicates([key, date_col])
            .groupBy(key)
            .agg(F.max(date_col).alias(date_col), F.count(F.lit(1)).cast("int").alias("__copies"))
        )
        out = (
            persons.join(F.broadcast(per_person) if small else per_person, key, "left")
            .withColumn("__copy", F.explode_outer(F.array_repeat(F.lit(1), F.col("__copies"))))
            .drop("__copy", "__copies")
        )
    return out.withColumn(flag_col, F.when(F.col(date_col).isNotNull(), F.lit(1)).otherwise(F.lit(0)))
