"""Data-quality and drill-down views over the visit table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import HOT_ROWS, find_hot_keys, join_spread

VISIT_DETAIL_COLUMNS = [
    "person_id", "macrovisit_id", "visit_occurrence_id", "visit_concept_id",
    "visit_concept_name", "visit_start_date", "visit_end_date",
    "macrovisit_start_date", "macrovisit_end_date",
]
INPATIENT_CONCEPT_ID = 9201  # Fixed value: the inpatient visit concept.


def codes_per_stay(visits: DataFrame, concept_id: int = INPATIENT_CONCEPT_ID) -> DataFrame:
    """Per stay, the number of its visit rows with ``concept_id``:
    (macrovisit_id, multi_inpatient_codes)."""
    return (
        visits.where(F.col("macrovisit_id").isNotNull() & (F.col("visit_concept_id") == concept_id))
        .groupBy("macrovisit_id")
        .agg(F.count("visit_concept_id").alias("multi_inpatient_codes"))
    )


def distinct_starts_per_stay(visits: DataFrame) -> DataFrame:
    """Per stay, the number of distinct stay start dates its rows carry (a
    consistency check: 1 everywhere when stays are well formed)."""
    return (
        visits.where(F.col("macrovisit_id").isNotNull())
        .groupBy("macrovisit_id")
        .agg(F.countDistinct("macrovisit_start_date").alias("distinct_start_dates"))
    )


def _restrict(df: DataFrame, keys: DataFrame | Sequence[str], column: str, keys_small: bool = False,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Semi join to a key set. A key DataFrame is usually an aggregate, so no
    count is run on it (that would compute it twice). ``keys_small`` states
    a bound the caller has proven (e.g. the keys are persons of a cohort
    within the broadcast bound): the keys are then broadcast. Otherwise the
    join runs on the key, and a sketch of ``df``'s key column names the keys
    with ``hot_rows`` rows and more than their share: their rows alone are
    spread, by visit id, and only those keys are repeated."""
    if not isinstance(keys, DataFrame):
        return df.where(F.col(column).isin(list(keys)))
    side = keys.select(column)
    if keys_small:
        return df.join(F.broadcast(side), column, "left_semi").select(*df.columns)
    hot = find_hot_keys(df, [column], hot_rows)
    return join_spread(df, side, [column], hot, "left_semi", ["visit_occurrence_id"], distinct_hot=False).select(*df.columns)


#: Total orders of the two drill-downs: the visit id closes the key.
STAY_ORDER = ["macrovisit_id", "visit_concept_id", "visit_occurrence_id"]
PERSON_ORDER = ["person_id", "macrovisit_start_date", "macrovisit_id", "visit_occurrence_id"]
Stage = Callable[[DataFrame], DataFrame]


def _ordered(rows: DataFrame, order: list[str], stage: Stage | None) -> DataFrame:
    """``rows`` in ``order``. The range partitioner samples its input before it
    sorts it, which runs the semi-join twice; ``stage`` (write and read back)
    lets it sample and sort the found rows instead."""
    return (stage(rows) if stage else rows).orderBy(*order)


def stay_drilldown(visits: DataFrame, stays: DataFrame | Sequence[str], keys_small: bool = False,
                   sort: bool = True, hot_rows: int = HOT_ROWS, stage: Stage | None = None) -> DataFrame:
    """Every visit row of the chosen stays (a list of ids, or a DataFrame with
    a macrovisit_id column), detail columns, with ``sort`` ordered by stay then
    concept.

    The visit id closes the sort key: the order is total, and the range
    partitioner can split one very large stay over several tasks. ``stage``
    writes the rows before they are sorted (see ``_ordered``)."""
    rows = _restrict(visits.select(*VISIT_DETAIL_COLUMNS), stays, "macrovisit_id", keys_small, hot_rows)
    return _ordered(rows, STAY_ORDER, stage) if sort else rows


def person_stays(visits: DataFrame, persons: DataFrame | Sequence[str], keys_small: bool = False,
                 sort: bool = True, hot_rows: int = HOT_ROWS, stage: Stage | None = None) -> DataFrame:
    """Every visit row inside a stay for the chosen persons (a list of ids,
    or a DataFrame with person_id), with ``sort`` ordered by person then stay
    start (then stay and visit id, so a person with very many rows spans
    several range partitions). ``stage`` writes the rows before they are sorted."""
    rows = _restrict(
        visits.where(F.col("macrovisit_id").isNotNull()).select(*VISIT_DETAIL_COLUMNS),
        persons, "person_id", keys_small, hot_rows,
    )
    return _ordered(rows, PERSON_ORDER, stage) if sort else rows


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` (null is its own group): (column, count)."""
    return df.groupBy(column).count()
