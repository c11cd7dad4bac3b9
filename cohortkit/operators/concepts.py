"""Concept-set resolution: curated set names to current concept ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, checked_broadcast


def most_recent_members(members: DataFrame) -> DataFrame:
    """Members of the latest version of each set (flag stored as text
    'true' or as a boolean; the text test is exact)."""
    return members.where(F.col("is_most_recent_version").cast("string") == "true")


def resolve_concepts(
    concept_sets: DataFrame,
    members: DataFrame,
    domain: str = "condition_occurrence",
    flag: str = "comorbidity",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(concept_id, column_name)`` for curated sets whose ``domain`` text
    contains ``domain`` and whose ``flag`` column is 1, restricted to the most
    recent version of each set. Distinct pairs."""
    return concept_pairs(concept_sets, members, domain, flag, max_broadcast_rows).distinct()


def chosen_sets(concept_sets: DataFrame, domain: str = "condition_occurrence", flag: str = "comorbidity") -> DataFrame:
    """(concept_set_name, column_name) of the curated sets for ``domain`` with ``flag`` = 1."""
    return concept_sets.where(F.col("domain").contains(domain) & (F.col(flag) == 1)).select(
        "concept_set_name", "column_name"
    )


def concept_pairs(
    concept_sets: DataFrame,
    members: DataFrame,
    domain: str = "condition_occurrence",
    flag: str = "comorbidity",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    chosen_broadcast: bool | None = None,
) -> DataFrame:
    """``resolve_concepts`` before the distinct: a streaming join whose
    bounded scan is cheap, and an upper bound of the distinct pairs.
    ``chosen_broadcast`` passes an earlier size decision on ``chosen_sets``."""
    chosen = chosen_sets(concept_sets, domain, flag)
    current = most_recent_members(members).select("concept_id", "concept_set_name")
    if chosen_broadcast is None:
        chosen, _ = checked_broadcast(chosen, max_broadcast_rows)
    elif chosen_broadcast:
        chosen = F.broadcast(chosen)
    return current.join(chosen, "concept_set_name").select("concept_id", "column_name")


def er_concept_ids(concept_sets: DataFrame, members: DataFrame, flag: str = "er_only_visit",
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct ``concept_id`` of the most recent versions of the curated sets
    flagged as emergency-room visits. Stays a DataFrame: callers semi-join it,
    nothing is collected to the driver."""
    er_sets, _ = checked_broadcast(concept_sets.where(F.col(flag) == 1).select("concept_set_name"), max_broadcast_rows)
    return (
        most_recent_members(members)
        .join(er_sets, "concept_set_name", "left_semi")
        .select("concept_id")
        .distinct()
    )


def curated_columns(concept_sets: DataFrame, domain: str = "condition_occurrence", flag: str = "comorbidity") -> list[str]:
    """Sorted output column names of the chosen curated sets.

    A pivot's schema must be known when the plan is built; this reads the
    names of the hand-made curated list, one an output column.
    """
    rows = (
        concept_sets.where(F.col("domain").contains(domain) & (F.col(flag) == 1) & F.col("column_name").isNotNull())
        .select("column_name")
        .distinct()
        .collect()
    )
    return sorted(r[0] for r in rows)
