"""First event per group, pivoted to one row per person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import require_unique
from .concepts import chosen_sets, concept_pairs, curated_columns
from .events import first_event_per
from .joins import COHORT_BROADCAST_ROWS, DEFAULT_BROADCAST_ROWS, small_enough


# More groups than this are pivoted in long form.
FUSED_GROUPS = 32


def pivot_first_events(
    events: DataFrame,
    key: str,
    group_col: str,
    values: Sequence[str],
    order_by: str,
    outputs: dict[str, str],
    tie_break: Sequence[str] = (),
    fused_groups: int = FUSED_GROUPS,
) -> DataFrame:
    """One row per ``key`` that has a dated event in one of ``values``.

    For each group value ``g`` and each ``suffix -> column`` of ``outputs``,
    column ``<g>_<suffix>`` holds ``column`` of the earliest event of ``g``
    (ties broken by ``tie_break`` then the other output columns). Groups
    without an event are null.

    Up to ``fused_groups`` groups, the earliest-per-(key, group) step and the
    pivot are one aggregation over ``key`` (one shuffle of partial aggregates),
    with a test per group and row. More groups go in long form: one aggregate
    per (key, group), then one map of the groups that a key has, from which the
    columns are taken, so that the work grows with the rows and not with rows
    times groups. No plan-time job discovers pivot values.
    """
    values = list(values)
    if not values:  # no groups: nobody has an event in one
        return events.select(key).where(F.lit(False))
    fields = [order_by, *[c for c in tie_break if c != order_by]]
    fields += [c for c in outputs.values() if c not in fields]
    row = F.struct(*[F.col(c) for c in fields])
    dated = events.where(F.col(order_by).isNotNull() & F.col(group_col).isin(values))
    if len(values) <= fused_groups:
        aggs = [F.min(F.when(F.col(group_col) == v, row)).alias(f"__g{i}") for i, v in enumerate(values)]
        picked = dated.groupBy(key).agg(*aggs)
        found = [f"__g{i}" for i in range(len(values))]
    else:
        first = dated.groupBy(key, group_col).agg(F.min(row).alias("__row"))
        picked = first.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(group_col, "__row"))).alias("__rows"))
        found = [f"try_element_at(__rows, {_text(v)})" for v in values]
    # as texts, which are parsed at once: building thousands of columns one call at a time takes minutes
    cols = [f"{g}.{_name(column)} AS {_name(f'{v}_{suffix}')}" for v, g in zip(values, found, strict=True) for suffix, column in outputs.items()]
    return picked.selectExpr(_name(key), *cols)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def comorbidity_events(
    concept_sets: DataFrame,
    members: DataFrame,
    conditions: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    chosen_broadcast: bool | None = None,
) -> DataFrame:
    """Dated condition records whose concept belongs to a chosen comorbidity
    set: person_id, comorbidity, comorbidity_start_date,
    condition_occurrence_id, condition_source_value."""
    # Count the pairs before their distinct (an upper bound, no shuffle in
    # the check); broadcast the distinct pairs.
    pairs = concept_pairs(concept_sets, members, max_broadcast_rows=max_broadcast_rows,
                          chosen_broadcast=chosen_broadcast)
    small = small_enough([pairs], max_broadcast_rows)[0]
    concepts = pairs.distinct()
    concepts = F.broadcast(concepts) if small else concepts
    return (
        conditions.where(F.col("condition_start_date").isNotNull())
        .join(concepts, F.col("condition_concept_id") == concepts["concept_id"])
        .select(
            "person_id",
            F.col("column_name").alias("comorbidity"),
            F.col("condition_start_date").alias("comorbidity_start_date"),
            "condition_occurrence_id",
            "condition_source_value",
        )
    )


def earliest_comorbidities(
    persons: DataFrame,
    concept_sets: DataFrame,
    members: DataFrame,
    conditions: DataFrame,
    index_col: str = "first_pos_pcr_antigen_date",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Earliest record per (person, comorbidity) for persons of the cohort,
    with the person's index date: person_id, comorbidity,
    comorbidity_start_date, <index_col>, condition_occurrence_id,
    condition_source_value. Ties go to the smallest occurrence id. A person
    who occurs several times in the cohort counts once, with the earliest of
    the index dates, or raises with ``unique="assert"``.

    A cohort within ``cohort_broadcast_rows`` is broadcast into the scan of
    the records (map-side filter, index date attached) before the
    aggregation; a larger one is joined to the per-(person, comorbidity)
    results.
    """
    require_unique(persons, ["person_id"], unique, "persons")
    cohort = persons.select("person_id", index_col)
    chosen_small, small = small_enough(
        [chosen_sets(concept_sets), cohort], [max_broadcast_rows, cohort_broadcast_rows]
    )
    cohort = cohort.groupBy("person_id").agg(F.min(index_col).alias(index_col))
    events = comorbidity_events(concept_sets, members, conditions, max_broadcast_rows, chosen_broadcast=chosen_small)
    out_cols = ["person_id", "comorbidity", "comorbidity_start_date", index_col,
                "condition_occurrence_id", "condition_source_value"]
    tie = ["condition_occurrence_id", "condition_source_value"]
    if small:
        events = events.join(F.broadcast(cohort), "person_id")
        first = first_event_per(events, ["person_id", "comorbidity"], "comorbidity_start_date", tie_break=tie)
        return first.select(*out_cols)
    first = first_event_per(events, ["person_id", "comorbidity"], "comorbidity_start_date", tie_break=tie)
    return first.join(cohort, "person_id").select(*out_cols)


def comorbidities(
    persons: DataFrame,
    concept_sets: DataFrame,
    members: DataFrame,
    conditions: DataFrame,
    columns: Sequence[str] | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
) -> DataFrame:
    """One row per cohort person with at least one dated comorbidity record:
    ``<comorbidity>_start`` (first date) and ``<comorbidity>_c_occ_id`` (its
    condition_occurrence_id) for every chosen comorbidity.

    Columns follow ``columns`` (default: the curated list's names, sorted),
    so comorbidities nobody has still get their (null) columns. A cohort
    within ``cohort_broadcast_rows`` filters the records map-side; a larger
    one is semi-joined after the records are reduced to one row per person.
    """
    cohort = persons.select("person_id")
    values = curated_columns(concept_sets) if columns is None else list(columns)
    chosen_small, small = small_enough(
        [chosen_sets(concept_sets), cohort], [max_broadcast_rows, cohort_broadcast_rows]
    )
    events = comorbidity_events(concept_sets, members, conditions, max_broadcast_rows, chosen_broadcast=chosen_small)
    if small:
        cohort = F.broadcast(cohort)
        # Filter the records map-side against the broadcast cohort.
        events = events.join(cohort, "person_id", "left_semi")
    pivoted = pivot_first_events(
        events, "person_id", "comorbidity", values, "comorbidity_start_date",
        {"start": "comorbidity_start_date", "c_occ_id": "condition_occurrence_id"},
        tie_break=["condition_occurrence_id", "condition_source_value"],
    )
    if small:
        return pivoted
    # Large cohort: reduce per person first, then one join of per-person rows.
    return pivoted.join(cohort, "person_id", "left_semi")
