"""cohortkit: cohort analytics around an index date, as Spark DataFrame operators."""

from .operators.area import attach_area, attach_column, cast_columns, unmatched_keys, zip_area_table
from .operators.attach import attach_renamed, attach_severity
from .operators.checks import assert_unique, observe_rows
from .operators.concepts import er_concept_ids, resolve_concepts
from .operators.events import first_event_per, keep_first, latest_event
from .operators.explore import codes_per_stay, distinct_starts_per_stay, person_stays, stay_drilldown, value_counts
from .operators.joins import checked_broadcast, join_lookup
from .operators.person import (
    add_age,
    add_gender,
    add_race_ethnicity,
    add_zip_code,
    clean_person,
    enrich_person,
    sample_cohort,
)
from .operators.pivot import comorbidities, earliest_comorbidities, pivot_first_events
from .operators.visits import (
    er_visits_near_index,
    first_visits,
    stay_near_index,
    stays_after_index,
    stays_near_index,
)
from .plans.person_fact import area_table, comorbidity_table, person_fact, person_fact_stages
from .session import build_session, cluster_conf, tune

__all__ = [
    "add_age", "add_gender", "add_race_ethnicity", "add_zip_code", "area_table", "assert_unique",
    "attach_area", "attach_column", "attach_renamed", "attach_severity", "build_session", "cast_columns",
    "checked_broadcast", "clean_person", "cluster_conf", "codes_per_stay", "comorbidities", "comorbidity_table",
    "distinct_starts_per_stay", "earliest_comorbidities", "enrich_person", "er_concept_ids",
    "er_visits_near_index", "first_event_per", "first_visits", "join_lookup", "keep_first", "latest_event",
    "observe_rows", "person_fact", "person_fact_stages", "person_stays", "pivot_first_events",
    "resolve_concepts", "sample_cohort", "stay_drilldown", "stay_near_index", "stays_after_index",
    "stays_near_index", "tune", "unmatched_keys", "value_counts", "zip_area_table",
]
