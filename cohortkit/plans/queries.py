"""Registered queries: every operator of the survey's inventory, with parameter variants.

Each takes ``(spark, base_dir)`` and returns a lazy DataFrame over the whole
tables of that directory (shaped by ``cohortkit.sources.fixtures``).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import area as A
from ..operators import explore as X
from ..operators.concepts import er_concept_ids, resolve_concepts
from ..operators.events import latest_event
from ..operators.person import add_age, add_gender, add_race_ethnicity, add_zip_code, clean_person, enrich_person, sample_cohort
from ..operators.pivot import earliest_comorbidities
from ..operators.visits import (
    INDEX_DATES,
    er_visits_near_index,
    first_visits,
    profile_cohort,
    stay_near_index,
    stays_after_index,
    stays_near_index,
)
from ..session import checkpoint_dir
from ..sources.colocated import colocate
from ..sources.fixtures import Inputs
from ..sources.sinks import materialize, stage_root
from .person_fact import (
    PERSON_SIDES,
    area_by_zip,
    area_facts,
    area_table,
    comorbidity_table,
    person_fact,
    persons_with_area,
    persons_with_mds,
    plan_facts,
    severity_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SAMPLE_FRACTION = 0.5
SAMPLE_SEED = 111
MIN_INPATIENT_CODES = 2


def _enriched(i: Inputs) -> DataFrame:
    return enrich_person(i.cohort, i.person_lds, i.location, i.manifest)


def _er_ids(i: Inputs) -> DataFrame:
    return er_concept_ids(i.our_concept_sets, i.concept_set_members)


def _first_visits(i: Inputs) -> DataFrame:
    return first_visits(i.cohort, i.visits, _er_ids(i), include_er=True, mode="either")


def _area_by_zip(i: Inputs) -> DataFrame:
    return A.zip_area_table(i.zcta_pct, i.zip_zcta)


def q_cohort_sample(spark, d):
    """Hash sample of the cohort (about half the persons, seed 111)."""
    return sample_cohort(Inputs.of(spark, d).cohort, SAMPLE_FRACTION, SAMPLE_SEED)


def q_enrich_person(spark, d):
    return _enriched(Inputs.of(spark, d))


def q_age_at_index(spark, d):
    return add_age(_enriched(Inputs.of(spark, d))).select(
        "person_id", "year_of_birth", "month_of_birth", "day_of_birth",
        "first_pos_pcr_antigen_date", "date_of_birth", "age_at_first_covid_diag",
    )


def q_gender_std(spark, d):
    return add_gender(_enriched(Inputs.of(spark, d))).select("person_id", "gender_concept_name", "gender")


def q_race_rules(spark, d):
    return add_race_ethnicity(_enriched(Inputs.of(spark, d))).select(
        "person_id", "ethnicity_concept_name", "race_concept_name", "race_ethnicity"
    )


def q_clean_zip(spark, d):
    return add_zip_code(_enriched(Inputs.of(spark, d))).select("person_id", "zip", "zip_code")


def q_clean_person(spark, d):
    return clean_person(_enriched(Inputs.of(spark, d)))


def q_resolve_concepts(spark, d):
    i = Inputs.of(spark, d)
    return resolve_concepts(i.our_concept_sets, i.concept_set_members)


def q_first_event(spark, d):
    i = Inputs.of(spark, d)
    return earliest_comorbidities(i.cohort, i.our_concept_sets, i.concept_set_members, i.condition_occurrence)


def q_comorbidity_pivot(spark, d):
    return comorbidity_table(Inputs.of(spark, d))


def q_first_stay_near_index(spark, d):
    i = Inputs.of(spark, d)
    return stay_near_index(i.cohort, i.visits)


def q_er_visits(spark, d):
    i = Inputs.of(spark, d)
    return er_visits_near_index(i.cohort, i.visits, _er_ids(i), mode="either")


def q_er_visits_both(spark, d):
    i = Inputs.of(spark, d)
    return er_visits_near_index(i.cohort, i.visits, _er_ids(i), mode="both")


def q_stay_either(spark, d):
    i = Inputs.of(spark, d)
    return stays_near_index(i.cohort, i.visits, mode="either")


def q_stay_both(spark, d):
    i = Inputs.of(spark, d)
    return stays_near_index(i.cohort, i.visits, mode="both")


def q_first_visits(spark, d):
    return _first_visits(Inputs.of(spark, d))


def q_first_visits_both(spark, d):
    """First stay and ER visit near the index when lab and diagnosis must both be near."""
    i = Inputs.of(spark, d)
    return first_visits(i.cohort, i.visits, _er_ids(i), include_er=True, mode="both")


def q_first_visits_hosp_only(spark, d):
    """First stay near the index only (ER visits switched off)."""
    i = Inputs.of(spark, d)
    return first_visits(i.cohort, i.visits, include_er=False)


def q_stays_after_index(spark, d):
    """Stays after each person's first stay (or index date). Only the stay
    columns of the first visits are read, so the ER part is not built."""
    i = Inputs.of(spark, d)
    profile = profile_cohort(i.cohort, INDEX_DATES)
    return stays_after_index(first_visits(i.cohort, i.visits, include_er=False, profile=profile), i.visits, profile=profile)


def q_first_visits_outer(spark, d):
    """The first visits with ER ids that are taken as too many to broadcast:
    stays and ER visits are found apart and joined by a full outer join."""
    i = Inputs.of(spark, d)
    return first_visits(i.cohort, i.visits, _er_ids(i), max_broadcast_rows=0)


def q_first_visits_at_times(spark, d):
    """The first visits when the visit dates are timestamps within the day."""
    i = Inputs.of(spark, d)
    return first_visits(i.cohort, i.visits_at_times, _er_ids(i))


def q_stays_after_index_union(spark, d):
    """Stays after the first stay and stays after the index date, found apart and united."""
    i = Inputs.of(spark, d)
    profile = profile_cohort(i.cohort, INDEX_DATES)
    first = first_visits(i.cohort, i.visits, include_er=False, profile=profile)
    return stays_after_index(first, i.visits, profile=profile, branches="union")


def q_stays_after_index_counts(spark, d):
    """The row counts observed while the stays after the index are written."""
    i = Inputs.of(spark, d)
    profile = profile_cohort(i.cohort, INDEX_DATES)
    seen = Observation()
    first = first_visits(i.cohort, i.visits, include_er=False, profile=profile)
    stays_after_index(first, i.visits, observation=seen, profile=profile).write.format("noop").mode("overwrite").save()
    names = ("after_stay_rows", "after_index_rows", "rows")
    return spark.range(1).select(*[F.lit(seen.get[n]).cast("long").alias(n) for n in names])


def _shared_folder(spark: SparkSession) -> str:
    """The stage root; a folder of this machine only where none is named and the session is local."""
    base = None
    if not checkpoint_dir(spark) and spark.sparkContext.master.startswith("local["):
        base = tempfile.mkdtemp()  # one machine, no shared folder named
    return stage_root(spark, base)


def _staged(spark: SparkSession, name: str):
    return lambda df: materialize(spark, df, f"{name}_{uuid.uuid4().hex}", _shared_folder(spark))


def q_person_fact_written(spark, d):
    """The person fact written as a stage table under the shared folder and read back."""
    return _staged(spark, "person_fact")(person_fact(Inputs.of(spark, d)))


def q_person_fact_colocated(spark, d):
    """The person fact over visits written once in buckets of person_id."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return person_fact(colocate(Inputs.of(spark, d), buckets, _shared_folder(spark), names=["visits"]))


def q_latest_event(spark, d):
    i = Inputs.of(spark, d)
    return latest_event(i.cohort, i.death)


def q_latest_event_fanout(spark, d):
    i = Inputs.of(spark, d)
    return latest_event(i.cohort, i.death, keep_fanout=True)


def q_person_fact(spark, d):
    return person_fact(Inputs.of(spark, d))


def q_person_fact_sample(spark, d):
    """The person fact for a hash sample of about half the cohort (seed 111)."""
    return person_fact(Inputs.of(spark, d), SAMPLE_FRACTION, SAMPLE_SEED)


def q_zip_area(spark, d):
    return _area_by_zip(Inputs.of(spark, d))


def q_attach_area(spark, d):
    i = Inputs.of(spark, d)
    facts = area_facts(i)
    return persons_with_area(i, person_fact(i, facts=facts), facts)


def q_unmatched_zips(spark, d):
    i = Inputs.of(spark, d)
    facts = area_facts(i)
    return A.unmatched_keys(person_fact(i, facts=facts), area_by_zip(i, facts), broadcast=facts.small["area"])


def q_attach_mds(spark, d):
    i = Inputs.of(spark, d)
    facts = area_facts(i)
    return persons_with_mds(i, persons_with_area(i, person_fact(i, facts=facts), facts), facts)


def q_cast_sdoh(spark, d):
    return area_table(Inputs.of(spark, d))


def q_attach_severity(spark, d):
    i = Inputs.of(spark, d)
    facts = plan_facts(i, i.cohort, (*PERSON_SIDES, "severity"))
    return severity_table(i, person_fact(i, facts=facts), facts)


def q_codes_per_stay(spark, d):
    return X.codes_per_stay(Inputs.of(spark, d).visits)


def q_stay_drilldown(spark, d):
    """Visit rows of every stay that has two or more inpatient codes."""
    i = Inputs.of(spark, d)
    multi = X.codes_per_stay(i.visits).where(F.col("multi_inpatient_codes") >= MIN_INPATIENT_CODES)
    return X.stay_drilldown(i.visits, multi, stage=_staged(spark, "multi_stay_rows"))


def q_person_stays(spark, d):
    """Stay rows, in start order, of every person with a stay near the index date.
    Those persons are at most the cohort, so a cohort within the broadcast
    bound proves the key set small."""
    i = Inputs.of(spark, d)
    facts = plan_facts(i, i.cohort, ())
    hospitalised = stay_near_index(i.cohort, i.visits, profile=facts.profile).where(F.col("covid_associated_hosp") == 1)
    return X.person_stays(i.visits, hospitalised, keys_small=facts.cohort_small, stage=_staged(spark, "person_stay_rows"))


def q_zip_counts(spark, d):
    return X.value_counts(person_fact(Inputs.of(spark, d)), "zip_code")


def q_zip_counts_raw(spark, d):
    return X.value_counts(_enriched(Inputs.of(spark, d)), "zip")


def q_distinct_starts(spark, d):
    return X.distinct_starts_per_stay(Inputs.of(spark, d).visits)


QUERIES: dict[str, Query] = {
    "cohort_sample": q_cohort_sample,
    "enrich_person": q_enrich_person,
    "age_at_index": q_age_at_index,
    "gender_std": q_gender_std,
    "race_rules": q_race_rules,
    "clean_zip": q_clean_zip,
    "clean_person": q_clean_person,
    "resolve_concepts": q_resolve_concepts,
    "first_event": q_first_event,
    "comorbidity_pivot": q_comorbidity_pivot,
    "first_stay_near_index": q_first_stay_near_index,
    "er_visits": q_er_visits,
    "er_visits_both": q_er_visits_both,
    "stay_either": q_stay_either,
    "stay_both": q_stay_both,
    "first_visits": q_first_visits,
    "first_visits_both": q_first_visits_both,
    "first_visits_hosp_only": q_first_visits_hosp_only,
    "stays_after_index": q_stays_after_index,
    "stays_after_index_union": q_stays_after_index_union,
    "stays_after_index_counts": q_stays_after_index_counts,
    "first_visits_outer": q_first_visits_outer,
    "first_visits_at_times": q_first_visits_at_times,
    "person_fact_written": q_person_fact_written,
    "person_fact_colocated": q_person_fact_colocated,
    "latest_event": q_latest_event,
    "latest_event_fanout": q_latest_event_fanout,
    "person_fact": q_person_fact,
    "person_fact_sample": q_person_fact_sample,
    "zip_area": q_zip_area,
    "attach_area": q_attach_area,
    "unmatched_zips": q_unmatched_zips,
    "attach_mds": q_attach_mds,
    "cast_sdoh": q_cast_sdoh,
    "attach_severity": q_attach_severity,
    "codes_per_stay": q_codes_per_stay,
    "stay_drilldown": q_stay_drilldown,
    "person_stays": q_person_stays,
    "zip_counts": q_zip_counts,
    "zip_counts_raw": q_zip_counts_raw,
    "distinct_starts": q_distinct_starts,
}
