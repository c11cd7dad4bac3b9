"""Cohort sampling, person enrichment and cleaning (narrow work, no shuffle
except the lookup joins of ``enrich_person``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import person as P
from ..functions.sampling import in_sample
from ..sources.tables import require_columns
from .checks import require_unique
from .joins import COHORT_BROADCAST_ROWS, DEFAULT_BROADCAST_ROWS, checked_broadcast, join_lookup, small_enough

# The columns taken from the person, location and site tables.
PERSON_COLUMNS = [
    "person_id", "year_of_birth", "month_of_birth", "day_of_birth",
    "ethnicity_concept_name", "race_concept_name", "gender_concept_name",
    "location_id", "data_partner_id",
]
LOCATION_COLUMNS = ["location_id", "city", "state", "zip", "county"]
MANIFEST_COLUMNS = [
    "data_partner_id", "run_date", "cdm_name", "cdm_version", "shift_date_yn", "max_num_shift_days",
]


def sample_cohort(cohort: DataFrame, fraction: float = 1.0, seed: int = 111, key: str = "person_id",
                  method: str = "hash") -> DataFrame:
    """Keep about ``fraction`` of the persons.

    ``hash`` chooses by a hash of (seed, key): the same persons are kept on
    every run and every cluster layout. ``random`` is Spark's row sample
    (``DataFrame.sample``): it depends on how the rows are partitioned.
    ``fraction=1.0`` returns the input unchanged.
    """
    if method not in ("hash", "random"):
        raise ValueError("method must be 'hash' or 'random'")
    if fraction >= 1.0:
        return cohort
    if method == "random":
        return cohort.sample(withReplacement=False, fraction=fraction, seed=seed)
    return cohort.where(in_sample(F.col(key), fraction, seed))


def enrich_person(
    cohort: DataFrame,
    person: DataFrame,
    location: DataFrame,
    manifest: DataFrame,
    key: str = "person_id",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    lookup_small: Sequence[bool] | None = None,
    cohort_small: bool | None = None,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Attach person attributes, then address, then the contributing site.

    Three left joins: persons without a person row, location or site keep
    their row with nulls. Output: the cohort's columns, then the person,
    location and site columns (the lookup keys appear once).

    The person table usually covers the whole population. When it is too
    large to broadcast but the cohort is small, it is first semi-joined to
    the broadcast cohort keys, so only the cohort's person rows are shuffled.

    ``lookup_small`` (person, location, site) and ``cohort_small`` pass size
    decisions made earlier. A repeated cohort person or lookup key multiplies
    rows, or raises with ``unique="assert"``.
    """
    require_unique(cohort, [key], unique, "cohort")
    require_columns(person, PERSON_COLUMNS, "person")
    require_columns(location, LOCATION_COLUMNS, "location")
    require_columns(manifest, MANIFEST_COLUMNS, "manifest")
    person, location, manifest = (
        person.select(*PERSON_COLUMNS), location.select(*LOCATION_COLUMNS), manifest.select(*MANIFEST_COLUMNS)
    )
    small = small_enough([person, location, manifest], max_broadcast_rows) if lookup_small is None else lookup_small
    if not small[0]:
        keys = cohort.select(F.col(key).alias("person_id"))
        if cohort_small is None:
            keys, cohort_small = checked_broadcast(keys, cohort_broadcast_rows)
        if cohort_small:
            person = person.join(F.broadcast(keys), "person_id", "left_semi")
    out = join_lookup(cohort, person, key, "person_id", "left", broadcast=small[0], unique=unique)
    out = join_lookup(out, location, "location_id", "location_id", "left", broadcast=small[1], unique=unique)
    return join_lookup(out, manifest, "data_partner_id", "data_partner_id", "left", broadcast=small[2], unique=unique)


def add_age(df: DataFrame, index_col: str = "first_pos_pcr_antigen_date") -> DataFrame:
    """Add ``date_of_birth`` and ``age_at_first_covid_diag`` (whole years at the
    index date; null when negative or when the birth date is unknown)."""
    dob = P.date_of_birth(F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth"))
    return df.withColumn("date_of_birth", dob).withColumn(
        "age_at_first_covid_diag",
        P.non_negative(P.whole_years_between(F.col(index_col), F.col("date_of_birth"))),
    )


def add_gender(df: DataFrame, source: str = "gender_concept_name", target: str = "gender") -> DataFrame:
    return df.withColumn(target, P.standardize_gender(F.col(source)))


def add_race_ethnicity(
    df: DataFrame,
    ethnicity: str = "ethnicity_concept_name",
    race: str = "race_concept_name",
    target: str = "race_ethnicity",
) -> DataFrame:
    return df.withColumn(target, P.race_ethnicity(ethnicity, race))


def add_zip_code(df: DataFrame, source: str = "zip", target: str = "zip_code") -> DataFrame:
    return df.withColumn(target, P.clean_zip(F.col(source)))


def clean_person(df: DataFrame, index_col: str = "first_pos_pcr_antigen_date") -> DataFrame:
    """Add date_of_birth, age_at_first_covid_diag, gender, race_ethnicity and
    zip_code; all other columns pass through. One narrow projection."""
    return add_zip_code(add_race_ethnicity(add_gender(add_age(df, index_col))))
