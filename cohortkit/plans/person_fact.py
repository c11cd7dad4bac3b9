"""The three end-to-end tables: person fact, comorbidity pivot, area table.

Each function builds one lazy plan from the named inputs; nothing runs until
the caller's action, and intermediate stages are written only when asked
(``cohortkit.sources.sinks.write_stage``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..operators.area import attach_area, attach_column, cast_columns, zip_area_table
from ..operators.attach import attach_severity
from ..operators.events import latest_event
from ..operators.joins import COHORT_BROADCAST_ROWS, DEFAULT_BROADCAST_ROWS, within_bounds
from ..operators.person import clean_person, enrich_person, sample_cohort
from ..operators.pivot import comorbidities
from ..operators.visits import LAB, CohortProfile, cohort_width, stay_near_index
from ..sources import AnyInputs


INDEX_COL = LAB  # the person fact matches stays to the first positive test

PERSON_SIDES = ("person", "location", "manifest")
AREA_SIDES = ("crosswalk", "area")


@dataclass(frozen=True)
class PlanFacts:
    """What a plan must know of its inputs, from one aggregate: the cohort's
    row count and index-date range, and which lookups may be broadcast."""

    profile: CohortProfile
    small: dict[str, bool]

    @property
    def cohort_small(self) -> bool:
        return self.profile.small(COHORT_BROADCAST_ROWS)


def plan_facts(inputs: AnyInputs, cohort: DataFrame, sides: Sequence[str] = PERSON_SIDES) -> PlanFacts:
    """``PlanFacts`` of the cohort and the named lookup sides. One row per
    input reaches the driver; parquet lookups are counted without reading
    columns."""
    build = {
        "person": lambda: inputs.person_lds,
        "location": lambda: inputs.location,
        "manifest": lambda: inputs.manifest,
        "crosswalk": lambda: inputs.zip_zcta,
        "area": lambda: zip_area_table(inputs.zcta_pct, inputs.zip_zcta, broadcast=False),
        "summary": lambda: inputs.summary_facts,
        "severity": lambda: inputs.severity,
    }
    tables = {name: build[name]() for name in sides}
    none = [F.lit(None).cast("date").alias("day"), F.lit(None).cast("int").alias("id_bytes")]
    id_bytes = F.octet_length(F.col("person_id").cast("string")).alias("id_bytes")
    rows = [cohort.select(F.lit("cohort").alias("input"), as_date(F.col(INDEX_COL)).alias("day"), id_bytes)]
    rows += [df.select(F.lit(name).alias("input"), *none) for name, df in tables.items()]
    found = {
        r["input"]: r
        for r in reduce(DataFrame.unionAll, rows)
        .groupBy("input")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("day").alias("lo"), F.max("day").alias("hi"), F.sum("id_bytes").alias("id_bytes"))
        .collect()
    }
    count = {name: found[name]["rows"] if name in found else 0 for name in ("cohort", *tables)}
    bounds = (found["cohort"]["lo"], found["cohort"]["hi"]) if "cohort" in found else (None, None)
    width = cohort_width(cohort.select("person_id", INDEX_COL), count["cohort"], found["cohort"]["id_bytes"] if "cohort" in found else 0)
    profile = CohortProfile(count["cohort"], {INDEX_COL: bounds}, width)
    small = within_bounds(list(tables.values()), [count[n] for n in tables], [DEFAULT_BROADCAST_ROWS] * len(tables))
    return PlanFacts(profile, dict(zip(tables, small, strict=True)))


@dataclass
class PersonFactStages:
    sample: DataFrame      # cohort after sampling
    located: DataFrame     # + person, location and site columns
    clean: DataFrame       # + date_of_birth, age, gender, race_ethnicity, zip_code
    first_stay: DataFrame  # + first stay near the index date and its flag
    fact: DataFrame        # + latest death date and its flag


def person_fact_stages(
    inputs: AnyInputs, sample_fraction: float = 1.0, seed: int = 111, cohort: DataFrame | None = None,
    facts: PlanFacts | None = None, unique: str = "allow_fanout",
) -> PersonFactStages:
    """Every step of the person fact; ``cohort`` defaults to the inputs' cohort.
    With ``unique="assert"`` a repeated person, location or site raises."""
    sample = sample_cohort(inputs.cohort if cohort is None else cohort, sample_fraction, seed)
    facts = plan_facts(inputs, sample) if facts is None else facts
    return finish_person_fact(inputs, sample, _located(inputs, sample, facts, unique), facts.profile)


def _located(inputs: AnyInputs, sample: DataFrame, facts: PlanFacts, unique: str = "allow_fanout") -> DataFrame:
    return enrich_person(
        sample, inputs.person_lds, inputs.location, inputs.manifest,
        lookup_small=[facts.small[n] for n in PERSON_SIDES], cohort_small=facts.cohort_small, unique=unique,
    )


def located_persons(inputs: AnyInputs, sample_fraction: float = 1.0, seed: int = 111,
                    unique: str = "allow_fanout") -> tuple[DataFrame, DataFrame, PlanFacts]:
    """(sampled cohort, cohort with person, location and site columns, facts)."""
    sample = sample_cohort(inputs.cohort, sample_fraction, seed)
    facts = plan_facts(inputs, sample, (*PERSON_SIDES, *AREA_SIDES, "summary", "severity"))
    return sample, _located(inputs, sample, facts, unique), facts


def finish_person_fact(inputs: AnyInputs, sample: DataFrame, located: DataFrame,
                       profile: CohortProfile | None = None) -> PersonFactStages:
    """Clean the located persons, then attach the first stay and death."""
    clean = clean_person(located)
    profile = plan_facts(inputs, sample, ()).profile if profile is None else profile
    first_stay = stay_near_index(clean, inputs.visits, index_col=INDEX_COL, index_source=sample, profile=profile)
    fact = latest_event(first_stay, inputs.death, restrict_to=sample,
                        restrict_to_small=profile.small(COHORT_BROADCAST_ROWS))
    return PersonFactStages(sample, located, clean, first_stay, fact)


def person_fact(inputs: AnyInputs, sample_fraction: float = 1.0, seed: int = 111, facts: PlanFacts | None = None,
                unique: str = "allow_fanout") -> DataFrame:
    """One row per cohort person: attributes, cleaned fields, first stay near
    the index date and death."""
    return person_fact_stages(inputs, sample_fraction, seed, facts=facts, unique=unique).fact


def comorbidity_table(inputs: AnyInputs, persons: DataFrame | None = None) -> DataFrame:
    """First date and record id of each comorbidity, one row per person."""
    persons = inputs.cohort if persons is None else persons
    return comorbidities(persons, inputs.our_concept_sets, inputs.concept_set_members, inputs.condition_occurrence)


def area_by_zip(inputs: AnyInputs, facts: PlanFacts) -> DataFrame:
    return zip_area_table(inputs.zcta_pct, inputs.zip_zcta, broadcast=facts.small["crosswalk"])


def area_facts(inputs: AnyInputs, cohort: DataFrame | None = None) -> PlanFacts:
    """Facts for the person fact and everything attached to it by area or person."""
    return plan_facts(inputs, inputs.cohort if cohort is None else cohort, (*PERSON_SIDES, *AREA_SIDES, "summary"))


def persons_with_area(inputs: AnyInputs, fact: DataFrame, facts: PlanFacts) -> DataFrame:
    return attach_area(fact, area_by_zip(inputs, facts), broadcast=facts.small["area"])


def persons_with_mds(inputs: AnyInputs, with_area: DataFrame, facts: PlanFacts, cohort: DataFrame | None = None) -> DataFrame:
    """``cohort`` bounds the persons of ``with_area`` (default: the inputs' cohort)."""
    return attach_column(with_area, inputs.summary_facts, ["MDs"], restrict_to=small_cohort(inputs, facts, cohort),
                         broadcast=facts.small["summary"])


def area_table(inputs: AnyInputs, fact: DataFrame | None = None, facts: PlanFacts | None = None,
               cohort: DataFrame | None = None) -> DataFrame:
    """Area measures (as numbers) and the summary MDs column per person."""
    facts = area_facts(inputs, cohort) if facts is None else facts
    fact = person_fact(inputs, facts=facts) if fact is None else fact
    return cast_columns(persons_with_mds(inputs, persons_with_area(inputs, fact, facts), facts, cohort))


def severity_table(inputs: AnyInputs, fact: DataFrame, facts: PlanFacts, cohort: DataFrame | None = None) -> DataFrame:
    """Severity scores per person of the fact table."""
    return attach_severity(fact, inputs.severity, restrict_to=small_cohort(inputs, facts, cohort),
                           broadcast=facts.small["severity"])


def small_cohort(inputs: AnyInputs, facts: PlanFacts, cohort: DataFrame | None = None) -> DataFrame | None:
    """The cohort's person ids when it is within the broadcast bound (every
    person-level result then is too), else None."""
    return (inputs.cohort if cohort is None else cohort).select("person_id") if facts.cohort_small else None
