"""Write the workbook's output tables in one run, one dataset per node.

The located persons, the person fact and the first visits are written first
and read back, so the tables built on them reuse them instead of recomputing
the enrichment and visit joins; the other tables are independent plans over
the inputs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.area import cast_columns, unmatched_keys
from ..operators.concepts import er_concept_ids
from ..operators.explore import codes_per_stay, distinct_starts_per_stay, person_stays, stay_drilldown, value_counts
from ..operators.person import clean_person
from ..operators.visits import INDEX_DATES, first_visits, profile_cohort, stays_after_index
from ..sources import AnyInputs
from ..sources.fixtures import Inputs
from ..sources.named import TableInputs
from ..sources.sinks import stage_root
from ..sources.stages import start_run
from .person_fact import (
    area_by_zip,
    comorbidity_table,
    finish_person_fact,
    located_persons,
    persons_with_area,
    persons_with_mds,
    severity_table,
)

MIN_INPATIENT_CODES = 2


def build_tables(inputs: AnyInputs, out_dir: str | None = None, sample_fraction: float = 1.0,
                 seed: int = 111, unique: str = "allow_fanout", resume: bool = True) -> dict[str, str]:
    """Write every node's table under ``out_dir`` (default: the stage root
    under ``spark.checkpoint.dir``) and publish them together. Returns table -> path.

    Tables go to a folder of this run: those published before stay readable
    until the new ones are complete. A run that died is taken up at its first
    unfinished table when it has the same inputs and parameters (``resume``);
    see ``sources.stages``.
    """
    spark = inputs.spark
    root = stage_root(spark, out_dir)
    key = f"{inputs.identity} sample={sample_fraction} seed={seed} unique={unique}"
    run = start_run(spark, root, key, resume)

    cohort, located, facts = located_persons(inputs, sample_fraction, seed, unique)
    cohort = run.table("cohort_sample", lambda c=cohort: c)
    located = run.table("person_locations", lambda t=located: t)
    clean = run.table("persons_clean", lambda: clean_person(located))
    stages = finish_person_fact(inputs, cohort, clean.select(*located.columns), facts.profile)
    first_stay = run.table("first_stay", lambda: stages.first_stay)
    fact = run.table("person_fact", lambda: stages.fact)
    profile = profile_cohort(cohort, INDEX_DATES)
    visits = run.table("first_visits", lambda: first_visits(
        cohort, inputs.visits, er_concept_ids(inputs.our_concept_sets, inputs.concept_set_members), profile=profile))
    with_area = run.table("persons_with_area", lambda: persons_with_area(inputs, fact, facts))
    with_mds = run.table("persons_with_mds", lambda: persons_with_mds(inputs, with_area, facts, cohort))

    def multi_stays():
        multi = codes_per_stay(inputs.visits).where(F.col("multi_inpatient_codes") >= MIN_INPATIENT_CODES)
        return stay_drilldown(inputs.visits, multi, stage=lambda rows: run.table("multi_inpatient_rows", lambda: rows))

    hospitalised = first_stay.where(F.col("covid_associated_hosp") == 1)
    outputs = {
        "comorbidities": lambda: comorbidity_table(inputs, cohort),
        "sdoh": lambda: cast_columns(with_mds),
        "severity": lambda: severity_table(inputs, fact, facts, cohort),
        "stays_after_index": lambda: stays_after_index(visits, inputs.visits, profile=profile),
        "zip_area": lambda: area_by_zip(inputs, facts),
        "unmatched_zips": lambda: unmatched_keys(fact, area_by_zip(inputs, facts), broadcast=facts.small["area"]),
        "distinct_starts": lambda: distinct_starts_per_stay(inputs.visits),
        "codes_per_stay": lambda: codes_per_stay(inputs.visits),
        "multi_inpatient_stays": multi_stays,
        "person_stays": lambda: person_stays(inputs.visits, hospitalised, keys_small=facts.cohort_small,
                                             stage=lambda rows: run.table("person_stay_rows", lambda: rows)),
        "zip_counts": lambda: value_counts(fact, "zip_code"),
        "zip_counts_raw": lambda: value_counts(located, "zip"),
    }
    for name, make in outputs.items():
        run.table(name, make)
    return run.publish()


def main(argv: list[str] | None = None) -> None:
    """``python -m cohortkit.plans.build INPUT_DIR --out OUT_DIR``: write all tables."""
    import argparse
    import json

    from ..session import build_session

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("input_dir")
    ap.add_argument("--out", help="output folder (default: <spark.checkpoint.dir>/cohortkit_tables)")
    ap.add_argument("--sample-fraction", type=float, default=1.0)
    ap.add_argument("--seed", type=int, default=111)
    ap.add_argument("--master", default="local[8]")
    ap.add_argument("--datasets", action="store_true",
                    help="INPUT_DIR holds the named datasets (cohort, person_lds, visits, ...) as parquet folders; "
                         "otherwise it holds the driver's tables and the fixture views are derived")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master)
    inputs = TableInputs.from_folder(spark, args.input_dir) if args.datasets else Inputs(spark, args.input_dir)
    paths = build_tables(inputs, args.out, args.sample_fraction, args.seed)
    print(json.dumps(paths, indent=2))
    spark.stop()


if __name__ == "__main__":
    main()
