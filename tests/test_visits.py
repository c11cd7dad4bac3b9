"""Visit matching around the index date."""

from __future__ import annotations

from conftest import d, plan_text, rows

from cohortkit.operators.visits import (
    er_visits_near_index,
    first_visits,
    stay_near_index,
    stays_after_index,
    stays_near_index,
)

COHORT = ("person_id string, first_pos_pcr_antigen_date date, first_pos_diagnosis_date date, "
          "first_poslab_or_diagnosis_date date")
VISITS = ("person_id string, visit_occurrence_id bigint, visit_concept_id int, visit_start_date date, "
          "macrovisit_id string, macrovisit_start_date date, macrovisit_end_date date")


def cohort(spark, data):
    return spark.createDataFrame(data, COHORT)


def visits(spark, data):
    return spark.createDataFrame(data, VISITS)


def test_worked_example_both_modes(spark):
    # Index June 10, diagnosis June 12, stay June 22: inside [index - 1, index + 16] (up to June 26).
    c = cohort(spark, [("p", d("2020-06-10"), d("2020-06-12"), d("2020-06-10"))])
    v = visits(spark, [("p", 1, 9201, d("2020-06-22"), "s1", d("2020-06-22"), d("2020-06-30"))])
    for mode in ("either", "both"):
        out = rows(stays_near_index(c, v, mode=mode))
        assert out == [("p", "s1", d("2020-06-22"), d("2020-06-30"))], mode


def test_window_bounds_are_inclusive(spark):
    # D8: one day before the index to sixteen days after, both ends included
    c = cohort(spark, [("p", d("2020-06-10"), None, d("2020-06-10"))])
    v = visits(spark, [
        ("p", 1, 9201, d("2020-06-08"), "too_early", d("2020-06-08"), d("2020-06-30")),
        ("p", 2, 9201, d("2020-06-09"), "first_day", d("2020-06-09"), d("2020-06-30")),
        ("p", 3, 9201, d("2020-06-26"), "last_day", d("2020-06-26"), d("2020-06-30")),
        ("p", 4, 9201, d("2020-06-27"), "too_late", d("2020-06-27"), d("2020-06-30")),
    ])
    out = stay_near_index(c, v)
    assert rows(out, "first_covid_macrovisit_id", "covid_associated_hosp") == [("first_day", 1)]
    late_only = v.where("macrovisit_id in ('last_day', 'too_late')")
    assert rows(stay_near_index(c, late_only), "first_covid_macrovisit_id") == [("last_day",)]


def test_overlap_requirement(spark):
    # D9: stay must end on or after the index; a null end never qualifies
    c = cohort(spark, [("p", d("2020-06-10"), None, d("2020-06-10"))])
    v = visits(spark, [
        ("p", 1, 9201, d("2020-06-09"), "ends_before", d("2020-06-09"), d("2020-06-09")),
        ("p", 2, 9201, d("2020-06-09"), "open_end", d("2020-06-09"), None),
        ("p", 3, 9201, d("2020-06-11"), "ok", d("2020-06-11"), d("2020-06-12")),
    ])
    assert rows(stay_near_index(c, v), "first_covid_macrovisit_id") == [("ok",)]
    loose = stay_near_index(c, v, require_overlap=False)
    assert rows(loose, "first_covid_macrovisit_id") == [("ends_before",)]  # tie on start -> smallest id


def test_persons_without_match_keep_their_row(spark):
    c = cohort(spark, [("p", d("2020-06-10"), None, d("2020-06-10")), ("q", None, None, None)])
    v = visits(spark, [("p", 1, 9201, d("2020-06-11"), "s", d("2020-06-11"), d("2020-06-12"))])
    out = stay_near_index(c, v)
    assert rows(out, "person_id", "covid_associated_hosp") == [("p", 1), ("q", 0)]
    assert out.columns[:4] == c.columns


def test_er_visits_modes(spark):
    c = cohort(spark, [
        ("p", d("2020-06-10"), d("2020-06-01"), d("2020-06-01")),   # diagnosis far from lab
        ("q", d("2020-06-10"), d("2020-06-11"), d("2020-06-10")),
    ])
    er_ids = spark.createDataFrame([(9203,)], "concept_id bigint")
    v = visits(spark, [
        ("p", 1, 9203, d("2020-06-05"), None, None, None),
        ("p", 2, 9203, d("2020-06-12"), None, None, None),
        ("p", 3, 9202, d("2020-06-02"), None, None, None),          # not an ER concept
        ("p", 4, 9203, d("2020-06-03"), "s", d("2020-06-03"), None),  # inside a stay
        ("q", 5, 9203, d("2020-06-20"), None, None, None),
    ])
    either = rows(er_visits_near_index(c, v, er_ids, mode="either"))
    assert either == [("p", d("2020-06-05")), ("q", d("2020-06-20"))]
    both = rows(er_visits_near_index(c, v, er_ids, mode="both"))
    assert both == [("q", d("2020-06-20"))]   # p fails the lab-to-diagnosis test


def test_first_visits_full_outer(spark):
    c = cohort(spark, [
        ("h", d("2020-06-10"), None, d("2020-06-10")),
        ("e", d("2020-06-10"), None, d("2020-06-10")),
        ("n", d("2020-06-10"), None, d("2020-06-10")),
    ])
    er_ids = spark.createDataFrame([(9203,)], "concept_id bigint")
    v = visits(spark, [
        ("h", 1, 9201, d("2020-06-11"), "s", d("2020-06-11"), d("2020-06-15")),
        ("e", 2, 9203, d("2020-06-12"), None, None, None),
    ])
    out = first_visits(c, v, er_ids)
    assert rows(out, "person_id", "macrovisit_id", "first_covid_er_only_start_date") == [
        ("e", None, d("2020-06-12")), ("h", "s", None), ("n", None, None),
    ]
    assert "first_covid_er_only_start_date" not in first_visits(c, v, include_er=False).columns


def test_stays_after_index_anchor(spark):
    fv = spark.createDataFrame([
        ("h", d("2020-06-01"), d("2020-06-10"), d("2020-06-12")),   # anchor: stay start
        ("n", d("2020-06-01"), None, None),                          # anchor: index date
        ("z", None, None, None),                                     # no anchor
    ], "person_id string, first_poslab_or_diagnosis_date date, first_COVID_hospitalization_start_date date, "
       "first_COVID_hospitalization_end_date date")
    v = visits(spark, [
        ("h", 1, 9201, d("2020-06-05"), "before", d("2020-06-05"), d("2020-06-06")),
        ("h", 2, 9201, d("2020-06-10"), "same_day", d("2020-06-10"), d("2020-06-12")),   # strict <
        ("h", 3, 9201, d("2020-07-01"), "after", d("2020-07-01"), d("2020-07-03")),
        ("h", 4, 9201, d("2020-07-02"), "after", d("2020-07-02"), d("2020-07-05")),      # same stay, later row
        ("n", 5, 9201, d("2020-06-05"), "n_after", d("2020-06-05"), None),
        ("z", 6, 9201, d("2020-06-05"), "z_stay", d("2020-06-05"), d("2020-06-06")),
    ])
    out = stays_after_index(fv, v)
    assert rows(out, "person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date") == [
        ("h", "after", d("2020-07-01"), d("2020-07-03")),
        ("n", "n_after", d("2020-06-05"), None),
    ]


def test_stays_after_index_observation(spark):
    from pyspark.sql import Observation

    fv = spark.createDataFrame([("h", d("2020-06-01"), d("2020-06-10"), None), ("n", d("2020-06-01"), None, None)],
                               "person_id string, first_poslab_or_diagnosis_date date, "
                               "first_COVID_hospitalization_start_date date, first_COVID_hospitalization_end_date date")
    v = visits(spark, [
        ("h", 1, 9201, d("2020-07-01"), "a", d("2020-07-01"), None),
        ("n", 2, 9201, d("2020-06-05"), "b", d("2020-06-05"), None),
        ("n", 3, 9201, d("2020-06-06"), "c", d("2020-06-06"), None),
    ])
    obs = Observation("after")
    stays_after_index(fv, v, observation=obs).write.format("noop").mode("overwrite").save()
    assert obs.get == {"after_stay_rows": 1, "after_index_rows": 2, "rows": 3}


def test_first_visits_one_pass_equals_two_pass(spark):
    from conftest import SMALL_DIR

    from cohortkit.operators.concepts import er_concept_ids
    from cohortkit.sources.fixtures import Inputs

    i = Inputs(spark, SMALL_DIR)
    er = er_concept_ids(i.our_concept_sets, i.concept_set_members)
    for mode in ("either", "both"):
        fused = first_visits(i.cohort, i.visits, er, mode=mode)
        two_pass = first_visits(i.cohort, i.visits, er, mode=mode, max_broadcast_rows=0)
        assert rows(fused) == rows(two_pass), mode
    # a fresh (unexecuted) plan: an executed adaptive plan prints both its final and initial plans
    plan = plan_text(first_visits(i.cohort, i.visits, er))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert len(scans) == 1, scans


def test_index_range_pruning_is_exact_and_pushed(spark, tmp_path):
    from conftest import SMALL_DIR

    from cohortkit.operators.concepts import er_concept_ids
    from cohortkit.sources.fixtures import Inputs

    i = Inputs(spark, SMALL_DIR)
    er = er_concept_ids(i.our_concept_sets, i.concept_set_members)
    i.visits.write.parquet(str(tmp_path / "visits"))
    stored = spark.read.parquet(str(tmp_path / "visits"))
    for mode in ("either", "both"):
        assert rows(first_visits(i.cohort, stored, er, mode=mode)) == rows(
            first_visits(i.cohort, stored, er, mode=mode, prune_to_index_range=False)), mode
    assert rows(stay_near_index(i.cohort, stored)) == rows(stay_near_index(i.cohort, stored, prune_to_index_range=False))
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # explain truncates scan details otherwise
    try:
        plan = plan_text(stay_near_index(i.cohort, stored))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "/visits]" in line][0]
    pushed = scan.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(macrovisit_start_date" in pushed and "LessThan(macrovisit_start_date" in pushed


def test_missing_columns_are_reported(spark):
    import pytest

    c = cohort(spark, [("p", d("2020-06-10"), None, d("2020-06-10"))])
    v = visits(spark, [("p", 1, 9201, d("2020-06-11"), "s", d("2020-06-11"), d("2020-06-12"))])
    with pytest.raises(ValueError, match="macrovisit_end_date"):
        stay_near_index(c, v.drop("macrovisit_end_date"))
    with pytest.raises(ValueError, match="first_pos_diagnosis_date"):
        stays_near_index(c.drop("first_pos_diagnosis_date"), v)


def test_stay_identity_differs_between_operators(spark):
    # D19: stay_near_index takes rows with a stay id; stays_near_index takes rows with a stay start date
    c = cohort(spark, [("p", d("2020-06-10"), None, d("2020-06-10"))])
    v = visits(spark, [("p", 1, 9201, d("2020-06-11"), None, d("2020-06-11"), d("2020-06-12"))])  # start, no id
    assert rows(stay_near_index(c, v), "covid_associated_hosp") == [(0,)]
    assert rows(stays_near_index(c, v)) == [("p", None, d("2020-06-11"), d("2020-06-12"))]


def test_salted_cohort_join_equals_broadcast(spark):
    from conftest import SMALL_DIR

    from cohortkit.operators.concepts import er_concept_ids
    from cohortkit.sources.fixtures import Inputs

    i = Inputs(spark, SMALL_DIR)
    er = er_concept_ids(i.our_concept_sets, i.concept_set_members)
    for mode in ("either", "both"):
        assert rows(stays_near_index(i.cohort, i.visits, mode)) == rows(
            stays_near_index(i.cohort, i.visits, mode, cohort_broadcast_rows=0)), mode
        assert rows(er_visits_near_index(i.cohort, i.visits, er, mode)) == rows(
            er_visits_near_index(i.cohort, i.visits, er, mode, cohort_broadcast_rows=0)), mode
        assert rows(first_visits(i.cohort, i.visits, er, mode=mode)) == rows(
            first_visits(i.cohort, i.visits, er, mode=mode, cohort_broadcast_rows=0)), mode
    assert rows(stay_near_index(i.cohort, i.visits)) == rows(stay_near_index(i.cohort, i.visits, cohort_broadcast_rows=0))
