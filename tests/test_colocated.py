"""Event tables in buckets of person_id: same rows, and no shuffle of the events."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL_DIR, plan_text, rows

from cohortkit.operators.pivot import comorbidities
from cohortkit.operators.visits import stay_near_index
from cohortkit.plans.person_fact import comorbidity_table, person_fact
from cohortkit.sources.colocated import buckets_for, colocate, joins_inside_buckets, write_colocated
from cohortkit.sources.fixtures import Inputs


@pytest.fixture()
def inputs(spark, tmp_path):
    plain = Inputs(spark, SMALL_DIR)
    return plain, colocate(plain, 8, str(tmp_path))


def shuffled_scans(plan: str, path_part: str) -> int:
    """Exchanges on the way up from scans of tables whose location holds ``path_part``, up to the next join or aggregate."""
    lines, found = plan.splitlines(), 0
    for n, line in enumerate(lines):
        if path_part not in line or "FileScan" not in line:
            continue
        depth = re.search(r"[A-Za-z*]", line).start()
        for above in reversed(lines[:n]):
            at = re.search(r"[A-Za-z*]", above)
            if at is None or at.start() >= depth:
                continue
            depth = at.start()
            if "Exchange" in above:
                found += 1
            if "Join" in above or "Aggregate" in above:
                break
    return found


def test_buckets_for_is_a_power_of_two_of_the_size():
    assert [buckets_for(n << 30) for n in (0, 1, 3, 100)] == [8, 8, 16, 512]


def test_plans_on_bucketed_events_do_not_shuffle_them(spark, inputs):
    plain, by_person = inputs
    assert by_person.bucketed == {"visits": True, "condition_occurrence": True}
    for make in (person_fact, comorbidity_table):
        df = make(by_person)
        assert rows(df) == rows(make(plain))
        assert "_by_person_" in plan_text(df) and shuffled_scans(plan_text(df), "_by_person_") == 0


def test_aggregate_of_a_broadcast_cohort_needs_no_exchange(spark, inputs):
    plain, by_person = inputs
    per_person = stay_near_index(plain.cohort.select("person_id", "first_pos_pcr_antigen_date"), by_person.visits)
    per_person.collect()
    assert not re.search(r"(?<!Broadcast)Exchange hashpartitioning", plan_text(per_person))


def test_large_cohort_stays_inside_the_buckets(spark, inputs):
    plain, by_person = inputs
    cohort = plain.cohort.select("person_id", "first_pos_pcr_antigen_date")
    expected = rows(stay_near_index(cohort, plain.visits))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joins_inside_buckets(spark):
            got = stay_near_index(cohort, by_person.visits, cohort_broadcast_rows=0)
            assert rows(got) == expected
            assert shuffled_scans(plan_text(got), "_by_person_") == 0
            args = (plain.our_concept_sets, plain.concept_set_members)
            pivot = comorbidities(plain.cohort, *args, by_person.condition_occurrence, cohort_broadcast_rows=0)
            assert rows(pivot) == rows(comorbidities(plain.cohort, *args, plain.condition_occurrence))
            assert shuffled_scans(plan_text(pivot), "_by_person_") == 0
        outside = stay_near_index(cohort, by_person.visits, cohort_broadcast_rows=0)
        assert rows(outside) == expected and shuffled_scans(plan_text(outside), "_by_person_") > 0  # the same rows, on both keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_person_or_null_key_is_written_without_buckets(spark, tmp_path):
    even = spark.range(2000).selectExpr("string(id) AS person_id", "id AS v")
    hot = even.unionAll(spark.range(1500).selectExpr("'hot'", "id"))
    nulls = even.unionAll(spark.range(1500).selectExpr("string(null)", "id"))
    for name, df, bucketed in (("even", even, True), ("hot", hot, False), ("nulls", nulls, False)):
        assert write_colocated(df, f"t_{name}_colocated", str(tmp_path / name), 4, hot_rows=1000) is bucketed
        assert rows(spark.table(f"t_{name}_colocated")) == rows(df)
    empty = even.where("false")
    assert write_colocated(empty, "t_empty_colocated", str(tmp_path / "empty"), 4) and spark.table("t_empty_colocated").count() == 0
