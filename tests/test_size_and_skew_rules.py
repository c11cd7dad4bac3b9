"""Results that must not depend on column types, sizes or skew; how rows spread over salts; uniqueness checks."""

from __future__ import annotations

import pytest
from conftest import SMALL_DIR, plan_text, rows
from pyspark.sql import functions as F

from cohortkit.operators.checks import DuplicateKeyError
from cohortkit.operators.concepts import curated_columns
from cohortkit.operators.events import first_event_per
from cohortkit.operators.explore import PERSON_ORDER, STAY_ORDER, person_stays, stay_drilldown
from cohortkit.operators.joins import checked_broadcast, count_rows, fits, join_lookup, row_width, small_enough, stored_bytes, within_bounds
from cohortkit.operators.person import enrich_person, sample_cohort
from cohortkit.operators.pivot import earliest_comorbidities
from cohortkit.operators.visits import (
    INDEX_DATES,
    LAB,
    _join_cohort,
    er_visits_near_index,
    first_visits,
    profile_cohort,
    stay_near_index,
    stays_after_index,
    stays_near_index,
)
from cohortkit.plans.person_fact import person_fact
from cohortkit.sources.fixtures import Inputs
from cohortkit.sources.sinks import materialize

VISITS = "person_id string, visit_occurrence_id long, visit_concept_id int, visit_start_date {0}, macrovisit_id string, macrovisit_start_date {0}, macrovisit_end_date {0}"


def cohort_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "person_id string").selectExpr(
        "person_id", "date'2020-06-10' as first_pos_pcr_antigen_date", "date'2020-06-10' as first_pos_diagnosis_date",
        "date'2020-06-10' as first_poslab_or_diagnosis_date")


def timed_visits(spark, kind):
    """A stay and an ER visit at 10:00 on the last day of the window, and others just outside it."""
    rows_ = [("p", 1, 9203, "2020-06-26 10:00:00", None, None, None), ("q", 2, 9203, "2020-06-27 00:00:00", None, None, None),
             ("p", 3, 9201, "2020-06-26 10:00:00", "s1", "2020-06-26 10:00:00", "2020-06-28 12:00:00"),
             ("q", 4, 9201, "2020-06-27 00:00:00", "s2", "2020-06-27 00:00:00", None),
             ("r", 5, 9203, "2020-06-09 23:59:00", None, None, None), ("s", 6, 9203, "2020-06-08 23:59:00", None, None, None)]
    df = spark.createDataFrame(rows_, VISITS.format("string"))
    return df.withColumns({c: F.col(c).cast(kind) for c in ("visit_start_date", "macrovisit_start_date", "macrovisit_end_date")})


@pytest.mark.parametrize("mode", ["either", "both"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_times_of_day_do_not_lose_rows(spark, kind, mode):
    cohort, er = cohort_of(spark, "p", "q", "r", "s"), spark.createDataFrame([(9203,)], "concept_id int")
    timed = timed_visits(spark, kind)
    dated = timed.withColumns({c: F.to_date(c) for c in ("visit_start_date", "macrovisit_start_date", "macrovisit_end_date")})
    for bound in (1_000_000, 0):
        for f in (
            lambda v, p: stays_near_index(cohort, v, mode=mode, prune_to_index_range=p, cohort_broadcast_rows=bound),  # noqa: B023
            lambda v, p: er_visits_near_index(cohort, v, er, mode=mode, prune_to_index_range=p, cohort_broadcast_rows=bound),  # noqa: B023
            lambda v, p: first_visits(cohort, v, er, mode=mode, prune_to_index_range=p, cohort_broadcast_rows=bound),  # noqa: B023
            lambda v, p: first_visits(cohort, v, er, mode=mode, prune_to_index_range=p, max_broadcast_rows=0, cohort_broadcast_rows=bound),  # noqa: B023
            lambda v, p: stay_near_index(cohort, v, prune_to_index_range=p, cohort_broadcast_rows=bound),  # noqa: B023
        ):
            assert rows(f(timed, True)) == rows(f(timed, False)) == rows(f(dated, True))
    assert {r["person_id"] for r in stays_near_index(cohort, timed, mode=mode).collect()} == {"p"}
    assert {r["person_id"] for r in er_visits_near_index(cohort, timed, er, mode=mode).collect()} == {"p", "r"}


def test_repeated_person_gives_the_same_rows_at_every_cohort_size(spark):
    i = Inputs(spark, SMALL_DIR)
    again = i.cohort.unionByName(i.cohort.withColumn("first_pos_pcr_antigen_date", F.date_add("first_pos_pcr_antigen_date", 9)))
    args = (i.our_concept_sets, i.concept_set_members, i.condition_occurrence)
    small = rows(earliest_comorbidities(again, *args))
    assert small and small == rows(earliest_comorbidities(again, *args, cohort_broadcast_rows=0)) == rows(earliest_comorbidities(i.cohort, *args))
    with pytest.raises(DuplicateKeyError):
        earliest_comorbidities(again, *args, unique="assert")


def test_lookup_join_takes_map_columns_at_every_size(spark):
    df = spark.createDataFrame([("a", {"x": 1}, [{"y": 2}]), (None, {"x": 3}, []), (None, None, None)], "k string, m map<string,int>, n array<map<string,int>>")
    lookup = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for how in ("left", "left_anti", "left_semi"):
        got = [sorted(map(str, join_lookup(df, lookup, "k", how=how, max_broadcast_rows=n).collect())) for n in (100, 0)]
        assert got[0] == got[1]


def test_unique_keys_on_request(spark):
    i = Inputs(spark, SMALL_DIR)
    assert rows(person_fact(i, unique="assert")) == rows(person_fact(i))
    with pytest.raises(DuplicateKeyError, match="location_id"):
        enrich_person(i.cohort, i.person_lds, i.location.unionByName(i.location), i.manifest, unique="assert")
    with pytest.raises(DuplicateKeyError, match="person_id"):
        enrich_person(i.cohort.unionByName(i.cohort.limit(1)), i.person_lds, i.location, i.manifest, unique="assert")
    with pytest.raises(DuplicateKeyError):
        stay_near_index(i.cohort.unionByName(i.cohort), i.visits, unique="assert")
    twice = enrich_person(i.cohort, i.person_lds, i.location.unionByName(i.location), i.manifest)
    assert twice.count() > i.cohort.count()
    with pytest.raises(ValueError, match="unique"):
        enrich_person(i.cohort, i.person_lds, i.location, i.manifest, unique="maybe")


def test_many_curated_names(spark):
    sets = spark.range(1500).selectExpr("concat('s', id) as concept_set_name", "concat('c', id) as column_name",
                                        "'condition_occurrence' as domain", "1 as comorbidity", "0 as er_only_visit")
    assert len(curated_columns(sets)) == 1500


def test_size_checks(spark):
    a, b = spark.range(70), spark.range(0).selectExpr("id", "cast(id as string) as s")
    assert count_rows([a, b, a.where("id < 3")]) == [70, 0, 3] and count_rows([]) == []
    assert row_width(b) > row_width(a) >= 8
    assert fits(a, 70, 70) and not fits(a, 71, 70) and not fits(a, 70, 100, max_bytes=100) and not fits(a, 0, 0)


def test_large_texts_are_measured_before_a_broadcast(spark):
    wide = spark.range(30_000).selectExpr("id", "repeat('x', 10000) as t")  # 300 MB in few rows
    nested = spark.range(30_000).selectExpr("id", "array(struct(repeat('x', 10000) as t)) as t")
    narrow = spark.range(30_000).selectExpr("id", "'x' as t", "array(1) as a")
    assert row_width(wide) * 30_000 < 2 << 20
    assert within_bounds([wide, nested, narrow, wide, narrow], [30_000] * 5, [200_000] * 4 + [100]) == [False, False, True, False, False]
    assert small_enough([wide, narrow]) == [False, True]
    assert stored_bytes([wide.limit(0), spark.createDataFrame([(None, "é"), ("ab", None)], "a string, b string")]) == [0, 4]
    assert not checked_broadcast(wide)[1] and checked_broadcast(narrow)[1]
    ids = spark.range(20_000).selectExpr("repeat('y', 20000) as person_id", "date'2020-01-01' as d")
    assert not profile_cohort(ids, ["d"]).small(1_000_000)


def hot_visits(spark, n=100_000):
    """One stay with a third of the rows as microvisits, other stays of the same person, one busy ER day, other persons."""
    return spark.range(n).selectExpr(
        "case when id % 3 < 2 then 'hot' else concat('p', id % 97) end as person_id",
        "id as visit_occurrence_id",
        "case when id % 3 = 1 then 9203 else 9201 end as visit_concept_id", "'x' as visit_concept_name",
        "date_add(date'2020-06-08', case when id % 3 = 1 then 0 else cast(id % 5 as int) end) as visit_start_date", "date'2020-07-01' as visit_end_date",
        "case when id % 3 = 0 then 'hot_stay' when id % 3 = 2 then concat('s', id % 5000) end as macrovisit_id",
        "case when id % 3 = 0 then date'2020-06-12' when id % 3 = 2 then date_add(date'2020-06-05', cast(id % 5000 % 30 as int)) end as macrovisit_start_date",
        "case when id % 3 = 0 then date'2020-06-20' when id % 3 = 2 then date_add(date'2020-07-05', cast(id % 5000 % 30 as int)) end as macrovisit_end_date",
    )


@pytest.mark.parametrize("columns", [["person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"], ["person_id", "visit_start_date"]])
def test_rows_of_a_hot_stay_and_day_are_reduced_before_the_join(spark, columns):
    visits = hot_visits(spark).select(*columns)
    cohort = cohort_of(spark, "hot", *[f"p{i}" for i in range(97)])
    bounds = (LAB, 1, 16, 5000)
    joined = _join_cohort(visits, cohort, ["person_id", *INDEX_DATES], False, F.col(columns[-1 if len(columns) == 2 else 2]), *bounds)
    hot = "person_id = 'hot'"
    assert joined.where(hot).count() <= 100 and visits.where(hot).count() > 60_000


def test_hot_rows_give_equal_results_on_every_path(spark):
    cohort, visits, er = cohort_of(spark, "hot", *[f"p{i}" for i in range(97)]), hot_visits(spark, 30_000), spark.createDataFrame([(9203,)], "concept_id int")
    for f in (lambda **k: stay_near_index(cohort, visits, **k), lambda **k: first_visits(cohort, visits, er, **k), lambda **k: stays_near_index(cohort, visits, **k), lambda **k: er_visits_near_index(cohort, visits, er, **k)):
        assert rows(f()) == rows(f(cohort_broadcast_rows=0)) == rows(f(cohort_broadcast_rows=0, hot_rows=100))
    first, profile = first_visits(cohort, visits, er), profile_cohort(cohort, INDEX_DATES)
    expected = rows(stays_after_index(first, visits))
    assert expected and expected == rows(stays_after_index(first, visits, profile=profile)) == rows(stays_after_index(first, visits, profile=profile, cohort_broadcast_rows=0, hot_rows=100))
    assert expected == rows(stays_after_index(first, visits, branches="union")) == rows(stays_after_index(first, visits, profile=profile, branches="union"))


def test_staged_drilldowns_sort_the_found_rows_alone(spark, tmp_path):
    inputs = Inputs(spark, SMALL_DIR)
    visits = inputs.visits
    for make, keys, order in ((stay_drilldown, visits.select("macrovisit_id").limit(50), STAY_ORDER),
                              (person_stays, visits.select("person_id").limit(50), PERSON_ORDER)):
        keys = spark.createDataFrame(keys.collect(), keys.schema)
        got = make(visits, keys, stage=lambda df, n=make.__name__: materialize(spark, df, n, str(tmp_path)))
        found = got.collect()
        assert found == make(visits, keys).collect() and found == sorted(found, key=lambda r, o=order: tuple(r[c] for c in o))
        plan = plan_text(got)
        assert "Join" not in plan and all(f"/{make.__name__}/" in f for f in got.inputFiles())


def test_drilldowns_spread_a_hot_stay(spark):
    visits = hot_visits(spark, 20_000)
    keys = spark.createDataFrame([("hot_stay",), ("s5",), ("none",)], "macrovisit_id string")
    expected = rows(stay_drilldown(visits, ["hot_stay", "s5", "none"]))
    assert len(expected) > 6000 and expected == rows(stay_drilldown(visits, keys)) == rows(stay_drilldown(visits, keys, keys_small=True, sort=False)) == rows(stay_drilldown(visits, keys, hot_rows=100, sort=False))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in conf if spark.conf.get(k, None) is not None}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        per_task = stay_drilldown(visits, keys, hot_rows=100, sort=False).where("macrovisit_id = 'hot_stay'").groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in per_task.collect()]
    finally:
        for k in conf:
            spark.conf.unset(k) if k not in before else spark.conf.set(k, before[k])
    assert len(counts) >= 16 and max(counts) < 0.2 * sum(counts)
    persons = spark.createDataFrame([("hot",)], "person_id string")
    assert rows(person_stays(visits, persons)) == rows(person_stays(visits, ["hot"], sort=False))


def test_random_sample_option(spark):
    cohort = cohort_of(spark, *map(str, range(400)))
    some = sample_cohort(cohort, 0.5, 3, method="random")
    assert 100 < some.count() < 300 and some.exceptAll(cohort).count() == 0
    with pytest.raises(ValueError, match="method"):
        sample_cohort(cohort, 0.5, method="other")


def test_first_event_ties(spark):
    df = spark.createDataFrame([("p", "2020-01-02", 2), ("p", "2020-01-01", 9), ("p", "2020-01-01", 3)], "person_id string, d string, i int")
    assert rows(first_event_per(df, ["person_id"], "d", tie_break=["i"])) == [("p", "2020-01-01", 3)]
