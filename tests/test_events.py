"""First/latest event per key, the fused pivot, and their invariants."""

from __future__ import annotations

from conftest import d, rows

from pyspark.sql import functions as F

from cohortkit.operators.events import first_event_per, keep_first, latest_event
from cohortkit.operators.pivot import pivot_first_events

EVENTS = "person_id string, grp string, dt date, occ_id bigint, src string"


def test_first_event_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("p1", "a", d("2020-01-05"), 9, "x"),
        ("p1", "a", d("2020-01-02"), 7, "y"),
        ("p1", "a", d("2020-01-02"), 3, "z"),    # D3: tie on date -> smallest occurrence id
        ("p1", "a", None, 1, "n"),               # null date skipped
        ("p1", "b", d("2020-02-01"), 5, "w"),
        ("p2", "a", None, 2, "n"),               # only null dates -> no row
    ], EVENTS)
    out = first_event_per(df, ["person_id", "grp"], "dt", tie_break=["occ_id"])
    assert out.columns == ["person_id", "grp", "dt", "occ_id", "src"]
    assert rows(out) == [
        ("p1", "a", d("2020-01-02"), 3, "z"),
        ("p1", "b", d("2020-02-01"), 5, "w"),
    ]


def test_first_event_carries_one_row(spark):
    # D2: every carried column comes from the same earliest row
    df = spark.createDataFrame([
        ("p", "a", d("2020-01-03"), 1, "late"),
        ("p", "a", d("2020-01-01"), 2, "early"),
    ], EVENTS)
    assert rows(first_event_per(df, ["person_id", "grp"], "dt")) == [("p", "a", d("2020-01-01"), 2, "early")]


def test_first_event_same_for_any_partitioning(spark):
    df = spark.range(0, 3000).selectExpr(
        "cast(id % 37 as string) as person_id", "cast(id % 3 as string) as grp",
        "date_add(date'2020-01-01', cast(id % 11 as int)) as dt", "id as occ_id", "cast(id as string) as src",
    )
    ref = rows(first_event_per(df.repartition(1), ["person_id", "grp"], "dt", ["occ_id"]))
    for n in (4, 16):
        assert rows(first_event_per(df.repartition(n), ["person_id", "grp"], "dt", ["occ_id"])) == ref


def test_pivot_matches_first_event_then_pivot(spark):
    df = spark.range(0, 2000).selectExpr(
        "cast(id % 53 as string) as person_id", "element_at(array('a','b','c'), cast(id % 3 + 1 as int)) as grp",
        "date_add(date'2020-01-01', cast((id * 7) % 29 as int)) as dt", "id as occ_id", "cast(id as string) as src",
    )
    fused = pivot_first_events(df, "person_id", "grp", ["a", "b", "c", "zz"], "dt",
                               {"start": "dt", "c_occ_id": "occ_id"}, tie_break=["occ_id"])
    assert fused.columns == ["person_id", "a_start", "a_c_occ_id", "b_start", "b_c_occ_id", "c_start", "c_c_occ_id",
                             "zz_start", "zz_c_occ_id"]
    two_step = (first_event_per(df, ["person_id", "grp"], "dt", ["occ_id"])
                .groupBy("person_id").pivot("grp", ["a", "b", "c", "zz"])
                .agg({"dt": "first", "occ_id": "first"}))
    got = {r["person_id"]: (r["a_start"], r["a_c_occ_id"], r["c_start"], r["zz_start"]) for r in fused.collect()}
    want = {r["person_id"]: (r["a_first(dt)"], r["a_first(occ_id)"], r["c_first(dt)"], r["zz_first(dt)"])
            for r in two_step.collect()}
    assert got == want
    assert all(v[3] is None for v in got.values())  # D12: a group nobody has still gets (null) columns


PERSONS = "person_id string, x int"
DEATHS = "person_id string, death_date date"


def test_latest_event_one_row_per_person(spark):
    persons = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], PERSONS)
    deaths = spark.createDataFrame([
        ("a", d("2020-06-01")), ("a", d("2020-06-09")), ("a", d("2020-06-09")), ("a", None),
        ("b", None),
        ("z", d("2020-01-01")),   # not in the cohort
    ], DEATHS)
    out = latest_event(persons, deaths)
    assert rows(out) == [("a", 1, d("2020-06-09"), 1), ("b", 2, None, 0), ("c", 3, None, 0)]


def test_latest_event_fanout_reproduces_window_without_dedupe(spark):
    # D1: one copy per distinct death date (null included), all with the latest date
    persons = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], PERSONS)
    deaths = spark.createDataFrame([
        ("a", d("2020-06-01")), ("a", d("2020-06-09")), ("a", d("2020-06-09")), ("a", None),
        ("b", None), ("b", None),
    ], DEATHS)
    out = latest_event(persons, deaths, keep_fanout=True)
    assert rows(out) == [
        ("a", 1, d("2020-06-09"), 1), ("a", 1, d("2020-06-09"), 1), ("a", 1, d("2020-06-09"), 1),
        ("b", 2, None, 0), ("c", 3, None, 0),
    ]


def test_keep_first_matches_first_event_and_mixed_order(spark):
    df = spark.range(0, 3000).selectExpr(
        "cast(id % 37 as string) as person_id", "cast(id % 3 as string) as grp",
        "date_add(date'2020-01-01', cast(id % 11 as int)) as dt", "id as occ_id", "cast(id as string) as src",
    )
    assert rows(keep_first(df, ["person_id", "grp"], ["dt", "occ_id"])) == rows(
        first_event_per(df, ["person_id", "grp"], "dt", ["occ_id"])
    )
    latest = keep_first(df, ["person_id"], [F.col("dt").desc(), F.col("occ_id").asc()])
    want = {}
    for r in df.collect():
        k = r["person_id"]
        if k not in want or (r["dt"], -r["occ_id"]) > (want[k]["dt"], -want[k]["occ_id"]):
            want[k] = r
    assert rows(latest) == sorted((tuple(r) for r in want.values()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_earliest_comorbidities_paths_agree(spark):
    from conftest import SMALL_DIR

    from cohortkit.operators.pivot import comorbidities, earliest_comorbidities
    from cohortkit.sources.fixtures import Inputs

    i = Inputs(spark, SMALL_DIR)
    args = (i.cohort, i.our_concept_sets, i.concept_set_members, i.condition_occurrence)
    assert rows(earliest_comorbidities(*args)) == rows(earliest_comorbidities(*args, cohort_broadcast_rows=0))
    assert rows(comorbidities(*args)) == rows(comorbidities(*args, cohort_broadcast_rows=0, max_broadcast_rows=0))


def test_empty_inputs(spark):
    from conftest import SMALL_DIR

    from cohortkit.operators.concepts import er_concept_ids
    from cohortkit.operators.pivot import comorbidities
    from cohortkit.operators.visits import first_visits, stay_near_index, stays_after_index
    from cohortkit.sources.fixtures import Inputs

    i = Inputs(spark, SMALL_DIR)
    n = i.cohort.count()
    no_visits, no_deaths = i.visits.where("false"), i.death.where("false")
    er = er_concept_ids(i.our_concept_sets, i.concept_set_members)
    assert stay_near_index(i.cohort, no_visits).where("covid_associated_hosp = 0").count() == n
    assert first_visits(i.cohort, no_visits, er).count() == n
    assert stays_after_index(first_visits(i.cohort, no_visits, include_er=False), no_visits).count() == 0
    assert latest_event(i.cohort, no_deaths).where("death_recorded = 0").count() == n
    assert latest_event(i.cohort, no_deaths, keep_fanout=True).count() == n
    no_sets = comorbidities(i.cohort, i.our_concept_sets.where("false"), i.concept_set_members,
                            i.condition_occurrence)
    assert no_sets.columns == ["person_id"] and no_sets.count() == 0
    assert stay_near_index(i.cohort.where("false"), i.visits).count() == 0


def _pivot(events, names, **kwargs):
    return pivot_first_events(events, "person_id", "g", names, "day", {"start": "day", "id": "occ"}, tie_break=["occ"], **kwargs)


def test_long_form_pivot_equals_the_fused_one(spark):
    events = spark.range(4000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 11 = 0 then null else concat('p', id % 50) end as person_id", "concat('g', id % 23) as g",
        "case when id % 7 > 0 then date_add(date'2020-01-01', cast(id * 31 % 90 as int)) end as day", "id % 13 as occ")
    names = [f"g{i}" for i in range(0, 26)]  # some have no event, one event group is not asked for
    fused = _pivot(events, names[2:])
    assert fused.columns[:3] == ["person_id", "g2_start", "g2_id"]
    assert rows(_pivot(events, names[2:], fused_groups=0)) == rows(fused)
    assert _pivot(events, [], fused_groups=0).count() == 0
    odd = ["it's", "a`b", "c\\d", "e.f", '"g"']
    strange = events.withColumn("g", F.element_at(F.array(*[F.lit(x) for x in odd]), (F.col("occ") % 5 + 1).cast("int")))
    assert rows(_pivot(strange, odd, fused_groups=0)) == rows(_pivot(strange, odd)) and "it's_start" in _pivot(strange, odd).columns


def test_pivot_of_five_thousand_names(spark):
    events = spark.range(20_000).selectExpr("concat('p', id % 40) as person_id", "concat('g', id % 5000) as g", "date_add(date'2020-01-01', cast(id % 90 as int)) as day", "id as occ")
    out = _pivot(events, [f"g{i}" for i in range(5000)])
    assert len(out.columns) == 10_001
    got = out.where("person_id = 'p7'").select("g7_start", "g7_id", "g47_id", "g8_id").collect()
    assert [tuple(r) for r in got] == [(d("2020-01-08"), 7, 5047, None)]
