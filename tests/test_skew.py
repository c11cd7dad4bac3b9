"""A person holding a third of all visit rows: shuffle paths stay exact and split the hot key."""

from __future__ import annotations

import contextlib

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from cohortkit.operators.skew import find_hot_keys, join_spread
from cohortkit.operators.visits import _day_bin, first_visits, stay_near_index, stays_after_index, stays_near_index

SKEW_CONF = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    visits = spark.range(30000).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id % 500 as string) end as person_id",
        "id as visit_occurrence_id", "9201 as visit_concept_id",
        "date_add(date'2020-06-01', cast(id % 40 as int)) as visit_start_date",
        "concat('s', cast(id % 7000 as string)) as macrovisit_id",
        "date_add(date'2020-06-01', cast(id % 40 as int)) as macrovisit_start_date",
        "date_add(date'2020-06-05', cast(id % 40 as int)) as macrovisit_end_date",
    )
    cohort = spark.range(500).selectExpr("cast(id as string) as person_id").unionByName(
        spark.createDataFrame([("hot",)], "person_id string")
    ).selectExpr(
        "person_id", "date'2020-06-10' as first_pos_pcr_antigen_date",
        "date'2020-06-11' as first_pos_diagnosis_date", "date'2020-06-10' as first_poslab_or_diagnosis_date",
    )
    return cohort, visits


def _final_plan(df) -> str:
    return plan_text(df)


def test_skewed_person_results_match(spark, skewed):
    cohort, visits = skewed
    expected_first = rows(stay_near_index(cohort, visits))
    expected_after = rows(stays_after_index(first_visits(cohort, visits, include_er=False), visits))

    spark_conf = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")  # salting must not need it
        first = stay_near_index(cohort, visits, cohort_broadcast_rows=0)
        assert rows(first) == expected_first
        plan = _final_plan(first)
        assert "__bin" in plan and "BroadcastHashJoin" not in plan.split("== Initial Plan ==")[0]

        after = stays_after_index(first_visits(cohort, visits, include_er=False, cohort_broadcast_rows=0), visits, hot_rows=1000)
        assert rows(after) == expected_after
        plan = _final_plan(after)
        assert "__piece" in plan
    finally:
        for k, v in spark_conf.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bound_of_hot_rows_does_not_change_results(spark, skewed):
    cohort, visits = skewed
    fv = first_visits(cohort, visits, include_er=False)
    base = rows(stays_after_index(fv, visits))
    assert rows(stays_after_index(fv, visits, hot_rows=1)) == base
    assert rows(stays_after_index(fv, visits, hot_rows=5000)) == base
    first = rows(stay_near_index(cohort, visits))
    for bound in (1, 3000, 100_000):
        assert rows(stay_near_index(cohort, visits, cohort_broadcast_rows=0, hot_rows=bound)) == first


def test_hot_keys_are_found_and_only_they_are_repeated(spark, skewed):
    cohort, visits = skewed
    hot = find_hot_keys(visits, ["person_id"], 1000)
    assert len(hot.hashes) == 1 and 100 < hot.pieces <= 512
    assert not find_hot_keys(visits, ["person_id"]).hashes and not find_hot_keys(visits.limit(0), ["person_id"], 1).hashes
    nulls = visits.withColumn("person_id", F.when(F.col("person_id") != "hot", F.col("person_id")))
    assert not find_hot_keys(nulls, ["person_id"], 1000).hashes
    joined = join_spread(visits, cohort, ["person_id"], hot)
    assert joined.count() == visits.distinct().join(cohort, "person_id").count()
    side = cohort.withColumn("n", F.when(hot.has(["person_id"]), hot.pieces).otherwise(1)).agg(F.sum("n")).first()[0]
    assert side == 500 + hot.pieces  # whatever the number of cores


@contextlib.contextmanager
def settings(spark, conf):
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_person_spreads_evenly(spark):
    """The largest task reads less than twice the median where one key owns a third."""
    visits = spark.range(120_000).selectExpr("case when id % 3 = 0 then 'hot' else concat('p', id) end as person_id", "id as visit")
    side = visits.select("person_id").distinct()
    with settings(spark, {**SKEW_CONF, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}):
        def largest_to_median(df):
            counts = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            return counts[-1] / counts[len(counts) // 2]

        hot = find_hot_keys(visits, ["person_id"], 1000)
        assert largest_to_median(join_spread(visits, side, ["person_id"], hot)) < 2 < largest_to_median(visits.join(side, "person_id"))


def test_large_cohort_shuffles_visits_once(spark, skewed):
    cohort, visits = skewed
    with settings(spark, {**SKEW_CONF, "spark.sql.adaptive.enabled": "false"}):
        fv = spark.createDataFrame(first_visits(cohort, visits, include_er=False).collect())
        plan = plan_text(stays_after_index(fv, visits))
        # one exchange of visits, one of anchors
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
        plan = plan_text(stays_near_index(cohort, visits, cohort_broadcast_rows=0))
        # those two by person and day bin, and one of each person's partial result
        assert plan.count("Exchange hashpartitioning") == 3 and plan.count("__bin") > 0


def test_plans_do_not_depend_on_the_cluster(spark, skewed):
    """A cohort without a hot person goes to two day bins a row and is not repeated."""
    cohort, visits = skewed
    rows_ = cohort.withColumn("bins", F.sequence(_day_bin(F.date_sub("first_pos_pcr_antigen_date", 1), 18), _day_bin(F.date_add("first_pos_pcr_antigen_date", 16), 18)))
    assert rows_.agg(F.max(F.size("bins"))).first()[0] <= 2
    plan = plan_text(stays_after_index(first_visits(cohort, visits.where("person_id <> 'hot'"), include_er=False), visits.where("person_id <> 'hot'")))
    assert "Generate explode" not in plan


@pytest.mark.parametrize("before,after", [(0, 0), (1, 16), (30, 0), (-2, 5), (-5, 2), (400, 400)])
def test_day_bins_equal_the_broadcast_join(spark, skewed, before, after):
    cohort, visits = skewed
    dates = cohort.withColumn("first_pos_pcr_antigen_date", F.expr("date_add(date'1969-12-20', cast(hash(person_id) % 40 as int))"))
    old = visits.withColumn("macrovisit_start_date", F.expr("date_add(date'1969-12-15', cast(visit_occurrence_id % 60 as int))"))
    got = [rows(stay_near_index(dates, old, days_before_index=before, days_after_index=after, cohort_broadcast_rows=n)) for n in (1000, 0)]
    assert got[0] == got[1]


def test_hot_lookup_key_is_split(spark):
    from cohortkit.operators.joins import join_lookup

    people = spark.range(30000).selectExpr(
        "cast(id as string) as person_id",
        "case when id % 3 = 0 then 'L0' when id % 7 = 0 then null else concat('L', cast(id % 300 as string)) end as loc",
    )
    places = spark.range(300).selectExpr("concat('L', cast(id as string)) as loc", "cast(id % 5 as string) as region")
    expected = rows(join_lookup(people, places, "loc"))
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        # nothing after a lookup join needs its partitioning, so AQE splits without being forced
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
        joined = join_lookup(people, places, "loc", max_broadcast_rows=0)
        assert rows(joined) == expected
        assert "skew=true" in _final_plan(joined)  # the hot location's partition was split
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
