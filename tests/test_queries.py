"""Registered queries: oracle parity, entry smoke check, known counts, plan shape."""

from __future__ import annotations

import pytest
from conftest import ORACLE_DIR, SMALL_DIR, plan_text
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortkit.plans.queries import QUERIES as CORE
from oracle_check import compare, duck_connect

QUERIES = {name: query for name, query in entry.queries().items() if name in CORE}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in CORE}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 32


@pytest.fixture(scope="module")
def duck_small():
    return duck_connect(SMALL_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    report = compare(QUERIES[name](spark, SMALL_DIR), duck_small, ORACLES[name])
    assert report["ok"], report


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == spark.read.parquet(f"{SMALL_DIR}/customer.parquet").count()
    assert df.columns[0] == "person_id"
    assert df.columns[-2:] == ["death_date", "death_recorded"]
    assert df.schema == entry.entry(spark).schema


def test_person_fact_one_row_per_person(spark):
    from cohortkit.operators.checks import assert_unique

    assert_unique(QUERIES["person_fact"](spark, SMALL_DIR), ["person_id"], "person_fact")


def test_known_fixture_counts(spark):
    # Row counts stated in FIXTURES.md for sf0.01 (persons / rows).
    hosp = QUERIES["first_stay_near_index"](spark, ORACLE_DIR)
    assert hosp.where(F.col("covid_associated_hosp") == 1).count() == 1181
    assert QUERIES["er_visits"](spark, ORACLE_DIR).count() == 896
    assert QUERIES["er_visits_both"](spark, ORACLE_DIR).count() == 276
    assert QUERIES["first_event"](spark, ORACLE_DIR).count() == 4363
    assert QUERIES["codes_per_stay"](spark, ORACLE_DIR).count() == 4331
    # area views come from supplier (100 at sf0.01): 80 crosswalk ZIPs (key % 5 <> 4) + the second area of ZIP 10000
    assert QUERIES["zip_area"](spark, ORACLE_DIR).count() == 101


def _plan(df) -> str:
    return plan_text(df)


def test_visit_scan_is_pruned_and_filtered(spark):
    plan = _plan(QUERIES["stay_either"](spark, ORACLE_DIR))
    lineitem_scan = [line for line in plan.splitlines() if "lineitem" in line][0]
    assert "l_extendedprice" not in lineitem_scan and "l_shipdate" not in lineitem_scan
    assert "BroadcastHashJoin" in plan  # cohort side proven small and broadcast


def test_pivot_is_one_aggregation(spark):
    plan = _plan(QUERIES["comorbidity_pivot"](spark, ORACLE_DIR))
    # the event side is shuffled once, for the per-person aggregate; the concept
    # list and the cohort are broadcast (the concept list's own distinct is the
    # only other exchange, on the small side)
    assert plan.count("Exchange hashpartitioning(person_id") == 1, plan
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "LeftSemi" in plan


@pytest.mark.parametrize("name", ["person_fact", "comorbidity_pivot", "first_visits", "stays_after_index",
                                  "latest_event_fanout", "cast_sdoh"])
def test_same_result_for_any_partition_count(spark, name):
    from conftest import rows

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    results = []
    try:
        for partitions, adaptive in (("1", "true"), ("4", "false"), ("16", "true")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            results.append(rows(QUERIES[name](spark, SMALL_DIR)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert results[0] == results[1] == results[2]


def test_entry_keeps_its_queries_without_an_optional_library():
    """A library that only the optional operators need may be absent."""
    import subprocess
    import sys

    from conftest import ROOT

    code = "import sys; sys.modules['regex'] = None; import __spark_entry__ as e; from cohortkit.plans.queries import QUERIES; assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
