"""Lookup joins (broadcast and salted shuffle paths), area attachment, casts."""

from __future__ import annotations

from conftest import rows

from cohortkit.operators.area import attach_area, attach_column, cast_columns, unmatched_keys, zip_area_table
from cohortkit.operators.attach import attach_severity
from cohortkit.operators.checks import DuplicateKeyError, assert_unique, observe_rows
from cohortkit.operators.joins import checked_broadcast, has_at_most, join_lookup, small_enough


def _people(spark):
    return spark.createDataFrame(
        [("1", "A"), ("2", None), ("3", "B"), ("4", None), ("5", "Z")], "person_id string, loc string"
    )


def _places(spark):
    return spark.createDataFrame([("A", "north"), ("B", "south")], "loc string, region string")


def test_broadcast_and_salted_paths_agree(spark):
    people, places = _people(spark), _places(spark)
    for how in ("left", "left_anti", "left_semi"):
        fast = join_lookup(people, places, "loc", how=how)
        salted = join_lookup(people, places, "loc", how=how, max_broadcast_rows=0)
        assert rows(fast) == rows(salted), how
    left = join_lookup(people, places, "loc", max_broadcast_rows=0)
    assert left.columns == ["person_id", "loc", "region"]
    assert rows(left, "person_id", "region") == [("1", "north"), ("2", None), ("3", "south"), ("4", None), ("5", None)]
    assert rows(join_lookup(people, places, "loc", how="left_anti"), "person_id") == [("2",), ("4",), ("5",)]


def test_salted_path_spreads_null_keys(spark, capsys):
    people = spark.range(0, 400).selectExpr(
        "cast(id as string) as person_id", "case when id % 4 = 0 then 'A' end as loc"
    )
    out = join_lookup(people, _places(spark), "loc", max_broadcast_rows=0)
    out.explain()
    assert "__salt_l" in capsys.readouterr().out
    assert out.count() == 400
    assert out.where("region = 'north'").count() == 100


def test_size_checks(spark):
    df = spark.range(100)
    assert has_at_most(df, 100) and not has_at_most(df, 99)
    assert checked_broadcast(df, 10)[1] is False
    assert checked_broadcast(df, 1000)[1] is True
    assert small_enough([df, spark.range(5)], 50) == [False, True]
    assert small_enough([df], 0) == [False]


def test_lookup_column_collision_is_rejected(spark):
    people = spark.createDataFrame([("1", "A", "x")], "person_id string, loc string, region string")
    try:
        join_lookup(people, _places(spark), "loc")
    except ValueError as exc:
        assert "collide" in str(exc)
    else:
        raise AssertionError("expected a collision error")


def _area(spark):
    area = spark.createDataFrame([("Z1", "1.5", "NA"), ("Z2", "", "3")], "ZCTA string, White string, AIAN string")
    xwalk = spark.createDataFrame([("10000", "Z1"), ("10000", "Z2"), ("10037", "Z2"), ("99999", "ZX")],
                                  "ZIP_CODE string, ZCTA string")
    return zip_area_table(area, xwalk)


def test_zip_area_and_attach(spark):
    by_zip = _area(spark)
    assert by_zip.columns == ["ZCTA", "White", "AIAN", "zipcode"]
    persons = spark.createDataFrame([("p1", "10000", "c", "s", "10000"), ("p2", None, "c", "s", "junk"),
                                     ("p3", "20000", "c2", "s2", "20000")],
                                    "person_id string, zip_code string, city string, state string, zip string")
    for bound in (200_000, 0):
        out = attach_area(persons, by_zip, max_broadcast_rows=bound)
        assert out.columns == ["zip_code", "person_id", "ZCTA", "White", "AIAN", "zipcode"]
        # D13: a ZIP with two areas gives two rows; unmatched persons keep one row of nulls
        assert rows(out, "person_id", "ZCTA", "zipcode") == [
            ("p1", "Z1", "10000"), ("p1", "Z2", "10000"), ("p2", None, None), ("p3", None, None),
        ]
        # D16: unmatched places, null ZIP included
        # (with the area key, null as nothing matched)
        assert rows(unmatched_keys(persons, by_zip, max_broadcast_rows=bound)) == [("c", "s", "junk", None),
                                                                                   ("c2", "s2", "20000", None)]


def test_cast_columns(spark):
    df = spark.createDataFrame([("a", "1.5", "NA", "keep"), ("b", "", None, "x")],
                               "id string, White string, AIAN string, other string")
    out = cast_columns(df, ["White", "AIAN"])
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "double", "double", "string"]
    assert rows(out) == [("a", 1.5, None, "keep"), ("b", None, None, "x")]


def test_attach_column_and_severity(spark):
    base = spark.createDataFrame([("1", "P1"), ("2", "P2")], "person_id string, data_partner_id string")
    facts = spark.createDataFrame([("1", 7, "ignored")], "person_id string, MDs int, other string")
    assert rows(attach_column(base, facts, ["MDs"])) == [("1", "P1", 7), ("2", "P2", None)]
    sev = spark.createDataFrame(
        [("1", "Mild", "S1", None, 10, 1, 0, 2, 3, 20.0, 150.0, 60.0, "A", "Non smoker")],
        "person_id string, Severity_Type string, data_partner_id string, visit_start_date date, "
        "visit_occurrence_id bigint, AKI_in_hospital int, ECMO int, Invasive_Ventilation int, Q_Score int, "
        "BMI double, Height double, Weight double, blood_type string, smoking_status string",
    )
    out = attach_severity(base, sev)
    assert out.columns[:3] == ["person_id", "data_partner_id", "Severity_Type"]
    assert "sev_data_partner_id" in out.columns and len(out.columns) == 2 + 13
    assert rows(out, "person_id", "data_partner_id", "sev_data_partner_id") == [("1", "P1", "S1"), ("2", "P2", None)]


def test_checks(spark):
    df = spark.createDataFrame([("1",), ("2",), ("2",)], "person_id string")
    try:
        assert_unique(df, ["person_id"])
    except DuplicateKeyError as exc:
        assert "'2'" in str(exc)
    else:
        raise AssertionError("expected duplicate key")
    assert assert_unique(df.distinct(), ["person_id"]) is not None
    observed, obs = observe_rows(df, "n")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3}


def test_restricted_lookup_equals_plain(spark):
    people = spark.createDataFrame([("1", "A"), ("2", None), ("3", "B")], "person_id string, loc string")
    places = spark.range(1000).selectExpr("cast(id as string) as loc", "id as n").unionByName(
        spark.createDataFrame([("A", 1), ("B", 2)], "loc string, n long"))
    keys = people.select("loc").where("loc is not null")
    plain = join_lookup(people, places, "loc", max_broadcast_rows=0)
    restricted = join_lookup(people, places, "loc", max_broadcast_rows=0, restrict_to=keys)
    assert rows(plain) == rows(restricted) == [("1", "A", 1), ("2", None, None), ("3", "B", 2)]
