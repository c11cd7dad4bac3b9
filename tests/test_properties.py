"""Property tests: column expressions against plain-Python statements of the same rules."""

from __future__ import annotations

import calendar
import datetime as dt
import math
import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortkit.functions.person import RACE_ETHNICITY_DEFAULT, RACE_ETHNICITY_RULES
from cohortkit.operators.person import add_age, add_race_ethnicity, add_zip_code

# A few fixed (derandomized) cases by default; PROPERTY_EXAMPLES=n explores n random cases.
SETTINGS = settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "4")), deadline=None,
                    derandomize="PROPERTY_EXAMPLES" not in os.environ,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_birth_date(y, m, d):
    if y is None:
        return None
    try:
        return dt.date(y, m or 1, d or 1)
    except ValueError:
        return None


def py_age(index, dob):
    """Whole years by Spark's months_between rule (31-day months unless the
    days match or both dates end their month), floored; negative -> None."""
    if index is None or dob is None:
        return None
    months = (index.year - dob.year) * 12 + (index.month - dob.month)
    both_month_end = (index.day == calendar.monthrange(index.year, index.month)[1]
                      and dob.day == calendar.monthrange(dob.year, dob.month)[1])
    if index.day != dob.day and not both_month_end:
        months += (index.day - dob.day) / 31
    age = math.floor(months / 12)
    return age if age >= 0 else None


def py_zip(z):
    if z is None:
        return None
    t = z.strip(" ")
    if len(t) < 5:
        return None
    return t[:5] if re.fullmatch("[0-9]{5}", t[:5]) else None


def py_race(ethnicity, race):
    for role, test, value, label in RACE_ETHNICITY_RULES:
        v = ethnicity if role == "ethnicity" else race
        if v is None:
            continue
        if (test == "equals" and v == value) or (test == "contains" and value in v):
            return label
    return RACE_ETHNICITY_DEFAULT


person_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1900, 2030)),
        st.one_of(st.none(), st.integers(1, 12)),
        st.one_of(st.none(), st.integers(1, 31)),
        st.one_of(st.none(), st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31))),
    ),
    min_size=100, max_size=300,
)


@SETTINGS
@given(person_rows)
def test_birth_date_and_age(spark, data):
    data = [(str(i), *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(
        data, "person_id string, year_of_birth int, month_of_birth int, day_of_birth int, first_pos_pcr_antigen_date date"
    )
    got = {r["person_id"]: (r["date_of_birth"], r["age_at_first_covid_diag"]) for r in add_age(df).collect()}
    for pid, y, m, d, index in data:
        dob = py_birth_date(y, m, d)
        assert got[pid] == (dob, py_age(index, dob)), (y, m, d, index)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" 0123456789-A\t", max_size=12)), min_size=50, max_size=200))
def test_zip(spark, zips):
    data = [(str(i), z) for i, z in enumerate(zips)]
    out = {r["person_id"]: r["zip_code"] for r in add_zip_code(spark.createDataFrame(data, "person_id string, zip string")).collect()}
    for pid, z in data:
        assert out[pid] == py_zip(z), repr(z)


words = [v for _, _, v, _ in RACE_ETHNICITY_RULES] + ["Other", "Black Hispanic", "o'Neil", "back\\slash"]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(words)),
                          st.one_of(st.none(), st.sampled_from(words), st.text(max_size=8))),
                min_size=50, max_size=200))
def test_race_rules(spark, pairs):
    data = [(str(i), e, r) for i, (e, r) in enumerate(pairs)]
    df = spark.createDataFrame(data, "person_id string, ethnicity_concept_name string, race_concept_name string")
    out = {r["person_id"]: r["race_ethnicity"] for r in add_race_ethnicity(df).collect()}
    for pid, e, r in data:
        assert out[pid] == py_race(e, r), (e, r)


# --- visit matching against a direct statement of the rules -----------------

def _within(index, event, before=1, after=16):
    return index is not None and event is not None and -after <= (index - event).days <= before


def py_first_visits(persons, visits, er_ids, mode="either"):
    """person_id -> (stay id, stay start, stay end, first ER date)."""
    out = {}
    for pid, lab, dx, earlier in persons:
        index = earlier if mode == "either" else lab
        pair_ok = mode == "either" or (lab is not None and dx is not None and -16 <= (lab - dx).days <= 1)
        stays = [(s, m, e) for (p, c, vs, m, s, e) in visits
                 if p == pid and s is not None and pair_ok and _within(index, s)]
        ers = [vs for (p, c, vs, m, s, e) in visits
               if p == pid and s is None and c in er_ids and pair_ok and _within(index, vs)]
        # ties: smallest stay id, then end date, nulls first
        first = min(stays, key=lambda t: (t[0], t[1] is not None, t[1] or "", t[2] is not None, t[2] or dt.date.min),
                    default=None)
        out[pid] = (first[1] if first else None, first[0] if first else None, first[2] if first else None,
                    min(ers) if ers else None)
    return out


def py_stays_after(anchors, visits):
    """(person_id, stay id) -> (start, end) of the stay's earliest row after the anchor."""
    out = {}
    for pid, earlier, hosp_start, _ in anchors:
        anchor = hosp_start if hosp_start is not None else earlier
        if anchor is None:
            continue
        for (p, c, vs, m, s, e) in visits:
            if p == pid and m is not None and s is not None and anchor < s:
                key = (pid, m)
                cand = (s, e)
                if key not in out or (cand[0], cand[1] is not None, cand[1] or dt.date.min) < (
                        out[key][0], out[key][1] is not None, out[key][1] or dt.date.min):
                    out[key] = cand
    return out


base = dt.date(2020, 6, 1)
day = st.integers(-25, 25).map(lambda n: base + dt.timedelta(days=n))
maybe_day = st.one_of(st.none(), day)
visit_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from([9201, 9203, 262, 9202]), day,
              st.one_of(st.none(), st.sampled_from(["s1", "s2", "s3", "s4"])), maybe_day, maybe_day),
    min_size=1, max_size=60,
)
person_rows = st.lists(st.tuples(maybe_day, maybe_day), min_size=4, max_size=4)


@SETTINGS
@given(person_rows, visit_rows, st.sampled_from(["either", "both"]))
def test_first_visits_matches_rules(spark, people, visits, mode):
    from cohortkit.operators.visits import first_visits

    persons = [(pid, lab, dx, min([x for x in (lab, dx) if x is not None], default=None))
               for pid, (lab, dx) in zip("abcd", people)]
    # a stay row has a stay id exactly when it has a stay start (as in the fixture data)
    vrows = [(p, c, vs, m if s is not None else None, s if m is not None else None, e if m is not None else None)
             for (p, c, vs, m, s, e) in visits]
    pdf = spark.createDataFrame(persons, "person_id string, first_pos_pcr_antigen_date date, "
                                "first_pos_diagnosis_date date, first_poslab_or_diagnosis_date date")
    vdf = spark.createDataFrame(vrows, "person_id string, visit_concept_id int, visit_start_date date, "
                                "macrovisit_id string, macrovisit_start_date date, macrovisit_end_date date")
    er = spark.createDataFrame([(9203,), (262,)], "concept_id bigint")
    got = {r["person_id"]: (r["macrovisit_id"], r["first_COVID_hospitalization_start_date"],
                            r["first_COVID_hospitalization_end_date"], r["first_covid_er_only_start_date"])
           for r in first_visits(pdf, vdf, er, mode=mode).collect()}
    assert got == py_first_visits(persons, vrows, {9203, 262}, mode)


@SETTINGS
@given(st.lists(st.tuples(maybe_day, maybe_day), min_size=4, max_size=4), visit_rows)
def test_stays_after_index_matches_rules(spark, anchor_pairs, visits):
    from cohortkit.operators.visits import stays_after_index

    anchors = [(pid, earlier, hosp, None) for pid, (earlier, hosp) in zip("abcd", anchor_pairs)]
    adf = spark.createDataFrame(anchors, "person_id string, first_poslab_or_diagnosis_date date, "
                                "first_COVID_hospitalization_start_date date, first_COVID_hospitalization_end_date date")
    vdf = spark.createDataFrame(visits, "person_id string, visit_concept_id int, visit_start_date date, "
                                "macrovisit_id string, macrovisit_start_date date, macrovisit_end_date date")
    got = {(r["person_id"], r["macrovisit_id"]): (r["macrovisit_start_date"], r["macrovisit_end_date"])
           for r in stays_after_index(adf, vdf, hot_rows=2).collect()}
    assert got == py_stays_after(anchors, visits)


def py_stay_near_index(persons, visits):
    """person_id -> (stay id, start, end, flag) for the first stay in [index-1, index+16] ending on/after index."""
    out = {}
    for pid, lab, _dx, _earlier in persons:
        cands = [(s, m, e) for (p, c, vs, m, s, e) in visits
                 if p == pid and m is not None and lab is not None and s is not None and e is not None
                 and lab - dt.timedelta(days=1) <= s <= lab + dt.timedelta(days=16) and lab <= e]
        first = min(cands, key=lambda t: (t[0], t[1], t[2]), default=None)
        out[pid] = (first[1], first[0], first[2], 1) if first else (None, None, None, 0)
    return out


@SETTINGS
@given(person_rows, visit_rows)
def test_stay_near_index_matches_rules(spark, people, visits):
    from cohortkit.operators.visits import stay_near_index

    persons = [(pid, lab, dx, None) for pid, (lab, dx) in zip("abcd", people)]
    pdf = spark.createDataFrame(persons, "person_id string, first_pos_pcr_antigen_date date, "
                                "first_pos_diagnosis_date date, first_poslab_or_diagnosis_date date")
    vdf = spark.createDataFrame(visits, "person_id string, visit_concept_id int, visit_start_date date, "
                                "macrovisit_id string, macrovisit_start_date date, macrovisit_end_date date")
    got = {r["person_id"]: (r["first_covid_macrovisit_id"], r["first_covid_macrovisit_start_date"],
                            r["first_covid_macrovisit_end_date"], r["covid_associated_hosp"])
           for r in stay_near_index(pdf, vdf).collect()}
    assert got == py_stay_near_index(persons, visits)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from([1, 2, 3, 4]), maybe_day,
                          st.integers(1, 30), st.sampled_from(["AF", "NO", None])), min_size=1, max_size=60))
def test_comorbidity_pivot_matches_rules(spark, conditions):
    from cohortkit.operators.pivot import comorbidities

    sets = spark.createDataFrame([("S1", "one", "condition_occurrence", 1, 0), ("S2", "two", "condition_occurrence", 1, 0),
                                  ("S3", "three", "drug_exposure", 1, 0)],
                                 "concept_set_name string, column_name string, domain string, comorbidity int, "
                                 "er_only_visit int")
    members = spark.createDataFrame([(1, "S1", "true"), (2, "S2", "true"), (3, "S2", "false"), (4, "S3", "true")],
                                    "concept_id bigint, concept_set_name string, is_most_recent_version string")
    cohort = spark.createDataFrame([("a",), ("b",)], "person_id string")
    cdf = spark.createDataFrame(conditions, "person_id string, condition_concept_id bigint, "
                                "condition_start_date date, condition_occurrence_id bigint, "
                                "condition_source_value string")
    got = {r["person_id"]: tuple(r[c] for c in ("one_start", "one_c_occ_id", "two_start", "two_c_occ_id"))
           for r in comorbidities(cohort, sets, members, cdf).collect()}
    group = {1: "one", 2: "two"}  # concept 3 is an old version, concept 4 not a condition set
    want: dict = {}
    for pid in ("a", "b"):
        firsts = {}
        for p, concept, start, occ, src in conditions:
            if p == pid and concept in group and start is not None:
                key = (start, occ, src is not None, src or "")
                if group[concept] not in firsts or key < firsts[group[concept]]:
                    firsts[group[concept]] = key
        if firsts:
            want[pid] = tuple(x for g in ("one", "two") for x in ((firsts[g][0], firsts[g][1]) if g in firsts
                                                                    else (None, None)))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "z"]), maybe_day), max_size=40), st.booleans())
def test_latest_event_matches_rules(spark, deaths, fanout):
    from cohortkit.operators.events import latest_event

    persons = spark.createDataFrame([("a",), ("b",), ("c",)], "person_id string")
    ddf = spark.createDataFrame(deaths, "person_id string, death_date date")
    got = sorted((r["person_id"], r["death_date"] or dt.date.min, r["death_recorded"])
                 for r in latest_event(persons, ddf, keep_fanout=fanout).collect())
    want = []
    for pid in "abc":
        dates = [d for p, d in deaths if p == pid]
        latest = max((d for d in dates if d is not None), default=None)
        copies = len(set(dates)) if (fanout and dates) else 1
        want += [(pid, latest or dt.date.min, int(latest is not None))] * copies
    assert got == sorted(want)
