"""DuckDB oracle SQL for every registered query.

Written by hand from the reference's semantics (and the decisions in the
survey), not generated from the Spark code: windows with ROW_NUMBER where
the Spark side uses grouped min(struct), the reference's two-branch union
for stays after the index, the reference's distinct-then-window for the
death fan-out, and Spark's months_between rule spelled out for ages.
Tie-breaks follow the documented order (dates, then ids, nulls first).
"""

from __future__ import annotations

from .fixture_sql import with_views

# --- shared steps ---------------------------------------------------------

def _enriched(persons: str = "cohort"):
    return ("enriched", f"""
SELECT c.*, p.year_of_birth, p.month_of_birth, p.day_of_birth, p.ethnicity_concept_name,
       p.race_concept_name, p.gender_concept_name, p.location_id, p.data_partner_id,
       l.city, l.state, l.zip, l.county,
       m.run_date, m.cdm_name, m.cdm_version, m.shift_date_yn, m.max_num_shift_days
FROM {persons} c
LEFT JOIN person_lds p ON c.person_id = p.person_id
LEFT JOIN location l ON p.location_id = l.location_id
LEFT JOIN manifest m ON p.data_partner_id = m.data_partner_id""")


ENRICHED = _enriched()
SAMPLED = ("sampled", """
SELECT * FROM cohort
WHERE CAST(('0x' || substr(md5('111:' || person_id), 1, 8)) AS BIGINT) % 1000000 < 500000""")

WITH_DOB = ("with_dob", """
SELECT *,
       CASE WHEN year_of_birth IS NULL THEN NULL
            ELSE TRY_CAST(CAST(year_of_birth AS VARCHAR) || '-' || CAST(coalesce(month_of_birth, 1) AS VARCHAR)
                          || '-' || CAST(coalesce(day_of_birth, 1) AS VARCHAR) AS DATE) END AS date_of_birth
FROM enriched""")

# Whole years by Spark's months_between: month difference, plus day
# difference / 31 unless the days match or both dates end their month.
_AGE = """
CAST(CASE WHEN floor(((year(first_pos_pcr_antigen_date) - year(date_of_birth)) * 12
                      + (month(first_pos_pcr_antigen_date) - month(date_of_birth))
                      + CASE WHEN day(first_pos_pcr_antigen_date) = day(date_of_birth)
                               OR (first_pos_pcr_antigen_date = last_day(first_pos_pcr_antigen_date)
                                   AND date_of_birth = last_day(date_of_birth)) THEN 0
                             ELSE (day(first_pos_pcr_antigen_date) - day(date_of_birth)) / 31.0 END) / 12.0) >= 0
          THEN floor(((year(first_pos_pcr_antigen_date) - year(date_of_birth)) * 12
                      + (month(first_pos_pcr_antigen_date) - month(date_of_birth))
                      + CASE WHEN day(first_pos_pcr_antigen_date) = day(date_of_birth)
                               OR (first_pos_pcr_antigen_date = last_day(first_pos_pcr_antigen_date)
                                   AND date_of_birth = last_day(date_of_birth)) THEN 0
                             ELSE (day(first_pos_pcr_antigen_date) - day(date_of_birth)) / 31.0 END) / 12.0)
     END AS BIGINT)"""

_GENDER = """
CASE WHEN upper(gender_concept_name) = 'MALE' THEN 'MALE'
     WHEN upper(gender_concept_name) = 'FEMALE' THEN 'FEMALE'
     ELSE 'UNKNOWN' END"""

# The race categories and the words that decide them.
_NHPI = "'Native Hawaiian or Other Pacific Islander Non-Hispanic'"
_ASIAN_WORDS = [
    "Filipino", "Chinese", "Korean", "Vietnamese", "Japanese", "Bangladeshi", "Pakistani",
    "Nepalese", "Laotian", "Taiwanese", "Thai", "Sri Lankan", "Burmese", "Okinawan",
    "Cambodian", "Bhutanese", "Singaporean", "Hmong", "Malaysian", "Indonesian",
]
_RACE = (
    "\nCASE WHEN ethnicity_concept_name = 'Hispanic or Latino' THEN 'Hispanic or Latino Any Race'"
    "\n     WHEN strpos(race_concept_name, 'Hispanic') > 0 THEN 'Hispanic or Latino Any Race'"
    "\n     WHEN strpos(race_concept_name, 'Black') > 0 THEN 'Black or African American Non-Hispanic'"
    "\n     WHEN race_concept_name = 'African American' THEN 'Black or African American Non-Hispanic'"
    "\n     WHEN strpos(race_concept_name, 'White') > 0 THEN 'White Non-Hispanic'"
    "\n     WHEN race_concept_name = 'Asian or Pacific Islander' THEN 'Unknown'"
    "\n     WHEN strpos(race_concept_name, 'Asian Indian') > 0 THEN 'Asian Indian'"
    "\n     WHEN strpos(race_concept_name, 'Asian') > 0 THEN 'Asian Non-Hispanic'"
    + "".join(f"\n     WHEN strpos(race_concept_name, '{w}') > 0 THEN 'Asian Non-Hispanic'" for w in _ASIAN_WORDS)
    + "".join(
        f"\n     WHEN strpos(race_concept_name, '{w}') > 0 THEN {_NHPI}"
        for w in ["Pacific", "Polynesian", "Native Hawaiian", "Micronesian", "Melanesian"]
    )
    + "\n     ELSE 'UNKNOWN' END"
)

_ZIP = """
CASE WHEN length(trim(zip)) >= 5 AND regexp_full_match(substr(trim(zip), 1, 5), '[0-9]{5}')
     THEN substr(trim(zip), 1, 5) END"""

CLEANED = ("cleaned", f"""
SELECT *, {_AGE} AS age_at_first_covid_diag,
       {_GENDER} AS gender,
       {_RACE} AS race_ethnicity,
       {_ZIP} AS zip_code
FROM with_dob""")

STAYS = ("stays", """
SELECT DISTINCT person_id, macrovisit_id, macrovisit_start_date, macrovisit_end_date
FROM visits WHERE macrovisit_id IS NOT NULL""")


def _first_stay(persons: str, name: str = "first_stay"):
    return (name, f"""
SELECT p.*, m.macrovisit_id AS first_covid_macrovisit_id,
       m.macrovisit_start_date AS first_covid_macrovisit_start_date,
       m.macrovisit_end_date AS first_covid_macrovisit_end_date,
       CASE WHEN m.macrovisit_id IS NOT NULL THEN 1 ELSE 0 END AS covid_associated_hosp
FROM {persons} p
LEFT JOIN (
  SELECT * FROM (
    SELECT s.person_id, s.macrovisit_id, s.macrovisit_start_date, s.macrovisit_end_date,
           row_number() OVER (PARTITION BY s.person_id
                              ORDER BY s.macrovisit_start_date, s.macrovisit_id, s.macrovisit_end_date NULLS FIRST) AS rn
    FROM stays s JOIN {persons} q ON s.person_id = q.person_id
    WHERE s.macrovisit_start_date >= q.first_pos_pcr_antigen_date - 1
      AND s.macrovisit_start_date <= q.first_pos_pcr_antigen_date + 16
      AND q.first_pos_pcr_antigen_date <= s.macrovisit_end_date
  ) WHERE rn = 1
) m ON p.person_id = m.person_id""")


FACT = ("fact", """
SELECT h.*, d.death_date, CASE WHEN d.death_date IS NOT NULL THEN 1 ELSE 0 END AS death_recorded
FROM first_stay h
LEFT JOIN (SELECT person_id, max(death_date) AS death_date FROM death GROUP BY person_id) d
  ON h.person_id = d.person_id""")

FACT_VIEWS = ("cohort", "person_lds", "location", "manifest", "visits", "death")
FACT_STEPS = [ENRICHED, WITH_DOB, CLEANED, STAYS, _first_stay("cleaned"), FACT]

CONCEPTS = ("concepts", """
SELECT DISTINCT m.concept_id, s.column_name
FROM concept_set_members m JOIN our_concept_sets s ON m.concept_set_name = s.concept_set_name
WHERE m.is_most_recent_version = 'true' AND contains(s.domain, 'condition_occurrence') AND s.comorbidity = 1""")

FIRST_COMORBIDITY = ("first_comorbidity", """
SELECT * FROM (
  SELECT c.person_id, k.column_name AS comorbidity, c.condition_start_date AS comorbidity_start_date,
         p.first_pos_pcr_antigen_date, c.condition_occurrence_id, c.condition_source_value,
         row_number() OVER (PARTITION BY c.person_id, k.column_name
                            ORDER BY c.condition_start_date, c.condition_occurrence_id NULLS FIRST,
                                     c.condition_source_value NULLS FIRST) AS rn
  FROM condition_occurrence c
  JOIN cohort p ON c.person_id = p.person_id
  JOIN concepts k ON c.condition_concept_id = k.concept_id
  WHERE c.condition_start_date IS NOT NULL
) WHERE rn = 1""")

ER_IDS = ("er_ids", """
SELECT DISTINCT concept_id FROM concept_set_members
WHERE is_most_recent_version = 'true'
  AND concept_set_name IN (SELECT concept_set_name FROM our_concept_sets WHERE er_only_visit = 1)""")


def _er(mode: str, name: str = "er"):
    if mode == "either":
        test = "date_diff('day', v.visit_start_date, p.first_poslab_or_diagnosis_date) BETWEEN -16 AND 1"
    else:
        test = ("date_diff('day', v.visit_start_date, p.first_pos_pcr_antigen_date) BETWEEN -16 AND 1\n"
                "  AND date_diff('day', p.first_pos_diagnosis_date, p.first_pos_pcr_antigen_date) BETWEEN -16 AND 1")
    return (name, f"""
SELECT person_id, min(covid_ER_only_start_date) AS first_covid_er_only_start_date
FROM (
  SELECT DISTINCT v.person_id, v.visit_start_date AS covid_ER_only_start_date
  FROM visits v JOIN cohort p ON v.person_id = p.person_id
  WHERE v.macrovisit_start_date IS NULL
    AND v.visit_concept_id IN (SELECT concept_id FROM er_ids)
    AND {test}
) GROUP BY person_id""")


def _hosp(mode: str, name: str = "hosp"):
    if mode == "either":
        test = "date_diff('day', v.macrovisit_start_date, p.first_poslab_or_diagnosis_date) BETWEEN -16 AND 1"
    else:
        test = ("date_diff('day', v.macrovisit_start_date, p.first_pos_pcr_antigen_date) BETWEEN -16 AND 1\n"
                "  AND date_diff('day', p.first_pos_diagnosis_date, p.first_pos_pcr_antigen_date) BETWEEN -16 AND 1")
    return (name, f"""
SELECT person_id, macrovisit_id,
       covid_hospitalization_start_date AS first_COVID_hospitalization_start_date,
       covid_hospitalization_end_date AS first_COVID_hospitalization_end_date
FROM (
  SELECT h.*, row_number() OVER (PARTITION BY person_id
                                 ORDER BY covid_hospitalization_start_date, macrovisit_id NULLS FIRST,
                                          covid_hospitalization_end_date NULLS FIRST) AS rn
  FROM (
    SELECT DISTINCT v.person_id, v.macrovisit_id, v.macrovisit_start_date AS covid_hospitalization_start_date,
           v.macrovisit_end_date AS covid_hospitalization_end_date
    FROM visits v JOIN cohort p ON v.person_id = p.person_id
    WHERE v.macrovisit_start_date IS NOT NULL AND {test}
  ) h
) WHERE rn = 1""")


HOSP_ONLY = ("hosp_only", """
SELECT p.*, h.macrovisit_id, h.first_COVID_hospitalization_start_date, h.first_COVID_hospitalization_end_date
FROM cohort p LEFT JOIN hosp h ON p.person_id = h.person_id""")

FIRST_VISITS = ("first_visits", """
SELECT p.*, f.macrovisit_id, f.first_COVID_hospitalization_start_date,
       f.first_COVID_hospitalization_end_date, f.first_covid_er_only_start_date
FROM cohort p
LEFT JOIN (
  SELECT coalesce(h.person_id, e.person_id) AS person_id, h.macrovisit_id,
         h.first_COVID_hospitalization_start_date, h.first_COVID_hospitalization_end_date,
         e.first_covid_er_only_start_date
  FROM hosp h FULL OUTER JOIN er e ON h.person_id = e.person_id
) f ON p.person_id = f.person_id""")

ZIP_AREA = ("zip_area", """
SELECT z.*, x.ZIP_CODE AS zipcode
FROM zcta_pct z JOIN zip_zcta x ON z.ZCTA = x.ZCTA""")

SDOH = ("sdoh", """
SELECT f.zip_code, f.person_id, a.*
FROM fact f LEFT JOIN zip_area a ON f.zip_code = a.zipcode""")

MDS = ("mds", """
SELECT s.*, sf.MDs
FROM sdoh s LEFT JOIN summary_facts sf ON s.person_id = sf.person_id""")

_SDOH_COLS = [
    "African_American", "AIAN", "Asian", "NHPI", "White", "other_race",
    "two_or_more_races", "Hispanic_any_race", "male", "female",
    "age_18_and_under", "age_18_and_over", "age_65plus",
]

CODES = ("codes", """
SELECT macrovisit_id, count(visit_concept_id) AS multi_inpatient_codes
FROM visits WHERE macrovisit_id IS NOT NULL AND visit_concept_id = 9201
GROUP BY macrovisit_id""")

_DETAIL = ("person_id, macrovisit_id, visit_occurrence_id, visit_concept_id, visit_concept_name, "
           "visit_start_date, visit_end_date, macrovisit_start_date, macrovisit_end_date")

AREA_VIEWS = FACT_VIEWS + ("zcta_pct", "zip_zcta")


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["cohort_sample"] = with_views("""
SELECT * FROM cohort
WHERE CAST(('0x' || substr(md5('111:' || person_id), 1, 8)) AS BIGINT) % 1000000 < 500000""", "cohort")
    q["enrich_person"] = with_views("SELECT * FROM enriched", *FACT_VIEWS[:4], local=[ENRICHED])
    dob_steps = [ENRICHED, WITH_DOB]
    q["age_at_index"] = with_views(f"""
SELECT person_id, year_of_birth, month_of_birth, day_of_birth, first_pos_pcr_antigen_date, date_of_birth,
       {_AGE} AS age_at_first_covid_diag
FROM with_dob""", *FACT_VIEWS[:4], local=dob_steps)
    q["gender_std"] = with_views(f"SELECT person_id, gender_concept_name, {_GENDER} AS gender FROM enriched",
                                 *FACT_VIEWS[:4], local=[ENRICHED])
    q["race_rules"] = with_views(
        f"SELECT person_id, ethnicity_concept_name, race_concept_name, {_RACE} AS race_ethnicity FROM enriched",
        *FACT_VIEWS[:4], local=[ENRICHED])
    q["clean_zip"] = with_views(f"SELECT person_id, zip, {_ZIP} AS zip_code FROM enriched",
                                *FACT_VIEWS[:4], local=[ENRICHED])
    q["clean_person"] = with_views("SELECT * FROM cleaned", *FACT_VIEWS[:4], local=[ENRICHED, WITH_DOB, CLEANED])
    q["resolve_concepts"] = with_views("SELECT * FROM concepts", "our_concept_sets", "concept_set_members",
                                       local=[CONCEPTS])
    cm_views = ("cohort", "our_concept_sets", "concept_set_members", "condition_occurrence")
    q["first_event"] = with_views("""
SELECT person_id, comorbidity, comorbidity_start_date, first_pos_pcr_antigen_date,
       condition_occurrence_id, condition_source_value
FROM first_comorbidity""", *cm_views, local=[CONCEPTS, FIRST_COMORBIDITY])
    q["comorbidity_pivot"] = with_views("""
SELECT person_id,
       max(comorbidity_start_date) FILTER (WHERE comorbidity = 'economy') AS economy_start,
       max(condition_occurrence_id) FILTER (WHERE comorbidity = 'economy') AS economy_c_occ_id,
       max(comorbidity_start_date) FILTER (WHERE comorbidity = 'large') AS large_start,
       max(condition_occurrence_id) FILTER (WHERE comorbidity = 'large') AS large_c_occ_id,
       max(comorbidity_start_date) FILTER (WHERE comorbidity = 'small') AS small_start,
       max(condition_occurrence_id) FILTER (WHERE comorbidity = 'small') AS small_c_occ_id
FROM first_comorbidity GROUP BY person_id""", *cm_views, local=[CONCEPTS, FIRST_COMORBIDITY])
    q["first_stay_near_index"] = with_views("SELECT * FROM first_stay", "cohort", "visits",
                                            local=[STAYS, _first_stay("cohort")])
    er_views = ("cohort", "visits", "our_concept_sets", "concept_set_members")
    q["er_visits"] = with_views("SELECT * FROM er", *er_views, local=[ER_IDS, _er("either")])
    q["er_visits_both"] = with_views("SELECT * FROM er", *er_views, local=[ER_IDS, _er("both")])
    q["stay_either"] = with_views("SELECT * FROM hosp", "cohort", "visits", local=[_hosp("either")])
    q["stay_both"] = with_views("SELECT * FROM hosp", "cohort", "visits", local=[_hosp("both")])
    fv_steps = [ER_IDS, _er("either"), _hosp("either"), FIRST_VISITS]
    q["first_visits"] = with_views("SELECT * FROM first_visits", *er_views, local=fv_steps)
    q["first_visits_outer"] = q["first_visits"]
    q["first_visits_at_times"] = q["first_visits"]
    q["first_visits_both"] = with_views("SELECT * FROM first_visits", *er_views,
                                        local=[ER_IDS, _er("both"), _hosp("both"), FIRST_VISITS])
    q["first_visits_hosp_only"] = with_views("SELECT * FROM hosp_only", "cohort", "visits",
                                             local=[_hosp("either"), HOSP_ONLY])
    q["stays_after_index"] = with_views("""
SELECT person_id, first_poslab_or_diagnosis_date, first_COVID_hospitalization_start_date,
       first_COVID_hospitalization_end_date, macrovisit_id, macrovisit_start_date, macrovisit_end_date
FROM (
  SELECT u.*, row_number() OVER (PARTITION BY person_id, macrovisit_id
                                 ORDER BY macrovisit_start_date, macrovisit_end_date NULLS FIRST) AS rn
  FROM (
    SELECT f.person_id, f.first_poslab_or_diagnosis_date, f.first_COVID_hospitalization_start_date,
           f.first_COVID_hospitalization_end_date, m.macrovisit_id, m.macrovisit_start_date, m.macrovisit_end_date
    FROM first_visits f JOIN visits m ON f.person_id = m.person_id
    WHERE m.macrovisit_id IS NOT NULL AND f.first_COVID_hospitalization_start_date IS NOT NULL
      AND f.first_COVID_hospitalization_start_date < m.macrovisit_start_date
    UNION ALL
    SELECT f.person_id, f.first_poslab_or_diagnosis_date, f.first_COVID_hospitalization_start_date,
           f.first_COVID_hospitalization_end_date, m.macrovisit_id, m.macrovisit_start_date, m.macrovisit_end_date
    FROM first_visits f JOIN visits m ON f.person_id = m.person_id
    WHERE m.macrovisit_id IS NOT NULL AND f.first_COVID_hospitalization_start_date IS NULL
      AND f.first_poslab_or_diagnosis_date < m.macrovisit_start_date
  ) u
) WHERE rn = 1""", *er_views, local=fv_steps)
    q["stays_after_index_union"] = q["stays_after_index"]
    q["stays_after_index_counts"] = f"""
SELECT count(*) FILTER (WHERE first_COVID_hospitalization_start_date IS NOT NULL) AS after_stay_rows,
       count(*) FILTER (WHERE first_COVID_hospitalization_start_date IS NULL) AS after_index_rows,
       count(*) AS rows
FROM ({q["stays_after_index"]}) s"""
    q["latest_event"] = with_views("""
SELECT c.*, d.death_date, CASE WHEN d.death_date IS NOT NULL THEN 1 ELSE 0 END AS death_recorded
FROM cohort c LEFT JOIN (SELECT person_id, max(death_date) AS death_date FROM death GROUP BY person_id) d
  ON c.person_id = d.person_id""", "cohort", "death")
    q["latest_event_fanout"] = with_views("""
SELECT c.*, d.death_date, CASE WHEN d.death_date IS NOT NULL THEN 1 ELSE 0 END AS death_recorded
FROM cohort c LEFT JOIN (
  SELECT person_id, max(death_date) OVER (PARTITION BY person_id) AS death_date
  FROM (SELECT DISTINCT x.person_id, x.death_date FROM death x JOIN cohort y ON x.person_id = y.person_id)
) d ON c.person_id = d.person_id""", "cohort", "death")
    q["person_fact"] = with_views("SELECT * FROM fact", *FACT_VIEWS, local=FACT_STEPS)
    q["person_fact_written"] = q["person_fact_colocated"] = q["person_fact"]
    q["person_fact_sample"] = with_views(
        "SELECT * FROM fact", *FACT_VIEWS,
        local=[SAMPLED, _enriched("sampled"), WITH_DOB, CLEANED, STAYS, _first_stay("cleaned"), FACT])
    q["zip_area"] = with_views("SELECT * FROM zip_area", "zcta_pct", "zip_zcta", local=[ZIP_AREA])
    q["attach_area"] = with_views("SELECT * FROM sdoh", *AREA_VIEWS, local=FACT_STEPS + [ZIP_AREA, SDOH])
    q["unmatched_zips"] = with_views("""
SELECT DISTINCT f.city, f.state, f.zip, a.ZCTA
FROM fact f LEFT JOIN zip_area a ON f.zip_code = a.zipcode
WHERE a.ZCTA IS NULL""", *AREA_VIEWS, local=FACT_STEPS + [ZIP_AREA])
    mds_views = AREA_VIEWS + ("summary_facts",)
    q["attach_mds"] = with_views("SELECT * FROM mds", *mds_views, local=FACT_STEPS + [ZIP_AREA, SDOH, MDS])
    casts = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _SDOH_COLS)
    q["cast_sdoh"] = with_views(f"SELECT * REPLACE ({casts}) FROM mds", *mds_views,
                                local=FACT_STEPS + [ZIP_AREA, SDOH, MDS])
    q["attach_severity"] = with_views("""
SELECT f.*, s.Severity_Type, s.data_partner_id AS sev_data_partner_id,
       s.visit_start_date AS sev_visit_start_date, s.visit_occurrence_id AS sev_visit_occurrence_id,
       s.AKI_in_hospital, s.ECMO, s.Invasive_Ventilation, s.Q_Score, s.BMI, s.Height, s.Weight,
       s.blood_type, s.smoking_status
FROM fact f LEFT JOIN severity s ON f.person_id = s.person_id""", *FACT_VIEWS, "severity", local=FACT_STEPS)
    q["codes_per_stay"] = with_views("SELECT * FROM codes", "visits", local=[CODES])
    q["stay_drilldown"] = with_views(f"""
SELECT {_DETAIL} FROM visits
WHERE macrovisit_id IN (SELECT macrovisit_id FROM codes WHERE multi_inpatient_codes >= 2)""", "visits",
                                     local=[CODES])
    q["person_stays"] = with_views(f"""
SELECT {_DETAIL} FROM visits
WHERE macrovisit_id IS NOT NULL
  AND person_id IN (SELECT person_id FROM first_stay WHERE covid_associated_hosp = 1)""", "cohort", "visits",
                                   local=[STAYS, _first_stay("cohort")])
    q["zip_counts"] = with_views("SELECT zip_code, count(*) AS count FROM fact GROUP BY zip_code",
                                 *FACT_VIEWS, local=FACT_STEPS)
    q["zip_counts_raw"] = with_views("SELECT zip, count(*) AS count FROM enriched GROUP BY zip",
                                     *FACT_VIEWS[:4], local=[ENRICHED])
    q["distinct_starts"] = with_views("""
SELECT macrovisit_id, count(DISTINCT macrovisit_start_date) AS distinct_start_dates
FROM visits WHERE macrovisit_id IS NOT NULL GROUP BY macrovisit_id""", "visits")
    return q


ORACLE_SQL: dict[str, str] = _sql()
