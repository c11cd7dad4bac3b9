"""The fixture views of FIXTURES.md as DuckDB SQL, for the oracle queries.

Hand-written from the rules in FIXTURES.md, independently of the Spark
derivation in ``cohortkit.sources.fixtures``. The driver registers the
TPC-H-style tables as views; these CTEs shape them into the reference's
inputs.
"""

from __future__ import annotations

_SDOH = [
    "African_American", "AIAN", "Asian", "NHPI", "White", "other_race",
    "two_or_more_races", "Hispanic_any_race", "male", "female",
    "age_18_and_under", "age_18_and_over", "age_65plus",
]


def _sdoh_select() -> str:
    parts = []
    for k, name in enumerate(_SDOH):
        parts.append(
            f"CASE (s_suppkey + {k}) % 7 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN NULL "
            f"ELSE CAST((s_suppkey * 7 + {k * 3}) % 100 AS VARCHAR) || '.5' END AS {name}"
        )
    return ",\n       ".join(parts)


VIEWS: dict[str, str] = {
    "cohort": """
SELECT CAST(c_custkey AS VARCHAR) AS person_id,
       lab AS first_pos_pcr_antigen_date,
       dx AS first_pos_diagnosis_date,
       least(lab, dx) AS first_poslab_or_diagnosis_date
FROM (
  SELECT c_custkey,
         CASE WHEN c_custkey % 19 = 0 THEN NULL
              ELSE DATE '2020-03-01' + CAST((c_custkey * 37) % 120 AS INTEGER) END AS lab,
         CASE WHEN c_custkey % 3 = 0 THEN NULL
              ELSE DATE '2020-03-01' + CAST((c_custkey * 37) % 120 + (c_custkey * 7) % 40 - 20 AS INTEGER) END AS dx
  FROM customer
) c""",
    "race_labels": """
SELECT * FROM (VALUES
  (0, 'Hispanic'), (1, 'White Hispanic'), (2, 'Black or African American'), (3, 'Black'),
  (4, 'African American'), (5, 'White'), (6, 'Asian or Pacific Islander'), (7, 'Asian Indian'),
  (8, 'Asian'), (9, 'Filipino'), (10, 'Chinese'), (11, 'Korean'), (12, 'Vietnamese'),
  (13, 'Japanese'), (14, 'Bangladeshi'), (15, 'Pakistani'), (16, 'Nepalese'), (17, 'Laotian'),
  (18, 'Taiwanese'), (19, 'Thai'), (20, 'Sri Lankan'), (21, 'Burmese'), (22, 'Okinawan'),
  (23, 'Cambodian'), (24, 'Bhutanese'), (25, 'Singaporean'), (26, 'Hmong'), (27, 'Malaysian'),
  (28, 'Indonesian'), (29, 'Native Hawaiian or Other Pacific Islander'), (30, 'Polynesian'),
  (31, 'Native Hawaiian'), (32, 'Micronesian'), (33, 'Melanesian'), (34, 'West Indian'),
  (35, 'Barbadian'), (36, 'African'), (37, 'black'), (38, 'Other Race'), (39, 'Multiple races')
) AS t(label_no, label)""",
    "person_lds": """
SELECT CASE WHEN c.c_custkey % 23 <> 0 THEN '' ELSE 'u' END || CAST(c.c_custkey AS VARCHAR) AS person_id,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE CAST(1925 + (c.c_custkey * 11) % 97 AS INTEGER) END AS year_of_birth,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE CAST(1 + c.c_custkey % 12 AS INTEGER) END AS month_of_birth,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CAST(1 + (c.c_custkey * 5) % 31 AS INTEGER) END AS day_of_birth,
       CASE c.c_custkey % 9 WHEN 0 THEN 'Hispanic or Latino' WHEN 1 THEN NULL
            ELSE 'Not Hispanic or Latino' END AS ethnicity_concept_name,
       r.label AS race_concept_name,
       CASE c.c_custkey % 6 WHEN 0 THEN 'MALE' WHEN 1 THEN 'female' WHEN 2 THEN 'Male'
            WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'OTHER' ELSE NULL END AS gender_concept_name,
       CAST(c.c_nationkey AS VARCHAR) AS location_id,
       CAST(c.c_custkey % 7 AS VARCHAR) AS data_partner_id
FROM customer c LEFT JOIN race_labels r ON r.label_no = c.c_custkey % 41""",
    "location": """
SELECT CAST(n_nationkey AS VARCHAR) AS location_id,
       n_name AS city,
       r_name AS state,
       CASE n_nationkey % 5
            WHEN 0 THEN '  ' || CAST(10000 + 37 * n_nationkey AS VARCHAR) || ' '
            WHEN 1 THEN CAST(10000 + 37 * n_nationkey AS VARCHAR) || '-1234'
            WHEN 2 THEN '2770'
            WHEN 3 THEN '2770A'
            ELSE CAST(10000 + 37 * n_nationkey AS VARCHAR) END AS zip,
       'COUNTY_' || CAST(n_regionkey AS VARCHAR) AS county
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "manifest": """
SELECT CAST(s_suppkey AS VARCHAR) AS data_partner_id,
       DATE '2022-01-01' + CAST(s_suppkey % 100 AS INTEGER) AS run_date,
       CASE s_suppkey % 3 WHEN 0 THEN 'OMOP' WHEN 1 THEN 'PCORNET' ELSE 'ACT' END AS cdm_name,
       '5.3.1' AS cdm_version,
       CASE s_suppkey % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS shift_date_yn,
       CAST(s_suppkey % 8 AS INTEGER) AS max_num_shift_days
FROM supplier""",
    "visits": """
SELECT CAST(o.o_custkey AS VARCHAR) AS person_id,
       l.l_orderkey * 10 + l.l_linenumber AS visit_occurrence_id,
       CAST(CASE l.l_linenumber % 4 WHEN 0 THEN 9201 WHEN 1 THEN 9203 WHEN 2 THEN 9202 ELSE 262 END AS INTEGER) AS visit_concept_id,
       CASE l.l_linenumber % 4 WHEN 0 THEN 'Inpatient Visit' WHEN 1 THEN 'Emergency Room Visit'
            WHEN 2 THEN 'Outpatient Visit' ELSE 'ER and Inpatient Visit' END AS visit_concept_name,
       DATE '2020-03-01' + CAST((o.o_custkey * 37) % 120 + (o.o_orderkey * 13) % 60 - 20 + l.l_linenumber % 3 AS INTEGER) AS visit_start_date,
       DATE '2020-03-01' + CAST((o.o_custkey * 37) % 120 + (o.o_orderkey * 13) % 60 - 20 + l.l_linenumber % 3 AS INTEGER)
           + CAST(l.l_linenumber AS INTEGER) AS visit_end_date,
       CASE WHEN o.o_orderkey % 3 <> 0 THEN CAST(o.o_orderkey AS VARCHAR) || '_1' END AS macrovisit_id,
       CASE WHEN o.o_orderkey % 3 <> 0
            THEN DATE '2020-03-01' + CAST((o.o_custkey * 37) % 120 + (o.o_orderkey * 13) % 60 - 20 AS INTEGER) END AS macrovisit_start_date,
       CASE WHEN o.o_orderkey % 3 <> 0 AND o.o_orderkey % 10 <> 1
            THEN DATE '2020-03-01' + CAST((o.o_custkey * 37) % 120 + (o.o_orderkey * 13) % 60 - 20 + o.o_orderkey % 9 AS INTEGER) END AS macrovisit_end_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "our_concept_sets": """
SELECT * FROM (VALUES
  ('ECONOMY', 'economy', 'condition_occurrence', 1, 0),
  ('SMALL', 'small', 'condition_occurrence,observation', 1, 0),
  ('MEDIUM', 'medium', 'drug_exposure', 1, 0),
  ('PROMO', 'promo', 'condition_occurrence', 0, 0),
  ('LARGE', 'large', 'condition_occurrence', 1, 0),
  ('ER_SET', 'er', 'visit', 0, 1)
) AS t(concept_set_name, column_name, domain, comorbidity, er_only_visit)""",
    "concept_set_members": """
SELECT p_partkey AS concept_id, p_type AS concept_set_name,
       CASE WHEN p_size % 4 = 0 THEN 'false' ELSE 'true' END AS is_most_recent_version
FROM part
UNION ALL
SELECT * FROM (VALUES (9203::BIGINT, 'ER_SET', 'true'), (9202::BIGINT, 'ER_SET', 'false'), (262::BIGINT, 'ER_SET', 'true'))
  AS t(concept_id, concept_set_name, is_most_recent_version)""",
    "condition_occurrence": """
SELECT CAST(o.o_custkey AS VARCHAR) AS person_id,
       CASE WHEN l.l_linenumber = 7 THEN NULL
            ELSE DATE '2015-01-01' + CAST((l.l_orderkey * 31 + l.l_partkey) % 400 AS INTEGER) END AS condition_start_date,
       l.l_partkey AS condition_concept_id,
       l.l_orderkey * 10 + l.l_linenumber AS condition_occurrence_id,
       l.l_returnflag || l.l_linestatus AS condition_source_value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "death": """
SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 5 = 0 THEN '' ELSE 'd' END || CAST(o_custkey AS VARCHAR) AS person_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE DATE '2020-06-01' + CAST(o_orderkey % 90 AS INTEGER) END AS death_date
FROM orders""",
    "zcta_pct": f"""
SELECT CAST(20000 + s_suppkey AS VARCHAR) AS ZCTA,
       {_sdoh_select()}
FROM supplier
UNION ALL
SELECT '19999', {", ".join("'1.0'" for _ in _SDOH)}""",
    "zip_zcta": """
SELECT CASE WHEN s_suppkey % 5 <> 4 THEN '' ELSE 'z' END || CAST(10000 + 37 * s_suppkey AS VARCHAR) AS ZIP_CODE,
       CAST(20000 + s_suppkey % 15 AS VARCHAR) AS ZCTA
FROM supplier
UNION ALL SELECT '10000', '19999'""",
    "summary_facts": """
SELECT CASE WHEN c_custkey % 4 <> 0 THEN '' ELSE 's' END || CAST(c_custkey AS VARCHAR) AS person_id, CAST(c_custkey % 50 AS INTEGER) AS MDs
FROM customer""",
    "severity": """
SELECT CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'v' END || CAST(c_custkey AS VARCHAR) AS person_id,
       CASE c_custkey % 4 WHEN 0 THEN 'Mild' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'Severe' ELSE 'Mild_ED' END AS Severity_Type,
       CAST(c_custkey % 7 AS VARCHAR) AS data_partner_id,
       DATE '2020-03-01' + CAST(c_custkey % 200 AS INTEGER) AS visit_start_date,
       c_custkey * 10 AS visit_occurrence_id,
       CAST(c_custkey % 2 AS INTEGER) AS AKI_in_hospital,
       CAST(CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END AS INTEGER) AS ECMO,
       CAST(c_custkey % 3 AS INTEGER) AS Invasive_Ventilation,
       CAST(c_custkey % 10 AS INTEGER) AS Q_Score,
       CAST(18 + c_custkey % 20 AS DOUBLE) AS BMI,
       CAST(150 + c_custkey % 40 AS DOUBLE) AS Height,
       CAST(50 + c_custkey % 60 AS DOUBLE) AS Weight,
       'A' AS blood_type,
       'Non smoker' AS smoking_status
FROM customer""",
}

# Views other views read from.
_DEPENDS = {"person_lds": ["race_labels"]}


def with_views(body: str, *names: str, local: list[tuple[str, str]] | None = None) -> str:
    """``WITH <views>, <local CTEs> <body>``: prefix a query with the fixture
    views it reads, then the query's own named steps in order."""
    ordered: list[str] = []
    for name in names:
        for dep in _DEPENDS.get(name, []):
            if dep not in ordered:
                ordered.append(dep)
        if name not in ordered:
            ordered.append(name)
    steps = [(n, VIEWS[n]) for n in ordered] + list(local or [])
    ctes = ",\n".join(f"{n} AS ({sql.strip()})" for n, sql in steps)
    return f"WITH {ctes}\n{body.strip()}"
