"""Stand-in inputs in the schemas the operators expect, derived from the
driver's TPC-H-style tables by the rules written down in FIXTURES.md.

These views only shape rows: keys are cast to strings, dates are built from
key arithmetic, some values are left null. They do none of the operators'
work, and no operator relies on how they are made.

``Inputs`` builds each view lazily from one table directory, so a query only
scans the tables it needs.
"""

from __future__ import annotations

import datetime as _dt
import weakref
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import read_table

# Fixed values of the fixture rules (FIXTURES.md section 2), in the order given there.
GENDER_BY_KEY_MOD_6 = ["MALE", "female", "Male", "FEMALE", "OTHER", None]
RACE_BY_KEY_MOD_41 = [
    "Hispanic", "White Hispanic", "Black or African American", "Black",
    "African American", "White", "Asian or Pacific Islander", "Asian Indian",
    "Asian", "Filipino", "Chinese", "Korean", "Vietnamese", "Japanese",
    "Bangladeshi", "Pakistani", "Nepalese", "Laotian", "Taiwanese", "Thai",
    "Sri Lankan", "Burmese", "Okinawan", "Cambodian", "Bhutanese", "Singaporean",
    "Hmong", "Malaysian", "Indonesian",
    "Native Hawaiian or Other Pacific Islander", "Polynesian", "Native Hawaiian",
    "Micronesian", "Melanesian", "West Indian", "Barbadian", "African", "black",
    "Other Race", "Multiple races", None,
]
VISIT_CONCEPT_BY_LINE_MOD_4 = [9201, 9203, 9202, 262]
VISIT_NAME_BY_LINE_MOD_4 = [
    "Inpatient Visit", "Emergency Room Visit", "Outpatient Visit", "ER and Inpatient Visit",
]
CDM_NAME_BY_KEY_MOD_3 = ["OMOP", "PCORNET", "ACT"]
SEVERITY_BY_KEY_MOD_4 = ["Mild", "Moderate", "Severe", "Mild_ED"]
# (concept_set_name, column_name, domain, comorbidity, er_only_visit)
OUR_CONCEPT_SETS = [
    ("ECONOMY", "economy", "condition_occurrence", 1, 0),
    ("SMALL", "small", "condition_occurrence,observation", 1, 0),
    ("MEDIUM", "medium", "drug_exposure", 1, 0),
    ("PROMO", "promo", "condition_occurrence", 0, 0),
    ("LARGE", "large", "condition_occurrence", 1, 0),
    ("ER_SET", "er", "visit", 0, 1),
]
# (concept_id, concept_set_name, is_most_recent_version) added to the part-derived members
EXTRA_CONCEPT_SET_MEMBERS = [
    (9203, "ER_SET", "true"),
    (9202, "ER_SET", "false"),
    (262, "ER_SET", "true"),
]
EXTRA_ZCTA = "19999"  # the second area of ZIP 10000 (outside the supplier-derived range)
SDOH_COLUMNS = [
    "African_American", "AIAN", "Asian", "NHPI", "White", "other_race",
    "two_or_more_races", "Hispanic_any_race", "male", "female",
    "age_18_and_under", "age_18_and_over", "age_65plus",
]
COHORT_EPOCH = _dt.date(2020, 3, 1)
CONDITION_EPOCH = _dt.date(2015, 1, 1)
DEATH_EPOCH = _dt.date(2020, 6, 1)
MANIFEST_EPOCH = _dt.date(2022, 1, 1)


def _pick(values: list, index: Column, dtype: str = "string") -> Column:
    """``values[index]`` for a small fixed list (null entries allowed)."""
    return F.array(*[F.lit(v).cast(dtype) for v in values])[index.cast("int")]


def _days_after(epoch: _dt.date, n: Column) -> Column:
    return F.date_add(F.lit(epoch), n.cast("int"))


def _key_or_other(known: Column, letter: str, key: Column) -> Column:
    """The key as text where ``known``; elsewhere with a letter before it, so that it matches nothing."""
    text = key.cast("string")
    return F.when(known, text).otherwise(F.concat(F.lit(letter), text))


def _cohort_base(custkey: Column) -> Column:
    return (custkey * 37) % 120


class Inputs:
    """The reference's named inputs, derived from one table directory."""

    _defined: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self.identity = f"fixtures of {base_dir}"

    @classmethod
    def of(cls, spark: SparkSession, base_dir: str) -> Inputs:
        """The session's ``Inputs`` for ``base_dir``, defined once per session.

        Only the lazy view definitions are kept (no data, no cache): every
        query still reads the files when it runs.
        """
        per_session = cls._defined.setdefault(spark, {})
        if base_dir not in per_session:
            per_session[base_dir] = cls(spark, base_dir)
        return per_session[base_dir]

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base_dir, name)

    @cached_property
    def cohort(self) -> DataFrame:
        """One row per person with the index dates (first test, first diagnosis, earlier of both)."""
        key = F.col("c_custkey")
        base = _cohort_base(key)
        lab = F.when(key % 19 == 0, F.lit(None)).otherwise(_days_after(COHORT_EPOCH, base))
        dx = F.when(key % 3 == 0, F.lit(None)).otherwise(
            _days_after(COHORT_EPOCH, base + (key * 7) % 40 - 20)
        )
        return self.table("customer").select(
            key.cast("string").alias("person_id"),
            lab.alias("first_pos_pcr_antigen_date"),
            dx.alias("first_pos_diagnosis_date"),
            F.least(lab, dx).alias("first_poslab_or_diagnosis_date"),
        )

    @cached_property
    def person_lds(self) -> DataFrame:
        key = F.col("c_custkey")
        ethnicity = (
            F.when(key % 9 == 0, F.lit("Hispanic or Latino"))
            .when(key % 9 == 1, F.lit(None).cast("string"))
            .otherwise(F.lit("Not Hispanic or Latino"))
        )
        return (
            self.table("customer")
            .select(
                _key_or_other(key % 23 != 0, "u", key).alias("person_id"),
                F.when(key % 17 == 0, F.lit(None)).otherwise(1925 + (key * 11) % 97).cast("int").alias("year_of_birth"),
                F.when(key % 13 == 0, F.lit(None)).otherwise(1 + key % 12).cast("int").alias("month_of_birth"),
                F.when(key % 11 == 0, F.lit(None)).otherwise(1 + (key * 5) % 31).cast("int").alias("day_of_birth"),
                ethnicity.alias("ethnicity_concept_name"),
                _pick(RACE_BY_KEY_MOD_41, key % 41).alias("race_concept_name"),
                _pick(GENDER_BY_KEY_MOD_6, key % 6).alias("gender_concept_name"),
                F.col("c_nationkey").cast("string").alias("location_id"),
                (key % 7).cast("string").alias("data_partner_id"),
            )
        )

    @cached_property
    def location(self) -> DataFrame:
        key = F.col("n_nationkey")
        z = (10000 + key * 37).cast("string")
        zip_ = (
            F.when(key % 5 == 0, F.concat(F.lit("  "), z, F.lit(" ")))
            .when(key % 5 == 1, F.concat(z, F.lit("-1234")))
            .when(key % 5 == 2, F.lit("2770"))
            .when(key % 5 == 3, F.lit("2770A"))
            .otherwise(z)
        )
        region = self.table("region")
        return self.table("nation").join(
            region, F.col("n_regionkey") == F.col("r_regionkey")
        ).select(
            key.cast("string").alias("location_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            zip_.alias("zip"),
            F.concat(F.lit("COUNTY_"), F.col("n_regionkey").cast("string")).alias("county"),
        )

    @cached_property
    def manifest(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.table("supplier")
            .select(
                key.cast("string").alias("data_partner_id"),
                _days_after(MANIFEST_EPOCH, key % 100).alias("run_date"),
                _pick(CDM_NAME_BY_KEY_MOD_3, key % 3).alias("cdm_name"),
                F.lit("5.3.1").alias("cdm_version"),
                F.when(key % 2 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("shift_date_yn"),
                (key % 8).cast("int").alias("max_num_shift_days"),
            )
        )

    def _lines_with_orders(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def visits(self) -> DataFrame:
        """Microvisits with their optional enclosing macrovisit (stay)."""
        order = F.col("o_orderkey")
        line = F.col("l_linenumber")
        offset = _cohort_base(F.col("o_custkey")) + (order * 13) % 60 - 20
        in_stay = order % 3 != 0
        stay_start = _days_after(COHORT_EPOCH, offset)
        stay_end = F.when(order % 10 == 1, F.lit(None)).otherwise(F.date_add(stay_start, (order % 9).cast("int")))
        visit_start = _days_after(COHORT_EPOCH, offset + line % 3)
        return self._lines_with_orders().select(
            F.col("o_custkey").cast("string").alias("person_id"),
            (order * 10 + line).alias("visit_occurrence_id"),
            _pick(VISIT_CONCEPT_BY_LINE_MOD_4, line % 4, "int").alias("visit_concept_id"),
            _pick(VISIT_NAME_BY_LINE_MOD_4, line % 4).alias("visit_concept_name"),
            visit_start.alias("visit_start_date"),
            F.date_add(visit_start, line).alias("visit_end_date"),
            F.when(in_stay, F.concat(order.cast("string"), F.lit("_1"))).alias("macrovisit_id"),
            F.when(in_stay, stay_start).alias("macrovisit_start_date"),
            F.when(in_stay, stay_end).alias("macrovisit_end_date"),
        )

    @cached_property
    def visits_at_times(self) -> DataFrame:
        """The visits with timestamp_ntz start columns at 10:00 and end columns at 23:59."""
        def at(c: str, clock: str) -> Column:
            return F.concat(F.col(c).cast("string"), F.lit(clock)).cast("timestamp_ntz").alias(c)

        times = {"visit_start_date": " 10:00:00", "macrovisit_start_date": " 10:00:00", "macrovisit_end_date": " 23:59:00"}
        return self.visits.select(*[at(c, times[c]) if c in times else F.col(c) for c in self.visits.columns])

    @cached_property
    def our_concept_sets(self) -> DataFrame:
        schema = T.StructType([
            T.StructField("concept_set_name", T.StringType()),
            T.StructField("column_name", T.StringType()),
            T.StructField("domain", T.StringType()),
            T.StructField("comorbidity", T.IntegerType()),
            T.StructField("er_only_visit", T.IntegerType()),
        ])
        return self.spark.createDataFrame(OUR_CONCEPT_SETS, schema)

    @cached_property
    def concept_set_members(self) -> DataFrame:
        from_parts = self.table("part").select(
            F.col("p_partkey").alias("concept_id"),
            F.col("p_type").alias("concept_set_name"),
            F.when(F.col("p_size") % 4 == 0, F.lit("false")).otherwise(F.lit("true")).alias("is_most_recent_version"),
        )
        extra = self.spark.createDataFrame(
            EXTRA_CONCEPT_SET_MEMBERS,
            "concept_id bigint, concept_set_name string, is_most_recent_version string",
        )
        return from_parts.unionByName(extra)

    @cached_property
    def condition_occurrence(self) -> DataFrame:
        order = F.col("l_orderkey")
        part = F.col("l_partkey")
        line = F.col("l_linenumber")
        return self._lines_with_orders().select(
            F.col("o_custkey").cast("string").alias("person_id"),
            F.when(line == 7, F.lit(None))
            .otherwise(_days_after(CONDITION_EPOCH, (order * 31 + part) % 400))
            .alias("condition_start_date"),
            part.alias("condition_concept_id"),
            (order * 10 + line).alias("condition_occurrence_id"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("condition_source_value"),
        )

    @cached_property
    def death(self) -> DataFrame:
        order = F.col("o_orderkey")
        cust = F.col("o_custkey")
        return (
            self.table("orders")
            .select(
                _key_or_other((F.col("o_orderpriority") == "1-URGENT") & (cust % 5 == 0), "d", cust).alias("person_id"),
                F.when(order % 11 == 0, F.lit(None)).otherwise(_days_after(DEATH_EPOCH, order % 90)).alias("death_date"),
            )
        )

    @cached_property
    def zcta_pct(self) -> DataFrame:
        """Area percentages per ZCTA, stored as text ('NA', '' and null included).
        One ZCTA per supplier, so the area table grows with the data."""
        key = F.col("s_suppkey")
        cols = []
        for k, name in enumerate(SDOH_COLUMNS):
            r = (key + k) % 7
            cols.append(
                F.when(r == 0, F.lit("NA"))
                .when(r == 1, F.lit(""))
                .when(r == 2, F.lit(None).cast("string"))
                .otherwise(F.concat(((key * 7 + k * 3) % 100).cast("string"), F.lit(".5")))
                .alias(name)
            )
        from_suppliers = self.table("supplier").select((20000 + key).cast("string").alias("ZCTA"), *cols)
        full_row = self.spark.createDataFrame(
            [tuple([EXTRA_ZCTA] + ["1.0"] * len(SDOH_COLUMNS))],
            T.StructType([T.StructField(c, T.StringType()) for c in ["ZCTA", *SDOH_COLUMNS]]),
        )
        return from_suppliers.unionByName(full_row)

    @cached_property
    def zip_zcta(self) -> DataFrame:
        """ZIP to ZCTA crosswalk, one ZIP per supplier (of no person if key % 5 = 4),
        plus a second ZCTA for ZIP 10000."""
        key = F.col("s_suppkey")
        from_suppliers = self.table("supplier").select(
            _key_or_other(key % 5 != 4, "z", 10000 + key * 37).alias("ZIP_CODE"),
            (20000 + key % 15).cast("string").alias("ZCTA"),
        )
        extra = self.spark.createDataFrame([("10000", EXTRA_ZCTA)], "ZIP_CODE string, ZCTA string")
        return from_suppliers.unionByName(extra)

    @cached_property
    def summary_facts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            _key_or_other(key % 4 != 0, "s", key).alias("person_id"), (key % 50).cast("int").alias("MDs")
        )

    @cached_property
    def severity(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            _key_or_other(key % 3 == 0, "v", key).alias("person_id"),
            _pick(SEVERITY_BY_KEY_MOD_4, key % 4).alias("Severity_Type"),
            (key % 7).cast("string").alias("data_partner_id"),
            _days_after(COHORT_EPOCH, key % 200).alias("visit_start_date"),
            (key * 10).alias("visit_occurrence_id"),
            (key % 2).cast("int").alias("AKI_in_hospital"),
            F.when(key % 5 == 4, 1).otherwise(0).cast("int").alias("ECMO"),
            (key % 3).cast("int").alias("Invasive_Ventilation"),
            (key % 10).cast("int").alias("Q_Score"),
            (18 + key % 20).cast("double").alias("BMI"),
            (150 + key % 40).cast("double").alias("Height"),
            (50 + key % 60).cast("double").alias("Weight"),
            F.lit("A").alias("blood_type"),
            F.lit("Non smoker").alias("smoking_status"),
        )
