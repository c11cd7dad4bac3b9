"""Real inputs by name: the same attributes as the fixture ``Inputs``
(``cohort``, ``person_lds``, ``visits``, ...), read from stored datasets.

Every plan in ``cohortkit.plans`` takes either kind, so a workbook's inputs
run unchanged once their datasets are named here:

    inputs = TableInputs.from_folder(spark, "/data/cohort_v3",
                                     names={"visits": "microvisit_to_macrovisit_lds"})
    person_fact(inputs).write.parquet(...)

Each dataset is checked for the columns the operators read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import require_columns

# Columns each input must have (FIXTURES.md section 1). Extra columns pass through.
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "cohort": ["person_id", "first_pos_pcr_antigen_date", "first_pos_diagnosis_date", "first_poslab_or_diagnosis_date"],
    "person_lds": ["person_id", "year_of_birth", "month_of_birth", "day_of_birth", "ethnicity_concept_name",
                   "race_concept_name", "gender_concept_name", "location_id", "data_partner_id"],
    "location": ["location_id", "city", "state", "zip", "county"],
    "manifest": ["data_partner_id", "run_date", "cdm_name", "cdm_version", "shift_date_yn", "max_num_shift_days"],
    "visits": ["person_id", "visit_occurrence_id", "visit_concept_id", "visit_concept_name", "visit_start_date",
               "visit_end_date", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"],
    "our_concept_sets": ["concept_set_name", "column_name", "domain", "comorbidity", "er_only_visit"],
    "concept_set_members": ["concept_id", "concept_set_name", "is_most_recent_version"],
    "condition_occurrence": ["person_id", "condition_start_date", "condition_concept_id",
                             "condition_occurrence_id", "condition_source_value"],
    "death": ["person_id", "death_date"],
    "zcta_pct": ["ZCTA"],
    "zip_zcta": ["ZIP_CODE", "ZCTA"],
    "summary_facts": ["person_id", "MDs"],
    "severity": ["person_id", "Severity_Type", "data_partner_id", "visit_start_date", "visit_occurrence_id"],
}


# Site metadata that no operator computes with.
NOT_DATES = ("run_date",)


def require_dates(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Raise unless the date columns are dates or timestamps: text or numbers would fail or shift later."""
    wrong = {c: k for c, k in df.dtypes if c in columns and k not in ("date", "timestamp", "timestamp_ntz")}
    if wrong:
        raise ValueError(f"{name}: not a date or timestamp: {wrong}")
    return df


class TableInputs:
    """Named inputs loaded lazily by ``loader(dataset_name) -> DataFrame``."""

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame], names: dict[str, str] | None = None,
                 where: str = ""):
        self.spark = spark
        self.where = where
        self._loader = loader
        self._names = {key: key for key in REQUIRED_COLUMNS}
        self._names.update(names or {})
        self._cache: dict[str, DataFrame] = {}

    @property
    def identity(self) -> str:
        """What the inputs are, as a text (names a run of stage tables)."""
        return f"tables of {self.where}: {sorted(self._names.items())}"

    @classmethod
    def from_folder(cls, spark: SparkSession, base_dir: str, names: dict[str, str] | None = None,
                    fmt: str = "parquet") -> TableInputs:
        """Datasets stored as ``<base_dir>/<name>`` in ``fmt``."""
        base = base_dir.rstrip("/")
        return cls(spark, lambda name: spark.read.format(fmt).load(f"{base}/{name}"), names, base)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str] | None = None,
                     database: str | None = None) -> TableInputs:
        """Datasets registered as catalog tables (``database.name``)."""
        prefix = f"{database}." if database else ""
        return cls(spark, lambda name: spark.table(f"{prefix}{name}"), names, prefix)

    def _get(self, key: str) -> DataFrame:
        if key not in self._cache:
            df = self._loader(self._names[key])
            df = require_columns(df, REQUIRED_COLUMNS[key], self._names[key])
            dates = [c for c in REQUIRED_COLUMNS[key] if c.endswith("_date") and c not in NOT_DATES]
            self._cache[key] = require_dates(df, dates, self._names[key])
        return self._cache[key]

    def __getattr__(self, key: str) -> DataFrame:
        if key.startswith("_") or key not in REQUIRED_COLUMNS:
            raise AttributeError(key)
        return self._get(key)
