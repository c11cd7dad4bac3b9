"""Column expressions for person attributes (all JVM-side, no UDFs).

Each function returns a ``Column`` (the rule table takes column names and
builds one SQL CASE expression), so they compose into a single projection
that stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered race/ethnicity rules, first match wins.
# (column role, test, value, label); role "ethnicity" or "race", test
# "equals" (exact, case-sensitive) or "contains" (substring, case-sensitive).
RACE_ETHNICITY_RULES: list[tuple[str, str, str, str]] = [
    ("ethnicity", "equals", "Hispanic or Latino", "Hispanic or Latino Any Race"),
    ("race", "contains", "Hispanic", "Hispanic or Latino Any Race"),
    ("race", "contains", "Black", "Black or African American Non-Hispanic"),
    ("race", "equals", "African American", "Black or African American Non-Hispanic"),
    ("race", "contains", "White", "White Non-Hispanic"),
    ("race", "equals", "Asian or Pacific Islander", "Unknown"),
    ("race", "contains", "Asian Indian", "Asian Indian"),
    ("race", "contains", "Asian", "Asian Non-Hispanic"),
    ("race", "contains", "Filipino", "Asian Non-Hispanic"),
    ("race", "contains", "Chinese", "Asian Non-Hispanic"),
    ("race", "contains", "Korean", "Asian Non-Hispanic"),
    ("race", "contains", "Vietnamese", "Asian Non-Hispanic"),
    ("race", "contains", "Japanese", "Asian Non-Hispanic"),
    ("race", "contains", "Bangladeshi", "Asian Non-Hispanic"),
    ("race", "contains", "Pakistani", "Asian Non-Hispanic"),
    ("race", "contains", "Nepalese", "Asian Non-Hispanic"),
    ("race", "contains", "Laotian", "Asian Non-Hispanic"),
    ("race", "contains", "Taiwanese", "Asian Non-Hispanic"),
    ("race", "contains", "Thai", "Asian Non-Hispanic"),
    ("race", "contains", "Sri Lankan", "Asian Non-Hispanic"),
    ("race", "contains", "Burmese", "Asian Non-Hispanic"),
    ("race", "contains", "Okinawan", "Asian Non-Hispanic"),
    ("race", "contains", "Cambodian", "Asian Non-Hispanic"),
    ("race", "contains", "Bhutanese", "Asian Non-Hispanic"),
    ("race", "contains", "Singaporean", "Asian Non-Hispanic"),
    ("race", "contains", "Hmong", "Asian Non-Hispanic"),
    ("race", "contains", "Malaysian", "Asian Non-Hispanic"),
    ("race", "contains", "Indonesian", "Asian Non-Hispanic"),
    ("race", "contains", "Pacific", "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("race", "contains", "Polynesian", "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("race", "contains", "Native Hawaiian", "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("race", "contains", "Micronesian", "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("race", "contains", "Melanesian", "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
]
RACE_ETHNICITY_DEFAULT = "UNKNOWN"

# Gender labels kept after upper-casing; everything else is UNKNOWN.
GENDER_LABELS = ("MALE", "FEMALE")
GENDER_DEFAULT = "UNKNOWN"

# Zip codes keep their first five characters when all five are digits.
ZIP_LENGTH = 5
ZIP_PATTERN = "[0-9]{5}"


def date_of_birth(year: Column, month: Column, day: Column) -> Column:
    """Birth date from parts. A missing month or day counts as 1; a missing
    year, or a date that does not exist (Feb 30), gives null.

    The parts are joined as ``y-m-d`` text and parsed like a date cast, so a
    year needs four digits to parse (a defaulted year of 1 never would).
    """
    text = F.concat_ws("-", year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
    return F.when(year.isNotNull(), F.try_to_date(text))


def whole_years_between(later: Column, earlier: Column) -> Column:
    """Whole years from ``earlier`` to ``later`` (bigint), by Spark's
    unrounded ``months_between`` divided by 12 and floored."""
    return F.floor(F.months_between(later, earlier, roundOff=False) / 12)


def non_negative(value: Column) -> Column:
    """The value when >= 0, else null (negative ages are data errors)."""
    return F.when(value >= 0, value)


def standardize_gender(name: Column) -> Column:
    """MALE / FEMALE for any casing of those words, UNKNOWN otherwise (null too)."""
    upper = F.upper(name)
    expr = None
    for label in GENDER_LABELS:
        expr = (F.when if expr is None else expr.when)(upper == label, F.lit(label))
    return expr.otherwise(F.lit(GENDER_DEFAULT))


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ordered_rules(
    columns: dict[str, str],
    rules: Sequence[tuple[str, str, str, str]],
    default: str,
) -> Column:
    """Fold a first-match-wins rule table into one CASE WHEN expression.

    ``columns`` maps each rule's column role to an input column name. A null
    input fails every test, so it falls through to later rules / the
    default. The whole table becomes one SQL expression (one call to build,
    however many rules).
    """
    branches = []
    for role, test, value, label in rules:
        col = f"`{columns[role]}`"
        if test == "equals":
            cond = f"{col} = {_sql_string(value)}"
        elif test == "contains":
            cond = f"contains({col}, {_sql_string(value)})"
        else:
            raise ValueError(f"unknown rule test {test!r}")
        branches.append(f"WHEN {cond} THEN {_sql_string(label)}")
    if not branches:
        return F.lit(default)
    return F.expr(f"CASE {' '.join(branches)} ELSE {_sql_string(default)} END")


def race_ethnicity(ethnicity: str = "ethnicity_concept_name", race: str = "race_concept_name") -> Column:
    """Race/ethnicity label from the two concept-name columns (by name)."""
    return ordered_rules({"ethnicity": ethnicity, "race": race}, RACE_ETHNICITY_RULES, RACE_ETHNICITY_DEFAULT)


def clean_zip(raw: Column) -> Column:
    """Trim spaces; keep the first five characters when there are at least
    five; keep the result only when those five are digits; else null."""
    trimmed = F.trim(raw)
    first5 = F.when(F.length(trimmed) >= ZIP_LENGTH, trimmed.substr(1, ZIP_LENGTH))
    return F.when(first5.rlike(ZIP_PATTERN), first5)
