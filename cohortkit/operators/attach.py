"""Attach per-person score tables with collision-safe renames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .joins import DEFAULT_BROADCAST_ROWS, join_lookup

# The columns renamed and kept.
SEVERITY_RENAMES = {
    "data_partner_id": "sev_data_partner_id",
    "visit_start_date": "sev_visit_start_date",
    "visit_occurrence_id": "sev_visit_occurrence_id",
}
SEVERITY_COLUMNS = [
    "person_id", "Severity_Type", "sev_data_partner_id", "sev_visit_start_date",
    "sev_visit_occurrence_id", "AKI_in_hospital", "ECMO", "Invasive_Ventilation",
    "Q_Score", "BMI", "Height", "Weight", "blood_type", "smoking_status",
]


def attach_renamed(
    df: DataFrame,
    scores: DataFrame,
    renames: dict[str, str],
    columns: list[str],
    key: str = "person_id",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    restrict_to: DataFrame | None = None,
    broadcast: bool | None = None,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Rename the score columns that would collide, keep ``columns`` (which
    include ``key``) and left-join them onto ``df`` by ``key``
    (``restrict_to``, ``broadcast``, ``unique``: see ``joins.join_lookup``)."""
    renamed = scores.withColumnsRenamed(renames).select(*columns)
    return join_lookup(df, renamed, key, key, "left", max_broadcast_rows, restrict_to=restrict_to,
                       broadcast=broadcast, unique=unique)


def attach_severity(
    df: DataFrame, severity: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    restrict_to: DataFrame | None = None, broadcast: bool | None = None, unique: str = "allow_fanout",
) -> DataFrame:
    """Severity type and critical-visit measures per person (left join)."""
    return attach_renamed(df, severity, SEVERITY_RENAMES, SEVERITY_COLUMNS, "person_id", max_broadcast_rows,
                          restrict_to, broadcast, unique)
