"""Area-level measures by ZIP code, and other per-person column attachments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, checked_broadcast, join_lookup

# The area measures stored as text and read as numbers.
SDOH_COLUMNS = [
    "African_American", "AIAN", "Asian", "NHPI", "White", "other_race",
    "two_or_more_races", "Hispanic_any_race", "male", "female",
    "age_18_and_under", "age_18_and_over", "age_65plus",
]


def zip_area_table(
    area: DataFrame,
    crosswalk: DataFrame,
    area_key: str = "ZCTA",
    zip_col: str = "ZIP_CODE",
    out_zip: str = "zipcode",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast: bool | None = None,
) -> DataFrame:
    """Area measures per ZIP: every area column plus the crosswalk's ZIP as
    ``out_zip`` (inner join on the area key; a ZIP that maps to several
    areas gets one row per area). ``broadcast`` passes a size decision made
    earlier."""
    xwalk = crosswalk.select(F.col(area_key).alias("__area_key"), F.col(zip_col).alias(out_zip))
    if broadcast is None:
        xwalk, _ = checked_broadcast(xwalk, max_broadcast_rows)
    elif broadcast:
        xwalk = F.broadcast(xwalk)
    return area.join(xwalk, area[area_key] == xwalk["__area_key"]).select(*[area[c] for c in area.columns], out_zip)


def attach_area(
    persons: DataFrame,
    area_by_zip: DataFrame,
    zip_col: str = "zip_code",
    area_zip: str = "zipcode",
    keep: Sequence[str] = ("zip_code", "person_id"),
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast: bool | None = None,
) -> DataFrame:
    """``keep`` columns of each person followed by every column of the
    matching area row(s); persons without a match keep one row of nulls.

    Null ZIP codes never match and are salted when the area table is too
    large to broadcast, so they do not pile up in one task. ``broadcast``
    passes a size decision made earlier (see ``joins.small_enough``)."""
    return join_lookup(
        persons.select(*keep), area_by_zip, zip_col, area_zip, "left", max_broadcast_rows, keep_lookup_key=True,
        broadcast=broadcast,
    )


def unmatched_keys(
    persons: DataFrame,
    area_by_zip: DataFrame,
    columns: Sequence[str] = ("city", "state", "zip"),
    area_columns: Sequence[str] = ("ZCTA",),
    zip_col: str = "zip_code",
    area_zip: str = "zipcode",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast: bool | None = None,
) -> DataFrame:
    """Distinct place columns of persons whose ZIP found no area row
    (null ZIPs included): an anti join, then distinct. ``area_columns`` of the
    area table follow, all null as no area matched."""
    probe = persons.select(zip_col, *columns)
    none = [F.lit(None).cast(area_by_zip.schema[c].dataType).alias(c) for c in area_columns]
    found = join_lookup(probe, area_by_zip.select(area_zip), zip_col, area_zip, "left_anti", max_broadcast_rows,
                        broadcast=broadcast)
    return found.select(*columns).distinct().select(*columns, *none)


def attach_column(
    df: DataFrame,
    other: DataFrame,
    columns: Sequence[str],
    key: str = "person_id",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    restrict_to: DataFrame | None = None,
    broadcast: bool | None = None,
    unique: str = "allow_fanout",
) -> DataFrame:
    """All of ``df`` plus ``columns`` of ``other`` by a left join on ``key``
    (``restrict_to``, ``broadcast``, ``unique``: see ``joins.join_lookup``)."""
    return join_lookup(df, other.select(key, *columns), key, key, "left", max_broadcast_rows,
                       restrict_to=restrict_to, broadcast=broadcast, unique=unique)


def cast_columns(df: DataFrame, columns: Sequence[str] = tuple(SDOH_COLUMNS), dtype: str = "double") -> DataFrame:
    """Cast the named columns (text such as '12.5') to ``dtype``; values that
    do not parse ('NA', '') become null. Other columns are untouched."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in columns})
