"""Match hospital stays and emergency-room visits to each person's index date.

Visit rows are microvisits; a stay (macrovisit) is the enclosing hospital
episode, null for visits outside a stay.

Plan shape of the first-match operators (``stay_near_index``,
``er_visits_near_index``, ``stays_near_index``, ``first_visits``): scan and
filter the visit table, join it on person_id to the cohort's (person_id,
index dates) with the day window as a join condition, then reduce to one
row per person with a partial aggregate. One aggregate over the cohort
(``profile_cohort``) gives its row count and index-date range: the cohort
side is broadcast when the count is within the bound, so the visit table is
never shuffled for the join (otherwise the join runs on person and day bin, so
a person with many visits splits by date; see ``_join_cohort``); and the visit
scan is filtered to the overall date range every match must fall in, a literal
range that reaches parquet row-group and partition pruning.
``stays_after_index`` keeps every later stay, so it joins on person_id and
spreads hot persons alone; see there.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, days_between, event_within, index_minus_event_within
from ..sources.tables import require_columns
from .checks import require_unique
from .joins import BROADCAST_BYTES, COHORT_BROADCAST_ROWS, DEFAULT_BROADCAST_ROWS, row_width, small_enough
from .skew import HOT_ROWS, find_hot_keys, join_spread

MODES = ("either", "both")

LAB = "first_pos_pcr_antigen_date"
DIAGNOSIS = "first_pos_diagnosis_date"
EARLIER = "first_poslab_or_diagnosis_date"
INDEX_DATES = [LAB, DIAGNOSIS, EARLIER]
STAY_COLUMNS = ["person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"]
VISIT_COLUMNS = [*STAY_COLUMNS, "visit_concept_id", "visit_start_date"]


@dataclass(frozen=True)
class CohortProfile:
    """Row count and per-column date range of the cohort's index dates, from
    one aggregate job (one row reaches the driver)."""

    rows: int
    bounds: dict[str, tuple[dt.date | None, dt.date | None]]
    width: int = 64  # bytes of a cohort row

    def small(self, max_rows: int) -> bool:
        return 0 < max_rows and self.rows <= max_rows and self.rows * self.width <= BROADCAST_BYTES


def cohort_width(side: DataFrame, rows: int, id_bytes: int | None) -> int:
    """Bytes of a cohort row: its columns' widths, and the measured length of its ids."""
    return row_width(side) + -(-(id_bytes or 0) // max(1, rows))


def profile_cohort(persons: DataFrame, index_cols: list[str]) -> CohortProfile:
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.col("person_id").cast("string"))).alias("id_bytes")]
    for i, c in enumerate(index_cols):
        aggs += [F.min(as_date(F.col(c))).alias(f"lo{i}"), F.max(as_date(F.col(c))).alias(f"hi{i}")]
    r = persons.agg(*aggs).first()
    width = cohort_width(persons.select("person_id", *index_cols), r["rows"], r["id_bytes"])
    return CohortProfile(r["rows"], {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(index_cols)}, width)


def _dated(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as DATE (timestamps lose their time of day); DATE columns stay as they are."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: as_date(F.col(c)) for c in columns if kinds[c] != "date"})


def _in_index_range(event: Column, bounds: tuple, days_before: int, days_after: int) -> Column:
    """Event date within [earliest index - days_before, latest index + days_after]:
    every match of any person lies there. A literal range on the stored column
    (the end as an open bound, so that times of the last day are inside), so it
    reaches the scan (row-group and partition pruning on the event date)."""
    lo, hi = bounds
    if lo is None or hi is None:
        return F.lit(False)
    first, end = lo - dt.timedelta(days=days_before), hi + dt.timedelta(days=days_after + 1)
    return (event >= F.lit(first)) & (event < F.lit(end))


def _day_bin(date: Column, width: int) -> Column:
    return F.floor(F.unix_date(date) / F.lit(width)).cast("int")


def _join_cohort(events: DataFrame, persons: DataFrame, columns: list[str], broadcast: bool, event_date: Column,
                 index_col: str, days_before: int, days_after: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join event rows to the cohort's (person_id, index dates).

    A cohort proven small is broadcast: the events stay where they are. A
    large one is an interval join by day bins as wide as the window: an event
    carries (person_id, bin of its date), and a cohort row goes to the one or
    two bins that [index - days_before, index + days_after] touches, so only
    events of those bins meet it. The visits are shuffled once, a person with
    very many visits splits by date, and nothing in the plan depends on the
    size of the cluster. The window test itself follows the join; the
    per-person aggregate combines partial results in the joining tasks before
    its own (small) shuffle. A (person, bin) that still owns ``hot_rows`` rows
    and more than its share is spread further (``join_spread``).
    """
    dates = [c for c in columns if c != "person_id"]
    side = _dated(persons.select(*columns), dates)
    if broadcast:
        return events.join(F.broadcast(side), "person_id")
    width = max(1, days_before + days_after + 1)
    index = F.col(index_col)
    bins = F.sequence(_day_bin(F.date_sub(index, days_before), width), _day_bin(F.date_add(index, days_after), width))
    side = side.where(F.lit(days_before + days_after >= 0)).withColumn("__bin", F.explode(bins))
    events = events.withColumn("__bin", _day_bin(event_date, width))
    keys = ["person_id", "__bin"]
    return join_spread(events, side, keys, find_hot_keys(events, keys, hot_rows)).drop("__bin", "__piece")


def _attach_per_person(persons: DataFrame, per_person: DataFrame, small: bool) -> DataFrame:
    """Left-join a per-person result (at most one row per cohort person) onto
    persons. When the cohort is proven small the result is too, so it is
    broadcast and the person rows are not shuffled."""
    return persons.join(F.broadcast(per_person) if small else per_person, "person_id", "left")


def _mode_index(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return EARLIER if mode == "either" else LAB


def _window_test(mode: str, event: Column, days_before: int, days_after: int) -> Column:
    """Index-date proximity of an event.

    ``either``: the earlier of lab and diagnosis date is near the event.
    ``both``: the lab date is near the event and the diagnosis date is near
    the lab date.
    """
    if mode == "either":
        return index_minus_event_within(F.col(EARLIER), event, days_before, days_after)
    if mode == "both":
        return index_minus_event_within(F.col(LAB), event, days_before, days_after) & days_between(
            F.col(LAB), F.col(DIAGNOSIS)
        ).between(-days_after, days_before)
    raise ValueError(f"mode must be one of {MODES}")


def stay_near_index(
    persons: DataFrame,
    visits: DataFrame,
    index_col: str = LAB,
    days_before_index: int = 1,
    days_after_index: int = 16,
    require_overlap: bool = True,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    index_source: DataFrame | None = None,
    prune_to_index_range: bool = True,
    profile: CohortProfile | None = None,
    hot_rows: int = HOT_ROWS,
    unique: str = "allow_fanout",
) -> DataFrame:
    """First stay starting from ``days_before_index`` days before to
    ``days_after_index`` days after the index date (and, with
    ``require_overlap``, ending on or after it), left-joined onto persons.

    Adds first_covid_macrovisit_id, first_covid_macrovisit_start_date,
    first_covid_macrovisit_end_date and covid_associated_hosp (0/1). A stay
    is identified by macrovisit_id; ties on start date go to the smallest
    stay id, then end date.

    ``index_source`` supplies (person_id, index date) when ``persons`` is an
    expensive derivation of a cheaper table that already has them (the
    cohort before enrichment): the window join then reads that table
    instead of recomputing ``persons``. With ``prune_to_index_range``, stays
    outside the cohort's overall index range are filtered at the scan.
    ``profile`` passes ``profile_cohort(source with a non-null index,
    [index_col])`` when the caller computed it already (e.g. concurrently
    with other plan-time work). ``hot_rows`` bounds the rows that a person may
    have in a day bin when the cohort is too large to broadcast (see
    ``_join_cohort``). Dates may be timestamps;
    they are read as DATE. A person who occurs several times gets the first
    stay near any of the index dates in each row, or raises with
    ``unique="assert"``.
    """
    require_columns(visits, STAY_COLUMNS, "visits")
    source = persons if index_source is None else index_source
    require_columns(source, ["person_id", index_col], "persons")
    require_unique(source, ["person_id"], unique, "persons")
    source = source.where(F.col(index_col).isNotNull())
    profile = profile_cohort(source, [index_col]) if profile is None else profile
    stays = visits.where(F.col("macrovisit_id").isNotNull())
    if prune_to_index_range:
        stays = stays.where(_in_index_range(F.col("macrovisit_start_date"), profile.bounds[index_col],
                                            days_before_index, days_after_index))
    stays = _dated(stays.select(*STAY_COLUMNS), STAY_COLUMNS[2:])
    start, idx = F.col("macrovisit_start_date"), F.col(index_col)
    cond = event_within(idx, start, days_before_index, days_after_index)
    if require_overlap:
        cond = cond & (idx <= F.col("macrovisit_end_date"))
    first = (
        _join_cohort(stays, source, ["person_id", index_col], profile.small(cohort_broadcast_rows), start,
                     index_col, days_before_index, days_after_index, hot_rows)
        .where(cond)
        .groupBy("person_id")
        .agg(F.min(F.struct("macrovisit_start_date", "macrovisit_id", "macrovisit_end_date")).alias("s"))
        .select(
            "person_id",
            F.col("s.macrovisit_id").alias("first_covid_macrovisit_id"),
            F.col("s.macrovisit_start_date").alias("first_covid_macrovisit_start_date"),
            F.col("s.macrovisit_end_date").alias("first_covid_macrovisit_end_date"),
        )
    )
    return _attach_per_person(persons, first, profile.small(cohort_broadcast_rows)).withColumn(
        "covid_associated_hosp",
        F.when(F.col("first_covid_macrovisit_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)),
    )


def er_visits_near_index(
    persons: DataFrame,
    visits: DataFrame,
    er_concepts: DataFrame,
    mode: str = "either",
    days_before_index: int = 1,
    days_after_index: int = 16,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    prune_to_index_range: bool = True,
    profile: CohortProfile | None = None,
    hot_rows: int = HOT_ROWS,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Earliest emergency-room visit near the index date, per person:
    (person_id, first_covid_er_only_start_date).

    An ER visit is a visit outside any stay (null stay start) whose
    visit_concept_id is in ``er_concepts.concept_id`` (semi join).
    """
    require_columns(visits, VISIT_COLUMNS, "visits")
    require_columns(persons, ["person_id", *INDEX_DATES], "persons")
    require_unique(persons, ["person_id"], unique, "persons")
    er_ids = er_concepts.select("concept_id")
    profile = profile_cohort(persons, INDEX_DATES) if profile is None else profile
    if small_enough([er_ids], max_broadcast_rows)[0]:
        er_ids = F.broadcast(er_ids)
    er = visits.where(F.col("macrovisit_start_date").isNull())
    if prune_to_index_range:
        er = er.where(_in_index_range(F.col("visit_start_date"), profile.bounds[_mode_index(mode)],
                                      days_before_index, days_after_index))
    er = er.join(er_ids, F.col("visit_concept_id") == er_ids["concept_id"], "left_semi")
    return (
        _join_cohort(_dated(er.select("person_id", "visit_start_date"), ["visit_start_date"]), persons,
                     ["person_id", *INDEX_DATES], profile.small(cohort_broadcast_rows), F.col("visit_start_date"),
                     _mode_index(mode), days_before_index, days_after_index, hot_rows)
        .where(_window_test(mode, F.col("visit_start_date"), days_before_index, days_after_index))
        .groupBy("person_id")
        .agg(F.min("visit_start_date").alias("first_covid_er_only_start_date"))
    )


def stays_near_index(
    persons: DataFrame,
    visits: DataFrame,
    mode: str = "either",
    days_before_index: int = 1,
    days_after_index: int = 16,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    prune_to_index_range: bool = True,
    profile: CohortProfile | None = None,
    hot_rows: int = HOT_ROWS,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Earliest stay starting near the index date, per person:
    (person_id, macrovisit_id, first_COVID_hospitalization_start_date,
    first_COVID_hospitalization_end_date). A stay is any visit row with a
    stay start date; no end-date test. Ties go to the smallest stay id."""
    require_columns(visits, STAY_COLUMNS, "visits")
    require_columns(persons, ["person_id", *INDEX_DATES], "persons")
    require_unique(persons, ["person_id"], unique, "persons")
    profile = profile_cohort(persons, INDEX_DATES) if profile is None else profile
    stays = visits.where(F.col("macrovisit_start_date").isNotNull())
    if prune_to_index_range:
        stays = stays.where(_in_index_range(F.col("macrovisit_start_date"), profile.bounds[_mode_index(mode)],
                                            days_before_index, days_after_index))
    stays = _dated(stays.select(*STAY_COLUMNS), STAY_COLUMNS[2:])
    return (
        _join_cohort(stays, persons, ["person_id", *INDEX_DATES], profile.small(cohort_broadcast_rows),
                     F.col("macrovisit_start_date"), _mode_index(mode), days_before_index, days_after_index, hot_rows)
        .where(_window_test(mode, F.col("macrovisit_start_date"), days_before_index, days_after_index))
        .groupBy("person_id")
        .agg(F.min(F.struct("macrovisit_start_date", "macrovisit_id", "macrovisit_end_date")).alias("s"))
        .select(
            "person_id",
            F.col("s.macrovisit_id").alias("macrovisit_id"),
            F.col("s.macrovisit_start_date").alias("first_COVID_hospitalization_start_date"),
            F.col("s.macrovisit_end_date").alias("first_COVID_hospitalization_end_date"),
        )
    )


def first_visits(
    persons: DataFrame,
    visits: DataFrame,
    er_concepts: DataFrame | None = None,
    include_er: bool = True,
    mode: str = "either",
    days_before_index: int = 1,
    days_after_index: int = 16,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    prune_to_index_range: bool = True,
    profile: CohortProfile | None = None,
    hot_rows: int = HOT_ROWS,
    unique: str = "allow_fanout",
) -> DataFrame:
    """Persons with their first stay near the index date and, with
    ``include_er``, their first ER visit near it, left-joined onto persons:
    adds macrovisit_id, first_COVID_hospitalization_start_date,
    first_COVID_hospitalization_end_date (and first_covid_er_only_start_date).

    Same result as ``stays_near_index`` full-outer-joined with
    ``er_visits_near_index``, computed in one pass: the visit table is
    scanned once, ER concepts are flagged by a left join against the
    (broadcast, distinct) ER ids, each window applies under its own
    condition, and one aggregation per person yields both first dates.
    When the ER ids are not provably small, the two operators run
    separately and are joined.
    """
    if include_er and er_concepts is None:
        raise ValueError("include_er needs er_concepts")
    require_columns(visits, VISIT_COLUMNS if include_er else STAY_COLUMNS, "visits")
    require_columns(persons, ["person_id", *INDEX_DATES], "persons")
    require_unique(persons, ["person_id"], unique, "persons")
    profile = profile_cohort(persons, INDEX_DATES) if profile is None else profile
    if not include_er:
        first = stays_near_index(persons, visits, mode, days_before_index, days_after_index,
                                 cohort_broadcast_rows, prune_to_index_range, profile, hot_rows)
        return _attach_per_person(persons, first, profile.small(cohort_broadcast_rows))
    er_ids = er_concepts.select("concept_id")
    if not small_enough([er_ids], max_broadcast_rows)[0]:
        hosp = stays_near_index(persons, visits, mode, days_before_index, days_after_index,
                                cohort_broadcast_rows, prune_to_index_range, profile, hot_rows)
        # a bound of 0: the ids were just counted and are too many
        er = er_visits_near_index(persons, visits, er_concepts, mode, days_before_index, days_after_index,
                                  cohort_broadcast_rows, 0, prune_to_index_range, profile, hot_rows)
        return _attach_per_person(persons, hosp.join(er, "person_id", "full_outer"),
                                  profile.small(cohort_broadcast_rows))

    flags = F.broadcast(er_ids.distinct().select(F.col("concept_id").alias("__er_id"), F.lit(True).alias("__is_er")))
    stay_row = F.col("macrovisit_start_date").isNotNull()
    er_row = F.col("macrovisit_start_date").isNull()  # and an ER concept, tested after the flag join
    rows = visits
    if prune_to_index_range:
        bounds = profile.bounds[_mode_index(mode)]
        rows = rows.where(
            (stay_row & _in_index_range(F.col("macrovisit_start_date"), bounds, days_before_index, days_after_index))
            | (er_row & _in_index_range(F.col("visit_start_date"), bounds, days_before_index, days_after_index))
        )
    rows = rows.select(
        "person_id", "visit_concept_id", "visit_start_date",
        "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date",
    ).join(flags, F.col("visit_concept_id") == F.col("__er_id"), "left")
    rows = _dated(rows, ["visit_start_date", "macrovisit_start_date", "macrovisit_end_date"]).where(
        stay_row | (er_row & F.col("__is_er"))
    )
    # only what decides a row's match stays, so that equal rows of a stay or a day can be reduced to one
    rows = rows.select(*STAY_COLUMNS, F.when(er_row, F.col("visit_start_date")).alias("visit_start_date"))
    near_stay = stay_row & _window_test(mode, F.col("macrovisit_start_date"), days_before_index, days_after_index)
    near_er = er_row & _window_test(mode, F.col("visit_start_date"), days_before_index, days_after_index)
    first = (
        _join_cohort(rows, persons, ["person_id", *INDEX_DATES], profile.small(cohort_broadcast_rows),
                     F.coalesce("macrovisit_start_date", "visit_start_date"), _mode_index(mode), days_before_index,
                     days_after_index, hot_rows)
        .where(near_stay | near_er)
        .groupBy("person_id")
        .agg(
            F.min(F.when(near_stay, F.struct("macrovisit_start_date", "macrovisit_id", "macrovisit_end_date"))).alias("s"),
            F.min(F.when(near_er, F.col("visit_start_date"))).alias("first_covid_er_only_start_date"),
        )
        .select(
            "person_id",
            F.col("s.macrovisit_id").alias("macrovisit_id"),
            F.col("s.macrovisit_start_date").alias("first_COVID_hospitalization_start_date"),
            F.col("s.macrovisit_end_date").alias("first_COVID_hospitalization_end_date"),
            "first_covid_er_only_start_date",
        )
    )
    return _attach_per_person(persons, first, profile.small(cohort_broadcast_rows))


def stays_after_index(
    first_visits_df: DataFrame,
    visits: DataFrame,
    index_col: str = EARLIER,
    stay_start_col: str = "first_COVID_hospitalization_start_date",
    stay_end_col: str = "first_COVID_hospitalization_end_date",
    observation=None,
    hot_rows: int = HOT_ROWS,
    profile: CohortProfile | None = None,
    cohort_broadcast_rows: int = COHORT_BROADCAST_ROWS,
    days_before_index: int = 1,
    branches: str = "joined",
) -> DataFrame:
    """Stays that start strictly after the person's index stay start, or,
    for persons without an index stay, strictly after the index date.

    One row per (person, stay): the stay's earliest start after the anchor
    and that row's end date. Output: person_id, <index_col>,
    <stay_start_col>, <stay_end_col>, macrovisit_id, macrovisit_start_date,
    macrovisit_end_date.

    Pass a ``pyspark.sql.Observation`` to get row counts (after-stay,
    after-index, total) as metrics of the same job, without extra actions.

    ``profile`` is ``profile_cohort`` of the persons (one row each in
    ``first_visits_df``) over their index dates. It bounds the anchors: within
    ``cohort_broadcast_rows`` they are broadcast, so visits are never shuffled
    for the join; and no anchor lies before the earliest index date minus
    ``days_before_index`` (the window of the first stays), so earlier stays are
    left out at the scan.

    Otherwise visits are shuffled once, by person_id: the join's partitioning
    serves the per-stay aggregate too. One person may own a large share of all
    stays, and one stay of its person's microvisits: a sketch over person_id
    names persons with ``hot_rows`` rows and more than their share. Only their
    equal (person, stay, start, end) rows are first reduced to one by a partial
    aggregate, and only they are spread, by stay id, with their one anchor row
    repeated once per piece. All rows of one stay share a piece, so results
    are exact.

    ``branches="union"`` finds the stays after a first stay and those after an
    index date apart and unites them by name; the rows are the same, from two
    scans.
    """
    if branches not in ("joined", "union"):
        raise ValueError("branches must be 'joined' or 'union'")
    if branches == "union":
        parts = [
            stays_after_index(first_visits_df.where(part), visits, index_col, stay_start_col, stay_end_col, None, hot_rows,
                              profile, cohort_broadcast_rows, days_before_index)
            for part in (F.col(stay_start_col).isNotNull(), F.col(stay_start_col).isNull())
        ]
        return _observed(parts[0].unionByName(parts[1]), stay_start_col, observation)
    anchor_cols = ["person_id", index_col, stay_start_col, stay_end_col]
    require_columns(first_visits_df, anchor_cols, "first visits")
    require_columns(visits, STAY_COLUMNS, "visits")
    anchors = (
        _dated(first_visits_df.select(*anchor_cols), anchor_cols[1:])
        .withColumn("__anchor", F.coalesce(F.col(stay_start_col), F.col(index_col)))
        .where(F.col("__anchor").isNotNull())
    )
    stays = visits.where(F.col("macrovisit_id").isNotNull())
    earliest = [lo for lo, _ in profile.bounds.values() if lo is not None] if profile else []
    if earliest:
        stays = stays.where(F.col("macrovisit_start_date") >= F.lit(min(earliest) - dt.timedelta(days=days_before_index)))
    stays = _dated(stays.select(*STAY_COLUMNS), STAY_COLUMNS[2:])
    keys = ["person_id"]
    if profile is not None and profile.small(cohort_broadcast_rows):
        joined = stays.join(F.broadcast(anchors), keys)
    else:
        hot = find_hot_keys(stays, keys, hot_rows)
        joined = join_spread(stays, anchors, keys, hot, spread_by=["macrovisit_id"])
        keys += ["__piece"] if hot.hashes else []
    out = (
        joined
        .where(F.col("__anchor") < F.col("macrovisit_start_date"))
        .groupBy(*keys, *anchor_cols[1:], "macrovisit_id")
        .agg(F.min(F.struct("macrovisit_start_date", "macrovisit_end_date")).alias("s"))
        .select(
            *anchor_cols, "macrovisit_id",
            F.col("s.macrovisit_start_date").alias("macrovisit_start_date"),
            F.col("s.macrovisit_end_date").alias("macrovisit_end_date"),
        )
    )
    return _observed(out, stay_start_col, observation)


def _observed(out: DataFrame, stay_start_col: str, observation) -> DataFrame:
    if observation is None:
        return out
    return out.observe(
        observation,
        F.count(F.when(F.col(stay_start_col).isNotNull(), 1)).alias("after_stay_rows"),
        F.count(F.when(F.col(stay_start_col).isNull(), 1)).alias("after_index_rows"),
        F.count(F.lit(1)).alias("rows"),
    )
