"""Uniform event views: person_id, concept_id, event_date, event_id and, for labs, value.

Each view takes an optional closed date range, and ``date_only`` to ignore the timestamp fallback.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import event_date, within
from ..sources.tables import ClinicalTables


def _events(df: DataFrame, concept: str, date: str, moment: str, event_id: str, *more: str,
            date_only: bool, start, end) -> DataFrame:
    fallback = not date_only and moment in df.columns
    ranged = start is not None or end is not None
    if ranged and fallback:
        # Implied by the range test below, but on a plain column, so that the scan can use it.
        day = F.col(date).cast("date")
        df = df.filter(within(day, start, end) | day.isNull())
    when = event_date(date, moment) if fallback else event_date(date)
    events = df.select("person_id", F.col(concept).alias("concept_id"), when.alias("event_date"),
                       F.col(event_id).alias("event_id"), *more)
    return events.filter(within("event_date", start, end)) if ranged else events


def condition_events(tables: ClinicalTables, date_only: bool = False, start=None, end=None) -> DataFrame:
    return _events(tables["condition_occurrence"], "condition_concept_id", "condition_start_date",
                   "condition_start_datetime", "condition_occurrence_id", date_only=date_only, start=start, end=end)


def drug_events(tables: ClinicalTables, date_only: bool = False, start=None, end=None) -> DataFrame:
    return _events(tables["drug_exposure"], "drug_concept_id", "drug_exposure_start_date",
                   "drug_exposure_start_datetime", "drug_exposure_id", date_only=date_only, start=start, end=end)


def measurement_events(tables: ClinicalTables, date_only: bool = False, start=None, end=None) -> DataFrame:
    return _events(tables["measurement"], "measurement_concept_id", "measurement_date", "measurement_datetime",
                   "measurement_id", "value_as_number", date_only=date_only, start=start, end=end)


def visit_events(tables: ClinicalTables, date_only: bool = False, start=None, end=None) -> DataFrame:
    return _events(tables["visit_occurrence"], "visit_concept_id", "visit_start_date", "visit_start_datetime",
                   "visit_occurrence_id", date_only=date_only, start=start, end=end)


def observation_spans(tables: ClinicalTables, merge_gap_days: int | None = None) -> DataFrame:
    """Observation periods per person, the longest for each start date; merged if a gap is given.

    Shorter periods with the same start cover no further day, so dropping them changes no test
    of coverage and bounds the rows per person.
    """
    periods = tables["observation_period"]
    spans = periods.groupBy("person_id", F.col("observation_period_start_date").cast("date").alias("obs_start")).agg(
        F.max(F.col("observation_period_end_date").cast("date")).alias("obs_end")
    )
    return spans if merge_gap_days is None else merged_spans(spans, merge_gap_days)


def merged_spans(spans: DataFrame, gap_days: int = 0) -> DataFrame:
    """Islands of observation: periods with at most ``gap_days`` days between them become one; 0 joins those that overlap or touch.

    A period begins an island if it starts too late after the latest end of all earlier ones, which may belong to a long period far
    before. Periods without a start or an end are left out, one that ends before it starts covers nothing and is left out too.
    """
    whole = spans.filter("obs_start IS NOT NULL AND obs_end >= obs_start")
    in_order = Window.partitionBy("person_id").orderBy("obs_start")
    reached = F.max("obs_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (reached.isNull() | (F.datediff("obs_start", reached) > gap_days + 1)).cast("int")
    numbered = whole.withColumn("begins", begins).withColumn("island", F.sum("begins").over(in_order))
    return numbered.groupBy("person_id", "island").agg(F.min("obs_start").alias("obs_start"), F.max("obs_end").alias("obs_end")).drop("island")


def first_deaths(tables: ClinicalTables) -> DataFrame:
    """Earliest known death date per person."""
    return (
        tables["death"]
        .filter(F.col("death_date").isNotNull())
        .groupBy("person_id")
        .agg(F.min(F.col("death_date").cast("date")).alias("death_date"))
    )
