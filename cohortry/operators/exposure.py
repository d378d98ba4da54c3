"""Exposed and unexposed arms of a cohort, under both rule sets."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import ORDER, age_rounded, packed_id, packed_order
from ..scale import local_frame
from ..sources.membership import MEMBER_DAY, Membership
from ..sources.tables import ClinicalTables
from .cohort import cap_persons, covered
from .concepts import ConceptSets
from .events import drug_events

EXPOSURE_SET = "exposure"


def typed_cohort(cohort: DataFrame, max_persons: int | None = None) -> DataFrame:
    """Cohort columns the split needs, with dates cast; accepts a cohort read back from CSV."""
    base = cohort.select(
        "person_id",
        F.col("index_date").cast("date").alias("obesity_index_date"),
        "index_source",
        F.col("birth_date").try_cast("date").alias("birth_date"),
        "age_at_index",
        "gender_concept_id",
        "race_concept_id",
        "ethnicity_concept_id",
        F.col("death_date").try_cast("date").alias("death_date"),
    )
    return cap_persons(base, max_persons, "person_id")


def exposure_events(tables: ClinicalTables, sets: ConceptSets, start=None, end=None, *names: str) -> DataFrame:
    """Dated exposures to the sets inside the closed date range, or at any time."""
    events = sets.restrict(drug_events(tables, start=start, end=end), *(names or (EXPOSURE_SET,)))
    return events.filter(F.col("event_date").isNotNull())


def first_exposure(events: DataFrame) -> DataFrame:
    """First exposure per person with its concept; the lower id wins on equal dates.

    Taken over everyone before the cohort is joined: each map task sends one row per person, grouped
    by hash, since day and record are packed into one number.
    """
    order = packed_order("event_date", "event_id")
    return events.groupBy("person_id").agg(
        F.min("event_date").alias("exposure_date"),
        F.min(order).alias("first"),
        F.min_by("concept_id", order).alias("exposure_concept_id"),
    ).select("person_id", "exposure_date", packed_id("first").alias("exposure_id"), "exposure_concept_id")


def ever_exposed(tables: ClinicalTables, sets: ConceptSets, *names: str) -> DataFrame:
    """Persons with any exposure to the sets, dated or not, at any time."""
    return sets.restrict(drug_events(tables), *(names or (EXPOSURE_SET,))).select("person_id").distinct()


def exposure_candidates(
    cohort: DataFrame, first: DataFrame, spans: DataFrame, min_days: int = 0, max_days: int = 730
) -> DataFrame:
    """Members first exposed ``min_days``..``max_days`` after the index and under observation then."""
    days = F.datediff("exposure_date", "obesity_index_date")
    timed = (
        cohort.select("person_id", "obesity_index_date")
        .join(first, "person_id")
        .withColumn("days_from_index", days)
        .filter(F.col("days_from_index").between(min_days, max_days))
    )
    return covered(timed, spans, "exposure_date").select(
        "person_id",
        F.col("exposure_date").alias("exposure_index_date"),
        "exposure_concept_id",
        "days_from_index",
    )


def label_arms(
    cohort: DataFrame,
    first: DataFrame,
    spans: DataFrame,
    min_days: int = 0,
    max_days: int = 730,
    ever: DataFrame | None = None,
) -> DataFrame:
    """The whole cohort with ``user_flag``; exposure columns are null for non-users.

    Non-users include people exposed too early, too late or outside observation. With ``ever``, the
    persons exposed at any time, the comparator is clean of them. The cohort is read once for both arms.
    """
    days = F.datediff("exposure_date", "obesity_index_date")
    joined = cohort.join(first, "person_id", "left").withColumn("days_from_index", days)
    spans = spans.select(F.col("person_id").alias("span_person"), "obs_start", "obs_end", F.lit(1).alias("hit"))
    inside = (
        (joined.person_id == spans.span_person)
        & joined.exposure_date.between(spans.obs_start, spans.obs_end)
        & joined.days_from_index.between(min_days, max_days)
    )
    found = (
        joined.join(spans, inside, "left")
        .groupBy(*joined.columns)
        .agg(F.coalesce(F.max("hit"), F.lit(0)).alias("user_flag"))
    )
    used = F.col("user_flag") == 1
    arms = found
    if ever is not None:
        marked = ever.select("person_id", F.lit(True).alias("ever"))
        arms = found.join(marked, "person_id", "left").filter(used | F.col("ever").isNull())
    return arms.select(
        *cohort.columns,
        F.when(used, F.col("exposure_date")).alias("exposure_index_date"),
        F.when(used, F.col("exposure_concept_id")).alias("exposure_concept_id"),
        F.when(used, F.col("days_from_index")).alias("days_from_index"),
        F.when(used, age_rounded("birth_date", "exposure_date")).alias("age_at_exposure_index"),
        "user_flag",
    )


def users(cohort: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exposed arm with the rounded age at exposure."""
    return cohort.join(candidates, "person_id").select(
        "person_id", "exposure_index_date", "exposure_concept_id", "days_from_index",
        "obesity_index_date", "index_source", "birth_date",
        age_rounded("birth_date", "exposure_index_date").alias("age_at_exposure_index"),
        "gender_concept_id", "race_concept_id", "ethnicity_concept_id", "death_date",
    )


def non_users(cohort: DataFrame, candidates: DataFrame, ever: DataFrame | None = None) -> DataFrame:
    """Unexposed arm; with ``ever`` given, people exposed at any time are left out as well."""
    rest = cohort.join(candidates, "person_id", "left_anti")
    return rest if ever is None else rest.join(ever, "person_id", "left_anti")


def arm_counts(arms: DataFrame) -> DataFrame:
    return arms.groupBy("user_flag").agg(F.count(F.lit(1)).alias("n"))


def drug_order(tables: ClinicalTables, drugs: Sequence[str]) -> DataFrame:
    return local_frame(
        tables.spark,
        {"set_name": list(drugs), "position": list(range(len(drugs)))},
        {"set_name": pa.string(), "position": pa.int32()},
    )


def labelled_exposures(tables: ClinicalTables, sets: ConceptSets, drugs: Sequence[str], start, end) -> DataFrame:
    """The drug of each person and day inside the study dates (date column only).

    A concept of several sets takes the last of them in ``drugs``; among a day's records the one
    with the lowest id counts.
    """
    events = drug_events(tables, date_only=True, start=start, end=end)
    names = drug_order(tables, drugs)
    tagged = sets.tag(events, *drugs).join(names, "set_name")
    # The label's number is chosen, and turned into the label after the grouping.
    chosen = F.min_by("position", F.col("event_id").cast(ORDER) * 10_000 - F.col("position"))
    return tagged.groupBy("person_id", "event_date").agg(chosen.alias("position")).join(names, "position").select(
        "person_id", "event_date", F.col("set_name").alias("exposure_drug")
    )


def windowed_arms(cohort: DataFrame, labelled: DataFrame, members: Membership | None = None) -> DataFrame:
    """The whole cohort with ``user_flag``, first exposure on or after entry, and its drug.

    With ``members`` (of ``cohort``, with the entry date) exposures are tested and reduced to the first one before the join.
    """
    if members is not None:
        after = members.dated(labelled).filter(F.col("event_date") >= F.col(MEMBER_DAY))
        first = after.groupBy(F.col("person_id").alias("exposed_person")).agg(F.min("event_date").alias("exposure_index_date"))
        dated = cohort.join(first, cohort.person_id == first.exposed_person, "left").drop("exposed_person")
    else:
        days = labelled.select(F.col("person_id").alias("exposed_person"), "event_date")
        after = (cohort.person_id == days.exposed_person) & (days.event_date >= cohort.obesity_entry_date)
        dated = cohort.join(days, after, "left").groupBy(*cohort.columns).agg(F.min("event_date").alias("exposure_index_date"))
    # One label per person and day, so the date finds it.
    drugs = labelled.withColumnRenamed("event_date", "exposure_index_date")
    return dated.join(drugs, ["person_id", "exposure_index_date"], "left").select(
        *cohort.columns,
        "exposure_index_date",
        "exposure_drug",
        F.col("exposure_index_date").isNotNull().cast("int").alias("user_flag"),
    )


def drug_distribution(arms: DataFrame) -> DataFrame:
    """Users per drug, most used first."""
    counts = arms.filter("user_flag = 1").groupBy("exposure_drug").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "exposure_drug")
