"""Cohorts from evidence inside the study dates only (windowed rules)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import ORDER, age_truncated, birth_date, packed_order, safe_double
from ..scale import stage
from ..sources.membership import MEMBER_DAY, Membership
from ..sources.tables import ClinicalTables
from .concepts import ConceptSets
from .cohort import CONDITION_SET, MEASUREMENT_SET
from .events import condition_events, measurement_events, visit_events

# Evidence labels.
DIAGNOSIS = "diagnosis"
HIGH = "bmi_30plus"
BANDED = "bmi_27to29"

SPECIFIC_SET = "specific_condition"


def windowed_evidence(
    tables: ClinicalTables, sets: ConceptSets, start: str, end: str, low: float = 27, high: float = 30
) -> DataFrame:
    """Every diagnosis and every reading of at least ``low`` dated inside the study.

    Only the date column counts; a record with nothing but a timestamp is left out.
    """
    diagnoses = sets.restrict(condition_events(tables, True, start, end), CONDITION_SET)
    readings = sets.restrict(measurement_events(tables, True, start, end), MEASUREMENT_SET)

    def shape(df: DataFrame, label: Column, rank: int, value: Column) -> DataFrame:
        return df.select(
            "person_id",
            F.col("event_date").alias("obesity_date"),
            F.col("event_id").alias("record_id"),
            label.alias("obesity_criterion"),
            value.alias("bmi_value"),
            F.lit(rank).alias("source_rank"),
        )

    value = safe_double("value_as_number")
    by_condition = shape(diagnoses, F.lit(DIAGNOSIS), 1, F.lit(None).cast("double"))
    by_reading = shape(
        readings.filter(value >= low), F.when(value >= high, HIGH).otherwise(BANDED), 2, value
    )
    return by_condition.unionByName(by_reading)


def windowed_entry(evidence: DataFrame) -> DataFrame:
    """Entry date and criterion per person.

    A diagnosis names the criterion whenever there is one, whatever its date; otherwise the
    earliest reading does, the lower record id on equal dates.
    """
    label = F.col("obesity_criterion")
    code = F.when(label == DIAGNOSIS, 1).when(label == HIGH, 2).otherwise(3)
    # The code is chosen and turned back into its label after the grouping, which so needs no sort.
    rank = F.col("source_rank").cast("decimal(4,0)") * F.lit(Decimal(10**30)).cast("decimal(31,0)")
    order = (rank + packed_order("obesity_date", "record_id")).cast(ORDER)
    chosen = evidence.groupBy("person_id").agg(
        F.min("obesity_date").alias("obesity_entry_date"), F.min_by(code, order).alias("code")
    )
    named = F.when(F.col("code") == 1, DIAGNOSIS).when(F.col("code") == 2, HIGH).otherwise(BANDED)
    return chosen.select("person_id", "obesity_entry_date", named.alias("obesity_criterion"))


def visits_before(
    cohort: DataFrame, visits: DataFrame, date: str, name: str = "visits_before_entry", members: Membership | None = None
) -> DataFrame:
    """``cohort`` (one row per person) with the number of visits strictly before ``date``, 0 if none.

    With ``members`` (of ``cohort``, with that date) visits are tested where they are scanned and counted per person. Else they are counted per person and day before the join; the final grouping reuses the join's
    partitioning by person.
    """
    if members is not None:
        earlier = members.dated(visits).filter(F.col("event_date") < F.col(MEMBER_DAY))
        counts = earlier.groupBy(F.col("person_id").alias("visitor")).agg(F.count(F.lit(1)).alias("visits"))
        joined = cohort.join(counts, cohort.person_id == counts.visitor, "left")
        return joined.select(*cohort.columns, F.coalesce("visits", F.lit(0)).cast("int").alias(name))
    per_day = visits.groupBy(F.col("person_id").alias("visitor"), F.col("event_date").alias("visit_day")).agg(
        F.count(F.lit(1)).alias("visits")
    )
    earlier = (cohort.person_id == per_day.visitor) & (per_day.visit_day < cohort[date])
    return (
        cohort.join(per_day, earlier, "left")
        .groupBy(*cohort.columns)
        .agg(F.coalesce(F.sum("visits"), F.lit(0)).cast("int").alias(name))
    )


def study_visits(tables: ClinicalTables, start: str, end: str) -> DataFrame:
    """Visit events that start and end inside the study dates."""
    inside = ClinicalTables(tables.spark, {"visit_occurrence": tables.visits(start=start, end=end)})
    return visit_events(inside, date_only=True)


def flag_specific(cohort: DataFrame, conditions: DataFrame, require: bool) -> DataFrame:
    """Flag persons with any of the (already restricted) conditions at any time; keep only them if required."""
    persons = conditions.select("person_id").distinct()
    if require:
        return cohort.join(persons, "person_id", "left_semi").withColumn("has_specific_condition", F.lit(True))
    flagged = persons.withColumn("has_specific_condition", F.lit(True))
    return cohort.join(flagged, "person_id", "left").withColumn(
        "has_specific_condition", F.coalesce("has_specific_condition", F.lit(False))
    )


def add_entry_age(entry: DataFrame, person: DataFrame, min_age: int = 0) -> DataFrame:
    """All person columns, the birth date and completed years at entry; ``min_age`` 0 keeps everyone."""
    with_age = (
        entry.join(person, "person_id", "left")
        .withColumn("birth_date", birth_date("year_of_birth", "month_of_birth", "day_of_birth"))
        .withColumn("age_at_obesity_entry", age_truncated("birth_date", "obesity_entry_date"))
    )
    return with_age.filter(F.col("age_at_obesity_entry") >= min_age) if min_age else with_age


def build_windowed_cohort(
    tables: ClinicalTables,
    sets: ConceptSets,
    study_start: str,
    study_end: str,
    min_age: int = 18,
    low: float = 27,
    high: float = 30,
    specific: bool = False,
    require_specific: bool = False,
    evidence: DataFrame | None = None,
) -> DataFrame:
    if evidence is None:
        evidence = windowed_evidence(tables, sets, study_start, study_end, low, high)
    aged = add_entry_age(windowed_entry(evidence), tables.persons(), min_age)
    aged = stage(aged)
    members = Membership.of(aged, "obesity_entry_date")
    cohort = visits_before(aged, study_visits(tables, study_start, study_end), "obesity_entry_date", members=members)
    if specific:
        conditions = sets.restrict(condition_events(tables, date_only=True), SPECIFIC_SET)
        cohort = flag_specific(cohort, conditions, require_specific)
    return cohort


def evidence_counts(evidence: DataFrame) -> DataFrame:
    """Records and distinct persons per criterion."""
    per_person = evidence.groupBy("obesity_criterion", "person_id").agg(F.count(F.lit(1)).alias("n"))
    return per_person.groupBy("obesity_criterion").agg(
        F.count(F.lit(1)).alias("n_persons"), F.sum("n").alias("n_records")
    )


def entry_age_range(cohort: DataFrame) -> DataFrame:
    return cohort.agg(
        F.count(F.lit(1)).alias("n_persons"),
        F.min("age_at_obesity_entry").alias("min_age"),
        F.max("age_at_obesity_entry").alias("max_age"),
        F.count_if(F.col("visits_before_entry") >= 1).alias("n_with_visit"),
    )
