"""Indexed cohorts from diagnosis and measurement evidence (evidence rules).

The index is chosen over all time and then tested against the study window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import age_rounded, birth_date, safe_double, within
from ..sources.tables import ClinicalTables
from .concepts import ConceptSets
from .events import condition_events, first_deaths, measurement_events, observation_spans, visit_events

# Evidence labels, in order of rank on the same date.
SOURCES = ["condition_dx", "bmi_ge_30", "bmi_ge_27_plus_comorb"]

CONDITION_SET = "conditions"
MEASUREMENT_SET = "measurements"
COMORBIDITY_SET = "comorbidities"


def first_event(events: DataFrame, name: str = "first_date") -> DataFrame:
    """First dated event per person."""
    return events.groupBy("person_id").agg(F.min("event_date").alias(name))


def measurement_values(tables: ClinicalTables, sets: ConceptSets, name: str = MEASUREMENT_SET) -> DataFrame:
    """Readings of a set with a value; unreadable text gives a null ``value``."""
    readings = sets.restrict(measurement_events(tables), name).filter(F.col("value_as_number").isNotNull())
    return readings.select(
        "person_id",
        F.col("event_date").alias("measurement_date"),
        safe_double("value_as_number").alias("value"),
    )


def first_at_least(values: DataFrame, threshold: float, name: str = "first_high") -> DataFrame:
    return (
        values.filter(F.col("value") >= threshold)
        .groupBy("person_id")
        .agg(F.min("measurement_date").alias(name))
    )


def banded_with_prior(values: DataFrame, first_prior: DataFrame, low: float, high: float) -> DataFrame:
    """Readings in [low, high) on or after the person's first prior event (``first_date``).

    Any prior event on or before a reading exists exactly if the first one is.
    """
    banded = values.filter((F.col("value") >= low) & (F.col("value") < high))
    return (
        banded.join(first_prior, "person_id")
        .filter(F.col("first_date") <= F.col("measurement_date"))
        .select("person_id", "measurement_date")
    )


def index_candidates(first_dates: Sequence[DataFrame], sources: Sequence[str] = SOURCES) -> DataFrame:
    """One row per person and kind of evidence; each frame is (person_id, first date)."""
    parts = None
    for rank, (source, df) in enumerate(zip(sources, first_dates), start=1):
        date = df.columns[-1]
        part = df.filter(F.col(date).isNotNull()).select(
            "person_id",
            F.col(date).alias("index_date"),
            F.lit(source).alias("index_source"),
            F.lit(rank).alias("source_rank"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def choose_index(candidates: DataFrame) -> DataFrame:
    """Earliest candidate per person, the better ranked source on equal dates."""
    best = F.min(F.struct("index_date", "source_rank", "index_source")).alias("best")
    return candidates.groupBy("person_id").agg(best).select("person_id", "best.index_date", "best.index_source")


def cap_persons(df: DataFrame, max_persons: int | None, *order: str) -> DataFrame:
    """Debug aid: the first ``max_persons`` rows in the given order."""
    return df if not max_persons else df.orderBy(*(order or ("person_id",))).limit(max_persons)


def evidence_dates(tables: ClinicalTables, sets: ConceptSets, low: float, high: float) -> DataFrame:
    """First date of each kind of evidence per person, from one scan of each fact table."""
    tagged = sets.tag(condition_events(tables), CONDITION_SET, COMORBIDITY_SET)
    diagnoses = tagged.groupBy("person_id").agg(
        F.min(F.when(F.col("set_name") == CONDITION_SET, F.col("event_date"))).alias("first_condition"),
        F.min(F.when(F.col("set_name") == COMORBIDITY_SET, F.col("event_date"))).alias("first_comorbidity"),
    )
    readings = measurement_values(tables, sets).filter(F.col("value") >= low)
    days = readings.groupBy("person_id", "measurement_date").agg(
        F.max(F.col("value") >= high).alias("is_high"),
        F.max(F.col("value") < high).alias("is_banded"),
    )
    day = F.col("measurement_date")
    return (
        days.join(diagnoses, "person_id", "full_outer")
        .groupBy("person_id")
        .agg(
            F.min("first_condition").alias("first_condition"),
            F.min(F.when(F.col("is_high"), day)).alias("first_high"),
            F.min(F.when(F.col("is_banded") & (F.col("first_comorbidity") <= day), day)).alias("first_banded"),
        )
    )


def index_from_dates(dates: DataFrame) -> DataFrame:
    """Index date, source and a flag per kind of evidence that falls on the index date."""
    columns = ["first_condition", "first_high", "first_banded"]
    index = F.least(*columns)
    source = F
    for label, column in zip(SOURCES, columns):
        source = source.when(F.col(column) == F.col("index_date"), label)

    def on_index(column: str, name: str):
        return F.coalesce((F.col(column) == F.col("index_date")).cast("int"), F.lit(0)).alias(name)

    return (
        dates.withColumn("index_date", index)
        .filter(F.col("index_date").isNotNull())
        .select(
            "person_id",
            "index_date",
            source.alias("index_source"),
            on_index("first_condition", "obesity_dx_flag"),
            on_index("first_high", "bmi_ge_30_flag"),
            on_index("first_banded", "bmi_ge_27_plus_comorb_flag"),
        )
    )


def person_core(tables: ClinicalTables) -> DataFrame:
    """Birth date and demographic concepts."""
    person = tables["person"]
    moment = "birth_datetime" if "birth_datetime" in person.columns else None
    born = birth_date("year_of_birth", "month_of_birth", "day_of_birth", moment)
    return person.select("person_id", born.alias("birth_date"), "gender_concept_id",
                         "race_concept_id", "ethnicity_concept_id")


def with_prior_visit(index: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows of ``index`` whose person has a visit strictly before the index date."""
    first = first_event(visits, "first_visit")
    return (
        index.join(first, "person_id")
        .filter(F.col("first_visit") < F.col("index_date"))
        .select(*index.columns)
    )


def covered(df: DataFrame, spans: DataFrame, date: str) -> DataFrame:
    """Rows whose ``date`` lies in an observation period of the person, ends included."""
    inside = (df.person_id == spans.person_id) & df[date].between(spans.obs_start, spans.obs_end)
    return df.join(spans, inside, "left_semi")


def build_cohort(
    tables: ClinicalTables,
    sets: ConceptSets,
    study_start: str,
    study_end: str,
    min_index_date: str,
    min_age: int = 18,
    low: float = 27,
    high: float = 30,
    max_persons: int | None = None,
    index: DataFrame | None = None,
    merge_gap_days: int | None = None,
) -> DataFrame:
    """The final cohort: chosen index, demographics, and every study filter.

    The window test on the index date comes first, so the later joins carry study members only.
    """
    if index is None:
        index = index_from_dates(evidence_dates(tables, sets, low, high))
    index = cap_persons(index, max_persons, "person_id", "index_date", "index_source")
    in_study = index.filter(within("index_date", study_start, study_end) & within("index_date", min_index_date))
    aged = (
        in_study.join(person_core(tables), "person_id")
        .withColumn("age_at_index", age_rounded("birth_date", "index_date"))
        .filter((F.col("age_at_index") >= min_age) & (F.col("index_date") >= F.col("birth_date")))
    )
    alive = aged.join(first_deaths(tables), "person_id", "left").filter(
        F.col("death_date").isNull() | (F.col("index_date") <= F.col("death_date"))
    )
    seen = with_prior_visit(alive, visit_events(tables))
    return covered(seen, observation_spans(tables, merge_gap_days), "index_date").select(
        "person_id", "index_date", "index_source",
        "obesity_dx_flag", "bmi_ge_30_flag", "bmi_ge_27_plus_comorb_flag",
        "birth_date", "age_at_index",
        "gender_concept_id", "race_concept_id", "ethnicity_concept_id", "death_date",
    )


def attrition(index: DataFrame, cohort: DataFrame) -> DataFrame:
    """Persons with evidence and persons kept, as ``(step, n)``."""
    steps = [("evidence", index), ("cohort", cohort)]
    parts = None
    for step, df in steps:
        # Persons are unique in both frames, so a plain count is the distinct count.
        part = df.agg(F.count("person_id").alias("n")).select(F.lit(step).alias("step"), "n")
        parts = part if parts is None else parts.unionByName(part)
    return parts
