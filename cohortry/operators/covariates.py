"""Baseline covariates: flags and latest values on or before the index date.

Each fact table is scanned once for all its features, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import lookback_start, packed_order, safe_double, sex_from_concept
from ..sources.membership import MEMBER_DAY, Membership
from ..sources.tables import ClinicalTables
from .concepts import ConceptSets
from .events import condition_events, drug_events, measurement_events

Features = Mapping[str, Sequence[int]]


def with_index_date(arms: DataFrame, exposure: str = "exposure_index_date", entry: str = "obesity_index_date") -> DataFrame:
    """Index date: exposure for users, cohort entry for non-users."""
    return arms.withColumn("index_date", F.when(F.col("user_flag") == 1, F.col(exposure)).otherwise(F.col(entry)))


def with_demographics(arms: DataFrame, keep_race: bool = False) -> DataFrame:
    """``sex`` from its concept; ``race`` is the constant Other unless the concept is kept."""
    out = arms
    if "gender_concept_id" in arms.columns:
        out = out.withColumn("sex", sex_from_concept("gender_concept_id"))
    if "race_concept_id" in arms.columns:
        race = F.col("race_concept_id").cast("string") if keep_race else F.lit("Other")
        out = out.withColumn("race", race)
    return out


def _tagged(events: DataFrame, features: Features) -> DataFrame:
    sets = ConceptSets.of_lists(events.sparkSession, features)
    return sets.tag(events, *features)


def _on_baseline(day: str, index: Column, lookback_months: int | None) -> Column:
    test = F.col(day) <= index
    return test if lookback_months is None else test & (F.col(day) >= lookback_start(index, lookback_months))


def baseline_flags(
    base: DataFrame, events: DataFrame, features: Features, lookback_months: int | None = None, members: Membership | None = None
) -> DataFrame:
    """``base`` (one row per person with ``index_date``) plus a 0/1 column per feature.

    Without a look-back limit a flag only asks whether the first record is early enough, so events
    shrink to one row per person before the join. With a limit they do where ``members`` (of ``base``, with its
    index date) are given, since then each row is tested where it is scanned; else the distinct days are kept.
    """
    if not features:
        return base
    tagged = _tagged(events, features).withColumnRenamed("person_id", "event_person")
    index = F.col("index_date")
    asof = members is not None and lookback_months is not None

    def is_feature(f):
        return F.col("set_name") == f

    if asof:
        near = members.dated(tagged, "event_person").filter(_on_baseline("event_date", F.col(MEMBER_DAY), lookback_months))
        found = near.groupBy("event_person").agg(*[F.max(is_feature(f).cast("int")).alias(f"any_{f}") for f in features])
        joined = base.join(found, F.col("person_id") == F.col("event_person"), "left")
        return joined.select(*base.columns, *[F.coalesce(f"any_{f}", F.lit(0)).alias(f) for f in features])

    if lookback_months is None:
        firsts = tagged.groupBy("event_person").agg(
            *[F.min(F.when(is_feature(f), F.col("event_date"))).alias(f"first_{f}") for f in features]
        )
        joined = base.join(firsts, F.col("person_id") == F.col("event_person"), "left")
        flags = [F.coalesce((F.col(f"first_{f}") <= index).cast("int"), F.lit(0)).alias(f) for f in features]
        return joined.select(*base.columns, *flags)

    days = tagged.select("event_person", "set_name", "event_date").distinct()
    near = (F.col("person_id") == F.col("event_person")) & _on_baseline("event_date", index, lookback_months)
    flags = [F.coalesce(F.max(is_feature(f).cast("int")), F.lit(0)).alias(f) for f in features]
    return base.join(days, near, "left").groupBy(*base.columns).agg(*flags)


def latest_values(
    base: DataFrame, events: DataFrame, labs: Features, lookback_months: int | None = None, members: Membership | None = None
) -> DataFrame:
    """``base`` plus, per lab, the latest readable value on or before the index date, null if none.

    Several readings on one day: the highest measurement id counts. With ``members`` (of ``base``, with its index date)
    map tasks keep the latest reading of each person and lab, one row per person. Else readings shrink to one per
    person, lab and day before the join; the grouping after it reuses the join's partitioning.
    """
    if not labs:
        return base
    value = safe_double("value_as_number")
    readable = events.select("person_id", "concept_id", "event_date", "event_id", value.alias("value")).filter(
        F.col("value").isNotNull() & F.col("event_date").isNotNull()
    )
    if members is not None:
        tagged = _tagged(readable, labs).withColumnRenamed("person_id", "event_person")
        near = members.dated(tagged, "event_person").filter(_on_baseline("event_date", F.col(MEMBER_DAY), lookback_months))
        order = packed_order("event_date", "event_id")
        found = near.groupBy("event_person").agg(*[F.max_by("value", F.when(F.col("set_name") == lab, order)).alias(f"last_{lab}") for lab in labs])
        joined = base.join(found, F.col("person_id") == F.col("event_person"), "left")
        return joined.select(*base.columns, *[F.col(f"last_{lab}").alias(lab) for lab in labs])
    days = (
        _tagged(readable, labs)
        .groupBy(F.col("person_id").alias("event_person"), "set_name", "event_date")
        .agg(F.max_by("value", "event_id").alias("value"))
    )
    near = (F.col("person_id") == F.col("event_person")) & _on_baseline("event_date", F.col("index_date"), lookback_months)
    latest = [F.max_by("value", F.when(F.col("set_name") == lab, F.col("event_date"))).alias(lab) for lab in labs]
    carried = [F.any_value(c).alias(c) for c in base.columns if c != "person_id"]
    return base.join(days, near, "left").groupBy("person_id").agg(*carried, *latest)


def extract_covariates(
    tables: ClinicalTables,
    base: DataFrame,
    conditions: Features,
    drugs: Features,
    labs: Features,
    lookback_months: int | None = None,
    date_only: bool = True,
    keep_race: bool = False,
    members: Membership | None = None,
) -> DataFrame:
    """All covariates of both arms in three fact scans; ``base`` has person_id, index_date, demographics.

    ``members`` are those of ``base`` with its index date, if they are small enough to travel. Condition features without ids are left out, drug features without ids are 0.
    """
    named = {f: ids for f, ids in conditions.items() if ids}
    out = with_demographics(base, keep_race)
    out = latest_values(out, measurement_events(tables, date_only), labs, lookback_months, members)
    out = baseline_flags(out, condition_events(tables, date_only), named, lookback_months, members)
    out = baseline_flags(out, drug_events(tables, date_only), drugs, lookback_months, members)
    return out.select(*base.columns, *[c for c in ("sex", "race") if c in out.columns], *named, *drugs, *labs)
