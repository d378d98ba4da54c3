"""Wide person table with use and first date of several drugs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import ClinicalTables
from .concepts import ConceptSets
from .events import drug_events


def drug_universe(tables: ClinicalTables, start: str, end: str) -> DataFrame:
    """Persons with any exposure in the window."""
    return drug_events(tables, start=start, end=end).select("person_id").distinct()


def drug_table(
    tables: ClinicalTables,
    sets: ConceptSets,
    drugs: Sequence[str],
    start: str,
    end: str,
    cohort: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """``{drug}_used`` and ``{drug}_first_date`` for every drug.

    The persons are those with any exposure in the window, or those of ``cohort``. Exposures are
    scanned once and grouped once: the sets are outer-joined by concept, so that people who took
    none of the drugs keep a row too.
    """
    events = drug_events(tables, start=start, end=end).select("person_id", "concept_id", "event_date")
    if cohort is None:
        tagged = events.join(sets.frame(*drugs), "concept_id", "left")
    else:
        tagged = sets.tag(events, *drugs)
    firsts = tagged.groupBy("person_id").agg(
        *[F.min(F.when(F.col("set_name") == d, F.col("event_date"))).alias(f"{d}_first_date") for d in drugs]
    )
    if cohort is not None:
        firsts = cohort.select("person_id").distinct().join(firsts, "person_id", "left")
    columns: list[Column] = [F.col("person_id")]
    for d in drugs:
        columns += [F.col(f"{d}_first_date").isNotNull().cast("int").alias(f"{d}_used"), F.col(f"{d}_first_date")]
    table = firsts.select(*columns)
    return table.orderBy("person_id") if ordered else table


def drug_usage(table: DataFrame, drugs: Sequence[str]) -> DataFrame:
    """Users and percent of persons per drug, from one pass over the wide table."""
    totals = table.agg(
        F.count(F.lit(1)).alias("n_persons"),
        *[F.coalesce(F.sum(f"{d}_used"), F.lit(0)).alias(d) for d in drugs],
    )
    long = totals.unpivot("n_persons", list(drugs), "drug", "n_users")
    percent = F.coalesce(F.try_divide(F.col("n_users") * 100.0, F.col("n_persons")), F.lit(0.0))
    return long.select("drug", "n_persons", "n_users", percent.alias("percent"))


def drug_count_distribution(table: DataFrame, drugs: Sequence[str]) -> DataFrame:
    """Persons by number of different drugs used, 0 included."""
    used = reduce(Column.__add__, [F.col(f"{d}_used") for d in drugs])
    return table.groupBy(used.alias("drug_count")).agg(F.count(F.lit(1)).alias("person_count"))
