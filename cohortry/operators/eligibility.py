"""Eligibility rules on labelled arms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .cohort import first_event


def eligibility_rules(
    age: str = "age_at_obesity_entry",
    min_age: int | None = 18,
    require_visit: bool = True,
    visits: str = "visits_before_entry",
) -> dict[str, Column]:
    """Named predicates in the order they are applied, the same for both arms."""
    rules: dict[str, Column] = {}
    if min_age:
        rules["min_age"] = F.col(age) >= min_age
    if require_visit:
        rules["baseline_visit"] = F.col(visits) >= 1
    return rules


def apply_rules(arms: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    for rule in rules.values():
        arms = arms.filter(rule)
    return arms


def rule_attrition(arms: DataFrame, rules: Mapping[str, Column], arm: str = "user_flag") -> DataFrame:
    """Persons left in each arm after every rule, as ``(arm, step, n)``; one pass for all rules."""
    passed, counts = F.lit(True), {"initial": F.count(F.lit(1))}
    for name, rule in rules.items():
        passed = passed & F.coalesce(rule, F.lit(False))
        counts[name] = F.count_if(passed)
    wide = arms.groupBy(arm).agg(*[c.alias(n) for n, c in counts.items()])
    return wide.unpivot(arm, list(counts), "step", "n")


def with_follow_up(arms: DataFrame, spans: DataFrame, index: str, min_days: int) -> DataFrame:
    """Persons observed for at least ``min_days`` after the index, in the period covering it."""
    enough = (
        (arms.person_id == spans.person_id)
        & arms[index].between(spans.obs_start, spans.obs_end)
        & (F.datediff(spans.obs_end, arms[index]) >= min_days)
    )
    return arms.join(spans, enough, "left_semi")


def by_baseline_condition(arms: DataFrame, events: DataFrame, index: str, exclude: bool = False) -> DataFrame:
    """Keep (or exclude) persons with any of the events on or before the index.

    Only the first event matters, so events shrink to one row per person before the join.
    """
    first = first_event(events, "first_condition").withColumnRenamed("person_id", "condition_person")
    hit = (arms.person_id == first.condition_person) & (first.first_condition <= arms[index])
    return arms.join(first, hit, "left_anti" if exclude else "left_semi")
