"""Time to event: survival data, risk tables, Kaplan-Meier, cumulative incidence and Cox models.

People are reduced to counts per outcome, subgroup, arm and day before anything is ordered, so
every window and every fitted group has at most one row per day of follow-up.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from math import erfc, exp, sqrt

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .concepts import ConceptSets
from .propensity import TREATMENT

CENSORED, EVENT, COMPETING = 0, 1, 2

# The model fit runs in Python workers; sent by value, it works where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def survival_data(
    arms: DataFrame,
    events: DataFrame,
    outcomes: Mapping[str, Sequence[int]],
    spans: DataFrame,
    deaths: DataFrame,
    study_end: str,
    max_years: int | None = None,
    competing_death: bool = False,
    keep_uncovered: bool = False,
) -> DataFrame:
    """``person_id, treatment, [other columns], outcome, T, E`` for every person and outcome.

    The event is the first record of the outcome after ``index_date``. Follow-up ends with the
    covering observation period, death, the study, or ``max_years``, whichever is first. With
    ``competing_death`` a death that ends follow-up has E = 2. People whose follow-up ends before
    their index date have no time at risk and are left out, as are people whose index date no observation
    period covers; ``keep_uncovered`` follows these to death or the end of the study.
    """
    sets = ConceptSets.of_lists(arms.sparkSession, outcomes)
    days = sets.tag(events, *outcomes).select(
        F.col("person_id").alias("event_person"), "set_name", "event_date"
    ).distinct()
    spans = spans.withColumnRenamed("person_id", "span_person")
    keep = arms.columns
    index = F.col("index_date")

    covering = (F.col("person_id") == F.col("span_person")) & index.between(F.col("obs_start"), F.col("obs_end"))
    observed = arms.join(spans, covering, "left" if keep_uncovered else "inner").groupBy(*keep).agg(F.max("obs_end").alias("obs_end"))
    with_death = observed.join(deaths, "person_id", "left")

    later = (F.col("person_id") == F.col("event_person")) & (F.col("event_date") > index)
    firsts = [F.min(F.when(F.col("set_name") == o, F.col("event_date"))).alias(f"first_{i}") for i, o in enumerate(outcomes)]
    wide = with_death.join(days, later, "left").groupBy(*with_death.columns).agg(*firsts)

    ends = [F.col("obs_end"), F.col("death_date"), F.lit(study_end).cast("date")]
    if max_years:
        ends.append(F.add_months(index, 12 * max_years))
    rows = F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(f"first_{i}").alias("event")) for i, o in enumerate(outcomes)])
    status = F.when(F.col("event") <= F.col("censor"), EVENT)
    if competing_death:
        status = status.when(F.col("death_date") == F.col("censor"), COMPETING)
    return (
        wide.withColumn("censor", F.least(*ends))
        .filter(F.col("censor") >= index)
        .select("*", F.inline(rows))
        .select(
            *[c for c in keep if c != "index_date"],
            "outcome",
            F.datediff(F.least("event", "censor"), index).alias("T"),
            status.otherwise(CENSORED).alias("E"),
        )
    )


def risk_table(survival: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per outcome, subgroup and day: events (d0, d1) and people at risk (n0, n1) of each arm."""
    keys = ["outcome", *by]
    arm, event = F.col(TREATMENT), F.col("E") == EVENT
    days = survival.groupBy(*keys, "T").agg(
        F.count_if(event & (arm == 0)).alias("d0"),
        F.count_if(event & (arm == 1)).alias("d1"),
        F.count_if(arm == 0).alias("m0"),
        F.count_if(arm == 1).alias("m1"),
    )
    onward = Window.partitionBy(*keys).orderBy("T").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return days.select(
        *keys, "T", "d0", "d1", F.sum("m0").over(onward).alias("n0"), F.sum("m1").over(onward).alias("n1")
    )


def _arm_days(survival: DataFrame, by: Sequence[str]) -> tuple[list[str], DataFrame]:
    keys = ["outcome", *by, TREATMENT]
    days = survival.groupBy(*keys, "T").agg(
        F.count_if(F.col("E") == EVENT).alias("events"),
        F.count_if(F.col("E") == COMPETING).alias("competing"),
        F.count(F.lit(1)).alias("leaving"),
    )
    onward = Window.partitionBy(*keys).orderBy("T").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return keys, days.withColumn("at_risk", F.sum("leaving").over(onward))


def kaplan_meier(survival: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Survival curve of each arm, one row per day anyone leaves."""
    keys, days = _arm_days(survival, by)
    upto = Window.partitionBy(*keys).orderBy("T").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = 1 - F.col("events") / F.col("at_risk")
    return days.select(*keys, "T", "at_risk", "events", F.product(step).over(upto).alias("survival"))


def cumulative_incidence(survival: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Probability of the event by each day when death competes with it (Aalen-Johansen)."""
    keys, days = _arm_days(survival, by)
    order = Window.partitionBy(*keys).orderBy("T")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    step = 1 - (F.col("events") + F.col("competing")) / F.col("at_risk")
    alive = days.withColumn("alive_before", F.coalesce(F.product(step).over(earlier), F.lit(1.0)))
    rise = F.col("alive_before") * F.col("events") / F.col("at_risk")
    return alive.select(
        *keys, "T", "at_risk", "events", "competing", F.sum(rise).over(upto).alias("incidence")
    )


def _score_and_information(beta: float, days: np.ndarray) -> tuple[float, float]:
    """First derivative and negative second derivative of the Efron log likelihood.

    ``days`` has one row (d0, d1, n0, n1) per day with events. The tied events of a day are one
    vector, so the work grows with the number of events and the Python loop with the days only.
    """
    score, information = float(days[:, 1].sum()), 0.0
    for d0, d1, n0, n1 in days:
        share = np.arange(d0 + d1) / (d0 + d1)
        exposed, others = n1 - share * d1, n0 - share * d0
        # Scaled so that neither weight overflows.
        exposed, others = (exposed * exp(beta), others) if beta < 0 else (exposed, others * exp(-beta))
        mean = exposed / (exposed + others)
        score -= mean.sum()
        information += (mean * (1 - mean)).sum()
    return score, information


def _has_estimate(days: np.ndarray) -> bool:
    """Whether the score, which falls with beta, is positive far to the left and negative far to the right."""
    exposed = others = 0
    for d0, d1, n0, n1 in days:
        share = np.arange(d0 + d1) / (d0 + d1)
        exposed += int(np.count_nonzero(n1 - share * d1 > 1e-12))
        others += int(np.count_nonzero(n0 - share * d0 > 1e-12))
    events, treated = float(days[:, :2].sum()), float(days[:, 1].sum())
    return events - others < treated < exposed


def fit_cox(risk: pd.DataFrame) -> dict[str, float | None]:
    """Hazard ratio of treatment with its 95 % limits and Wald p, from one risk table.

    Null exactly where no finite estimate exists, such as without events or with events in one arm
    only. Otherwise the root of the falling score is bracketed, and Newton steps that leave the
    bracket are replaced by halving it, so the search always ends.
    """
    empty = {"HR": None, "HR_lower_95CI": None, "HR_upper_95CI": None, "p_value": None}
    counts = risk[risk.d0 + risk.d1 > 0][["d0", "d1", "n0", "n1"]].to_numpy(float)
    if not len(counts) or not _has_estimate(counts):
        return empty
    low, high = -1.0, 1.0
    while _score_and_information(low, counts)[0] < 0:
        low *= 2
    while _score_and_information(high, counts)[0] > 0:
        high *= 2
    beta = 0.0
    while True:
        score, information = _score_and_information(beta, counts)
        low, high = (beta, high) if score > 0 else (low, beta)
        following = beta + score / information if information > 0 else low
        if not low < following < high:
            following = (low + high) / 2
        if abs(following - beta) <= 1e-12 * max(1.0, abs(beta)):
            break
        beta = following
    error = 1 / sqrt(information)
    return {
        "HR": exp(beta),
        "HR_lower_95CI": exp(beta - 1.959963984540054 * error),
        "HR_upper_95CI": exp(beta + 1.959963984540054 * error),
        "p_value": erfc(abs(beta / error) / sqrt(2)),
    }


def cox_model(survival: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per outcome (and subgroup): HR, limits on the ratio scale, p value.

    Groups are fitted in parallel from their risk tables, never from the people themselves.
    """
    keys = ["outcome", *by]
    table = risk_table(survival, by)
    kinds = dict(table.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [
        "HR double", "HR_lower_95CI double", "HR_upper_95CI double", "p_value double"
    ])

    def fit(key: tuple, risk: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{**dict(zip(keys, key)), **fit_cox(risk)}])

    return table.groupBy(*keys).applyInPandas(fit, schema)
