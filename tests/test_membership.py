"""Members as bits: exact for any ids, counted before they travel, tested before the first exchange; reductions by a travelling day."""

import datetime
import re

import pytest
from hypothesis import HealthCheck, Phase, example, given, settings, strategies as st

from cohortry.operators import covariates, exposure, windowed
from cohortry.scale import stage
from cohortry.sources.membership import WORD_BYTES, Membership
from cohortry.sources.tables import ClinicalTables
from study_queries import registry

IDS = st.lists(st.integers(-200, 200) | st.integers(-(2**63), 2**63 - 1), max_size=40)
DAY0 = datetime.date(2000, 1, 1)


@given(IDS, IDS)
@example([63, 127, -1, 0, 2**63 - 1, -(2**63)], [62, 64, 1, -2])
@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_exact_for_any_ids(spark, members, others):
    dated = {p: DAY0 + datetime.timedelta(days=i) for i, p in enumerate(dict.fromkeys(members))}
    people = spark.createDataFrame([*dated.items(), (None, DAY0)], "person_id long, day date")
    facts = spark.createDataFrame([(p, i) for i, p in enumerate([*members, *others, None])], "person_id long, n int")
    held = Membership.of(people, "day")
    want = [(p, i) for i, p in enumerate([*members, *others]) if p in dated]
    assert sorted(map(tuple, held.keep(facts).collect())) == sorted(want)
    assert sorted(map(tuple, held.dated(facts).collect())) == sorted((p, i, dated[p]) for p, i in want)
    assert sorted(map(tuple, Membership.of(people).keep(facts).collect())) == sorted(want)


def test_size_is_counted(spark):
    people = spark.range(64_000).toDF("person_id")
    held = Membership.of(people)
    assert held.words.count() == 1000 and held.bytes == 1000 * WORD_BYTES
    assert Membership.of(people, max_bytes=1000 * WORD_BYTES - 1) is None
    with pytest.raises(ValueError, match="no day"):
        held.dated(people)
    assert Membership.of(people.limit(0)).keep(people).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_filtered_before_the_first_exchange(spark, folder):
    spark.range(1000).selectExpr("id % 200 AS person_id", "id AS visit_occurrence_id").write.parquet(f"{folder}/facts")
    tables = ClinicalTables(spark, {"visit_occurrence": spark.read.parquet(f"{folder}/facts")})
    members = stage(spark.range(50).toDF("person_id"))
    bits = tables.of_members(members, max_rows=0)
    counted = bits["visit_occurrence"].groupBy("person_id").count()
    plan = plan_of(counted)
    chain = plan[: plan.index("FileScan")]
    assert chain.index("Exchange hashpartitioning") < chain.index("BroadcastHashJoin") and "getbit" in chain
    assert sorted(map(tuple, counted.collect())) == [(p, 5) for p in range(50)]
    assert tables.of_members(members, max_rows=0, max_bytes=WORD_BYTES - 1) is tables


@pytest.fixture(scope="module")
def context(spark):
    return registry.Context(spark, "/root/testdata/sf0.001")


def shuffled_rows(spark, df):
    """Rows that the first exchange of the plan's facts gets, from the metrics of a finished run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found, todo = [], [text]
    while todo:
        node = todo.pop()
        if node.nodeName() in ("AdaptiveSparkPlan",):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            written = node.metrics().get("shuffleRecordsWritten")
            found.append((written.get().value(), node.toString()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_shuffled_rows_are_bounded_by_persons_and_tasks(spark, frame, context):
    """Many readings per person and day: map tasks send one row per person, whatever their number."""
    base = stage(frame([(p, DAY0) for p in range(20)], "person_id long, index_date date"))
    readings = spark.range(40_000).selectExpr(
        "id % 25 AS person_id", "7 AS concept_id", "DATE'2000-01-01' - CAST(id % 400 AS INT) AS event_date", "id AS event_id", "CAST(id AS STRING) AS value_as_number"
    ).repartition(4)
    readings = stage(readings)
    members = Membership.of(base, "index_date")
    fast = covariates.latest_values(base, readings, {"lab": [7]}, 12, members)
    slow = covariates.latest_values(base, readings, {"lab": [7]}, 12)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    most = max((n for n, text in shuffled_rows(spark, fast) if "event_person" in text), default=0)
    tasks = readings.rdd.getNumPartitions()
    assert 0 < most <= 20 * tasks
    assert max(n for n, _ in shuffled_rows(spark, slow)) > 10 * most


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_both_ways_agree(context):
    c = context
    key = c.indexed.select("person_id", "index_date")
    from cohortry.operators import events

    conditions, labs = events.condition_events(c.tables, date_only=True), events.measurement_events(c.tables, date_only=True)
    features = registry.STUDY.condition_features
    for months in (None, 12):
        assert rows_of(covariates.baseline_flags(key, conditions, features, months, c.members)) == rows_of(covariates.baseline_flags(key, conditions, features, months))
        assert rows_of(covariates.latest_values(key, labs, registry.STUDY.labs, months, c.members)) == rows_of(covariates.latest_values(key, labs, registry.STUDY.labs, months))
    entry = stage(key.withColumnRenamed("index_date", "obesity_entry_date"))
    held = Membership.of(entry, "obesity_entry_date")
    visits = events.visit_events(c.tables, date_only=True)
    assert rows_of(windowed.visits_before(entry, visits, "obesity_entry_date", members=held)) == rows_of(windowed.visits_before(entry, visits, "obesity_entry_date"))
    labelled = exposure.labelled_exposures(c.tables, c.windowed_sets, registry.DRUG_NAMES, registry.START, registry.END)
    assert rows_of(exposure.windowed_arms(entry, labelled, held)) == rows_of(exposure.windowed_arms(entry, labelled))


def test_no_exchange_by_day(context):
    """The reduced path has no grouping by day below its join."""
    from cohortry.operators import events

    found = events.measurement_events(context.tables, date_only=True)
    df = covariates.latest_values(context.indexed.select("person_id", "index_date"), found, registry.STUDY.labs, None, context.members)
    assert not re.search(r"hashpartitioning\([^)]*event_date", plan_of(df))
