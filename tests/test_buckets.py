"""Tables bucketed by person: same rows, one file a bucket, and no shuffle between a fact scan and its first join by person."""

from pathlib import Path

import pytest

from cohortry.plans import steps
from cohortry.sources import csv_tables
from cohortry.sources.buckets import open_buckets, write_buckets
from cohortry.sources.sinks import write_csv
from cohortry.sources.tables import ClinicalTables
from study_queries.study_setup import STUDY
from study_queries.views import clinical_tables

FACTS = ("condition_occurrence", "measurement", "visit_occurrence", "drug_exposure")


@pytest.fixture(scope="module")
def plain(spark):
    return clinical_tables(spark, "/root/testdata/sf0.01")


@pytest.fixture
def bucketed(spark, plain, folder):
    write_buckets(spark, {n: plain[n] for n in plain.names}, f"{folder}/b", 8)
    return ClinicalTables.from_buckets(spark, f"{folder}/b")


def children(node):
    """Nodes below, adaptive wrappers opened."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return [node.executedPlan()]
    if "QueryStage" in name:
        return [node.plan()]
    below = node.children()
    return [below.apply(i) for i in range(below.size())]


def exchanges_over_facts(node, since_join=0):
    """For each fact scan the number of shuffles between it and the nearest join of two large sides above."""
    name = node.nodeName()
    if "FileScan" in node.toString().splitlines()[0] or name.startswith("Scan parquet"):
        line = node.toString().splitlines()[0]
        return [(f, since_join) for f in FACTS if f"bucketed_{f}[" in line]
    if name == "SortMergeJoin":
        since_join = 0
    if name == "Exchange":
        since_join += 1
    return [found for child in children(node) for found in exchanges_over_facts(child, since_join)]


def test_cohort_without_shuffled_facts(spark, plain, bucketed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")  # concept sets travel, tables don't
    try:
        cohort = steps.study_cohort(bucketed, steps.resolve_sets(bucketed, STUDY), STUDY)
        found = exchanges_over_facts(cohort._jdf.queryExecution().executedPlan())
        assert {f for f, _ in found} == {"condition_occurrence", "measurement", "visit_occurrence"}
        assert all(n == 0 for _, n in found), found
        rows = sorted(map(repr, cohort.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == sorted(map(repr, steps.study_cohort(plain, steps.resolve_sets(plain, STUDY), STUDY).collect()))
    assert rows


def test_files_and_reopening(spark, plain, bucketed, folder):
    assert 1 < len(list(Path(f"{folder}/b/measurement").glob("*.parquet"))) <= 8
    spark.sql("DROP TABLE bucketed_measurement")  # as in a later session
    again = open_buckets(spark, f"{folder}/b")
    assert set(again) == set(plain.names)
    for name in ("measurement", "concept"):
        assert sorted(map(repr, again[name].collect())) == sorted(map(repr, plain[name].select(again[name].columns).collect()))
    with pytest.raises(ValueError, match="positive"):
        write_buckets(spark, {}, f"{folder}/none", 0)


def test_conversion(spark, plain, folder):
    for table in ("person", "condition_occurrence", "concept"):
        write_csv(plain[table].coalesce(1), f"{folder}/parts_{table}")
        part = next(Path(f"{folder}/parts_{table}").glob("*.csv"))
        Path(f"{folder}/csv").mkdir(exist_ok=True)
        Path(f"{folder}/csv/x_{table}.csv").write_bytes(part.read_bytes())
    written = csv_tables.convert_to_parquet(spark, f"{folder}/csv", f"{folder}/target", buckets=4)
    assert set(written) == {"person", "condition_occurrence", "concept"}
    tables = ClinicalTables.from_buckets(spark, f"{folder}/target")
    assert "Bucketed: true" in tables["person"].join(tables["condition_occurrence"].hint("merge"), "person_id")._jdf.queryExecution().executedPlan().toString()
    assert tables["condition_occurrence"].count() == plain["condition_occurrence"].count()
