"""Shape of the physical plans, and whole studies from files to results."""

import json
import re
from pathlib import Path

import pytest

from cohortry.operators import covariates, drug_table, events, matching
from cohortry.plans import steps
from cohortry.plans.study import WINDOWED
from cohortry.scale import stage
from cohortry.sources.csv_tables import convert_to_parquet
from cohortry.sources.results import read_results
from cohortry.sources.sinks import write_csv
from cohortry.sources.tables import ClinicalTables
from study_queries import registry
from study_queries.study_setup import DRUGS, STUDY, WINDOWED_STUDY
from study_queries.views import VIEWS, clinical_tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    """Reads of one table; a reused exchange is listed once."""
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\b", plan_of(df)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The test study stored the way a converted export is: one Parquet table each."""
    base = str(tmp_path_factory.mktemp("tables"))
    views = clinical_tables(spark, FOLDER)
    for name in VIEWS:
        views[name].write.parquet(f"{base}/{name}")
    return ClinicalTables.from_parquet(spark, {name: f"{base}/{name}" for name in VIEWS})


@pytest.fixture(scope="module")
def sets(tables):
    return steps.resolve_sets(tables, STUDY)


@pytest.fixture
def shuffle_joins(spark):
    """No table is small enough to broadcast, as at full scale."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def assert_scalable(df):
    plan = plan_of(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        assert bad not in plan, bad


def test_each_fact_is_scanned_once_per_cohort(tables, sets):
    members = steps.study_cohort(tables, sets, STUDY)
    for table in ("condition_occurrence", "measurement", "visit_occurrence", "observation_period", "death", "person"):
        assert scans(members, table) == 1, table
    assert_scalable(members)


def test_arms_read_exposures_once(tables, sets):
    members = stage(steps.study_cohort(tables, sets, STUDY))
    arms = steps.study_arms(tables, sets, STUDY, members)
    assert scans(arms, "drug_exposure") == 1
    assert_scalable(arms)


def test_covariates_scan_each_domain_once(tables, sets):
    members = stage(steps.study_cohort(tables, sets, STUDY))
    arms = stage(covariates.with_index_date(steps.study_arms(tables, sets, STUDY, members)))
    frame = steps.study_covariates(tables, STUDY, arms)
    for table in ("condition_occurrence", "drug_exposure", "measurement"):
        assert scans(frame, table) == 1, table
    assert_scalable(frame)


def test_drug_table_is_one_scan_and_one_shuffle(tables, sets):
    wide = drug_table.drug_table(tables, sets, list(DRUGS), STUDY.study_start, STUDY.study_end)
    assert scans(wide, "drug_exposure") == 1
    assert plan_of(wide).count("Exchange hashpartitioning") == 1


def test_concept_filters_and_columns_reach_the_scan(tables, sets):
    kept = sets.restrict(events.measurement_events(tables), "measurements").select("person_id", "event_date")
    scan = next(line for line in plan_of(kept).splitlines() if "FileScan" in line)
    assert re.search(r"PushedFilters: \[[^\]]*measurement_concept_id,0", scan), scan
    assert "value_as_number" not in scan and "measurement_id" not in scan


def test_date_ranges_reach_the_scan(tables):
    for date_only in (False, True):
        kept = events.drug_events(tables, date_only, STUDY.study_start, STUDY.study_end)
        scan = next(line for line in plan_of(kept).splitlines() if "FileScan" in line)
        pushed = scan.split("PushedFilters: ")[1]
        assert "GreaterThanOrEqual(drug_exposure_start_date" in pushed, scan


@pytest.mark.parametrize("study", [STUDY, WINDOWED_STUDY], ids=lambda s: s.rules)
def test_results_do_not_depend_on_broadcasts(tables, study, spark):
    sets = steps.resolve_sets(tables, study)

    def run():
        arms = steps.study_arms(tables, sets, study, steps.study_cohort(tables, sets, study))
        frame = steps.study_covariates(tables, study, steps.eligible_arms(tables, study, arms))
        return sorted(map(repr, frame.collect()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with_broadcast = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == with_broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert with_broadcast


def test_shuffle_plans_have_no_pairwise_join(tables, sets, shuffle_joins):
    members = steps.study_cohort(tables, sets, STUDY)
    arms = covariates.with_index_date(steps.study_arms(tables, sets, STUDY, members))
    assert_scalable(arms)
    assert_scalable(steps.study_covariates(tables, STUDY, arms))


def test_other_people_are_dropped_before_the_shuffle(tables, sets, monkeypatch):
    members = stage(steps.study_cohort(tables, sets, STUDY))
    arms = stage(covariates.with_index_date(steps.study_arms(tables, sets, STUDY, members)))
    theirs, whole = tables.of_members(members), tables.of_members(members, max_rows=1, max_bytes=0)
    assert whole is tables
    assert theirs["measurement"].count() < tables["measurement"].count()
    assert theirs["concept"].count() == tables["concept"].count()
    few, all_rows = (steps.study_covariates(t, STUDY, arms) for t in (theirs, whole))
    assert "LeftSemi, BuildRight" in plan_of(few)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, all_rows.collect()))


def test_matching_is_windowed_by_bucket(frame):
    rows = [(i, i % 2, float(i % 97)) for i in range(500)]
    pairs = matching.match_pairs(frame(rows, "person_id long, treatment int, logit_ps double"), 1.0, rows_per_bucket=50)
    plan = plan_of(pairs)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "hashpartitioning(bucket" in plan


@pytest.mark.parametrize("study", [STUDY, WINDOWED_STUDY], ids=lambda s: s.rules)
def test_whole_study(tables, study, spark, folder):
    result = steps.run_study(tables, study)
    people, arms = result.cohort.count(), result.arms
    assert arms.count() == people == arms.select("person_id").distinct().count()
    pairs = result.pairs.toPandas()
    assert pairs.user_person_id.is_unique and pairs.nonuser_person_id.is_unique
    assert result.matched.count() == 2 * len(pairs)
    assert result.balance.count() == len(result.features)
    written = steps.write_study(result, study.with_changes(output_dir=folder), "csv")
    for name, path in written.items():
        assert spark.read.option("header", True).csv(path).columns, name
    assert spark.read.option("header", True).csv(written["match_pairs"]).count() == len(pairs)
    assert {"users", "nonusers", "users_eligible", "nonusers_with_covariates", "matched_users", "balance_stats", "cox"} <= set(written)
    steps.commit_study(result, study.with_changes(output_dir=f"{folder}/whole"))
    back = read_results(spark, f"{folder}/whole", study.cohort_name)
    assert sorted(map(repr, back["match_pairs"].collect())) == sorted(map(repr, result.pairs.collect()))
    assert {"users", "matched", "attrition", "cox"} <= set(back)


def test_study_from_csv_export_and_json(spark, tables, folder):
    """A JSON study with concept files over a CSV export gives the same cohort as the tables it came from."""
    for name in VIEWS:
        if name != "procedure_occurrence":
            part = f"{folder}/parts/{name}"
            write_csv(tables[name].coalesce(1), part)
            source = next(Path(part).glob("*.csv"))
            Path(f"{folder}/r1_{name}.csv").write_text(source.read_text())
    config = {
        "cohort_name": "x", "output_dir": folder, "study_start_date": STUDY.study_start, "study_end_date": STUDY.study_end,
        "x_diagnosis_concepts": {"concept_ids": [0]}, "x_measurement_concepts": [0], "min_age_at_entry": 18, "min_age_at_index": 18,
        "specific_condition_concepts": {"concept_ids": [30]}, "x_drugs": ["alpha", "beta"], "concept_sets_dir": folder,
        "matching_features": ["age_at_obesity_entry", "sex", "c_a", "lab_b"],
    }
    Path(f"{folder}/alpha_concepts.csv").write_text("CONCEPT_ID\n" + "\n".join(map(str, range(100, 110))))
    Path(f"{folder}/beta_concepts.json").write_text('{"concept_ids": [110]}')
    Path(f"{folder}/comorbidities.csv").write_text("Name,concept_ids,description\nc_a,11,x\n")
    Path(f"{folder}/medications.csv").write_text("Name,concept_ids,description\nm_a,50,x\n")
    Path(f"{folder}/labs.json").write_text('{"lab_b": [3]}')
    Path(f"{folder}/study.json").write_text(json.dumps(config))

    from cohortry.plans.study import load_study

    study = steps.load_concept_files(spark, load_study(spark, f"{folder}/study.json"))
    assert study.rules == WINDOWED
    export = Path(f"{folder}/export")
    export.mkdir()
    for path in Path(folder).glob("r1_*.csv"):
        (export / path.name).write_text(path.read_text())
    stored = ClinicalTables.from_parquet(spark, convert_to_parquet(spark, str(export), f"{folder}/parquet"))
    direct = ClinicalTables.from_csv(spark, str(export))

    def arms(t):
        resolved = steps.resolve_sets(t, study)
        return sorted(map(repr, steps.study_arms(t, resolved, study, steps.study_cohort(t, resolved, study)).select(
            "person_id", "obesity_entry_date", "age_at_obesity_entry", "visits_before_entry", "exposure_drug", "user_flag"
        ).collect()))

    want = arms(tables)
    assert want and arms(stored) == want and arms(direct) == want


@pytest.mark.parametrize("name, most", [("combined_arms", 2), ("non_users_clean", 3), ("non_users", 1), ("users", 1)])
def test_arms_hold_only_their_own_joins(spark, shuffle_joins, name, most):
    """Each sorted side of a join holds memory until its stage ends; the cohort's joins belong to earlier stages."""
    assert plan_of(registry.run(name, spark, FOLDER)).count("SortMergeJoin") <= most
