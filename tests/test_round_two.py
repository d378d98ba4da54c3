"""CSV dialect, rules over all time, estimates that exist, plans without sorts, and sectioned studies."""

import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from cohortry.functions.columns import packed_id, packed_order
from cohortry.operators import exposure, survival
from cohortry.plans import steps
from cohortry.plans.study import study_from_dict
from cohortry.scale import scratch, stage, staging_root
from cohortry.sources import csv_tables, sinks
from cohortry.sources.concept_files import parse_id_list
from cohortry.sources.tables import ClinicalTables
from study_queries import registry
from study_queries.study_setup import STUDY, WINDOWED_STUDY

FOLDER = "/root/testdata/sf0.001"


def save(folder, name, text):
    path = Path(folder) / name
    path.write_text(text)
    return str(path)


def test_quotes_delimiters_and_line_ends(spark, folder):
    text = 'id,note,end\n1,plain,a\n2,"say ""hi"", twice",b\n3,"x ""y"" z",c\n4,"two\nlines",d\n5,,e\n'
    path = save(folder, "q.csv", text)
    kinds = {"id": "int"}
    rows = csv_tables.read_csv_table(spark, path, types=kinds, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        (1, "plain", "a"), (2, 'say "hi", twice', "b"), (3, 'x "y" z', "c"), (4, "two\nlines", "d"), (5, None, "e")
    ]
    assert csv_tables.read_csv_table(spark, path, types=kinds).collect() == rows
    single = csv_tables.read_csv_table(spark, path, types=kinds, multi_line=False).collect()
    assert [r.id for r in single] == [1, 2, 3, 5]
    for delimiter in "\t;|":
        other = save(folder, f"d{ord(delimiter)}.csv", text.replace("two\nlines", "two").replace(",", delimiter))
        assert [r.id for r in csv_tables.read_csv_table(spark, other, types=kinds).collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="none of the expected columns"):
        csv_tables.read_csv_table(spark, path, "person")


def test_written_csv_is_read_by_others(spark, folder):
    rows = [(1, 'a "b", c'), (2, ""), (3, None), (4, " kept blanks "), (5, "x\ny"), (6, "back\\slash")]
    path = sinks.write_csv(spark.createDataFrame(rows, "id int, t string").coalesce(1), f"{folder}/out")
    part = next(Path(path).glob("*.csv"))
    theirs = pd.read_csv(part, keep_default_na=False)
    assert theirs.t.tolist() == ['a "b", c', "", "", " kept blanks ", "x\ny", "back\\slash"]
    ours = [tuple(r) for r in sinks.read_back(spark, path, "id int, t string").collect()]
    assert [r for r in ours if r[0] != 2] == [r for r in rows if r[0] != 2]


def test_compact_dates_and_counts_of_dropped_lines(spark, folder):
    path = save(folder, "death.csv", "person_id,death_date\n1,20010203\n2,2001-02-03\n3,2001/02/03\n4,03.02.2001\nx,20010203\n5\n6,\n")
    rows = csv_tables.read_csv_table(spark, path, "death").collect()
    day = datetime.date(2001, 2, 3)
    assert [(r.person_id, r.death_date) for r in rows] == [(1, day), (2, day), (3, day), (6, None)]
    lost = {r.reason: r.n for r in csv_tables.dropped_lines(spark, path, "death").collect()}
    assert lost == {"death_date": 1, "person_id": 1, "field count": 1}


def test_different_headers_from_the_main_entry(spark, folder):
    save(folder, "x_measurement_1.csv", "measurement_id,person_id\n1,1\n")
    save(folder, "x_measurement_2.csv", "PERSON_ID,MEASUREMENT_ID,value_as_number\n2,2,7\n")
    rows = ClinicalTables.from_csv(spark, folder, union_by_name=True)["measurement"].collect()
    assert sorted((r.measurement_id, r.person_id, r.value_as_number) for r in rows)[0][:2] == (1, 1) and len(rows) == 2


def test_large_ids_keep_their_digits():
    assert parse_id_list("9007199254740993, 12.0, x, -3, 1.5, ,") == [9007199254740993, 12, -3]


def test_clean_comparator_looks_at_all_time(frame):
    day = datetime.date
    cohort = frame([(i, day(2000, 1, 1), "s", day(1960, 1, 1), 40, 1, 1, 1, None) for i in (1, 2, 3)],
                   "person_id long, obesity_index_date date, index_source string, birth_date date, age_at_index int, "
                   "gender_concept_id int, race_concept_id int, ethnicity_concept_id int, death_date date")
    first = frame([(1, day(2000, 2, 1), 5, 9)], "person_id long, exposure_date date, exposure_id long, exposure_concept_id long")
    spans = frame([(i, day(1990, 1, 1), day(2010, 1, 1)) for i in (1, 2, 3)], "person_id long, obs_start date, obs_end date")
    # Person 2 was treated long before the study, person 3 never.
    ever = frame([(1,), (2,)], "person_id long")
    arms = {r.person_id: r.user_flag for r in exposure.label_arms(cohort, first, spans, ever=ever).collect()}
    assert arms == {1: 1, 3: 0}
    assert len(exposure.label_arms(cohort, first, spans).collect()) == 3


def test_uncovered_people_are_left_out_of_survival(frame, spark):
    day = datetime.date
    arms = frame([(1, 1, day(2000, 1, 1)), (2, 0, day(2000, 1, 1)), (3, 0, day(2000, 1, 1))], "person_id long, treatment int, index_date date")
    spans = frame([(1, day(1999, 1, 1), day(2001, 1, 1)), (2, day(2001, 1, 1), day(2005, 1, 1))], "person_id long, obs_start date, obs_end date")
    events = frame([(2, 7, day(2002, 1, 1))], "person_id long, concept_id long, event_date date")
    deaths = frame([(3, day(2003, 1, 1))], "person_id long, death_date date")
    run = lambda **k: {r.person_id: (r["T"], r.E) for r in survival.survival_data(arms, events, {"o": [7]}, spans, deaths, "2005-12-31", **k).collect()}
    assert run() == {1: (366, 0)}
    assert run(keep_uncovered=True) == {1: (366, 0), 2: (731, 1), 3: (1096, 0)}


def test_cox_finds_every_estimate_that_exists():
    far = pd.DataFrame([(1, 0, 100_000, 1), (0, 1, 99_999, 1)], columns=["d0", "d1", "n0", "n1"])
    found = survival.fit_cox(far)
    days = far.to_numpy(float)
    score, _ = survival._score_and_information(np.log(found["HR"]), days)
    assert abs(score) < 1e-8
    lone = pd.DataFrame([(0, 2, 5, 3), (1, 0, 5, 0)], columns=["d0", "d1", "n0", "n1"])
    assert survival.fit_cox(lone)["HR"] is None
    assert survival.fit_cox(far.iloc[:0])["HR"] is None


def test_packed_order(frame):
    rows = [(datetime.date(1960, 5, 1), 3), (datetime.date(1960, 5, 1), 2**62), (datetime.date(2020, 1, 1), -5), (datetime.date(2020, 1, 1), 0)]
    df = frame([(*r, i) for i, r in enumerate(rows)], "d date, i long, k int").withColumn("o", packed_order("d", "i"))
    assert [r.k for r in df.orderBy("o").collect()] == [0, 1, 2, 3]
    assert [r.x for r in df.orderBy("k").select(packed_id("o").alias("x")).collect()] == [i for _, i in rows]


@pytest.mark.parametrize("name", ["first_exposure", "windowed_entry", "labelled_exposures", "users_windowed", "last_value", "person_first"])
def test_wide_groupings_do_not_sort(spark, name):
    plan = registry.run(name, spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_sectioned_study_to_files(spark, folder):
    tables = registry.Context(spark, FOLDER).tables
    config = {
        "cdm_path": folder, "tables": {},
        "concept_sets": {"x_conditions": {"concept_ids": [0]}, "x_measurements": [0], "x_comorbidities": {"concept_ids": [20]},
                         "x_ingredients": {"concept_ids": [100, 110, 120]}},
        "study": {"name": "t", "start_date": STUDY.study_start, "end_date": STUDY.study_end, "x_min_index_date": "1995-03-01"},
        "exposure": {"exclude_ever_exposed": False, "max_days_from_x_index": 730},
        "features": {"conditions": {"c_a": [11]}, "drugs": {"m_a": [50]}, "labs": {"lab_b": [3]}},
        "matching": {"features": ["age_at_index", "sex", "c_a", "m_a", "lab_b"]},
        "outcomes": [{"name": "out_a", "concept_ids": [21, 22]}], "subgroups": ["sex"],
        "output": {"dir": folder, "cohort_csv": "c.csv", "user_csv": "u.csv", "nonuser_csv": "n.csv"},
    }
    study = study_from_dict(config)
    root = Path(staging_root(spark).removeprefix("file:")) / "cohortry"
    before = set(root.iterdir()) if root.exists() else set()
    written = steps.run_and_write(tables, study, "csv")
    assert set(root.iterdir()) == before
    assert {"attrition", "before_after", "match_rate", "cox", "kaplan_meier", "incidence", "cox_subgroups", "cohort_csv", "user_csv", "nonuser_csv"} <= set(written)
    count = lambda p: spark.read.options(**csv_tables.csv_options(multi_line=True)).csv(p).count()
    assert count(f"{folder}/u.csv") + count(f"{folder}/n.csv") == count(f"{folder}/c.csv") > 0
    # The written cohort is the next study's input.
    again = study.with_changes(source_dir=folder, cohort_input="c.csv", matching_features=())
    result = steps.run_study(tables, again)
    assert result.scored is None and result.arms.count() == count(f"{folder}/c.csv")


def test_baseline_rules_and_age_in_a_study(spark):
    c = registry.Context(spark, FOLDER)
    strict = study_from_dict({"true_age_at_index": True, "baseline_conditions": {"exclude": [30]}, "study_start_date": "1995-01-01"})
    assert strict.true_age_at_index and strict.baseline_exclude.ids == (30,) and strict.baseline_include is None
    study = WINDOWED_STUDY.with_changes(baseline_exclude=strict.baseline_exclude, true_age_at_index=True)
    sets = steps.resolve_sets(c.tables, study)
    kept = steps.eligible_arms(c.tables, study, c.windowed_arms, sets)
    loose = steps.eligible_arms(c.tables, WINDOWED_STUDY, c.windowed_arms)
    assert 0 < kept.count() < loose.count()


def test_scratch_is_removed(spark):
    with scratch(spark):
        path = stage(spark.range(3)).inputFiles()[0]
        assert Path(path.removeprefix("file://")).exists()
    assert not Path(path.removeprefix("file://")).parent.exists()
