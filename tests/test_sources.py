import json
from pathlib import Path

import pytest

from cohortry.operators import concepts
from cohortry.plans.study import EVIDENCE, WINDOWED, Study, load_study, study_from_dict
from cohortry.scale import stage, staging_root
from cohortry.sources import concept_files as files
from cohortry.sources import csv_tables, sinks
from cohortry.sources.tables import ClinicalTables, keep_ids


def write(folder, name, text):
    path = Path(folder) / name
    path.write_text(text)
    return str(path)


def test_tables_are_found_by_name(spark, folder):
    for name in ("person.csv", "r1_person.csv", "b_death.csv", "a_death.csv", "r1_vocab.csv",
                 "r1_measurement_half1.csv", "r1_measurement_half2.csv", "notes.csv", "skip.txt"):
        write(folder, name, "a\n1\n")
    found = csv_tables.discover_tables(spark, folder)
    names = {t: [p.rsplit("/", 1)[1] for p in paths] for t, paths in found.items()}
    assert names == {
        "person": ["person.csv"],
        "death": ["a_death.csv"],
        "vocabulary": ["r1_vocab.csv"],
        "measurement": ["r1_measurement_half1.csv", "r1_measurement_half2.csv"],
    }


def test_bad_lines_go_whatever_is_selected(spark, folder):
    path = write(folder, "r1_person.csv",
                 'PERSON_ID,YEAR_OF_BIRTH,NOTE\n1,1990,a\nx,1991,b\n3,1992\n4,1993,c,d\n5,,e\n6,2000,"q,z"\n7,2001.0,\n8,abc,\n')
    df = csv_tables.read_csv_table(spark, path, "person")
    assert df.columns == ["person_id", "year_of_birth", "note"]
    assert sorted(r.person_id for r in df.select("person_id").collect()) == [1, 5, 6, 7]
    assert [r.note for r in df.orderBy("person_id").select("note").collect()] == ["a", "e", "q,z", None]
    assert sorted(r.year_of_birth or 0 for r in df.select("year_of_birth").collect()) == [0, 1990, 2000, 2001]
    assert df.count() == 4


def test_split_measurements_and_text_values(spark, folder):
    head = "MEASUREMENT_ID,PERSON_ID,MEASUREMENT_CONCEPT_ID,MEASUREMENT_DATE,VALUE_AS_NUMBER\n"
    write(folder, "x_measurement_1.csv", head + "1,1,5,2020-01-01,30.5\n2,1,5,2020-01-02,n/a\n")
    write(folder, "x_measurement_2.csv", head + "3,2,5,2020-01-03,\n4,2,5,not a date,1\n")
    df = ClinicalTables.from_csv(spark, folder).measurements()
    assert [(r.measurement_id, r.value_as_number) for r in df.orderBy("measurement_id").collect()] == [
        (1, "30.5"), (2, "n/a"), (3, None)
    ]


def test_files_with_different_headers(spark, folder):
    a = write(folder, "a.csv", "person_id,death_date\n1,2000-01-01\n")
    b = write(folder, "b.csv", "DEATH_DATE,PERSON_ID,cause\n2001-01-01,2,x\n")
    df = csv_tables.read_csv_table(spark, [a, b], "death", union_by_name=True)
    assert {(r.person_id, str(r.death_date), r.cause) for r in df.collect()} == {(1, "2000-01-01", None), (2, "2001-01-01", "x")}


def test_conversion_keeps_types_and_names(spark, folder):
    write(folder, "r1_death.csv", "PERSON_ID,DEATH_DATE\n1,2000-01-01\n2,oops\n")
    write(folder, "r1_concept_ancestor.csv", "ANCESTOR_CONCEPT_ID,DESCENDANT_CONCEPT_ID\n2,3\n1,3\n")
    written = csv_tables.convert_to_parquet(spark, folder, f"{folder}/parquet")
    assert set(written) == {"death", "concept_ancestor"}
    tables = ClinicalTables.from_parquet(spark, written)
    assert tables["death"].dtypes == [("person_id", "bigint"), ("death_date", "date")]
    assert tables["death"].count() == 1
    assert [r[0] for r in tables["concept_ancestor"].collect()] == [1, 2]


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        ClinicalTables(spark, {})["person"]


def test_no_ids_and_empty_ids_differ(frame):
    df = frame([(1,), (2,)], "k long")
    assert keep_ids(df, "k", None).count() == 2
    assert keep_ids(df, "k", []).count() == 0
    assert keep_ids(df, "k", df.limit(0)).count() == 0
    assert keep_ids(df, "k", [2]).first().k == 2


def test_paths():
    assert csv_tables.resolve_path("/data/", "x.csv") == "/data/x.csv"
    assert csv_tables.resolve_path("/data", "/y/x.csv") == "/y/x.csv"
    assert csv_tables.resolve_path("/data", "s3a://b/x.csv") == "s3a://b/x.csv"


def test_concept_files(spark, folder):
    assert files.load_concept_set(spark, write(folder, "a.json", "[1, 2]")) == [1, 2]
    assert files.load_concept_set(spark, write(folder, "b.json", '{"concepts": [3]}')) == [3]
    assert files.load_concept_set(spark, write(folder, "c.json", '{"concept_ids": [4]}')) == [4]
    with pytest.raises(ValueError):
        files.load_concept_set(spark, write(folder, "d.json", '{"x": 1}'))
    with pytest.raises(FileNotFoundError):
        files.load_json(spark, f"{folder}/none.json")


def test_drug_files_are_searched_in_order(spark, folder):
    for sub in ("general", "special"):
        (Path(folder) / sub).mkdir()
    write(f"{folder}/general", "one_concepts.csv", "CONCEPT_ID,NAME\n5,x\n7,y\n")
    write(f"{folder}/general", "one_concepts.json", '{"concept_ids": [9]}')
    write(f"{folder}/special", "one_concepts.csv", "concept_id\n8\n")
    write(f"{folder}/special", "two_concepts.json", '{"concept_ids": [1], "include_descendants": false}')
    specs = files.load_drug_specs(spark, ["one", "two", "three"], [f"{folder}/general", f"{folder}/special"])
    assert specs["one"].ids == (5, 7) and not specs["one"].include_descendants
    assert specs["two"].ids == (1,) and not specs["two"].include_descendants
    assert specs["three"].ids == ()


def test_feature_files(spark, folder):
    path = write(folder, "features.csv", 'Name,concept_ids,description\na,1,x\nb,"2, 3,",y\nc,,z\n')
    assert files.load_feature_csv(spark, path) == {"a": [1], "b": [2, 3], "c": []}
    assert files.load_lab_json(spark, write(folder, "labs.json", '{"l": [1, 2]}')) == {"l": [1, 2]}
    df = spark.createDataFrame([("a", "1"), ("b", "2, 3,,x"), ("c", None), ("d", "4.0")], "name string, concept_ids string")
    assert {tuple(r) for r in files.exploded_ids(df).collect()} == {("a", 1), ("b", 2), ("b", 3), ("d", 4)}


def test_expansion(spark, frame):
    edges = frame([(1, 2), (1, 3), (2, 3), (4, 4), (4, 5)], "ancestor_concept_id long, descendant_concept_id long")

    def ids(*args, **kw):
        return sorted(r.concept_id for r in concepts.expand(spark, edges, *args, **kw).collect())

    assert ids([1, 4]) == [1, 2, 3, 4, 5]
    assert ids([1, 4], include_self=False) == [2, 3, 4, 5]
    assert ids([1, 1], include_descendants=False) == [1]
    assert ids([]) == []
    sets = concepts.ConceptSets.resolve(spark, edges, {"a": files.ConceptSpec((1,)), "none": files.ConceptSpec(())})
    events = frame([(1, 3), (2, 5)], "person_id long, concept_id long")
    assert [r.person_id for r in sets.restrict(events, "a").collect()] == [1]
    assert sets.restrict(events, "none").count() == 0


def test_large_sets_stay_distributed(spark, frame, monkeypatch):
    monkeypatch.setattr(concepts, "DRIVER_IDS", 2)
    edges = frame([(1, 2), (1, 3), (1, 4)], "ancestor_concept_id long, descendant_concept_id long")
    sets = concepts.ConceptSets.resolve(spark, edges, {"a": files.ConceptSpec((1,)), "b": files.ConceptSpec((4,))})
    events = frame([(1, 3), (2, 5), (3, 4)], "person_id long, concept_id long")
    assert sorted(r.person_id for r in sets.restrict(events, "a").collect()) == [1, 3]
    assert {(r.person_id, r.set_name) for r in sets.tag(events, "a", "b").collect()} == {(1, "a"), (3, "a"), (3, "b")}


def test_predicate_and_join_agree(spark, frame, monkeypatch):
    events = frame([(i, i % 7) for i in range(50)], "person_id long, concept_id long")
    sets = concepts.ConceptSets.of_lists(spark, {"a": [1, 2], "b": [2, 3]})
    by_predicate = sorted(map(tuple, sets.tag(events, "a", "b").collect()))
    monkeypatch.setattr(concepts, "PREDICATE_IDS", 0)
    assert sorted(map(tuple, sets.tag(events, "a", "b").collect())) == by_predicate
    assert sets.restrict(events, "a", "b").count() == 21


FLAT = {
    "cohort_name": "c", "x_data_dir": "/d", "output_dir": "/o", "study_start_date": "2012-01-01", "study_end_date": "2013-01-01",
    "x_diagnosis_concepts": {"concept_ids": [1], "include_descendants": False}, "x_measurement_concepts": [2],
    "bmi_threshold_low": 27, "min_age_at_entry": 21, "x_drugs": ["a"], "x_concepts_dir": "/b", "concept_sets_dir": "/a",
    "matching_features": ["sex"], "outcomes": [{"name": "o", "concept_ids": [3]}], "min_followup_days": 30,
}


def test_flat_config(spark, folder):
    study = load_study(spark, write(folder, "s.json", json.dumps(FLAT)))
    assert study.rules == WINDOWED and study.source_dir == "/d" and study.concept_dirs == ("/a", "/b")
    assert study.conditions.ids == (1,) and not study.conditions.include_descendants
    assert study.measurements.ids == (2,) and study.outcomes == {"o": (3,)}
    assert (study.min_age_at_entry, study.drug_names, study.min_followup_days) == (21, ("a",), 30)


def test_sectioned_config():
    study = study_from_dict({
        "cdm_path": "/d", "concept_sets": {"z_conditions": {"concept_ids": [1]}, "z_ingredients": {"concept_ids": [5]}},
        "study": {"min_age": 20, "z_min_index_date": "2015-01-01"},
        "exposure": {"max_days_from_z_index": 365, "min_date": "2016-01-01"}, "debug": {"max_persons": 10},
    })
    assert study.rules == EVIDENCE and study.exposure.ids == (5,) and study.max_persons == 10
    assert (study.min_age_at_entry, study.min_index_date, study.max_days, study.min_days) == (20, "2015-01-01", 365, 0)
    assert study.exposure_window == ("2016-01-01", "2024-01-31")


@pytest.mark.parametrize("changes", [
    {"study_start_date": "2014-01-01"}, {"matching_ratio": "1:2"}, {"caliper_multiplier": 0}, {"study_end_date": "soon"},
])
def test_bad_config(changes):
    with pytest.raises(ValueError):
        study_from_dict({**FLAT, **changes})


def test_bad_rules():
    with pytest.raises(ValueError):
        Study(rules="other")


def test_sinks(spark, frame, folder):
    df = frame([(1, "a"), (2, None)], "person_id long, v string")
    path = sinks.save_with_suffix(df, f"{folder}/base", "v1")
    assert path.endswith("base_v1.csv")
    assert sinks.save_with_suffix(df, f"{folder}/base").rsplit("_", 1)[1].removesuffix(".csv").isdigit()
    back = sinks.read_back(spark, path, df.schema)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]
    again = sinks.read_back(spark, sinks.write_table(df, f"{folder}/p"), df.schema, "parquet")
    assert sorted(map(tuple, again.collect())) == [(1, "a"), (2, None)]


def test_staging_uses_the_session_folder(spark, frame):
    staged = stage(frame([(1, None)], "a long, b string"))
    assert staged.dtypes == [("a", "bigint"), ("b", "string")] and staged.count() == 1
    assert staged.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(staging_root(spark).split(":", 1)[-1].lstrip("/"))
    assert stage(frame([], "a long")).count() == 0


class _Session:
    """The parts of a session the staging folder depends on."""

    def __init__(self, master, folder=None, set_in_context=None):
        self.conf, self.sparkContext = self, self
        self.master, self.folder, self.in_context = master, folder, set_in_context

    def get(self, _, default):
        return self.folder or default

    def getCheckpointDir(self):
        return self.in_context

    def setCheckpointDir(self, folder):
        self.in_context = folder


def test_staging_folder_of_a_cluster():
    assert staging_root(_Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert staging_root(_Session("yarn", None, "hdfs:///context")) == "hdfs:///context"
    with pytest.raises(RuntimeError):
        staging_root(_Session("yarn"))
    local = _Session("local[2]")
    assert staging_root(local) == staging_root(local)
