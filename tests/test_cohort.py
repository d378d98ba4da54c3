"""Hand-made edge cases of cohorts, arms, eligibility and covariates."""

import datetime as dt

import pytest

from cohortry.operators import cohort, covariates, drug_table, eligibility, exposure, windowed
from cohortry.operators.concepts import ConceptSets
from cohortry.sources.tables import ClinicalTables

D = dt.date
MIDNIGHT = dt.datetime(2000, 5, 1)

SCHEMAS = {
    "person": "person_id long, gender_concept_id long, year_of_birth int, month_of_birth int, day_of_birth int, "
              "birth_datetime timestamp, race_concept_id long, ethnicity_concept_id long",
    "condition_occurrence": "condition_occurrence_id long, person_id long, condition_concept_id long, "
                            "condition_start_date date, condition_start_datetime timestamp",
    "measurement": "measurement_id long, person_id long, measurement_concept_id long, measurement_date date, "
                   "measurement_datetime timestamp, value_as_number string",
    "drug_exposure": "drug_exposure_id long, person_id long, drug_concept_id long, drug_exposure_start_date date, "
                     "drug_exposure_start_datetime timestamp",
    "visit_occurrence": "visit_occurrence_id long, person_id long, visit_concept_id long, visit_start_date date, "
                        "visit_start_datetime timestamp, visit_end_date date",
    "observation_period": "person_id long, observation_period_start_date date, observation_period_end_date date",
    "death": "person_id long, death_date date",
}


def person(i, year=1970):
    return (i, 8507, year, 1, 1, None, 0, 0)


@pytest.fixture
def tables(frame, spark):
    def build(**rows):
        return ClinicalTables(spark, {n: frame(rows.get(n, []), s) for n, s in SCHEMAS.items()})
    return build


@pytest.fixture
def sets(spark):
    return ConceptSets.of_lists(spark, {
        cohort.CONDITION_SET: [1], cohort.MEASUREMENT_SET: [2], cohort.COMORBIDITY_SET: [3],
        windowed.SPECIFIC_SET: [4], exposure.EXPOSURE_SET: [5, 6], "a": [5], "b": [5, 6], "none": [],
    })


def by_id(df):
    return {r.person_id: r for r in df.collect()}


def index_of(tables, sets):
    return by_id(cohort.index_from_dates(cohort.evidence_dates(tables, sets, 27, 30)))


def test_index_sources_and_ties(tables, sets):
    t = tables(
        condition_occurrence=[
            (1, 1, 1, D(2000, 5, 1), None), (2, 2, 1, None, MIDNIGHT), (3, 3, 3, D(2000, 5, 2), None),
            (4, 4, 3, D(2000, 5, 1), None), (5, 5, 3, D(2000, 5, 3), None), (6, 7, 9, D(2000, 1, 1), None),
        ],
        measurement=[
            (1, 1, 2, D(2000, 5, 1), None, "31"), (2, 2, 2, D(2000, 4, 1), None, "30"),
            (3, 3, 2, D(2000, 5, 1), None, "28"), (4, 3, 2, None, dt.datetime(2000, 5, 3), "27.0"),
            (5, 4, 2, D(2000, 5, 1), None, "29.99"), (6, 5, 2, D(2000, 5, 1), None, "28"),
            (7, 6, 2, D(2000, 5, 1), None, "n/a"), (8, 6, 2, D(2000, 5, 2), None, None), (9, 6, 2, D(2000, 5, 3), None, "26"),
        ],
    )
    got = index_of(t, sets)
    assert set(got) == {1, 2, 3, 4}
    assert (got[1].index_source, got[1].obesity_dx_flag, got[1].bmi_ge_30_flag) == ("condition_dx", 1, 1)
    assert (got[2].index_source, got[2].index_date) == ("bmi_ge_30", D(2000, 4, 1))
    assert (got[3].index_source, got[3].index_date) == ("bmi_ge_27_plus_comorb", D(2000, 5, 3))
    assert got[4].index_date == D(2000, 5, 1)


def cohort_tables(tables, *, people, index=D(2000, 5, 1), visits=True, death=(), observed=None):
    start, end = observed or (D(1999, 1, 1), D(2001, 1, 1))
    return tables(
        person=people,
        condition_occurrence=[(p[0], p[0], 1, index, None) for p in people],
        visit_occurrence=[(p[0], p[0], 0, D(2000, 1, 1), None, D(2000, 1, 1)) for p in people] if visits else [],
        observation_period=[(p[0], start, end) for p in people],
        death=list(death),
    )


def members(t, sets, **kw):
    args = {"study_start": "2000-01-01", "study_end": "2000-12-31", "min_index_date": "2000-01-01", **kw}
    return set(by_id(cohort.build_cohort(t, sets, **args)))


def test_age_is_rounded_in_the_cohort(tables, sets):
    # 17.6 years on the index date rounds to 18, 17.3 does not.
    people = [(1, 8507, 1982, 10, 1, None, 0, 0), (2, 8507, 1983, 1, 15, None, 0, 0)]
    assert members(cohort_tables(tables, people=people), sets) == {1}


def test_cohort_filters(tables, sets):
    people = [person(1), person(2, 2001), person(3, None)]
    assert members(cohort_tables(tables, people=people), sets) == {1}
    one = [person(1)]
    assert members(cohort_tables(tables, people=one, visits=False), sets) == set()
    assert members(cohort_tables(tables, people=one, observed=(D(2000, 5, 2), D(2001, 1, 1))), sets) == set()
    assert members(cohort_tables(tables, people=one, observed=(D(2000, 5, 1), D(2000, 5, 1))), sets) == {1}
    assert members(cohort_tables(tables, people=one, death=[(1, D(2000, 4, 30))]), sets) == set()
    assert members(cohort_tables(tables, people=one, death=[(1, D(2000, 5, 1)), (1, None)]), sets) == {1}
    assert members(cohort_tables(tables, people=one), sets, min_index_date="2000-05-02") == set()
    assert members(cohort_tables(tables, people=[person(i) for i in (3, 1, 2)]), sets, max_persons=2) == {1, 2}


def test_visit_on_the_index_day_is_not_prior(tables, sets):
    assert members(cohort_tables(tables, people=[person(1)], index=D(2000, 1, 1)), sets) == set()


def test_no_evidence_gives_an_empty_cohort(tables, sets):
    t = tables(person=[person(1)])
    assert members(t, sets) == set()
    assert cohort.attrition(cohort.index_from_dates(cohort.evidence_dates(t, sets, 27, 30)), t["death"]).count() == 2


def test_coverage_with_several_periods(frame):
    days = frame([(1, D(2000, 1, 5)), (2, D(2000, 2, 5))], "person_id long, day date")
    spans = frame([(1, D(2000, 1, 1), D(2000, 1, 5)), (1, D(2000, 1, 2), D(2000, 3, 1)), (2, D(2000, 1, 1), D(2000, 2, 4))],
                  "person_id long, obs_start date, obs_end date")
    assert [r.person_id for r in cohort.covered(days, spans, "day").collect()] == [1]


def test_windowed_criterion_prefers_diagnosis(tables, sets):
    t = tables(
        condition_occurrence=[(1, 1, 1, D(2000, 6, 1), None), (2, 2, 1, D(1990, 1, 1), None), (3, 2, 1, None, MIDNIGHT)],
        measurement=[(1, 1, 2, D(2000, 5, 1), None, "28"), (5, 2, 2, D(2000, 5, 1), None, "28"),
                     (4, 2, 2, D(2000, 5, 1), None, "33"), (6, 3, 2, D(1999, 1, 1), None, "33")],
    )
    got = by_id(windowed.windowed_entry(windowed.windowed_evidence(t, sets, "2000-01-01", "2000-12-31")))
    assert {p: (r.obesity_entry_date, r.obesity_criterion) for p, r in got.items()} == {
        1: (D(2000, 5, 1), "diagnosis"), 2: (D(2000, 5, 1), "bmi_30plus")
    }


def test_windowed_cohort_counts_study_visits(tables, sets):
    visits = [(i, 1, 0, day, None, day) for i, day in enumerate([D(1999, 12, 31), D(2000, 1, 1), D(2000, 1, 1), D(2000, 5, 1)])]
    t = tables(person=[person(1), person(2)], visit_occurrence=visits,
               condition_occurrence=[(1, 1, 1, D(2000, 5, 1), None), (2, 2, 1, D(2000, 5, 1), None), (3, 2, 4, None, None)])
    got = by_id(windowed.build_windowed_cohort(t, sets, "2000-01-01", "2000-12-31", specific=True))
    assert {p: (r.visits_before_entry, r.has_specific_condition) for p, r in got.items()} == {1: (2, False), 2: (0, True)}
    strict = windowed.build_windowed_cohort(t, sets, "2000-01-01", "2000-12-31", specific=True, require_specific=True)
    assert set(by_id(strict)) == {2}


def test_arms(tables, sets, frame):
    base = frame([(i, D(2000, 1, 1), "s", D(1970, 1, 1), 30, 1, 1, 1, None) for i in (1, 2, 3, 4, 5)],
                 "person_id long, obesity_index_date date, index_source string, birth_date date, age_at_index int, "
                 "gender_concept_id long, race_concept_id long, ethnicity_concept_id long, death_date date")
    t = tables(
        drug_exposure=[(9, 1, 6, D(2000, 2, 1), None), (8, 1, 5, D(2000, 2, 1), None),  # tie on the day: lower id
                       (1, 2, 5, D(1999, 12, 31), None), (2, 2, 5, D(2000, 2, 1), None),  # exposed too early
                       (3, 3, 5, D(2005, 1, 1), None),  # too late
                       (4, 4, 5, None, dt.datetime(2000, 3, 1, 8))],  # not observed then
        observation_period=[(i, D(1999, 1, 1), D(2006, 1, 1)) for i in (1, 2, 3, 5)] + [(4, D(2001, 1, 1), D(2002, 1, 1))],
    )
    from cohortry.operators.events import observation_spans

    first = exposure.first_exposure(exposure.exposure_events(t, sets, "1999-01-01", "2006-01-01"))
    spans = observation_spans(t)
    arms = by_id(exposure.label_arms(base, first, spans))
    assert {p: r.user_flag for p, r in arms.items()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    assert (arms[1].exposure_concept_id, arms[1].days_from_index) == (5, 31)
    assert arms[3].exposure_index_date is None
    clean = by_id(exposure.label_arms(base, first, spans, ever=first.select("person_id")))
    assert set(clean) == {1, 5}
    candidates = exposure.exposure_candidates(base, first, spans)
    assert set(by_id(exposure.users(base, candidates))) == {1}
    assert set(by_id(exposure.non_users(base, candidates))) == {2, 3, 4, 5}
    assert set(by_id(exposure.non_users(base, candidates, first))) == {5}


def test_windowed_arms(tables, sets, frame):
    base = frame([(i, D(2000, 2, 1)) for i in (1, 2, 3)], "person_id long, obesity_entry_date date")
    t = tables(drug_exposure=[(1, 1, 6, D(2000, 1, 1), None), (2, 1, 5, D(2000, 3, 1), None), (3, 2, 6, D(2000, 2, 1), None),
                              (4, 3, 5, None, MIDNIGHT)])
    arms = by_id(exposure.windowed_arms(base, exposure.labelled_exposures(t, sets, ["a", "b", "none"], "1999-01-01", "2001-01-01")))
    # Concept 5 is in both sets; the later set names the drug. Timestamps alone do not count.
    assert {p: (r.user_flag, r.exposure_drug) for p, r in arms.items()} == {1: (1, "b"), 2: (1, "b"), 3: (0, None)}
    assert arms[1].exposure_index_date == D(2000, 3, 1)


def test_no_exposure_still_labels_everyone(tables, sets, frame):
    base = frame([(1, D(2000, 2, 1))], "person_id long, obesity_entry_date date")
    arms = exposure.windowed_arms(base, exposure.labelled_exposures(tables(), sets, ["a"], "1999-01-01", "2001-01-01"))
    assert arms.first().user_flag == 0


def test_drug_table(tables, sets):
    t = tables(drug_exposure=[(1, 1, 5, D(2000, 1, 2), None), (2, 1, 6, D(2000, 1, 1), None), (3, 2, 99, D(2000, 1, 1), None),
                              (4, 3, 5, D(1990, 1, 1), None)])
    wide = drug_table.drug_table(t, sets, ["a", "b", "none"], "2000-01-01", "2000-12-31", ordered=True)
    rows = [tuple(r) for r in wide.collect()]
    assert rows == [(1, 1, D(2000, 1, 2), 1, D(2000, 1, 1), 0, None), (2, 0, None, 0, None, 0, None)]
    usage = {r.drug: (r.n_users, r.percent) for r in drug_table.drug_usage(wide, ["a", "b", "none"]).collect()}
    assert usage == {"a": (1, 50.0), "b": (1, 50.0), "none": (0, 0.0)}
    counts = {r.drug_count: r.person_count for r in drug_table.drug_count_distribution(wide, ["a", "b", "none"]).collect()}
    assert counts == {0: 1, 2: 1}


def test_attrition_is_monotone(frame):
    arms = frame([(1, 1, 17, 0), (2, 1, 30, 0), (3, 1, 30, 2), (4, 0, None, 2)],
                 "person_id long, user_flag int, age_at_obesity_entry int, visits_before_entry int")
    rules = eligibility.eligibility_rules()
    got = {(r.user_flag, r.step): r.n for r in eligibility.rule_attrition(arms, rules).collect()}
    assert got == {(1, "initial"): 3, (1, "min_age"): 2, (1, "baseline_visit"): 1,
                   (0, "initial"): 1, (0, "min_age"): 0, (0, "baseline_visit"): 0}
    assert eligibility.apply_rules(arms, rules).count() == 1
    assert eligibility.apply_rules(arms, eligibility.eligibility_rules(min_age=0, require_visit=False)).count() == 4


def test_follow_up_and_baseline_conditions(frame):
    arms = frame([(1, D(2000, 1, 1)), (2, D(2000, 1, 1))], "person_id long, index_date date")
    spans = frame([(1, D(1999, 1, 1), D(2000, 1, 31)), (2, D(1999, 1, 1), D(2000, 1, 30))], "person_id long, obs_start date, obs_end date")
    assert [r.person_id for r in eligibility.with_follow_up(arms, spans, "index_date", 30).collect()] == [1]
    events = frame([(1, D(2000, 1, 1)), (2, D(2000, 1, 2))], "person_id long, event_date date")
    assert [r.person_id for r in eligibility.by_baseline_condition(arms, events, "index_date").collect()] == [1]
    assert [r.person_id for r in eligibility.by_baseline_condition(arms, events, "index_date", exclude=True).collect()] == [2]


EVENT = "person_id long, concept_id long, event_date date, event_id long"


def test_flags_and_lookback(frame):
    base = frame([(1, D(2000, 6, 1)), (2, D(2000, 6, 1))], "person_id long, index_date date")
    events = frame([(1, 1, D(1990, 1, 1), 1), (1, 2, D(2000, 6, 2), 2), (1, 2, D(2000, 6, 1), 3), (2, 1, None, 4)], EVENT)
    features = {"x": [1], "y": [2, 3], "none": []}
    assert {p: tuple(r)[2:] for p, r in by_id(covariates.baseline_flags(base, events, features)).items()} == {
        1: (1, 1, 0), 2: (0, 0, 0)
    }
    assert {p: tuple(r)[2:] for p, r in by_id(covariates.baseline_flags(base, events, features, 12)).items()} == {
        1: (0, 1, 0), 2: (0, 0, 0)
    }


def test_latest_values(frame):
    base = frame([(1, D(2000, 6, 1)), (2, D(2000, 6, 1))], "person_id long, index_date date")
    rows = [(1, 1, D(2000, 5, 1), 1, "10"), (1, 1, D(2000, 5, 2), 2, "n/a"), (1, 1, D(2000, 5, 1), 3, "12"),
            (1, 1, D(2000, 7, 1), 4, "99"), (1, 2, D(1998, 1, 1), 5, "7"), (2, 1, None, 6, "1")]
    events = frame(rows, EVENT + ", value_as_number string")
    labs = {"x": [1], "y": [2], "none": []}
    assert {p: tuple(r)[2:] for p, r in by_id(covariates.latest_values(base, events, labs)).items()} == {
        1: (12.0, 7.0, None), 2: (None, None, None)
    }
    assert {p: tuple(r)[2:] for p, r in by_id(covariates.latest_values(base, events, labs, 12)).items()} == {
        1: (12.0, None, None), 2: (None, None, None)
    }


def test_one_person_with_most_rows(tables, sets):
    """A dominating person changes nothing but the counts of its own rows."""
    readings = [(i, 1, 2, D(2000, 1, 1) + dt.timedelta(days=i % 300), None, str(20 + i % 20)) for i in range(3000)]
    few = [(5000 + i, 2 + i, 2, D(2000, 3, 1), None, "35") for i in range(50)]
    got = index_of(tables(measurement=readings + few), sets)
    assert len(got) == 51 and got[1].index_date == D(2000, 1, 11)
