"""Merged observation periods against a count of days; the study option; several periods and deaths in the views."""

import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st

from cohortry.operators.events import merged_spans, observation_spans
from cohortry.plans.study import Study, study_from_dict
from cohortry.sources.tables import ClinicalTables
from study_queries.views import clinical_tables

D0 = datetime.date(2000, 1, 1)
SCHEMA = "person_id long, observation_period_start_date date, observation_period_end_date date"


def day(n):
    return None if n is None else D0 + datetime.timedelta(days=n)


def brute(rows, gap):
    out = []
    for person in {p for p, *_ in rows}:
        days = {d for p, s, e in rows if p == person and s is not None and e is not None for d in range(s, e + 1)}
        islands = []
        for d in sorted(days):
            if islands and d - islands[-1][1] <= gap + 1:
                islands[-1][1] = d
            else:
                islands.append([d, d])
        out += [(person, day(s), day(e)) for s, e in islands]
    return sorted(out, key=repr)


PERIODS = st.lists(st.tuples(st.integers(1, 2), st.none() | st.integers(0, 60), st.none() | st.integers(0, 60)), max_size=12)


@given(PERIODS, st.sampled_from([0, 1, 7]))
@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_islands(spark, rows, gap):
    rows += [(3, 0, 50), (3, 5, 6), (3, 51, 52), (3, 54, 60)]  # inside a longer one, touching, apart by one day
    periods = spark.createDataFrame([(p, day(s), day(e)) for p, s, e in rows], SCHEMA)
    tables = ClinicalTables(spark, {"observation_period": periods})
    assert sorted(map(tuple, observation_spans(tables, gap).collect()), key=repr) == brute(rows, gap)


def test_no_periods(spark):
    empty = spark.createDataFrame([], "person_id long, obs_start date, obs_end date")
    assert merged_spans(empty).collect() == []


def test_option():
    assert study_from_dict({"study": {}, "follow_up": {"merge_gap_days": 30}}).merge_gap_days == 30
    assert study_from_dict({"merge_gap_days": 0}).merge_gap_days == 0
    assert Study().merge_gap_days is None
    with pytest.raises(ValueError, match="merge_gap_days"):
        Study(merge_gap_days=-1)


def test_views_have_several_periods_and_deaths(spark):
    tables = clinical_tables(spark, "/root/testdata/sf0.01")
    spans, islands, loose = (observation_spans(tables, gap).count() for gap in (None, 0, 400))
    assert spans > islands > loose
    deaths = tables["death"]
    assert deaths.count() > deaths.select("person_id").distinct().count()
