import datetime as dt
from math import log

import numpy as np
import pandas as pd
import pytest

from cohortry.operators import survival

D = dt.date


def people(seed, n, ties):
    rng = np.random.default_rng(seed)
    arm = rng.integers(0, 2, n)
    time = np.ceil(rng.exponential(np.where(arm == 1, 60, 40)) / ties) * ties
    event = rng.random(n) < 0.7
    return [(int(i), int(a), "o", int(t), int(e)) for i, (a, t, e) in enumerate(zip(arm, time, event))]


SCHEMA = "person_id long, treatment int, outcome string, T int, E int"


def efron_loglik(beta, rows):
    arm, time, event = (np.array([r[k] for r in rows], float) for k in (1, 3, 4))
    weight, total = np.exp(beta * arm), 0.0
    for t in np.unique(time[event == 1]):
        dead = (time == t) & (event == 1)
        d = dead.sum()
        total += beta * arm[dead].sum()
        for k in range(d):
            total -= log(weight[time >= t].sum() - k / d * weight[dead].sum())
    return total


@pytest.mark.parametrize("seed,ties", [(1, 1), (2, 10), (3, 40)])
def test_cox_maximises_the_partial_likelihood(frame, seed, ties):
    rows = people(seed, 200, ties)
    row = survival.cox_model(frame(rows, SCHEMA)).first()
    beta = log(row.HR)
    best = efron_loglik(beta, rows)
    assert best >= max(efron_loglik(beta + d, rows) for d in (-1e-3, 1e-3, -0.5, 0.5))
    h = 1e-3
    curvature = -(efron_loglik(beta + h, rows) - 2 * best + efron_loglik(beta - h, rows)) / h**2
    error = 1 / np.sqrt(curvature)
    assert (log(row.HR_upper_95CI) - beta) / 1.959964 == pytest.approx(error, rel=1e-3)
    assert row.HR_lower_95CI < row.HR < row.HR_upper_95CI and 0 <= row.p_value <= 1


def test_cox_without_an_estimate(frame):
    rows = [(1, 1, "one_arm", 5, 1), (2, 0, "one_arm", 6, 0), (3, 1, "none", 5, 0), (4, 0, "none", 5, 0)]
    got = survival.cox_model(frame(rows, SCHEMA)).collect()
    assert len(got) == 2 and all(r.HR is None and r.p_value is None for r in got)


def test_cox_by_subgroup_and_outcome(frame):
    rows = [(*r[:2], o, *r[3:], g) for o in ("a", "b") for g, seed in (("x", 4), ("y", 5)) for r in people(seed, 80, 5)]
    df = frame(rows, SCHEMA + ", g string")
    got = {(r.outcome, r.g): r.HR for r in survival.cox_model(df, ("g",)).collect()}
    single = survival.cox_model(df.filter("g = 'x' AND outcome = 'a'")).first().HR
    assert len(got) == 4 and got["a", "x"] == pytest.approx(single) and got["a", "x"] == pytest.approx(got["b", "x"])


def test_risk_table_and_curves(frame):
    rows = people(6, 150, 7)
    df = frame(rows, SCHEMA)
    arm, time, event = (np.array([r[k] for r in rows]) for k in (1, 3, 4))
    for r in survival.risk_table(df).collect():
        assert (r.n0, r.n1) == (((time >= r["T"]) & (arm == 0)).sum(), ((time >= r["T"]) & (arm == 1)).sum())
        assert r.d1 == ((time == r["T"]) & (event == 1) & (arm == 1)).sum()
    for a in (0, 1):
        alive = 1.0
        curve = survival.kaplan_meier(df).filter(f"treatment = {a}").orderBy("T").collect()
        incidence = survival.cumulative_incidence(df).filter(f"treatment = {a}").orderBy("T").collect()
        for r, i in zip(curve, incidence):
            here = (time == r["T"]) & (arm == a)
            alive *= 1 - (here & (event == 1)).sum() / ((time >= r["T"]) & (arm == a)).sum()
            assert r.survival == pytest.approx(alive)
            # Without competing deaths incidence and survival add up to one.
            assert i.incidence == pytest.approx(1 - alive)


def test_survival_reaches_zero(frame):
    df = frame([(1, 1, "o", 5, 1), (2, 1, "o", 9, 1)], SCHEMA)
    assert [r.survival for r in survival.kaplan_meier(df).orderBy("T").collect()] == [0.5, 0.0]


def test_competing_deaths_take_their_share(frame):
    df = frame([(1, 1, "o", 1, 2), (2, 1, "o", 2, 1), (3, 1, "o", 3, 0), (4, 1, "o", 4, 1)], SCHEMA)
    got = [r.incidence for r in survival.cumulative_incidence(df).orderBy("T").collect()]
    assert got == pytest.approx([0, 0.25, 0.25, 0.75])


def test_survival_data(frame):
    index = D(2000, 1, 1)
    arms = frame([(i, i % 2, index) for i in range(1, 7)], "person_id long, treatment int, index_date date")
    events = frame([
        (1, 10, D(2000, 1, 1), 1), (1, 10, D(2000, 1, 11), 2),  # the index day itself does not count
        (2, 10, D(2000, 3, 1), 3),  # after the death
        (3, 11, D(2000, 6, 1), 4),  # after observation ends
    ], "person_id long, concept_id long, event_date date, event_id long")
    spans = frame([(i, D(1999, 1, 1), D(2000, 2, 1) if i == 3 else D(2009, 1, 1)) for i in range(1, 6)] + [(6, D(2001, 1, 1), D(2002, 1, 1))],
                  "person_id long, obs_start date, obs_end date")
    deaths = frame([(2, D(2000, 2, 1)), (5, D(1999, 12, 1))], "person_id long, death_date date")
    data = survival.survival_data(arms, events, {"x": [10], "y": [10, 11]}, spans, deaths, "2004-12-31", 2)
    got = {(r.person_id, r.outcome): (r["T"], r.E) for r in data.collect()}
    cap = (D(2002, 1, 1) - index).days
    assert got == {
        (1, "x"): (10, 1), (1, "y"): (10, 1), (2, "x"): (31, 0), (2, "y"): (31, 0), (3, "x"): (31, 0), (3, "y"): (31, 0),
        (4, "x"): (cap, 0), (4, "y"): (cap, 0),  # no period covers the index date of person 6
    }
    competing = survival.survival_data(arms, events, {"x": [10]}, spans, deaths, "2004-12-31", 2, competing_death=True)
    assert {r.person_id: r.E for r in competing.collect()} == {1: 1, 2: 2, 3: 0, 4: 0}


def test_many_tied_events_are_one_vector():
    table = pd.DataFrame({"d0": [200_000], "d1": [100_000], "n0": [400_000], "n1": [300_000]})
    assert 0 < survival.fit_cox(table)["HR"] < 1
