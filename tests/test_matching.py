"""Scores, matching and balance against plain numpy."""

import random

import numpy as np
import pytest

from cohortry.operators import balance, matching, propensity

SCHEMA = "person_id long, treatment int, logit_ps double"


def brute_pairs(rows, width):
    controls = [(p, x) for p, t, x in rows if t == 0]
    pairs, used = set(), set()
    for p, t, x in sorted(rows):
        if t != 1 or not controls:
            continue
        gap, control = min((abs(x - y), c) for c, y in controls)
        if gap <= width and control not in used:
            used.add(control)
            pairs.add((p, control, gap))
    return pairs


def population(seed, n_users, n_controls, digits):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * (n_users + n_controls)), n_users + n_controls)
    return [(ids[i], int(i < n_users), round(rng.gauss(0.3 if i < n_users else 0, 1), digits)) for i in range(len(ids))]


@pytest.mark.parametrize("seed,n_users,n_controls,digits,size", [
    (1, 300, 900, 6, 100_000), (2, 300, 900, 1, 100_000), (3, 400, 100, 2, 40), (4, 200, 600, 6, 25), (5, 50, 3, 3, 5),
])
def test_pairs_equal_brute_force(frame, seed, n_users, n_controls, digits, size):
    rows = population(seed, n_users, n_controls, digits)
    scored = frame(rows, SCHEMA)
    width = matching.caliper_width(scored)
    assert width == pytest.approx(0.2 * np.std([r[2] for r in rows]))
    got = {tuple(r) for r in matching.match_pairs(scored, rows_per_bucket=size).collect()}
    assert got == brute_pairs(rows, width)
    near = {r.user_person_id: (r.ps_distance, r.nonuser_person_id) for r in matching.nearest_controls(scored, size).collect()}
    controls = [(p, x) for p, t, x in rows if t == 0]
    assert near == {p: min((abs(x - y), c) for c, y in controls) for p, t, x in rows if t == 1}


def test_a_third_of_everyone_shares_one_score(frame):
    rows = population(6, 300, 600, 4) + [(100_000 + i, i % 2, 0.125) for i in range(450)]
    scored = frame(rows, SCHEMA)
    got = {tuple(r) for r in matching.match_pairs(scored, 0.01, rows_per_bucket=60).collect()}
    assert got == brute_pairs(rows, 0.01)
    assert matching.nearest_controls(scored, 60).count() == 525


def test_pairs_are_one_to_one_and_within_the_caliper(frame):
    scored = frame(population(7, 500, 500, 3), SCHEMA)
    pairs = matching.match_pairs(scored, 0.05).toPandas()
    assert pairs.user_person_id.is_unique and pairs.nonuser_person_id.is_unique
    assert pairs.ps_distance.max() <= 0.05
    assert matching.matched_people(scored, matching.match_pairs(scored, 0.05)).count() == 2 * len(pairs)


@pytest.mark.parametrize("rows", [[(1, 1, 0.5)], [(1, 0, 0.5)], [(1, 1, 0.0), (2, 0, 5.0)], []])
def test_no_pair(frame, rows):
    scored = frame(rows, SCHEMA)
    pairs = matching.match_pairs(scored)
    assert pairs.count() == 0
    assert matching.matched_people(scored, pairs).count() == 0
    rate = matching.match_rate(scored, pairs).first()
    assert rate.n_pairs == 0 and rate.match_rate in (None, 0.0)


def test_equal_gaps_take_the_lower_control(frame):
    scored = frame([(10, 1, 0.0), (7, 0, 0.25), (5, 0, -0.25), (6, 0, -0.25)], SCHEMA)
    assert [tuple(r) for r in matching.match_pairs(scored, 1.0).collect()] == [(10, 5, 0.25)]


def test_medians_are_exact(frame):
    rng = np.random.default_rng(3)
    values = rng.normal(size=20_001).round(4)
    skewed = np.where(rng.random(20_001) < 0.4, 7.0, rng.exponential(size=20_001))
    rows = [(float(a), float(b), None if i % 3 else i) for i, (a, b) in enumerate(zip(values, skewed))]
    df = frame(rows, "a double, b double, c int")
    want = {"a": np.median(values), "b": np.median(skewed), "c": np.median(np.arange(0, 20_001, 3))}
    assert {r.feature: r["median"] for r in propensity.medians(df, ["a", "b", "c"]).collect()} == want


@pytest.mark.parametrize("limit", [5, 200])
def test_brackets_narrow_until_few_rows_are_left(frame, monkeypatch, limit):
    monkeypatch.setattr(propensity, "WINDOW_ROWS", limit)
    calls = []
    checked = propensity._checked
    monkeypatch.setattr(propensity, "_checked", lambda *a: calls.append(checked(*a)) or calls[-1])
    monkeypatch.setattr(propensity, "BRACKET", 0.1)
    rng = np.random.default_rng(11)
    smooth, tied = rng.normal(size=30_000), rng.normal(size=30_000)
    tied[rng.random(30_000) < 0.4] = 0.001
    steps = np.repeat([1.0, 2.0], 15_000)  # the median lies between two values
    df = frame([tuple(map(float, r)) for r in zip(smooth, tied, steps)], "a double, b double, c double")
    got = {r.feature: r["median"] for r in propensity.medians(df, ["a", "b", "c"]).collect()}
    assert got == {"a": np.median(smooth), "b": np.median(tied), "c": 1.5}
    assert len(calls) > 1
    ready = {b.feature: b for found, _ in calls for b in found}
    assert set(ready) == {"a", "b", "c"}
    for name, values in (("a", smooth), ("b", tied), ("c", steps)):
        assert np.sum((values > ready[name].low) & (values < ready[name].high)) <= limit


def test_a_missed_bracket_is_opened(frame, monkeypatch):
    # A bracket that cannot hold the middle stands for a sketch outside its bound.
    monkeypatch.setattr(propensity, "BRACKET", -0.3)
    df = frame([(float(i),) for i in range(101)], "a double")
    assert propensity.median_values(df, ["a"]) == {"a": 50.0}


def test_imputation(frame):
    rows = [(1.0, None, None), (2.0, 3, None), (5.0, None, None), (10.0, 4, None), (None, None, None), (float("nan"), 9, None)]
    filled, kept = propensity.impute(frame(rows, "a double, b int, c double"), ["a", "b", "c"])
    assert kept == ["a", "b"]
    assert [(r.a, r.b) for r in filled.collect()] == [(1, 4), (2, 3), (5, 4), (10, 4), (3.5, 4), (3.5, 9)]


def test_scaling_uses_the_population_deviation(frame):
    rows = [(float(x), 4.0) for x in (1, 2, 3, 10)]
    got = propensity.scale(frame(rows, "a double, k double"), ["a", "k"]).toPandas()
    x = np.array([1, 2, 3, 10.0])
    assert np.allclose(got.z_a, (x - x.mean()) / x.std()) and (got.z_k == 0).all()


def test_labels_and_numeric_text(frame):
    rows = [("M", "1", "3", "x"), ("F", "2.5", "oops", None), (None, None, "4", "x"), ("F", "7", None, "y")]
    df = frame(rows, "sex string, all_numbers string, some string, declared string")
    got = [tuple(r) for r in propensity.to_numeric(df, df.columns, numeric=["declared"]).collect()]
    assert sorted(got, key=str) == sorted([
        (1.0, 1.0, 0.0, None), (0.0, 2.5, 2.0, None), (None, None, 1.0, None), (0.0, 7.0, None, None)
    ], key=str)


def test_label_checks_read_the_rows_once(frame):
    df = frame([("b", "1"), ("a", "2"), (None, None)], "x string, y string")
    labels = propensity.distinct_labels(df, ["x", "y"])
    assert propensity.numeric_text(labels) == ["y"]
    codes = propensity.encode_labels(df, ["x"], labels).collect()
    assert sorted(((r.x, r.y) for r in codes), key=str) == sorted([(1.0, "1"), (0.0, "2"), (None, None)], key=str)


def test_many_labels_are_ranked_by_range(frame, monkeypatch):
    monkeypatch.setattr(propensity, "WINDOW_ROWS", 10)
    words = [f"w{i * 7919 % 1000:04d}" for i in range(1000)]
    df = frame([(i, w, w[-1]) for i, w in enumerate(words)], "person_id long, x string, y string")
    got = {r.person_id: (r.x, r.y) for r in propensity.encode_labels(df, ["x", "y"]).collect()}
    order = {w: float(i) for i, w in enumerate(sorted(set(words)))}
    assert got == {i: (order[w], float(w[-1])) for i, w in enumerate(words)}


def test_a_text_feature_without_values_is_dropped(frame):
    df = propensity.to_numeric(frame([(None, 1)], "x string, y int"), ["x", "y"])
    assert propensity.impute(df, ["x", "y"])[1] == ["y"]


def newton(x, y):
    x1 = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    beta = np.zeros(x1.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = x1.T @ (p - y) + penalty @ beta
        beta -= np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) + penalty, gradient)
    return beta


def test_scores_equal_newton(frame):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    x[:, 2] = 0  # a constant feature
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))).astype(int)
    df = frame([(int(i), int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
               "person_id long, treatment int, a double, b double, c double")
    scaled = propensity.scale(df, ["a", "b", "c"])
    model = propensity.fit_model(scaled, ["z_a", "z_b", "z_c"])
    z = np.column_stack([(x[:, 0] - x[:, 0].mean()) / x[:, 0].std(), (x[:, 1] - x[:, 1].mean()) / x[:, 1].std(), x[:, 2]])
    want = newton(z, y)
    assert np.allclose([model.intercept, *model.coefficients.values()], want, atol=1e-5)
    scored = propensity.add_scores(scaled, model).orderBy("person_id").toPandas()
    p = 1 / (1 + np.exp(-(want[0] + z @ want[1:])))
    assert np.allclose(scored.propensity_score, p, atol=1e-5)
    clipped = p.clip(0.001, 0.999)
    assert np.allclose(scored.logit_ps, np.log(clipped / (1 - clipped)), atol=1e-4)


def test_balance(frame):
    rows = [(1, 1.0, 5.0, None), (1, 3.0, 5.0, 1.0), (0, 2.0, 5.0, None), (0, 6.0, 5.0, None), (0, None, 5.0, None)]
    df = frame(rows, "treatment int, a double, k double, gap double")
    got = {r.feature: r for r in balance.standardized_differences(df, ["a", "k", "gap", "missing"]).collect()}
    assert got["a"].smd == pytest.approx(2 / np.sqrt((2 + 8) / 2)) and got["k"].smd == 0 and got["gap"].smd == 0
    assert set(got) == {"a", "k", "gap"}
    kept = balance.standardized_differences(df, ["a", "k", "gap"], skip_empty=True)
    assert {r.feature for r in kept.collect()} == {"a", "k"}
    assert [r.feature for r in balance.imbalanced(kept).collect()] == ["a"]


def test_combined_arms_keep_all_columns(frame):
    both = propensity.combine_arms(frame([(1, 2)], "person_id long, u int"), frame([(2,)], "person_id long"))
    assert {tuple(r) for r in both.select("person_id", "u", "treatment").collect()} == {(1, 2, 1), (2, None, 0)}
