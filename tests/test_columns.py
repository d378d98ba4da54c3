import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortry.functions import columns as C
from cohortry.functions import summaries as S


def one(frame, expression, rows=((1,),), schema="x int"):
    return frame(list(rows), schema).select(expression.alias("v")).first().v


D = dt.date


def test_birth_date_parts(frame):
    rows = [(1990, 0, None), (1990, 5, 0), (1991, 2, 30), (None, 1, 1), (1980, 12, 31)]
    df = frame(rows, "y int, m int, d int").select(C.birth_date("y", "m", "d").alias("b"))
    assert [r.b for r in df.collect()] == [D(1990, 1, 1), D(1990, 5, 1), None, None, D(1980, 12, 31)]


def test_birth_timestamp_wins(frame):
    df = frame([(1990, 1, 1, dt.datetime(1991, 6, 15, 12))], "y int, m int, d int, t timestamp")
    assert df.select(C.birth_date("y", "m", "d", "t").alias("b")).first().b == D(1991, 6, 15)


def test_ages_round_and_truncate_differently(frame):
    birth = D(2000, 1, 1)
    rows = [(birth, birth + dt.timedelta(days=n)) for n in (6392, 6393, 6575, 6574)]
    df = frame(rows, "b date, r date").select(C.age_rounded("b", "r").alias("a"), C.age_truncated("b", "r").alias("t"))
    assert [tuple(r) for r in df.collect()] == [(18, 17), (18, 17), (18, 18), (18, 17)]


def test_rounding_is_half_to_even(frame):
    df = frame([(17.5,), (18.5,), (17.6,)], "x double").select(F.bround("x", 0).cast("int").alias("v"))
    assert [r.v for r in df.collect()] == [18, 18, 18]


def test_event_date_falls_back_to_timestamp(frame):
    rows = [(D(2000, 1, 2), dt.datetime(2001, 1, 1)), (None, dt.datetime(2001, 1, 1, 23, 59)), (None, None)]
    df = frame(rows, "d date, t timestamp").select(C.event_date("d", "t").alias("v"))
    assert [r.v for r in df.collect()] == [D(2000, 1, 2), D(2001, 1, 1), None]


def test_follow_up_time_units(frame):
    rows = [(D(2000, 1, 1), D(2001, 1, 1))]
    row = frame(rows, "s date, e date").select(
        C.follow_up_time("s", "e").alias("d"),
        C.follow_up_time("s", "e", "months").alias("m"),
        C.follow_up_time("s", "e", "years").alias("y"),
    ).first()
    assert row.d == 366 and row.m == pytest.approx(366 / 30.44) and row.y == pytest.approx(366 / 365.25)
    with pytest.raises(ValueError):
        C.follow_up_time("s", "e", "weeks")


def test_lookback_clamps_month_ends(frame):
    df = frame([(D(2020, 3, 31),)], "i date").select(C.lookback_start("i", 1).alias("v"))
    assert df.first().v == D(2020, 2, 29)


def test_follow_up_end_without_last_contact(frame):
    rows = [(D(2000, 1, 1), D(2010, 1, 1)), (D(2000, 1, 1), D(2000, 6, 1)), (D(2000, 1, 1), None)]
    df = frame(rows, "i date, l date").select(C.follow_up_end("i", "l", 2).alias("v"))
    assert [r.v for r in df.collect()] == [D(2002, 1, 1), D(2000, 6, 1), None]


def test_smoking_codes(frame):
    rows = [("01",), ("8.0",), ("3",), ("4.0",), ("9",), (None,), ("Never Smoker",)]
    df = frame(rows, "c string").select(C.smoking_status("c").alias("v"))
    assert [r.v for r in df.collect()] == [
        "Current Smoker", "Current Smoker", "Former Smoker", "Never Smoker", "Unknown", "Unknown", "Never Smoker"
    ]


def test_body_mass_index(frame):
    rows = [(80.0, 200.0), (80.0, 0.0), (None, 180.0), (80.0, None)]
    df = frame(rows, "w double, h double").select(C.body_mass_index("w", "h").alias("v"))
    assert [r.v for r in df.collect()] == [20.0, None, None, None]


def test_any_flag_skips_nulls(frame):
    df = frame([(0, None), (1, None), (None, None)], "a int, b int").select(C.any_flag("a", "b").alias("v"))
    assert [r.v for r in df.collect()] == [0, 1, None]
    assert one(frame, C.any_flag("x")) == 1


def test_parse_date(frame):
    df = frame([("2020-01-31",), ("x",)], "t string").select(C.parse_date("t").alias("v"))
    assert [r.v for r in df.collect()] == [D(2020, 1, 31), None]


def test_filter_date_range_is_inclusive(frame):
    rows = [(D(2000, 1, d),) for d in (1, 2, 3)] + [(None,)]
    df = frame(rows, "d date")
    assert S.filter_date_range(df, "d", "2000-01-02", "2000-01-03").count() == 2
    assert S.filter_date_range(df, "d", end="2000-01-01").count() == 1
    assert S.filter_date_range(df, "d").count() == 4


def test_aggregate_by_person_takes_first_known_value(frame):
    rows = [(1, 2, "b"), (1, 1, None), (1, 3, "c"), (2, 1, None)]
    df = frame(rows, "person_id long, seq int, v string")
    got = {r.person_id: r.v for r in S.aggregate_by_person(df, order_by=["seq"]).collect()}
    assert got == {1: "b", 2: None}
    with pytest.raises(ValueError):
        S.aggregate_by_person(df)


def test_summary_of_nothing(frame):
    row = S.summarize(frame([], "person_id long")).first()
    assert tuple(row) == (0, 0, 0.0)
