"""Sets of results: written in one pass, in force only when whole, and checked when read."""

import datetime
from pathlib import Path

import pytest

from cohortry.sources import results
from cohortry.sources.results import read_results, write_results

SCHEMA = "id long, text string, x double, day date"
ROWS = [(1, 'a "b"\n,c', 1.5, datetime.date(2000, 1, 2)), (2, "", None, None), (3, None, float("nan"), None), (3, None, float("nan"), None)]


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trip(spark, folder, fmt):
    frames = {"one": spark.createDataFrame(ROWS, SCHEMA), "none": spark.createDataFrame([], SCHEMA)}
    write_results(frames, folder, "set", fmt)
    back = read_results(spark, folder, "set")
    assert {k: rows_of(v) for k, v in back.items()} == {k: rows_of(v) for k, v in frames.items()}


def test_a_half_written_set_is_not_read(spark, folder, monkeypatch):
    first, second = (spark.range(n).toDF("id") for n in (3, 5))
    with pytest.raises(ValueError, match="no whole set"):
        read_results(spark, folder, "set")
    write_results({"a": first, "b": first}, folder, "set")
    write, done = results.write_table, []

    def fails_on_the_second(df, path, fmt):
        if done:
            raise OSError("disk full")
        done.append(write(df, path, fmt))

    monkeypatch.setattr(results, "write_table", fails_on_the_second)
    with pytest.raises(OSError):
        write_results({"a": second, "b": second}, folder, "set")
    assert {k: v.count() for k, v in read_results(spark, folder, "set").items()} == {"a": 3, "b": 3}
    monkeypatch.setattr(results, "write_table", write)
    write_results({"a": second, "b": second}, folder, "set")
    assert {k: v.count() for k, v in read_results(spark, folder, "set").items()} == {"a": 5, "b": 5}


def test_damage_is_noticed(spark, folder):
    target = write_results({"a": spark.range(100).toDF("id").repartition(4)}, folder, "set")
    part = sorted(Path(f"{target}/a").glob("*.parquet"))[0]
    part.rename(f"{folder}/{part.name}")
    with pytest.raises(ValueError, match="rows with checksum"):
        read_results(spark, folder, "set")
    assert read_results(spark, folder, "set", check=False)["a"].count() < 100


def test_each_frame_is_computed_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    write_results({"a": spark.range(50).mapInArrow(count, "id long")}, folder, "set")
    assert calls.value == 50
