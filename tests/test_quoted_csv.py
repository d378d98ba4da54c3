"""Quoted records cut in splits: equal to the multi-line reader (which mixes up line ends of two kinds, hence the twins), whatever the splits, and one file in many tasks."""

import random

import pytest

from cohortry.sources import csv_tables, quoted_csv
from cohortry.sources.sinks import read_back, write_csv

HEADER = ["id", "no\nte", "x"]
SCHEMA = "id string, note string, x string"


def export(folder, name, n, seed, end="\n", spoil=True):
    """Values with delimiters, doubled quotes and all kinds of line ends; some lines with a field too few, some empty ones."""
    chance = random.Random(seed)
    with open(f"{folder}/{name}.csv", "w", newline="", encoding="utf-8") as out:
        out.write(f'id,"no\nte",x{end}')
        for i in range(n):
            text = "".join(chance.choice(["a", "b", ",", "\n", "\r\n", '""', " ", "é"]) for _ in range(chance.randrange(30)))
            if spoil and chance.random() < 0.03:
                out.write(chance.choice([f"{i},only two{end}", end]))
            out.write(f'{seed}-{i},"{text}",{chance.choice(["", "1.5", chr(34) * 2, "z z"])}{end}')
    return f"{folder}/{name}.csv"


@pytest.fixture
def splits(spark):
    """Sets the size of file splits in bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def sized(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield sized
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def good(df):
    return sorted((tuple(r)[:3] for r in df.collect() if r["_bad_line"] is None), key=repr)


@pytest.mark.parametrize("size, broadcast", [(10**8, 10**6), (2000, 10**6), (60, 10**6), (60, 0)])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, folder, splits, size, broadcast, end):
    paths, twins = ([export(folder, f"{name}{k}", 60, k, e) for k in range(3)] for name, e in (("f", end), ("twin", "\n")))
    options = csv_tables.csv_options(",", True)
    full = SCHEMA + ", _bad_line string"
    want = good(spark.read.options(**options).schema(full).option("columnNameOfCorruptRecord", "_bad_line").csv(twins))
    splits(size)
    records = quoted_csv.quoted_records(spark, paths, HEADER, broadcast_splits=broadcast)
    assert good(records.select(csv_tables.parsed(records.record, full, options).alias("r")).select("r.*")) == want
    assert len(want) == 180


def test_one_file_by_many_tasks(spark, folder, splits):
    path = export(folder, "one", 900, 5, spoil=False)
    splits(500)
    records = quoted_csv.quoted_records(spark, [path], HEADER)
    states = quoted_csv.split_states(spark, [path])
    assert states.count() >= 20
    assert records.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).filter(bool).count() > 10
    assert records.count() == 900


def test_a_value_longer_than_splits(spark, folder, splits):
    text = "\n".join(f"line {i}" for i in range(400))
    with open(f"{folder}/long.csv", "w") as out:
        out.write(f'id,note\n1,"{text}"\n2,"short"\n3,"{text}"')
    splits(100)
    rows = csv_tables.read_csv_table(spark, f"{folder}/long.csv", types={"id": "int"}).collect()
    assert sorted(map(tuple, rows)) == [(1, text), (2, "short"), (3, text)]


def test_table_reader_decides_itself(spark, folder, splits):
    """Line ends in quotes are found without being told; files without any are read as lines."""
    splits(80)
    broken = export(folder, "broken", 50, 7)
    df = csv_tables.read_csv_table(spark, broken, types={"id": "string"})
    assert df.count() == 50 and df.select("id").distinct().count() == 50
    with open(f"{folder}/plain.csv", "w") as out:
        out.write('id,note\n1,"a ""b"", c"\n2,d\n')
    plain = csv_tables.read_csv_table(spark, f"{folder}/plain.csv", types={"id": "int"})
    assert sorted(map(tuple, plain.collect())) == [(1, 'a "b", c'), (2, "d")]
    assert "MapInArrow" not in plain._jdf.queryExecution().toString()


def test_dropped_lines_of_cut_records(spark, folder, splits):
    splits(64)
    with open(f"{folder}/a.csv", "w") as out:
        out.write('id,note\n1,"a\nb"\nx,"c\nd"\n3\n4,"e"\n')
    rows = csv_tables.dropped_lines(spark, f"{folder}/a.csv", types={"id": "int"}).collect()
    assert sorted((r.reason, r.n) for r in rows) == [("field count", 1), ("id", 1)]
    assert all(r.file.endswith("/a.csv") for r in rows)


def test_another_header_is_an_error(spark, folder):
    for name, head in (("a", "id,note"), ("b", "note,id")):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(f'{head}\n1,"x\ny"\n')
    with pytest.raises(Exception, match="header"):
        csv_tables.read_csv_table(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], types={"id": "string"}).collect()


def test_written_results_are_read_in_splits(spark, folder, splits):
    rows = [(i, f"text\n{i}\r\n\"q\"", None if i % 3 else "", 1.5 * i) for i in range(300)]
    schema = "id long, text string, other string, x double"
    path = write_csv(spark.createDataFrame(rows, schema).coalesce(1), f"{folder}/out")
    splits(256)
    back = read_back(spark, path, schema)
    assert sorted(map(tuple, back.collect())) == rows
    assert quoted_csv.split_states(spark, [path]).count() > 10
    assert read_back(spark, write_csv(spark.createDataFrame([], schema), f"{folder}/none"), schema).collect() == []
