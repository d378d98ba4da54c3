"""Writing results and reading them back. Every sink writes a folder of part files in parallel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .csv_tables import csv_options, parsed
from .quoted_csv import quoted_records


def write_table(df: DataFrame, path: str, fmt: str = "parquet", delimiter: str = ",") -> str:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Quotes are doubled, blanks at the ends stay, and an empty text is quoted, so that it differs from null.
        plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, sep=delimiter, quote='"', escape='"', **plain).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> str:
    return write_table(df, path, "csv", delimiter)


def read_back(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """A written result with its types; CSV columns are matched by position as they were written.

    Texts may hold line ends; part files are read in splits all the same. An empty text was written in quotes and comes back empty.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    records = quoted_records(spark, [path], None)
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.select(parsed(F.col("record"), ddl, {**csv_options(multi_line=True), "nullValue": "\0"}).alias("r")).select("r.*")


def save_with_suffix(df: DataFrame, base: str, suffix: str | None = None, fmt: str = "csv") -> str:
    """Write to ``{base}_{suffix}.{fmt}``; the suffix defaults to today as YYYYMMDD."""
    return write_table(df, f"{base}_{suffix or date.today().strftime('%Y%m%d')}.{fmt}", fmt)


def write_matching(
    folder: str,
    cohort: str,
    matched: DataFrame,
    pairs: DataFrame,
    balance: DataFrame,
    fmt: str = "csv",
) -> dict[str, str]:
    """The four matching results; ``matched`` holds both arms with their ``treatment`` flag."""
    frames = {
        "matched_users": matched.filter("treatment = 1"),
        "matched_nonusers": matched.filter("treatment = 0"),
        "match_pairs": pairs,
        "balance_stats": balance,
    }
    base = folder.rstrip("/")
    return {name: write_table(df, f"{base}/{cohort}_{name}.{fmt}", fmt) for name, df in frames.items()}
