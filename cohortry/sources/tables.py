"""The set of clinical tables a study reads, with filtered access to each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import within
from .buckets import open_buckets
from .csv_tables import discover_tables, read_csv_table, resolve_path
from .membership import MEMBER_BYTES, Membership
from .schemas import TABLE_TYPES

# Ids of this many people are broadcast as they are; larger sets as bits, after these were counted.
MEMBER_ROWS = 2_000_000

Ids = Sequence[int] | DataFrame | Membership | None


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def keep_ids(df: DataFrame, column: str, ids: Ids) -> DataFrame:
    """Rows whose ``column`` is among ``ids``.

    ``None`` keeps everything and an empty collection keeps nothing. A list becomes a predicate
    the scan can use; a DataFrame (first column) becomes a semi join; a ``Membership`` is tested in the scan stage.
    """
    if ids is None:
        return df
    if isinstance(ids, Membership):
        return ids.keep(df, column)
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias(column))
        return df.join(keys, column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


class ClinicalTables:
    """Named tables; a value may be a DataFrame or a function that makes one on first use."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.spark = spark
        self._sources = dict(tables)
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str, files: Mapping[str, str] | None = None, **reading) -> ClinicalTables:
        """Tables found in ``folder``, or the given table -> file (or glob) mapping below it.

        ``reading`` goes to ``read_csv_table``: delimiter, multi_line, union_by_name.
        """
        if files is not None:
            found = {table: [resolve_path(folder, path)] for table, path in files.items()}
        else:
            found = discover_tables(spark, folder)
        return cls(spark, {t: (lambda t=t, p=p: read_csv_table(spark, p, t, **reading)) for t, p in found.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> ClinicalTables:
        return cls(spark, {t: (lambda p=p: lower_names(spark.read.parquet(p))) for t, p in paths.items()})

    @classmethod
    def from_buckets(cls, spark: SparkSession, folder: str) -> ClinicalTables:
        """Tables that were converted with ``buckets``."""
        return cls(spark, open_buckets(spark, folder))

    @property
    def names(self) -> list[str]:
        return sorted(self._sources)

    def __contains__(self, name: str) -> bool:
        return name in self._sources

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._sources:
            raise ValueError(f"Table {name} not found among {', '.join(self.names)}")
        if name not in self._frames:
            source = self._sources[name]
            self._frames[name] = source if isinstance(source, DataFrame) else source()
        return self._frames[name]

    def of_members(self, members: DataFrame, max_rows: int = MEMBER_ROWS, max_bytes: int = MEMBER_BYTES) -> ClinicalTables:
        """The same tables with the rows of ``members`` only, tested in the stage that scans a table.

        Counted first, so ``members`` should be staged. Up to ``max_rows`` ids are broadcast as they are, more as bits of at most
        ``max_bytes``. Beyond that the tables stay whole, which changes no result, since each step joins its members anyway.
        """
        ids = members.select("person_id")
        held = None
        if ids.count() > max_rows:
            held = Membership.of(ids, max_bytes=max_bytes)
            if held is None:
                return self

        def restricted(name: str) -> DataFrame:
            df = self[name]
            if "person_id" not in df.columns:
                return df
            return held.keep(df) if held else df.join(F.broadcast(ids), "person_id", "left_semi").select(*df.columns)

        return ClinicalTables(self.spark, {name: (lambda name=name: restricted(name)) for name in self._sources})

    def create_view(self, name: str, view: str | None = None) -> None:
        self[name].createOrReplaceTempView(view or name)

    def query(self, sql: str) -> DataFrame:
        """Ad-hoc SQL over every registered table; result columns are lower-case."""
        for name in self.names:
            if name in TABLE_TYPES and name in sql.lower():
                self.create_view(name)
        return lower_names(self.spark.sql(sql))

    def _select(
        self,
        table: str,
        person_ids: Ids,
        concept: tuple[str, Ids] | None = None,
        *tests: Column,
    ) -> DataFrame:
        df = self[table]
        for test in tests:
            df = df.filter(test)
        if concept is not None:
            df = keep_ids(df, *concept)
        return keep_ids(df, "person_id", person_ids)

    def persons(self, person_ids: Ids = None, min_birth_year=None, max_birth_year=None) -> DataFrame:
        tests = []
        if min_birth_year is not None:
            tests.append(F.col("year_of_birth") >= min_birth_year)
        if max_birth_year is not None:
            tests.append(F.col("year_of_birth") <= max_birth_year)
        return self._select("person", person_ids, None, *tests)

    def observation_periods(self, person_ids: Ids = None, start=None, end=None) -> DataFrame:
        """Periods that start on or after ``start`` and end on or before ``end``."""
        return self._select(
            "observation_period",
            person_ids,
            None,
            within("observation_period_start_date", start=start),
            within("observation_period_end_date", end=end),
        )

    def conditions(self, person_ids: Ids = None, concept_ids: Ids = None, start=None, end=None) -> DataFrame:
        return self._select(
            "condition_occurrence",
            person_ids,
            ("condition_concept_id", concept_ids),
            within("condition_start_date", start, end),
        )

    def drug_exposures(self, person_ids: Ids = None, concept_ids: Ids = None, start=None, end=None) -> DataFrame:
        return self._select(
            "drug_exposure",
            person_ids,
            ("drug_concept_id", concept_ids),
            within("drug_exposure_start_date", start, end),
        )

    def measurements(self, person_ids: Ids = None, concept_ids: Ids = None, start=None, end=None) -> DataFrame:
        return self._select(
            "measurement",
            person_ids,
            ("measurement_concept_id", concept_ids),
            within("measurement_date", start, end),
        )

    def procedures(self, person_ids: Ids = None, concept_ids: Ids = None, start=None, end=None) -> DataFrame:
        return self._select(
            "procedure_occurrence",
            person_ids,
            ("procedure_concept_id", concept_ids),
            within("procedure_date", start, end),
        )

    def visits(self, person_ids: Ids = None, concept_ids: Ids = None, start=None, end=None) -> DataFrame:
        """Visits that start on or after ``start`` and end on or before ``end``."""
        return self._select(
            "visit_occurrence",
            person_ids,
            ("visit_concept_id", concept_ids),
            within("visit_start_date", start=start),
            within("visit_end_date", end=end),
        )
