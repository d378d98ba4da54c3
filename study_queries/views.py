"""The test tables seen as clinical tables.

Each view is one SELECT that Spark and DuckDB both run, with a ``{table}`` slot per source table.
"""

from __future__ import annotations

from functools import partial
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortry.sources.tables import ClinicalTables

VIEWS = {
    "person": """
        SELECT c_custkey AS person_id,
               CASE WHEN c_custkey % 10 = 9 THEN 0 WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
               CAST(1925 + (c_custkey * 7) % 75 AS INT) AS year_of_birth,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 13 AS INT) END AS month_of_birth,
               CAST(c_custkey % 29 AS INT) AS day_of_birth,
               CASE WHEN c_custkey % 5 = 0
                    THEN CAST(make_date(CAST(1925 + (c_custkey * 7) % 75 AS INT), 6, 15) AS TIMESTAMP)
                    END AS birth_datetime,
               c_nationkey AS race_concept_id, n_regionkey AS ethnicity_concept_id
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "concept": """
        SELECT p_partkey AS concept_id, p_name AS concept_name, p_brand AS vocabulary_id, p_type AS domain_id,
               CASE WHEN p_size % 2 = 0 THEN 'S' END AS standard_concept
        FROM {part}""",
    "concept_ancestor": """
        SELECT p_partkey - p_partkey % 10 AS ancestor_concept_id, p_partkey AS descendant_concept_id FROM {part}
        UNION
        SELECT p_partkey AS ancestor_concept_id, p_partkey AS descendant_concept_id FROM {part}""",
    "visit_occurrence": """
        SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id,
               CASE o_orderstatus WHEN 'O' THEN 9202 WHEN 'F' THEN 9201 ELSE 9203 END AS visit_concept_id,
               CAST(o_orderdate AS DATE) AS visit_start_date, o_orderdate AS visit_start_datetime,
               CAST(o_orderdate AS DATE) AS visit_end_date
        FROM {orders}""",
    "condition_occurrence": """
        SELECT o_orderkey AS condition_occurrence_id, o_custkey AS person_id,
               (o_orderkey * 31) % 40 AS condition_concept_id,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS condition_start_date,
               o_orderdate AS condition_start_datetime
        FROM {orders}""",
    "procedure_occurrence": """
        SELECT o_orderkey AS procedure_occurrence_id, o_custkey AS person_id,
               (o_orderkey * 17) % 30 AS procedure_concept_id, CAST(o_orderdate AS DATE) AS procedure_date
        FROM {orders}""",
    "drug_exposure": """
        SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS drug_exposure_id,
               o_custkey AS person_id, l_partkey % 200 AS drug_concept_id,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS drug_exposure_start_date,
               l_shipdate AS drug_exposure_start_datetime
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "measurement": """
        SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS measurement_id,
               o_custkey AS person_id, l_suppkey % 10 AS measurement_concept_id,
               CAST(l_shipdate AS DATE) AS measurement_date, l_shipdate AS measurement_datetime,
               CASE WHEN l_quantity = 48 THEN NULL WHEN l_quantity = 49 THEN 'n/a'
                    ELSE CAST(l_quantity AS STRING) END AS value_as_number
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Half of the people have two periods: apart, touching, or overlapping.
    "observation_period": """
        SELECT person_id, period_start AS observation_period_start_date,
               CASE WHEN person_id % 4 = 0 THEN coalesce(CAST(next_start - INTERVAL '1' DAY AS DATE), period_end)
                    WHEN person_id % 12 = 2 THEN coalesce(CAST(next_start + INTERVAL '100' DAY AS DATE), period_end)
                    ELSE period_end END AS observation_period_end_date
        FROM (SELECT person_id, period_start, period_end, lead(period_start) OVER (PARTITION BY person_id ORDER BY period_start) AS next_start
              FROM (SELECT o_custkey AS person_id, CASE WHEN o_custkey % 2 = 0 AND o_orderdate < TIMESTAMP '1996-06-01 00:00:00' THEN 0 ELSE 1 END AS half,
                           CAST(min(o_orderdate) AS DATE) AS period_start, CAST(max(o_orderdate) AS DATE) AS period_end
                    FROM {orders} GROUP BY 1, 2) halves) ordered""",
    # A third of the dead have a second, later row.
    "death": """
        SELECT person_id, CASE WHEN again = 1 THEN CAST(death_date + INTERVAL '20' DAY AS DATE) ELSE death_date END AS death_date
        FROM (SELECT c_custkey AS person_id, CAST(max(o_orderdate) AS DATE) AS death_date
              FROM {customer} JOIN {orders} ON c_custkey = o_custkey
              WHERE c_acctbal < 0 AND o_orderkey % 2 = 0 GROUP BY c_custkey) dead
        CROSS JOIN (SELECT 0 AS again UNION ALL SELECT 1 AS again) copies
        WHERE again = 0 OR person_id % 3 = 0""",
}


def _slots(sql: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(sql) if name}


def duckdb_view(name: str) -> str:
    """The view's SELECT over the tables DuckDB has registered."""
    return VIEWS[name].format(**{slot: slot for slot in _slots(VIEWS[name])})


# Schemas of the test tables, kept so that each is read from file metadata only once.
_SCHEMAS: dict[str, StructType] = {}


def _source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    path = f"{folder}/{table}.parquet"
    if table not in _SCHEMAS:
        _SCHEMAS[table] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[table]).parquet(path)


def clinical_tables(spark: SparkSession, folder: str) -> ClinicalTables:
    sources: dict[str, DataFrame] = {}

    def view(name: str) -> DataFrame:
        slots = _slots(VIEWS[name])
        for slot in slots - sources.keys():
            sources[slot] = _source(spark, folder, slot)
        return spark.sql(VIEWS[name], **{slot: sources[slot] for slot in slots})

    return ClinicalTables(spark, {name: partial(view, name) for name in VIEWS})
