"""Per-person aggregates and cohort summaries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from .columns import packed_order, within


def filter_date_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows whose date lies in the closed range; rows without a date go when a bound is given."""
    return df.filter(within(F.col(column).cast("date"), start, end))


def last_known(value: str, day: str, record: str) -> Column:
    """Aggregate: the non-null value of the last day, on that day of the highest record id.

    With a fixed-width value Spark groups by hash, without sorting its input.
    """
    return F.max_by(value, F.when(F.col(value).isNotNull(), packed_order(day, record)))


_WHOLE_NUMBERS = {"tinyint", "smallint", "int", "bigint"}


def _order(df: DataFrame, order_by: list[str]) -> Column:
    """The order as one fixed-width number where a day and a record id make it, else as a struct."""
    kinds = dict(df.dtypes)
    if len(order_by) == 2 and kinds[order_by[0]] == "date" and kinds[order_by[1]] in _WHOLE_NUMBERS:
        return F.coalesce(packed_order(*order_by), F.lit(Decimal(-(10**37))).cast("decimal(38,0)"))
    return F.struct(*order_by)


def aggregate_by_person(
    df: DataFrame,
    aggregates: dict[str, Column] | None = None,
    order_by: list[str] | None = None,
    person: str = "person_id",
) -> DataFrame:
    """One row per person.

    Without ``aggregates`` each column takes its first non-null value in ``order_by``, which must
    then be given because rows have no order of their own.
    """
    if aggregates is None:
        if not order_by:
            raise ValueError("order_by is needed to pick a first value")
        aggregates = {
            c: F.min_by(c, F.when(F.col(c).isNotNull(), _order(df, order_by)))
            for c in df.columns
            if c != person
        }
    return df.groupBy(person).agg(*[expr.alias(name) for name, expr in aggregates.items()])


def summarize(df: DataFrame, person: str = "person_id") -> DataFrame:
    """Distinct persons, records, and records per person, as one row."""
    # Two grouping levels spread a dominating person's rows before they are counted.
    per_person = df.groupBy(person).agg(F.count(F.lit(1)).alias("n"))
    return per_person.agg(
        F.count(person).alias("n_persons"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"),
    ).select(
        "n_persons",
        "n_records",
        F.coalesce(F.try_divide(F.col("n_records").cast("double"), F.col("n_persons")), F.lit(0.0)).alias(
            "records_per_person"
        ),
    )
