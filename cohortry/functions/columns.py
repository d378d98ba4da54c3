"""Column expressions for dates, ages, codes and follow-up."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.44

# Sex concepts of the clinical data model.
SEX_CODES = {8507: "M", 8532: "F"}

# Survey codes of smoking status, as text.
SMOKING_CODES = {
    "Current Smoker": ["01", "1", "1.0", "02", "2", "2.0", "07", "7", "7.0", "08", "8", "8.0"],
    "Former Smoker": ["03", "3", "3.0"],
    "Never Smoker": ["04", "4", "4.0"],
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date(date: Column | str, moment: Column | str | None = None) -> Column:
    """Date of an event, falling back to its timestamp when the date is missing."""
    if moment is None:
        return _col(date).cast("date")
    return F.coalesce(_col(date).cast("date"), _col(moment).cast("date"))


def parse_date(text: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date from text in a Java date pattern, null when it does not parse."""
    return F.try_to_timestamp(_col(text), F.lit(pattern)).cast("date")


def safe_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def birth_date(
    year: Column | str,
    month: Column | str,
    day: Column | str,
    moment: Column | str | None = None,
) -> Column:
    """Birth date from parts; an unknown (null or 0) month or day counts as 1.

    A birth timestamp wins when given. Impossible dates give null.
    """

    def part(c):
        return F.coalesce(F.nullif(_col(c).cast("int"), F.lit(0)), F.lit(1))

    built = F.format_string("%04d-%02d-%02d", _col(year).cast("int"), part(month), part(day))
    from_parts = F.when(_col(year).isNotNull(), built).try_cast("date")
    return from_parts if moment is None else F.coalesce(_col(moment).cast("date"), from_parts)


def years_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)) / F.lit(DAYS_PER_YEAR)


def age_rounded(birth: Column | str, reference: Column | str) -> Column:
    """Age in years, rounded half to even."""
    return F.bround(years_between(birth, reference), 0).cast("int")


def age_truncated(birth: Column | str, reference: Column | str) -> Column:
    """Age in completed years."""
    return years_between(birth, reference).cast("int")


def follow_up_time(start: Column | str, end: Column | str, unit: str = "days") -> Column:
    days = F.datediff(_col(end), _col(start))
    if unit == "days":
        return days
    if unit == "months":
        return days / F.lit(DAYS_PER_MONTH)
    if unit == "years":
        return days / F.lit(DAYS_PER_YEAR)
    raise ValueError(f"Unknown unit: {unit}")


def lookback_start(index: Column | str, months: int = 12) -> Column:
    """First day of the baseline period, which ends on the index date."""
    return F.add_months(_col(index), -months)


def follow_up_end(index: Column | str, last_seen: Column | str, max_years: int | None = None) -> Column:
    """Last day of follow-up: the last contact, at most ``max_years`` after the index."""
    if not max_years:
        return _col(last_seen)
    capped = F.least(_col(last_seen), F.add_months(_col(index), 12 * max_years))
    return F.when(_col(last_seen).isNotNull(), capped)


def sex_from_concept(concept: Column | str) -> Column:
    branches = F
    for code, label in SEX_CODES.items():
        branches = branches.when(_col(concept) == code, label)
    return branches


def sex_clean(value: Column | str) -> Column:
    """F or M, anything else null."""
    return F.when(_col(value).isin(*SEX_CODES.values()), _col(value))


def smoking_status(code: Column | str) -> Column:
    text = _col(code).cast("string")
    branches = F
    for label, codes in SMOKING_CODES.items():
        branches = branches.when(text.isin(*codes, label), label)
    return branches.otherwise("Unknown")


def body_mass_index(weight_kg: Column | str, height_cm: Column | str) -> Column:
    """Weight over squared height in metres; null for a missing or zero height."""
    metres = _col(height_cm) / 100
    return F.try_divide(_col(weight_kg), metres * metres)


def any_flag(*flags: Column | str) -> Column:
    """Largest of the flags, nulls skipped."""
    cols = [_col(f) for f in flags]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def within(date: Column | str, start=None, end=None) -> Column:
    """``start <= date <= end`` with either side optional."""
    tests = []
    if start is not None:
        tests.append(_col(date) >= F.lit(start).cast("date"))
    if end is not None:
        tests.append(_col(date) <= F.lit(end).cast("date"))
    return reduce(Column.__and__, tests, F.lit(True)) if tests else F.lit(True)


# A day and a record id in one number; a fixed width lets Spark group by hash instead of sorting its input.
ORDER = "decimal(38,0)"
_ID_SPAN, _ID_SHIFT = Decimal(10**20), Decimal(2**63)


def packed_order(day: Column | str, record: Column | str) -> Column:
    """Orders rows by day, then by record id, as one fixed-width number; null without a day."""
    day, record = (F.col(c) if isinstance(c, str) else c for c in (day, record))
    number = F.unix_date(day.cast("date")).cast("decimal(9,0)") * F.lit(_ID_SPAN).cast("decimal(21,0)")
    return (number + (F.coalesce(record, F.lit(0)).cast("decimal(20,0)") + F.lit(_ID_SHIFT).cast("decimal(20,0)"))).cast(ORDER)


def packed_id(order: Column | str) -> Column:
    """The record id in a packed order."""
    order = F.col(order) if isinstance(order, str) else order
    span = F.lit(_ID_SPAN).cast("decimal(21,0)")
    return (F.pmod(order, span) - F.lit(_ID_SHIFT).cast("decimal(20,0)")).cast("bigint")
