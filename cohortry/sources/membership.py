"""Exact sets of persons, small enough to travel to every scan.

Ids are kept as words of 64 bits, one row for each word that holds a member, so a dense cohort of a hundred million
people is under two million rows. With a day per person (an index date) each word also holds its members' days in the order of
their bits. Facts meet the words in the stage that scans them: other people's rows leave before any shuffle, and rows on the
wrong side of the person's day can leave there too, so that map tasks reduce what is left to one value per person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..scale import stage

#: Bytes a broadcast set may take, and what a word and a day are counted with.
MEMBER_BYTES, WORD_BYTES, DAY_BYTES = 128 << 20, 56, 4
MEMBER_DAY = "member_day"


def _place(person: Column) -> Column:
    return person.bitwiseAND(F.lit(63)).cast("int")


class Membership:
    """Made by ``Membership.of``; ``bytes`` is the counted size."""

    def __init__(self, words: DataFrame, size: int, dated: bool):
        self.words, self.bytes, self.is_dated = words, size, dated

    @classmethod
    def of(cls, people: DataFrame, day: str | None = None, person: str = "person_id", max_bytes: int = MEMBER_BYTES) -> Membership | None:
        """The set of ``people``, one row each, with their ``day`` if named; None if it would take more than ``max_bytes``.

        The words are counted before anything is broadcast. Null ids are no members; without people the set is empty.
        """
        ids = people.where(F.col(person).isNotNull()).groupBy(F.col(person).cast("bigint").alias("id")).agg(F.min(F.col(day).cast("date") if day else F.lit(None)).alias("day"))
        placed = ids.select(F.shiftright("id", 6).alias("word"), _place(F.col("id")).alias("place"), "day")
        bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place"))).alias("bits")
        if day:
            days = F.transform(F.array_sort(F.collect_list(F.struct("place", "day"))), lambda x: x["day"]).alias("days")
            words = stage(placed.groupBy("word").agg(bits, days))
        else:
            words = stage(placed.groupBy("word").agg(bits))
        n_words, n_people = words.agg(F.count("*"), F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))).first()
        size = n_words * WORD_BYTES + (n_people * DAY_BYTES if day else 0)
        return cls(words, size, day is not None) if size <= max_bytes else None

    def _held(self, df: DataFrame, column: str) -> tuple[DataFrame, Column]:
        words = F.broadcast(self.words.toDF(*[f"_{c}" for c in self.words.columns]))
        person = df[column].cast("bigint")
        return words, (F.shiftright(person, 6) == F.col("_word")) & (F.call_function("getbit", F.col("_bits"), _place(person)) == 1)

    def keep(self, df: DataFrame, column: str = "person_id") -> DataFrame:
        """Rows of members."""
        words, held = self._held(df, column)
        return df.join(words, held, "left_semi")

    def dated(self, df: DataFrame, column: str = "person_id") -> DataFrame:
        """Rows of members, with their day as ``member_day``: the rank of the person's bit among the word's is the day's place."""
        if not self.is_dated:
            raise ValueError("these members have no day")
        words, held = self._held(df, column)
        below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), _place(F.col(column).cast("bigint"))))
        day = F.get("_days", F.bit_count(F.col("_bits").bitwiseAND(below)))
        return df.join(words, held).select(*df.columns, day.alias(MEMBER_DAY))
