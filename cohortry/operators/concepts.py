"""Concept sets: expansion through the hierarchy, look-ups, and tagging of events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scale import DRIVER_IDS, local_frame, stage
from ..sources.concept_files import ConceptSpec

# Sets up to this size become an IN predicate, which the Parquet scan can use to skip row groups.
PREDICATE_IDS = 1_000


def ids_frame(spark: SparkSession, ids: Sequence[int] | DataFrame) -> DataFrame:
    """A distinct ``concept_id`` column; no ids give a typed empty frame.

    Ids that come from a table are collected from it once and staged, since look-ups join them
    several times and the right join depends on how many there are.
    """
    if isinstance(ids, DataFrame):
        return stage(ids.select(F.col(ids.columns[0]).cast("bigint").alias("concept_id")).distinct())
    unique = list(dict.fromkeys(int(i) for i in ids))
    return local_frame(spark, {"concept_id": unique}, {"concept_id": pa.int64()})


def named_ids(spark: SparkSession, sets: Mapping[str, Sequence[int]], label: str = "set_name") -> DataFrame:
    """``(label, concept_id)`` rows of several sets."""
    rows = [(name, int(i)) for name, ids in sets.items() for i in dict.fromkeys(ids)]
    return local_frame(
        spark,
        {label: [r[0] for r in rows], "concept_id": [r[1] for r in rows]},
        {label: pa.string(), "concept_id": pa.int64()},
    )


def expand_named(spark: SparkSession, ancestor: DataFrame, specs: Mapping[str, ConceptSpec]) -> DataFrame:
    """Distinct ``(set_name, concept_id)`` of all sets, in one pass over the hierarchy."""
    seeds = named_ids(spark, {n: s.ids for n, s in specs.items() if s.include_descendants})
    kept = named_ids(
        spark, {n: s.ids for n, s in specs.items() if s.include_self or not s.include_descendants}
    )
    wanted = {i for s in specs.values() if s.include_descendants for i in s.ids}
    edges = ancestor.select("ancestor_concept_id", "descendant_concept_id")
    if len(wanted) <= PREDICATE_IDS:
        edges = edges.filter(F.col("ancestor_concept_id").isin(sorted(wanted)))
    below = edges.join(seeds, edges.ancestor_concept_id == seeds.concept_id).select(
        "set_name", F.col("descendant_concept_id").cast("bigint").alias("concept_id")
    )
    return below.union(kept).distinct()


def expand(
    spark: SparkSession,
    ancestor: DataFrame,
    ids: Sequence[int],
    include_descendants: bool = True,
    include_self: bool = True,
) -> DataFrame:
    """Distinct concepts of one set."""
    spec = ConceptSpec(tuple(ids), include_descendants, include_self)
    return expand_named(spark, ancestor, {"set": spec}).select("concept_id")


def _found(concept: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    return concept.select("concept_id", *columns).join(ids, "concept_id", "left_semi")


def concept_names(spark: SparkSession, concept: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Every id with its name, null when the vocabulary lacks it."""
    wanted = ids_frame(spark, ids)
    return wanted.join(_found(concept, wanted, "concept_name"), "concept_id", "left")


def of_vocabulary(spark: SparkSession, concept: DataFrame, ids, vocabulary: str) -> DataFrame:
    kept = concept.filter(F.col("vocabulary_id") == vocabulary)
    return _found(kept, ids_frame(spark, ids))


def standard_only(spark: SparkSession, concept: DataFrame, ids) -> DataFrame:
    kept = concept.filter(F.col("standard_concept") == "S")
    return _found(kept, ids_frame(spark, ids))


def set_details(concept: DataFrame, sets: DataFrame, specs: Mapping[str, ConceptSpec]) -> DataFrame:
    """Vocabulary columns of each set's concepts, with a flag for the ids the study named.

    Ids the vocabulary lacks do not appear here, though the summary counts them.
    """
    named = named_ids(concept.sparkSession, {n: s.ids for n, s in specs.items()}).withColumn("named", F.lit(1))
    columns = ["concept_name", "concept_code", "concept_class_id", "vocabulary_id", "domain_id"]
    details = concept.select("concept_id", *[c for c in columns if c in concept.columns])
    return (
        details.join(sets, "concept_id")
        .join(named, ["set_name", "concept_id"], "left")
        .withColumn("is_original", F.coalesce("named", F.lit(0)))
        .drop("named")
    )


def set_summary(sets: DataFrame, specs: Mapping[str, ConceptSpec]) -> DataFrame:
    """Per set: the named ids joined with ``;``, how many they are, and the expanded size."""
    spark = sets.sparkSession
    rows = [(n, ";".join(map(str, s.ids)), len(s.ids)) for n, s in specs.items()]
    named = local_frame(
        spark,
        {"set_name": [r[0] for r in rows], "original_ids": [r[1] for r in rows], "n_original": [r[2] for r in rows]},
        {"set_name": pa.string(), "original_ids": pa.string(), "n_original": pa.int32()},
    )
    sizes = sets.groupBy("set_name").agg(F.count(F.lit(1)).alias("n_total"))
    return named.join(sizes, "set_name", "left").withColumn("n_total", F.coalesce("n_total", F.lit(0)))


class ConceptSets:
    """The resolved sets of a study.

    Sets are resolved once, by one job over the hierarchy. Up to ``DRIVER_IDS`` ids in all
    they become a local relation the optimizer can size and broadcast; beyond that they stay a
    distributed frame and joins with them shuffle.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame, ids: dict[str, list[int]] | None):
        self.spark = spark
        self.rows = rows
        self._ids = ids

    @classmethod
    def of_lists(cls, spark: SparkSession, sets: Mapping[str, Sequence[int]]) -> ConceptSets:
        """Sets taken as written, without expansion."""
        return cls(spark, named_ids(spark, sets), {n: sorted({int(i) for i in ids}) for n, ids in sets.items()})

    @classmethod
    def resolve(cls, spark: SparkSession, ancestor: DataFrame, specs: Mapping[str, ConceptSpec]) -> ConceptSets:
        if not any(s.include_descendants for s in specs.values()):
            return cls.of_lists(spark, {n: s.ids for n, s in specs.items()})
        expanded = expand_named(spark, ancestor, specs)
        head = expanded.limit(DRIVER_IDS + 1).toArrow()
        if head.num_rows > DRIVER_IDS:
            return cls(spark, stage(expanded), None)
        ids: dict[str, list[int]] = {name: [] for name in specs}
        for name, concept in zip(head["set_name"].to_pylist(), head["concept_id"].to_pylist()):
            ids[name].append(concept)
        return cls.of_lists(spark, ids)

    def frame(self, *names: str) -> DataFrame:
        return self.rows.filter(F.col("set_name").isin(list(names)))

    def _prefilter(self, events: DataFrame, names: Sequence[str]) -> tuple[DataFrame, bool]:
        if self._ids is None:
            return events, False
        ids = sorted({i for n in names for i in self._ids[n]})
        if len(ids) > PREDICATE_IDS:
            return events, False
        return events.filter(F.col("concept_id").isin(ids)), True

    def restrict(self, events: DataFrame, *names: str) -> DataFrame:
        """Events whose ``concept_id`` belongs to any of the sets."""
        kept, done = self._prefilter(events, names)
        if done:
            return kept
        return kept.join(self.frame(*names).select("concept_id").distinct(), "concept_id", "left_semi")

    def tag(self, events: DataFrame, *names: str) -> DataFrame:
        """Events of the sets with their ``set_name``; one row per set an event belongs to."""
        kept, _ = self._prefilter(events, names)
        return kept.join(self.frame(*names), "concept_id")
