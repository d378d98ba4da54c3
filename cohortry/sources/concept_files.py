"""Concept sets and feature dictionaries kept in small CSV or JSON files."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..scale import DRIVER_IDS
from .csv_tables import csv_options, detect_delimiter

logger = logging.getLogger(__name__)


# A concept file is read whole on the driver up to this size.
FILE_BYTES = 64 << 20


@dataclass(frozen=True)
class ConceptSpec:
    """Concept ids as written in a study, and how to expand them through the hierarchy.

    ``include_self`` keeps the ids themselves even if the hierarchy has no row from an id to
    itself.
    """

    ids: tuple[int, ...] = ()
    include_descendants: bool = True
    include_self: bool = True

    @classmethod
    def of(cls, value, include_self: bool = True) -> ConceptSpec:
        """From a list (taken as it is) or ``{concept_ids, include_descendants}`` (expanded by default)."""
        if isinstance(value, ConceptSpec):
            return value
        if isinstance(value, dict):
            return cls(
                tuple(int(i) for i in value.get("concept_ids", [])),
                bool(value.get("include_descendants", True)),
                include_self,
            )
        return cls(tuple(int(i) for i in value), False, include_self)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file, on any file system; nothing of it is read."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of one small file on any file system, None when there is no such file."""
    if not _exists(spark, path):
        return None
    size = spark.read.format("binaryFile").load(path).select("length").first()
    if size and size[0] > FILE_BYTES:
        raise ValueError(f"{path} has {size[0]} bytes; a concept file may have {FILE_BYTES}")
    rows = spark.read.option("wholetext", True).text(path).collect()
    return rows[0].value if rows else ""


def _bounded(rows: DataFrame, path: str) -> list:
    """The rows of a file that a study keeps on the driver, an error beyond ``DRIVER_IDS``."""
    found = rows.limit(DRIVER_IDS + 1).collect()
    if len(found) > DRIVER_IDS:
        raise ValueError(f"{path} has more than {DRIVER_IDS} rows")
    return found


def load_json(spark: SparkSession, path: str):
    text = _read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return json.loads(text)


def load_concept_set(spark: SparkSession, path: str) -> list[int]:
    """Ids from a JSON list, or from the ``concepts`` or ``concept_ids`` entry of an object."""
    data = load_json(spark, path)
    if isinstance(data, list):
        return data
    for key in ("concepts", "concept_ids"):
        if isinstance(data, dict) and key in data:
            return data[key]
    raise ValueError(f"Unknown concept file format: {path}")


def read_concept_csv(spark: SparkSession, path: str) -> DataFrame:
    """The ``concept_id`` column (any case) of a CSV file; unreadable ids are dropped."""
    ids = spark.read.options(**csv_options(detect_delimiter(spark, path))).csv(path)
    return ids.select(F.col("concept_id").try_cast("bigint").alias("concept_id")).filter("concept_id IS NOT NULL")


def load_drug_specs(spark: SparkSession, drugs: Sequence[str], folders: Iterable[str]) -> dict[str, ConceptSpec]:
    """One spec per drug from ``{drug}_concepts.csv`` or ``.json``.

    Folders are searched in order, CSV before JSON in each. Ids from CSV are already expanded.
    A drug without a file gets an empty set and a warning.
    """
    folders = [f.rstrip("/") for f in folders]
    specs: dict[str, ConceptSpec] = {}
    for drug in drugs:
        spec = None
        for folder in folders:
            if _exists(spark, f"{folder}/{drug}_concepts.csv"):
                rows = _bounded(read_concept_csv(spark, f"{folder}/{drug}_concepts.csv"), f"{drug}_concepts.csv")
                if rows:
                    spec = ConceptSpec(tuple(r.concept_id for r in rows), include_descendants=False)
            if spec is None and _exists(spark, f"{folder}/{drug}_concepts.json"):
                spec = ConceptSpec.of(load_json(spark, f"{folder}/{drug}_concepts.json"), include_self=False)
            if spec is not None:
                break
        if spec is None:
            logger.warning("No concept file found for %s", drug)
        specs[drug] = spec or ConceptSpec((), include_descendants=False)
    return specs


def parse_id_list(cell: str | None) -> list[int]:
    """Ids of a comma list; blanks and unreadable parts are skipped."""
    parts = (p.strip() for p in (cell or "").split(","))
    return [int(p.removesuffix(".0")) for p in parts if re.fullmatch(r"[+-]?[0-9]+(\.0)?", p)]


def exploded_ids(df: DataFrame, name: str = "name", ids: str = "concept_ids") -> DataFrame:
    """``(feature, concept_id)`` rows of a frame with a comma list per feature."""
    part = F.explode(F.split(F.regexp_replace(F.col(ids).cast("string"), r"\s", ""), ","))
    return (
        df.select(F.col(name).alias("feature"), part.alias("part"))
        .select("feature", F.regexp_replace("part", r"\.0$", "").try_cast("bigint").alias("concept_id"))
        .filter("concept_id IS NOT NULL")
    )


def load_feature_csv(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Feature name -> ids from a ``Name,concept_ids,description`` file, in file order."""
    rows = _bounded(spark.read.options(**csv_options(detect_delimiter(spark, path))).csv(path).select("name", "concept_ids"), path)
    return {r[0]: parse_id_list(r[1]) for r in rows}


def load_lab_json(spark: SparkSession, path: str) -> dict[str, list[int]]:
    return {name: [int(i) for i in ids] for name, ids in load_json(spark, path).items()}
