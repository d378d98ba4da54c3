"""Study configuration: one validated object for both rule sets, read from JSON."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import SparkSession

from ..operators.matching import CALIPER
from ..sources.concept_files import ConceptSpec, load_json

EVIDENCE, WINDOWED = "evidence", "windowed"

# Defaults of a study that leaves them out.
STUDY_START, STUDY_END = "2012-01-01", "2024-01-31"
MIN_INDEX_DATE = "2014-01-01"
MIN_AGE = 18
BMI_LOW, BMI_HIGH = 27.0, 30.0
MIN_DAYS, MAX_DAYS = 0, 730


@dataclass(frozen=True)
class Study:
    """All parameters of a study; see the README for the JSON keys."""

    rules: str = EVIDENCE
    cohort_name: str = "cohort"
    source_dir: str | None = None
    output_dir: str = "output"
    tables: Mapping[str, str] = field(default_factory=dict)
    study_start: str = STUDY_START
    study_end: str = STUDY_END
    min_index_date: str = MIN_INDEX_DATE
    min_age_at_entry: int = MIN_AGE
    min_age_at_index: int = MIN_AGE
    bmi_low: float = BMI_LOW
    bmi_high: float = BMI_HIGH
    conditions: ConceptSpec = ConceptSpec()
    measurements: ConceptSpec = ConceptSpec()
    comorbidities: ConceptSpec = ConceptSpec()
    specific: ConceptSpec | None = None
    require_specific: bool = False
    exposure: ConceptSpec = ConceptSpec()
    exposure_start: str | None = None
    exposure_end: str | None = None
    min_days: int = MIN_DAYS
    max_days: int = MAX_DAYS
    exclude_ever_exposed: bool = False
    drugs: Mapping[str, ConceptSpec] = field(default_factory=dict)
    drug_names: tuple[str, ...] = ()
    concept_dirs: tuple[str, ...] = ()
    condition_features: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    drug_features: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    labs: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    lookback_months: int | None = None
    require_visit: bool = True
    true_age_at_index: bool = False
    baseline_include: ConceptSpec | None = None
    baseline_exclude: ConceptSpec | None = None
    subgroups: tuple[str, ...] = ()
    cohort_input: str | None = None
    outputs: Mapping[str, str] = field(default_factory=dict)
    min_followup_days: int = 0
    merge_gap_days: int | None = None
    matching_features: tuple[str, ...] = ()
    caliper_multiplier: float = CALIPER
    outcomes: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    max_followup_years: int | None = None
    max_persons: int | None = None

    def __post_init__(self):
        if self.rules not in (EVIDENCE, WINDOWED):
            raise ValueError(f"Unknown rules: {self.rules}")
        for name in ("study_start", "study_end", "min_index_date", "exposure_start", "exposure_end"):
            value = getattr(self, name)
            if value is not None:
                date.fromisoformat(value)
        if self.study_start > self.study_end:
            raise ValueError("study_start is after study_end")
        if not 0 <= self.bmi_low <= self.bmi_high:
            raise ValueError("BMI thresholds must satisfy 0 <= low <= high")
        if self.caliper_multiplier <= 0:
            raise ValueError("caliper_multiplier must be positive")
        if self.merge_gap_days is not None and self.merge_gap_days < 0:
            raise ValueError("merge_gap_days must not be negative")
        if self.min_days > self.max_days:
            raise ValueError("min_days is above max_days")

    @property
    def exposure_window(self) -> tuple[str, str]:
        return self.exposure_start or self.study_start, self.exposure_end or self.study_end

    def with_changes(self, **changes) -> Study:
        return replace(self, **changes)


def _ending(config: Mapping, suffix: str, default=None):
    """Value of ``suffix`` or of the key ``<study>_<suffix>``; studies prefix keys with their subject."""
    if suffix in config:
        return config[suffix]
    matches = [k for k in config if k.endswith(f"_{suffix}")]
    return config[matches[0]] if matches else default


def _days(config: Mapping, side: str, default: int) -> int:
    for key, value in config.items():
        if re.fullmatch(rf"{side}_days(_from_.*index)?", key):
            return int(value)
    return default


def _outcomes(entries) -> dict[str, tuple[int, ...]]:
    return {o["name"]: tuple(int(i) for i in o.get("concept_ids", [])) for o in entries or []}


def _features(entries) -> dict[str, tuple[int, ...]]:
    return {name: tuple(int(i) for i in ids) for name, ids in (entries or {}).items()}


def _baseline(config: Mapping) -> dict[str, ConceptSpec]:
    """Conditions that must, or must not, occur on or before the index date."""
    rules = config.get("baseline_conditions", {})
    return {f"baseline_{k}": ConceptSpec.of(rules[k]) for k in ("include", "exclude") if rules.get(k)}


def _from_nested(config: Mapping) -> Study:
    sets = config.get("concept_sets", {})
    study, exposure, output = (config.get(k, {}) for k in ("study", "exposure", "output"))
    features, matching, follow_up = (config.get(k, {}) for k in ("features", "matching", "follow_up"))
    cap = config.get("debug", {}).get("max_persons")
    return Study(
        rules=EVIDENCE,
        cohort_name=study.get("name", "cohort"),
        output_dir=output.get("dir", "output"),
        outputs={k.removesuffix("_csv"): v for k, v in output.items() if k.endswith("_csv")},
        cohort_input=_ending(config.get("input", {}), "cohort"),
        condition_features=_features(features.get("conditions")),
        drug_features=_features(features.get("drugs")),
        labs=_features(features.get("labs")),
        lookback_months=features.get("lookback_months"),
        matching_features=tuple(matching.get("features", ())),
        caliper_multiplier=float(matching.get("caliper_multiplier", CALIPER)),
        outcomes=_outcomes(config.get("outcomes")),
        subgroups=tuple(config.get("subgroups", ())),
        min_followup_days=int(follow_up.get("min_days") or 0),
        max_followup_years=follow_up.get("max_years"),
        merge_gap_days=follow_up.get("merge_gap_days"),
        exclude_ever_exposed=bool(exposure.get("exclude_ever_exposed", False)),
        **_baseline(config),
        source_dir=config.get("cdm_path"),
        tables=dict(config.get("tables", {})),
        study_start=study.get("start_date", STUDY_START),
        study_end=study.get("end_date", STUDY_END),
        min_index_date=_ending(study, "min_index_date", MIN_INDEX_DATE),
        min_age_at_entry=int(study.get("min_age", MIN_AGE)),
        conditions=ConceptSpec.of(_ending(sets, "conditions", [])),
        measurements=ConceptSpec.of(_ending(sets, "measurements", [])),
        comorbidities=ConceptSpec.of(_ending(sets, "comorbidities", [])),
        exposure=ConceptSpec.of(_ending(sets, "ingredients", [])),
        exposure_start=exposure.get("min_date"),
        exposure_end=exposure.get("max_date"),
        min_days=_days(exposure, "min", MIN_DAYS),
        max_days=_days(exposure, "max", MAX_DAYS),
        max_persons=int(cap) if cap else None,
    )


def _from_flat(config: Mapping) -> Study:
    method, ratio = config.get("matching_method", "nearest_neighbor"), config.get("matching_ratio", "1:1")
    if (method, ratio) != ("nearest_neighbor", "1:1"):
        raise ValueError(f"Only 1:1 nearest_neighbor matching is supported, not {ratio} {method}")
    specific = config.get("specific_condition_concepts")
    # These expansions keep an id only if the hierarchy has a row from it to itself.
    expanded = {
        name: ConceptSpec.of(_ending(config, key, []), include_self=False)
        for name, key in (("conditions", "diagnosis_concepts"), ("measurements", "measurement_concepts"))
    }
    folders = [config.get("concept_sets_dir"), _ending(config, "concepts_dir")]
    return Study(
        rules=WINDOWED,
        cohort_name=config.get("cohort_name", "cohort"),
        source_dir=_ending(config, "data_dir"),
        output_dir=config.get("output_dir", "output"),
        study_start=config.get("study_start_date", STUDY_START),
        study_end=config.get("study_end_date", STUDY_END),
        min_age_at_entry=int(config.get("min_age_at_entry") or 0),
        min_age_at_index=int(config.get("min_age_at_index") or 0),
        bmi_low=float(config.get("bmi_threshold_low", BMI_LOW)),
        bmi_high=float(config.get("bmi_threshold_high", BMI_HIGH)),
        **expanded,
        specific=ConceptSpec.of(specific, include_self=False) if specific else None,
        require_specific=bool(config.get("require_specific_condition", False)),
        drug_names=tuple(_ending(config, "drugs", ())),
        concept_dirs=tuple(f for f in folders if f),
        require_visit=bool(config.get("require_baseline_encounter", True)),
        min_followup_days=int(config.get("min_followup_days") or 0),
        matching_features=tuple(config.get("matching_features", ())),
        caliper_multiplier=float(config.get("caliper_multiplier", CALIPER)),
        outcomes=_outcomes(config.get("outcomes")),
        true_age_at_index=bool(config.get("true_age_at_index", False)),
        lookback_months=config.get("lookback_months"),
        max_followup_years=config.get("max_followup_years"),
        merge_gap_days=config.get("merge_gap_days"),
        subgroups=tuple(config.get("subgroups", ())),
        **_baseline(config),
    )


def study_from_dict(config: Mapping) -> Study:
    """A study from either JSON layout: sections (evidence rules) or flat keys (windowed rules)."""
    nested = any(isinstance(config.get(k), Mapping) for k in ("concept_sets", "study", "exposure"))
    return _from_nested(config) if nested else _from_flat(config)


def load_study(spark: SparkSession, path: str) -> Study:
    return study_from_dict(load_json(spark, path))
