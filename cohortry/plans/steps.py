"""The steps of a study, each a frame built from the one before."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import age_truncated
from ..operators import balance, cohort, covariates, eligibility, exposure, matching, propensity, survival, windowed
from ..operators.concepts import ConceptSets
from ..operators.events import condition_events, first_deaths, observation_spans
from ..scale import scratch, stage
from ..sources.concept_files import ConceptSpec, load_drug_specs, load_feature_csv, load_lab_json
from ..sources.csv_tables import read_csv_table, resolve_path
from ..sources.membership import Membership
from ..sources.results import write_results
from ..sources.sinks import write_matching, write_table
from ..sources.tables import ClinicalTables
from .study import EVIDENCE, Study

INCLUDE_SET, EXCLUDE_SET = "baseline_include", "baseline_exclude"


def open_tables(spark: SparkSession, study: Study, **reading) -> ClinicalTables:
    """The study's CSV export: the files its table map names, else those found in its folder."""
    return ClinicalTables.from_csv(spark, study.source_dir, study.tables or None, **reading)


def load_concept_files(spark: SparkSession, study: Study) -> Study:
    """The study with drug sets and feature dictionaries read from its concept folders."""
    if not study.concept_dirs:
        return study
    folder = study.concept_dirs[0].rstrip("/")
    return study.with_changes(
        drugs=load_drug_specs(spark, study.drug_names, study.concept_dirs),
        condition_features=load_feature_csv(spark, f"{folder}/comorbidities.csv"),
        drug_features=load_feature_csv(spark, f"{folder}/medications.csv"),
        labs=load_lab_json(spark, f"{folder}/labs.json"),
    )


def resolve_sets(tables: ClinicalTables, study: Study) -> ConceptSets:
    """Every concept set of the study, expanded in one pass over the hierarchy."""
    specs: dict[str, ConceptSpec] = {
        cohort.CONDITION_SET: study.conditions,
        cohort.MEASUREMENT_SET: study.measurements,
    }
    if study.rules == EVIDENCE:
        specs[cohort.COMORBIDITY_SET] = study.comorbidities
        specs[exposure.EXPOSURE_SET] = study.exposure
    elif study.specific is not None:
        specs[windowed.SPECIFIC_SET] = study.specific
    for name, spec in ((INCLUDE_SET, study.baseline_include), (EXCLUDE_SET, study.baseline_exclude)):
        if spec is not None:
            specs[name] = spec
    specs.update(study.drugs)
    expands = any(s.include_descendants and s.ids for s in specs.values())
    hierarchy = tables["concept_ancestor"] if expands else None
    if not expands:
        return ConceptSets.of_lists(tables.spark, {n: s.ids for n, s in specs.items()})
    return ConceptSets.resolve(tables.spark, hierarchy, specs)


def study_cohort(tables: ClinicalTables, sets: ConceptSets, study: Study) -> DataFrame:
    if study.rules == EVIDENCE:
        return cohort.build_cohort(
            tables, sets, study.study_start, study.study_end, study.min_index_date,
            study.min_age_at_entry, study.bmi_low, study.bmi_high, study.max_persons, merge_gap_days=study.merge_gap_days,
        )
    return windowed.build_windowed_cohort(
        tables, sets, study.study_start, study.study_end, study.min_age_at_entry, study.bmi_low, study.bmi_high,
        specific=study.specific is not None, require_specific=study.require_specific,
    )


def study_arms(tables: ClinicalTables, sets: ConceptSets, study: Study, members: DataFrame) -> DataFrame:
    """The cohort with ``user_flag`` and exposure columns."""
    if study.rules == EVIDENCE:
        events = exposure.exposure_events(tables, sets, *study.exposure_window)
        return exposure.label_arms(
            exposure.typed_cohort(members, study.max_persons), exposure.first_exposure(events),
            observation_spans(tables, study.merge_gap_days), study.min_days, study.max_days,
            exposure.ever_exposed(tables, sets) if study.exclude_ever_exposed else None,
        )
    labelled = exposure.labelled_exposures(tables, sets, list(study.drugs), study.study_start, study.study_end)
    return exposure.windowed_arms(members, labelled, Membership.of(members, "obesity_entry_date"))


def index_rules(study: Study, arms: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Arms with their ``index_date`` and age then, and the eligibility predicates on them.

    The evidence rules have tested age and prior visits already. The windowed rules test the age at entry, or with
    ``true_age_at_index`` the completed years at the index date.
    """
    if study.rules == EVIDENCE:
        return covariates.with_index_date(arms), {}
    indexed = covariates.with_index_date(arms, entry="obesity_entry_date")
    age = age_truncated("birth_date", "index_date") if study.true_age_at_index else F.col("age_at_obesity_entry")
    aged = indexed.withColumn("age_at_index", age)
    return aged, eligibility.eligibility_rules("age_at_index", study.min_age_at_index, study.require_visit)


def eligible_arms(
    tables: ClinicalTables, study: Study, arms: DataFrame, sets: ConceptSets | None = None
) -> DataFrame:
    """Arms after the eligibility rules, with their ``index_date``.

    Baseline conditions, which need the study's ``sets``, and follow-up are tested under both rule sets.
    """
    indexed, rules = index_rules(study, arms)
    kept = eligibility.apply_rules(indexed, rules)
    for name, spec, exclude in ((INCLUDE_SET, study.baseline_include, False), (EXCLUDE_SET, study.baseline_exclude, True)):
        if spec is not None:
            found = sets.restrict(condition_events(tables), name)
            kept = eligibility.by_baseline_condition(kept, found, "index_date", exclude)
    if study.min_followup_days:
        kept = eligibility.with_follow_up(kept, observation_spans(tables, study.merge_gap_days), "index_date", study.min_followup_days)
    return kept


def study_covariates(tables: ClinicalTables, study: Study, arms: DataFrame) -> DataFrame:
    """Covariates of ``arms``, which should be staged: their index dates are gathered first, and travel to the fact scans if they fit."""
    return covariates.extract_covariates(
        tables, arms, study.condition_features, study.drug_features, study.labs, study.lookback_months, members=Membership.of(arms, "index_date")
    )


def score_arms(frame: DataFrame, study: Study) -> tuple[DataFrame, list[str]]:
    """Staged scores of both arms, and the features used."""
    combined = frame.withColumn(propensity.TREATMENT, F.col("user_flag"))
    wanted = propensity.available(combined, study.matching_features)
    numbers = stage(propensity.to_numeric(combined, wanted))
    filled, used = propensity.impute(numbers, wanted)
    scaled = propensity.scale(filled, used)
    columns = [f"z_{f}" for f in used]
    model = propensity.fit_model(scaled, columns)
    return stage(propensity.add_scores(scaled, model).drop(*columns)), used


def study_survival(
    tables: ClinicalTables, study: Study, people: DataFrame, by: tuple[str, ...] = (), competing_death: bool = False
) -> DataFrame:
    """Survival data of people who have ``treatment`` and ``index_date``."""
    return survival.survival_data(
        people.select("person_id", propensity.TREATMENT, *by, "index_date"),
        condition_events(tables), study.outcomes, observation_spans(tables, study.merge_gap_days), first_deaths(tables),
        study.study_end, study.max_followup_years, competing_death,
    )


@dataclass
class StudyResult:
    """Frames of a finished study. Those from the scores on are None without any matching feature, outcome frames without outcomes."""

    cohort: DataFrame
    arms: DataFrame
    eligible: DataFrame
    covariates: DataFrame
    attrition: DataFrame
    scored: DataFrame | None = None
    pairs: DataFrame | None = None
    matched: DataFrame | None = None
    balance: DataFrame | None = None
    before_after: DataFrame | None = None
    match_rate: DataFrame | None = None
    score_ranges: DataFrame | None = None
    cox: DataFrame | None = None
    cox_subgroups: DataFrame | None = None
    kaplan_meier: DataFrame | None = None
    incidence: DataFrame | None = None
    features: list[str] = field(default_factory=list)

    def arm_frames(self) -> Mapping[str, DataFrame]:
        out = {"obesity_cohort": self.cohort}
        for suffix, df in (("", self.arms), ("_eligible", self.eligible), ("_with_covariates", self.covariates)):
            out[f"users{suffix}"] = df.filter("user_flag = 1")
            out[f"nonusers{suffix}"] = df.filter("user_flag = 0")
        return out

    def reports(self) -> Mapping[str, DataFrame]:
        """Small result tables by name, those that were computed."""
        names = ("attrition", "before_after", "match_rate", "score_ranges", "cox", "cox_subgroups", "kaplan_meier", "incidence")
        return {n: getattr(self, n) for n in names if getattr(self, n) is not None}


def study_members(tables: ClinicalTables, sets: ConceptSets, study: Study) -> DataFrame:
    """The cohort, built, or read back from the CSV that the study names."""
    if study.cohort_input is None:
        return study_cohort(tables, sets, study)
    kinds = {k: "bigint" for k in ("person_id", "gender_concept_id", "race_concept_id", "ethnicity_concept_id")}
    kinds |= {"index_date": "date", "birth_date": "date", "death_date": "date", "age_at_index": "int"}
    path = resolve_path(study.source_dir or "", study.cohort_input)
    return read_csv_table(tables.spark, path, types=kinds, multi_line=True)


def study_attrition(study: Study, members: DataFrame, arms: DataFrame, eligible: DataFrame) -> DataFrame:
    """Persons left after each step, as ``(user_flag, step, n)``; the cohort has no arm yet."""
    indexed, rules = index_rules(study, arms)
    by_rule = eligibility.rule_attrition(indexed, rules)
    last = eligible.groupBy("user_flag").agg(F.count(F.lit(1)).alias("n")).select("user_flag", F.lit("eligible").alias("step"), "n")
    first = members.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("int").alias("user_flag"), F.lit("cohort").alias("step"), "n")
    return first.unionByName(by_rule).unionByName(last)


def run_study(tables: ClinicalTables, study: Study) -> StudyResult:
    """Cohort, arms, eligibility, covariates, scores, pairs, balance, hazard ratios and curves.

    Steps that feed several later ones are staged to shared storage, so each source table is read
    once per step and a lost executor costs at most one step. Without any available matching feature
    the study ends with its covariates.
    """
    sets = resolve_sets(tables, study)
    members = stage(study_members(tables, sets, study))
    theirs = tables.of_members(members)
    arms = stage(study_arms(theirs, sets, study, members))
    eligible = stage(eligible_arms(theirs, study, arms, sets))
    features = stage(study_covariates(theirs, study, eligible))
    result = StudyResult(members, arms, eligible, features, study_attrition(study, members, arms, features))
    if not propensity.available(features, study.matching_features):
        return result
    scored, used = score_arms(features, study)
    pairs = stage(matching.match_pairs(scored, matching.caliper_width(scored, study.caliper_multiplier)))
    matched = stage(matching.matched_people(scored, pairs))
    result.scored, result.pairs, result.matched, result.features = scored, pairs, matched, used
    result.balance = balance.standardized_differences(matched, used).orderBy(F.desc("smd"), "feature")
    result.before_after = balance.before_and_after(scored, matched, used)
    result.match_rate = matching.match_rate(scored, pairs)
    result.score_ranges = propensity.score_ranges(scored)
    if study.outcomes:
        by = tuple(s for s in study.subgroups if s in matched.columns)
        observed = tables.of_members(matched)
        # The competing event is a kind of censoring to all but the incidence.
        outcomes = stage(study_survival(observed, study, matched, by, competing_death=True))
        result.cox = survival.cox_model(outcomes)
        result.kaplan_meier = survival.kaplan_meier(outcomes)
        result.incidence = survival.cumulative_incidence(outcomes)
        if by:
            result.cox_subgroups = survival.cox_model(outcomes, by)
    return result


def write_study(result: StudyResult, study: Study, fmt: str = "parquet") -> dict[str, str]:
    """Every result of the study below its output folder, arms also where the study's outputs name them; returns name -> path."""
    base = study.output_dir.rstrip("/")
    frames = result.arm_frames()
    written = {
        name: write_table(df, f"{base}/cohorts/{study.cohort_name}_{name}.{fmt}", fmt)
        for name, df in frames.items()
    }
    named = {"cohort": frames["obesity_cohort"], "user": frames["users"], "nonuser": frames["nonusers"]}
    for name, path in study.outputs.items():
        if name in named:
            written[f"{name}_csv"] = write_table(named[name], resolve_path(base, path), "csv")
    if result.pairs is not None:
        written |= write_matching(
            f"{base}/matched_pairs", study.cohort_name, result.matched, result.pairs, result.balance, fmt
        )
    for name, df in result.reports().items():
        written[name] = write_table(df, f"{base}/analysis_results/{study.cohort_name}_{name}.{fmt}", fmt)
    return written


def commit_study(result: StudyResult, study: Study, fmt: str = "parquet") -> str:
    """All frames of a study as one set that is in force only when whole; ``read_results(spark, output_dir, cohort_name)`` reads it."""
    frames = {**result.arm_frames(), **result.reports()}
    if result.pairs is not None:
        frames |= {"match_pairs": result.pairs, "matched": result.matched, "balance_stats": result.balance}
    return write_results(frames, study.output_dir, study.cohort_name, fmt)


def run_and_write(tables: ClinicalTables, study: Study, fmt: str = "parquet") -> dict[str, str]:
    """A whole study to files; what it staged on the way is removed."""
    with scratch(tables.spark):
        return write_study(run_study(tables, study), study, fmt)
