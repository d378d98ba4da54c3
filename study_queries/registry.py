"""One registered query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortry.functions import columns as C
from cohortry.functions import summaries as S
from cohortry.operators import balance, cohort, concepts, covariates, drug_table, eligibility, events, exposure
from cohortry.operators import matching, propensity, survival, windowed
from cohortry.plans import steps
from cohortry.scale import stage, staging_root
from cohortry.sources import concept_files, csv_tables
from cohortry.sources.buckets import open_buckets, write_buckets
from cohortry.sources.membership import Membership
from cohortry.sources.results import read_results, write_results
from cohortry.sources.concept_files import ConceptSpec, exploded_ids
from cohortry.sources.sinks import read_back, save_with_suffix, write_csv, write_matching
from cohortry.sources.tables import ClinicalTables

from .study_setup import DRUGS, STUDY, WINDOWED_STUDY
from .views import clinical_tables

START, END = STUDY.study_start, STUDY.study_end
FEATURES = list(STUDY.matching_features)
DRUG_NAMES = list(DRUGS)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


class Context:
    """Frames several queries build on; each is planned once per query run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.tables = clinical_tables(spark, folder)

    @cached_property
    def sets(self):
        return steps.resolve_sets(self.tables, STUDY)

    @cached_property
    def windowed_sets(self):
        return steps.resolve_sets(self.tables, WINDOWED_STUDY)

    @cached_property
    def conditions(self):
        return events.condition_events(self.tables)

    @cached_property
    def readings(self):
        return cohort.measurement_values(self.tables, self.sets)

    @cached_property
    def index(self):
        return cohort.index_from_dates(cohort.evidence_dates(self.tables, self.sets, STUDY.bmi_low, STUDY.bmi_high))

    @cached_property
    def cohort(self):
        return steps.study_cohort(self.tables, self.sets, STUDY)

    @cached_property
    def base(self):
        """The cohort as both arms read it, staged, so that no task holds the sorts of its joins beside those of the arms."""
        return exposure.typed_cohort(stage(self.cohort))

    @cached_property
    def spans(self):
        return events.observation_spans(self.tables)

    @cached_property
    def first_use(self):
        return exposure.first_exposure(exposure.exposure_events(self.tables, self.sets, START, END))

    @cached_property
    def candidates(self):
        """Staged, since one arm joins them and the other leaves them out."""
        return stage(exposure.exposure_candidates(self.base, self.first_use, self.spans))

    @cached_property
    def arms(self):
        return exposure.label_arms(self.base, self.first_use, self.spans)

    @cached_property
    def indexed(self):
        return stage(covariates.with_index_date(self.arms))

    @cached_property
    def members(self):
        """Members of both arms with their index dates, as bits."""
        return Membership.of(self.indexed, "index_date")

    @cached_property
    def covariates(self):
        return steps.study_covariates(self.tables, STUDY, self.indexed)

    @cached_property
    def encoded(self):
        """Numeric features of both arms, staged before and after labels are encoded, since imputing and scaling read them again and again."""
        combined = self.covariates.select(
            "person_id", F.col("user_flag").alias("treatment"), "index_date", "race_concept_id", *FEATURES
        )
        return stage(propensity.to_numeric(stage(combined), FEATURES))

    @cached_property
    def imputed(self):
        return propensity.impute(self.encoded, FEATURES)

    @cached_property
    def scored(self):
        """A fixed linear score, so that matching can be checked exactly."""
        total = -1.5 + 0.02 * F.col("age_at_index") + 0.3 * F.col("sex") + 0.5 * F.col("c_b") + -0.4 * F.col("m_b")
        return stage(self.imputed[0].withColumn("logit_ps", F.round(total + 0.01 * F.col("lab_a"), 6)))

    @cached_property
    def pairs(self):
        return stage(matching.match_pairs(self.scored))

    @cached_property
    def matched(self):
        return matching.matched_people(self.scored, self.pairs)

    def survival(self, competing: bool = False, by: tuple[str, ...] = ()):
        people = self.scored.withColumn("stratum", F.when(F.col("sex") == 1, "M").otherwise("F"))
        return steps.study_survival(self.tables, STUDY, people, by, competing)

    @cached_property
    def windowed_evidence(self):
        return windowed.windowed_evidence(self.tables, self.windowed_sets, START, END)

    @cached_property
    def windowed_cohort(self):
        return steps.study_cohort(self.tables, self.windowed_sets, WINDOWED_STUDY).drop(
            "year_of_birth", "month_of_birth", "day_of_birth", "birth_datetime", "ethnicity_concept_id"
        )

    @cached_property
    def windowed_arms(self):
        return steps.study_arms(self.tables, self.windowed_sets, WINDOWED_STUDY, self.windowed_cohort)

    @cached_property
    def eligible(self):
        return eligibility.apply_rules(self.windowed_arms, eligibility.eligibility_rules(min_age=30))

    @cached_property
    def wide(self):
        return drug_table.drug_table(self.tables, self.sets, DRUG_NAMES, START, END)

    @cached_property
    def deceased(self):
        """Persons with a death record, as an id frame."""
        return self.tables["death"].select("person_id")


QUERIES: dict[str, Callable[[Context], DataFrame]] = {}


def query(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    """Register a query under its function name; a trailing underscore avoids shadowing a module."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Context(spark, folder))


# Concept sets


@query
def concept_expand(c):
    return concepts.expand_named(c.spark, c.tables["concept_ancestor"], _specs())


@query
def concept_expand_no_self(c):
    return concepts.expand(c.spark, c.tables["concept_ancestor"], [100, 7, 115], include_self=False)


@query
def concept_unexpanded(c):
    used = c.tables["drug_exposure"].select("drug_concept_id")
    return concepts.ids_frame(c.spark, used)


@query
def concept_names(c):
    used = c.tables["condition_occurrence"].select("condition_concept_id")
    return concepts.concept_names(c.spark, c.tables["concept"], used)


@query
def concept_vocab(c):
    used = c.tables["drug_exposure"].select("drug_concept_id")
    return concepts.of_vocabulary(c.spark, c.tables["concept"], used, "Brand#11")


@query
def concept_standard(c):
    used = c.tables["drug_exposure"].select("drug_concept_id")
    return concepts.standard_only(c.spark, c.tables["concept"], used)


def _specs():
    return {
        "conditions": STUDY.conditions, "measurements": STUDY.measurements, "comorbidities": STUDY.comorbidities,
        "exposure": STUDY.exposure, **DRUGS,
    }


@query
def concept_details(c):
    return concepts.set_details(c.tables["concept"], c.sets.rows, _specs())


@query
def concept_summary(c):
    return concepts.set_summary(concept_expand(c), _specs())


@query
def drug_concepts(c):
    return concepts.expand_named(c.spark, c.tables["concept_ancestor"], DRUGS).select("concept_id").distinct()


@query
def id_lists(c):
    lists = c.tables["concept_ancestor"].groupBy(F.col("ancestor_concept_id").cast("string").alias("name")).agg(
        F.array_join(F.sort_array(F.collect_list("descendant_concept_id")), ", ").alias("concept_ids")
    )
    return exploded_ids(lists)


# Filtered table access


@query
def acc_person(c):
    people = c.tables.persons(c.deceased, min_birth_year=1940, max_birth_year=1980)
    return people.select("person_id", "year_of_birth", "gender_concept_id")


@query
def acc_obs(c):
    return c.tables.observation_periods(start="1995-02-01", end="2001-06-30")


@query
def acc_condition(c):
    kept = c.tables.conditions(c.deceased, c.sets.frame("conditions").select("concept_id"), START, END)
    return kept.select("condition_occurrence_id", "person_id", "condition_concept_id", "condition_start_date")


@query
def acc_members(c):
    """Measurements of the cohort's members, tested against their bits in the scan."""
    kept = c.tables.measurements(Membership.of(c.indexed), [0, 3], START, END)
    return kept.select("measurement_id", "person_id", "measurement_concept_id", "measurement_date")


@query
def member_days(c):
    """Conditions of members, with the index date that travels to the scan."""
    dated = c.members.dated(events.condition_events(c.tables, date_only=True))
    before = dated.filter(F.col("event_date") <= F.col("member_day"))
    return before.groupBy("person_id", F.col("member_day").alias("index_date")).agg(F.count(F.lit(1)).alias("n"))


@query
def acc_drug(c):
    kept = c.tables.drug_exposures(c.deceased, [50, 60, 61], start="1995-01-01")
    return kept.select("drug_exposure_id", "person_id", "drug_concept_id", "drug_exposure_start_date")


@query
def acc_measurement(c):
    return c.tables.measurements(concept_ids=[0, 3], start=START, end=END).drop("measurement_datetime")


@query
def acc_procedure(c):
    return c.tables.procedures(c.deceased, [1, 2, 3], end=END)


@query
def acc_visit(c):
    kept = c.tables.visits(concept_ids=[9201, 9202], start="1996-01-01", end="2000-12-31")
    return kept.select("visit_occurrence_id", "person_id", "visit_concept_id", "visit_start_date")


@query
def acc_empty_set(c):
    """Rows by filter: none keeps all, an empty list or frame nothing."""
    nobody = c.tables["person"].filter("person_id < 0").select("person_id")
    kept = {
        "no filter": c.tables.conditions(), "empty list": c.tables.conditions(concept_ids=[]), "empty frame": c.tables.conditions(nobody)
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("case"), "n") for name, df in kept.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def date_range(c):
    return S.filter_date_range(c.tables["death"], "death_date", START, END)


@query
def sql_query(c):
    return c.tables.query("SELECT visit_concept_id, COUNT(*) AS n FROM visit_occurrence GROUP BY visit_concept_id")


# CSV tables


def _csv_folder(c) -> str:
    return f"{staging_root(c.spark).rstrip('/')}/cohortry/csv-{uuid4().hex}"


@query
def csv_person(c):
    folder = _csv_folder(c)
    upper = c.tables["person"]
    write_csv(upper.toDF(*[n.upper() for n in upper.columns]), f"{folder}/export_person.csv")
    people = ClinicalTables.from_csv(c.spark, folder, {"person": "export_person.csv"})["person"]
    return people.select(
        "person_id", "year_of_birth", "month_of_birth", "gender_concept_id", F.col("birth_datetime").cast("date").alias("born")
    )


@query
def csv_measurement(c):
    folder = _csv_folder(c)
    readings = c.tables["measurement"]
    for part in (0, 1):
        write_csv(readings.filter(F.col("measurement_id") % 2 == part), f"{folder}/x_measurement_half{part}.csv")
    found = ClinicalTables.from_csv(c.spark, folder, {"measurement": "*measurement*.csv"})
    return found["measurement"].drop("measurement_datetime")


@query
def csv_arms(c):
    """Arms written as CSV and read back with their types."""
    path = write_csv(c.arms, f"{_csv_folder(c)}/arms")
    return read_back(c.spark, path, c.arms.schema)


@query
def csv_quoted(c):
    """Texts with line ends, delimiters and quotes, written and read back."""
    docs = c.spark.read.parquet(f"{c.folder}/documents.parquet")
    quoted = docs.select("doc_id", F.replace("text", F.lit("e "), F.lit('e", "')).alias("text"))
    path = write_csv(quoted, f"{_csv_folder(c)}/quoted.csv")
    return csv_tables.read_csv_table(c.spark, path, types={"doc_id": "bigint"})


@query
def bucketed_cohort(c):
    """The cohort over tables that were dealt to buckets by person."""
    folder = _csv_folder(c)
    names = ("person", "concept", "concept_ancestor", "condition_occurrence", "measurement", "observation_period", "visit_occurrence", "death")
    write_buckets(c.spark, {n: c.tables[n] for n in names}, folder, 8, f"b{uuid4().hex[:8]}")
    tables = ClinicalTables(c.spark, open_buckets(c.spark, folder, f"b{uuid4().hex[:8]}"))
    return steps.study_cohort(tables, steps.resolve_sets(tables, STUDY), STUDY)


@query
def written_results(c):
    """The content of a set of results that was written whole and checked when read."""
    folder = _csv_folder(c)
    write_results({"match_pairs": c.pairs, "arms": c.arms}, folder, "trial", "csv")
    return rounded(read_results(c.spark, folder, "trial")["match_pairs"], "ps_distance")


@query
def csv_delimited(c):
    """A vocabulary export with tabs; the reader finds the delimiter."""
    path = write_csv(c.tables["concept"], f"{_csv_folder(c)}/concept.csv", delimiter="\t")
    return csv_tables.read_csv_table(c.spark, path, "concept").select("concept_id", "concept_name", "domain_id", "standard_concept")


@query
def csv_dates(c):
    compact = c.tables["death"].select("person_id", F.date_format("death_date", "yyyyMMdd").alias("death_date"))
    path = write_csv(compact, f"{_csv_folder(c)}/death.csv")
    return csv_tables.read_csv_table(c.spark, path, "death").select("person_id", "death_date")


@query
def csv_dropped(c):
    """Lines left out by reason, of an export with unreadable dates and ids."""
    spoiled = c.tables["visit_occurrence"].select(
        F.when(F.col("visit_occurrence_id") % 5 == 0, "x").otherwise(F.col("visit_occurrence_id").cast("string")).alias("visit_occurrence_id"),
        "person_id",
        F.when(F.col("visit_occurrence_id") % 3 == 0, "31.31.2000").otherwise(F.col("visit_start_date").cast("string")).alias("visit_start_date"),
    )
    path = write_csv(spoiled, f"{_csv_folder(c)}/visit_occurrence.csv")
    return csv_tables.dropped_lines(c.spark, path, "visit_occurrence").groupBy("reason").agg(F.sum("n").alias("n"))


# Concept files


def _concept_folder(c) -> str:
    """Concept files made from the vocabulary: a CSV list, JSON with expansion, features and labs."""
    folder = _csv_folder(c)
    known = c.tables["concept"].filter("concept_id < 200")
    write_csv(known.filter("concept_id % 20 = 5").select(F.col("concept_id").alias("CONCEPT_ID"), "concept_name"), f"{folder}/five_concepts.csv")
    ids = F.concat_ws(", ", F.sort_array(F.collect_list("concept_id")))
    features = known.filter("concept_id % 10 < 3").groupBy((F.col("concept_id") % 10).alias("k")).agg(ids.alias("concept_ids"))
    write_csv(features.select(F.concat(F.lit("f"), "k").alias("Name"), "concept_ids", F.lit('a "quoted", text').alias("description")), f"{folder}/medications.csv")
    ancestors = known.filter("concept_id in (100, 110)").agg(ids.alias("ids"))

    def save(form: str, name: str) -> None:
        ancestors.select(F.format_string(form, "ids").alias("value")).coalesce(1).write.text(f"{folder}/{name}")

    save('{"concept_ids": [%s], "include_descendants": true}', "ten_concepts.json")
    save('{"concepts": [%s]}', "set.json")
    save('{"lab": [%s]}', "labs.json")
    return folder


def _tagged(c, specs) -> DataFrame:
    sets = concepts.ConceptSets.resolve(c.spark, c.tables["concept_ancestor"], specs)
    return sets.tag(events.drug_events(c.tables), *specs).groupBy("set_name").agg(F.count(F.lit(1)).alias("n"))


@query
def file_drugs(c):
    return _tagged(c, concept_files.load_drug_specs(c.spark, ["five", "ten", "none"], [_concept_folder(c)]))


@query
def file_features(c):
    found = concept_files.load_feature_csv(c.spark, f"{_concept_folder(c)}/medications.csv")
    return _tagged(c, {name: concept_files.ConceptSpec.of(ids) for name, ids in found.items()})


@query
def file_sets(c):
    folder = _concept_folder(c)
    labs = concept_files.load_lab_json(c.spark, f"{folder}/labs.json")
    wanted = {**labs, "set": concept_files.load_concept_set(c.spark, f"{folder}/set.json")}
    return _tagged(c, {name: concept_files.ConceptSpec.of(ids) for name, ids in wanted.items()})


# Cohort, evidence rules


@query
def evidence_condition(c):
    return cohort.first_event(c.sets.restrict(c.conditions, cohort.CONDITION_SET))


@query
def evidence_measure(c):
    return rounded(c.readings, "value")


@query
def evidence_high(c):
    return cohort.first_at_least(c.readings, STUDY.bmi_high)


@query
def comorbidity_events(c):
    return c.sets.restrict(c.conditions, cohort.COMORBIDITY_SET).select("person_id", "event_date")


def _banded(c):
    first = cohort.first_event(c.sets.restrict(c.conditions, cohort.COMORBIDITY_SET))
    return cohort.banded_with_prior(c.readings, first, STUDY.bmi_low, STUDY.bmi_high)


@query
def evidence_banded(c):
    return _banded(c)


@query
def banded_first(c):
    return _banded(c).groupBy("person_id").agg(F.min("measurement_date").alias("first_banded"))


def _candidates(c):
    return cohort.index_candidates([evidence_condition(c), evidence_high(c), banded_first(c)])


@query
def index_candidates(c):
    return _candidates(c)


@query
def index_choice(c):
    return cohort.choose_index(_candidates(c))


@query
def index_flags(c):
    return c.index


@query
def index_capped(c):
    index = c.index.select("person_id", "index_date", "index_source")
    return cohort.cap_persons(index, 100, "person_id", "index_date", "index_source")


@query
def birth_date(c):
    return cohort.person_core(c.tables)


@query
def prior_visit(c):
    return cohort.with_prior_visit(c.index.select("person_id", "index_date"), events.visit_events(c.tables))


@query
def coverage(c):
    return cohort.covered(c.index.select("person_id", "index_date"), c.spans, "index_date")


@query
def death_first(c):
    return events.first_deaths(c.tables)


@query
def attrition(c):
    return cohort.attrition(c.index, c.cohort)


@query
def cohort_(c):
    return c.cohort


# Cohort, windowed rules


@query
def windowed_evidence(c):
    return rounded(c.windowed_evidence.drop("source_rank"), "bmi_value")


@query
def windowed_entry(c):
    return windowed.windowed_entry(c.windowed_evidence)


@query
def cohort_windowed(c):
    return c.windowed_cohort


@query
def cohort_windowed_specific(c):
    strict = WINDOWED_STUDY.with_changes(require_specific=True)
    members = steps.study_cohort(c.tables, c.windowed_sets, strict)
    return members.select(*c.windowed_cohort.columns)


@query
def visit_counts(c):
    return c.windowed_cohort.select("person_id", "visits_before_entry")


@query
def specific_condition(c):
    return c.windowed_cohort.select("person_id", "has_specific_condition")


@query
def evidence_counts(c):
    return windowed.evidence_counts(c.windowed_evidence)


@query
def entry_ages(c):
    return windowed.entry_age_range(c.windowed_cohort)


# Exposure


@query
def exposure_events(c):
    return exposure.exposure_events(c.tables, c.sets, START, END)


@query
def first_exposure(c):
    return c.first_use.drop("exposure_id")


@query
def observation_islands(c):
    """Periods that overlap or touch are one."""
    return events.observation_spans(c.tables, 0)


@query
def observation_islands_gap(c):
    return events.observation_spans(c.tables, 180)


@query
def follow_up_islands(c):
    """People followed for two years, gaps of up to half a year ignored."""
    return eligibility.with_follow_up(_key(c), events.observation_spans(c.tables, 180), "index_date", 730)


@query
def survival_islands(c):
    """Survival where touching periods don't end the follow-up."""
    people = c.scored.select("person_id", "treatment", "index_date")
    return steps.study_survival(c.tables, STUDY.with_changes(merge_gap_days=0), people)


@query
def observation_spans(c):
    return c.spans


@query
def exposure_candidates(c):
    return c.candidates


@query
def users(c):
    return exposure.users(c.base, c.candidates)


@query
def non_users(c):
    return exposure.non_users(c.base, c.candidates)


@query
def non_users_clean(c):
    return exposure.non_users(c.base, c.candidates, exposure.ever_exposed(c.tables, c.sets))


@query
def arms_clean(c):
    ever = exposure.ever_exposed(c.tables, c.sets)
    return exposure.label_arms(c.base, c.first_use, c.spans, ever=ever).select("person_id", "user_flag")


@query
def arms_unexposed(c):
    """Arms of a study in which nobody is exposed."""
    nobody = exposure.first_exposure(exposure.exposure_events(c.tables, c.sets, "1800-01-01", "1800-12-31"))
    return exposure.arm_counts(exposure.label_arms(c.base, nobody, c.spans))


@query
def arms(c):
    return c.arms


@query
def arm_counts(c):
    return exposure.arm_counts(c.arms)


@query
def labelled_exposures(c):
    return exposure.labelled_exposures(c.tables, c.windowed_sets, DRUG_NAMES, START, END)


def _users(arms):
    return arms.filter("user_flag = 1").drop("user_flag")


def _non_users(arms):
    return arms.filter("user_flag = 0").drop("user_flag", "exposure_index_date", "exposure_drug")


@query
def users_windowed(c):
    return _users(c.windowed_arms)


@query
def non_users_windowed(c):
    return _non_users(c.windowed_arms)


@query
def drug_distribution(c):
    return exposure.drug_distribution(c.windowed_arms)


# Wide drug table


@query
def drug_universe(c):
    return drug_table.drug_universe(c.tables, START, END)


@query
def drug_table_(c):
    return c.wide


@query
def drug_table_cohort(c):
    return drug_table.drug_table(c.tables, c.sets, DRUG_NAMES, START, END, cohort=c.cohort)


@query
def drug_usage(c):
    return rounded(drug_table.drug_usage(c.wide, DRUG_NAMES), "percent")


@query
def drug_count_distribution(c):
    return drug_table.drug_count_distribution(c.wide, DRUG_NAMES)


# Eligibility


@query
def eligible_users(c):
    return _users(c.eligible)


@query
def eligible_non_users(c):
    return _non_users(c.eligible)


@query
def eligibility_attrition(c):
    return eligibility.rule_attrition(c.windowed_arms, eligibility.eligibility_rules(min_age=30))


@query
def followup_min(c):
    people = c.indexed.select("person_id", "index_date", "user_flag")
    return eligibility.with_follow_up(people, c.spans, "index_date", 365)


def _baseline(c, exclude):
    wanted = c.conditions.filter(F.col("concept_id").between(30, 39))
    return eligibility.by_baseline_condition(c.indexed, wanted, "index_date", exclude).select("person_id", "user_flag")


@query
def baseline_inclusion(c):
    return _baseline(c, exclude=False)


@query
def baseline_exclusion(c):
    return _baseline(c, exclude=True)


# Covariates


@query
def index_dates(c):
    return c.indexed.select("person_id", "user_flag", "index_date")


@query
def demographics(c):
    return covariates.with_demographics(c.indexed).select("person_id", "sex", "race")


def _key(c):
    return c.indexed.select("person_id", "index_date")


@query
def cov_conditions(c):
    found = events.condition_events(c.tables, date_only=True)
    return covariates.baseline_flags(_key(c), found, STUDY.condition_features).drop("index_date")


@query
def cov_drugs(c):
    found = events.drug_events(c.tables, date_only=True)
    return covariates.baseline_flags(_key(c), found, STUDY.drug_features).drop("index_date")


@query
def cov_labs(c):
    found = events.measurement_events(c.tables, date_only=True)
    return rounded(covariates.latest_values(_key(c), found, STUDY.labs, members=c.members), *STUDY.labs).drop("index_date")


@query
def cov_lookback(c):
    found = events.condition_events(c.tables, date_only=True)
    return covariates.baseline_flags(_key(c), found, STUDY.condition_features, 12, c.members).drop("index_date")


@query
def lab_lookback(c):
    found = events.measurement_events(c.tables, date_only=True)
    labs = {"lab_a": STUDY.labs["lab_a"]}
    return rounded(covariates.latest_values(_key(c), found, labs, 12, c.members), "lab_a").drop("index_date")


@query
def covariates_(c):
    flags = [*STUDY.condition_features, *STUDY.drug_features]
    frame = c.covariates.select(
        "person_id", "user_flag", "index_date", "age_at_index", "sex", "race", *flags, *STUDY.labs
    )
    return rounded(frame, *STUDY.labs)


@query
def baseline_period(c):
    return c.indexed.select(
        "person_id", C.lookback_start("index_date", 12).alias("baseline_start"), F.col("index_date").alias("baseline_end")
    )


@query
def smoking(c):
    visit = F.col("visit_occurrence_id")
    digit = (visit % 10).cast("string")
    code = (
        F.when(visit % 13 == 0, None)
        .when(visit % 3 == 0, F.concat(F.lit("0"), digit))
        .when(visit % 3 == 1, digit)
        .otherwise(F.concat(digit, F.lit(".0")))
    )
    return c.tables["visit_occurrence"].select("visit_occurrence_id", C.smoking_status(code).alias("smoking"))


@query
def sex_clean(c):
    label = F.coalesce(C.sex_from_concept("gender_concept_id"), F.lit("Unknown"))
    return c.tables["person"].select("person_id", C.sex_clean(label).alias("sex"))


@query
def bmi(c):
    value = C.body_mass_index(C.safe_double("value_as_number"), F.col("measurement_concept_id") * 20)
    return c.tables["measurement"].select("measurement_id", F.round(value, 6).alias("bmi"))


@query
def any_flag(c):
    return c.covariates.select("person_id", C.any_flag("c_a", "c_b", "c_c").alias("any_condition"))


# Scores, matching, balance


@query
def combined_arms(c):
    users_side = exposure.users(c.base, c.candidates).drop("days_from_index", "exposure_concept_id")
    both = propensity.combine_arms(users_side, exposure.non_users(c.base, c.candidates))
    return both.select("person_id", "treatment", "exposure_index_date", "age_at_index")


@query
def encode(c):
    return c.encoded.select("person_id", "sex")


@query
def medians(c):
    return rounded(propensity.medians(c.encoded, FEATURES), "median")


@query
def medians_wide(c):
    lines = c.spark.read.parquet(f"{c.folder}/lineitem.parquet")
    return rounded(propensity.medians(lines, ["l_quantity", "l_extendedprice", "l_partkey"]), "median")


@query
def impute_median(c):
    return rounded(c.imputed[0].select("person_id", "treatment", *FEATURES), *FEATURES)


@query
def scale_features(c):
    scaled = propensity.scale(*c.imputed)
    names = [f"z_{f}" for f in FEATURES]
    return rounded(scaled.select("person_id", *names), *names)


@query
def ps_fit(c):
    scaled = propensity.scale(*c.imputed)
    model = propensity.fit_model(scaled, [f"z_{f}" for f in c.imputed[1]])
    scored = propensity.add_scores(scaled, model).select("person_id", "treatment", "propensity_score", "logit_ps")
    return rounded(scored, "propensity_score", "logit_ps")


@query
def ps_fixed(c):
    # Stretched so that some scores reach the clipping bounds.
    model = propensity.ScoreModel(0.0, {"stretched": 1.0})
    stretched = c.scored.withColumn("stretched", 6 * (F.col("logit_ps") + 0.2))
    scored = propensity.add_scores(stretched, model).select("person_id", "treatment", "propensity_score", "logit_ps")
    return rounded(scored, "propensity_score", "logit_ps")


@query
def caliper(c):
    width = matching.caliper_width(c.scored)
    return c.scored.agg(F.round(F.max(F.lit(width)), 6).alias("caliper"))


@query
def nearest(c):
    return rounded(matching.nearest_controls(c.scored), "ps_distance")


@query
def match_pairs(c):
    return rounded(matching.match_pairs(c.scored), "ps_distance")


@query
def matched(c):
    return rounded(c.matched.select("person_id", "treatment", "logit_ps"), "logit_ps")


@query
def match_rate(c):
    return rounded(matching.match_rate(c.scored, c.pairs), "match_rate")


@query
def score_ranges(c):
    chance = c.scored.withColumn("propensity_score", 1.0 / (1.0 + F.exp(-F.col("logit_ps"))))
    return rounded(propensity.score_ranges(chance), "min_score", "max_score")


@query
def smd(c):
    return rounded(balance.standardized_differences(c.matched, FEATURES), "user_mean", "non_user_mean", "smd")


@query
def smd_before_after(c):
    return rounded(balance.before_and_after(c.scored, c.matched, FEATURES), "smd_before", "smd_after")


@query
def imbalance(c):
    worst = balance.imbalanced(balance.standardized_differences(c.scored, FEATURES))
    return rounded(worst.select("feature", "smd"), "smd")


# Survival


@query
def survival_data(c):
    return c.survival()


@query
def survival_uncovered(c):
    """Index dates moved back, so that many lie before the person's observation period."""
    people = c.scored.withColumn("index_date", F.date_sub("index_date", 400))
    return steps.study_survival(c.tables, STUDY, people)


@query
def survival_competing(c):
    return c.survival(competing=True)


@query
def risk_table(c):
    return survival.risk_table(c.survival())


@query
def subgroup_risk(c):
    return survival.risk_table(c.survival(by=("stratum",)), ("stratum",))


@query
def km(c):
    # Death ends follow-up here as in the curve with competing risks, only the step differs.
    return rounded(survival.kaplan_meier(c.survival()), "survival")


@query
def cif(c):
    return rounded(survival.cumulative_incidence(c.survival(competing=True)), "incidence")


COX_COLUMNS = ("HR", "HR_lower_95CI", "HR_upper_95CI", "p_value")


@query
def cox(c):
    return rounded(survival.cox_model(c.survival()), *COX_COLUMNS)


@query
def cox_subgroup(c):
    return rounded(survival.cox_model(c.survival(by=("stratum",)), ("stratum",)), *COX_COLUMNS)


@query
def cox_limits(c):
    return rounded(survival.cox_model(c.survival()).drop("p_value"), *COX_COLUMNS[:3])


@query
def cox_subgroup_limits(c):
    fitted = survival.cox_model(c.survival(by=("stratum",)), ("stratum",))
    return rounded(fitted.drop("p_value"), *COX_COLUMNS[:3])


@query
def ps_gradient(c):
    """The penalised gradient at the fitted weights, zero at the one optimum of a strictly convex loss."""
    scaled = propensity.scale(*c.imputed)
    names = [f"z_{f}" for f in c.imputed[1]]
    model = propensity.fit_model(scaled, names)
    off = propensity.add_scores(scaled, model).withColumn("off", F.col("propensity_score") - F.col("treatment"))
    slopes = [(F.avg(F.col("off") * F.col(n)) + F.lit(model.coefficients[n]) / F.count(F.lit(1))).alias(n) for n in names]
    wide = off.agg(F.avg("off").alias("intercept"), *slopes)
    return wide.unpivot([], ["intercept", *names], "feature", "gradient").select("feature", (F.round("gradient", 5) + 0.0).alias("gradient"))


# Whole studies


@query
def written_matching(c):
    """Rows of each matching result, counted in the written files."""
    balance_rows = balance.standardized_differences(c.matched, FEATURES)
    paths = write_matching(_csv_folder(c), "trial", c.matched, c.pairs, balance_rows, "parquet")
    paths["arms"] = save_with_suffix(c.arms, f"{_csv_folder(c)}/arms", "v1", "parquet")
    counts = [c.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, p in paths.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def study_evidence(c):
    result = steps.run_study(c.tables, STUDY)
    return rounded(result.balance, "user_mean", "non_user_mean", "smd")


@query
def study_evidence_balance(c):
    """Balance before matching in a whole study."""
    before = steps.run_study(c.tables, STUDY).before_after
    return rounded(before.select("feature", "smd_before"), "smd_before")


@query
def study_evidence_attrition(c):
    return steps.run_study(c.tables, STUDY.with_changes(matching_features=())).attrition


@query
def study_windowed_attrition(c):
    """With the true age at the index date and conditions that must not come before it."""
    study = WINDOWED_STUDY.with_changes(
        matching_features=(), true_age_at_index=True, min_age_at_index=30, baseline_exclude=ConceptSpec((30,))
    )
    return steps.run_study(c.tables, study).attrition


@query
def study_windowed(c):
    result = steps.run_study(c.tables, WINDOWED_STUDY)
    return rounded(result.balance, "user_mean", "non_user_mean", "smd")


# Helpers


@query
def person_summary(c):
    return rounded(S.summarize(c.tables["measurement"]), "records_per_person")


@query
def follow_up(c):
    start, end = "observation_period_start_date", "observation_period_end_date"
    return c.tables["observation_period"].select(
        "person_id",
        C.follow_up_time(start, end).alias("days"),
        F.round(C.follow_up_time(start, end, "months"), 6).alias("months"),
        F.round(C.follow_up_time(start, end, "years"), 6).alias("years"),
        C.follow_up_end(start, end, 2).alias("capped_end"),
    )


@query
def person_agg(c):
    wanted = {"first_day": F.min("event_date"), "last_day": F.max("event_date"), "n": F.count(F.lit(1))}
    return S.aggregate_by_person(c.conditions, wanted)


@query
def person_first(c):
    visits = c.tables["visit_occurrence"].select(
        "person_id", "visit_concept_id", "visit_start_date", "visit_occurrence_id"
    )
    firsts = S.aggregate_by_person(visits, order_by=["visit_start_date", "visit_occurrence_id"])
    return firsts.drop("visit_occurrence_id")


@query
def last_value(c):
    readings = events.measurement_events(c.tables).withColumn("value", C.safe_double("value_as_number"))
    last = S.last_known("value", "event_date", "event_id").alias("last_value")
    return rounded(readings.groupBy("person_id").agg(last), "last_value")


@query
def parsed_dates(c):
    text = F.date_format("visit_start_date", "dd/MM/yyyy")
    return c.tables["visit_occurrence"].select("visit_occurrence_id", C.parse_date(text, "dd/MM/yyyy").alias("day"))


@query
def ages(c):
    born = cohort.person_core(c.tables).select("person_id", "birth_date")
    period = c.tables["observation_period"]
    end = "observation_period_end_date"
    return born.join(period, "person_id").select(
        "person_id", C.age_truncated("birth_date", end).alias("whole_years"), C.age_rounded("birth_date", end).alias("rounded_years")
    )
