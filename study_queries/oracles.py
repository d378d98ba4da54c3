"""SQL each registered query is checked against.

``STEPS`` are named sub-queries; a check pulls in those it mentions. They follow the study rules
literally, with EXISTS, ROW_NUMBER and self joins, not the aggregated forms the operators use.
"""

from __future__ import annotations

import re

from .views import VIEWS, duckdb_view


def _expanded(ids: str, include_self: bool = True) -> str:
    below = f"SELECT descendant_concept_id AS concept_id FROM concept_ancestor WHERE ancestor_concept_id IN ({ids})"
    return f"SELECT concept_id FROM (SELECT unnest([{ids}]) AS concept_id) UNION {below}" if include_self else (
        f"SELECT DISTINCT concept_id FROM ({below})"
    )


def _rounded_age(birth: str, day: str) -> str:
    return f"CAST(date_diff('day', {birth}, {day}) / 365.25 AS INTEGER)"


def _whole_years(birth: str, day: str) -> str:
    return f"CAST(trunc(date_diff('day', {birth}, {day}) / 365.25) AS INTEGER)"


CONDITION_DAY = "CAST(COALESCE(condition_start_date, condition_start_datetime) AS DATE)"
DRUG_DAY = "CAST(COALESCE(drug_exposure_start_date, drug_exposure_start_datetime) AS DATE)"
IN_STUDY = "BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"

FEATURES = ["age_at_index", "sex", "c_a", "c_b", "c_c", "m_a", "m_b", "lab_a", "lab_b", "lab_bmi"]

STEPS: dict[str, str] = {
    **{name: duckdb_view(name) for name in VIEWS},
    "set_conditions": _expanded("0"),
    "set_comorbidities": _expanded("20"),
    "set_specific": _expanded("30", include_self=False),
    "set_alpha": _expanded("100"),
    "set_beta": _expanded("110"),
    "set_gamma": _expanded("120"),
    "set_exposure": _expanded("100, 110, 120"),
    "all_sets": """
        SELECT 'conditions' AS set_name, concept_id FROM set_conditions
        UNION ALL SELECT 'measurements', 0
        UNION ALL SELECT 'comorbidities', concept_id FROM set_comorbidities
        UNION ALL SELECT 'exposure', concept_id FROM set_exposure
        UNION ALL SELECT 'alpha', concept_id FROM set_alpha
        UNION ALL SELECT 'beta', concept_id FROM set_beta
        UNION ALL SELECT 'gamma', concept_id FROM set_gamma""",
    # Evidence rules.
    "condition_days": f"SELECT person_id, condition_concept_id AS concept_id, {CONDITION_DAY} AS day FROM condition_occurrence",
    "drug_days": f"SELECT person_id, drug_concept_id AS concept_id, drug_exposure_id AS event_id, {DRUG_DAY} AS day FROM drug_exposure",
    "first_dx": "SELECT person_id, MIN(day) AS first_date FROM condition_days SEMI JOIN set_conditions USING (concept_id) GROUP BY ALL",
    # Readings of the set; one without a number stays and compares as unknown.
    "readings": """
        WITH dated AS (
            SELECT person_id, TRY_CAST(value_as_number AS DOUBLE) AS value, value_as_number AS written,
                   COALESCE(measurement_date, CAST(measurement_datetime AS DATE)) AS measurement_date
            FROM measurement JOIN all_sets ON set_name = 'measurements' AND concept_id = measurement_concept_id)
        SELECT person_id, measurement_date, value FROM dated WHERE written IS NOT NULL""",
    "first_high": "SELECT person_id, MIN(measurement_date) AS first_high FROM readings WHERE value >= 30 GROUP BY person_id",
    "comorbid": "SELECT person_id, day AS event_date FROM condition_days SEMI JOIN set_comorbidities USING (concept_id)",
    "banded": """
        SELECT person_id, measurement_date FROM readings r
        WHERE value >= 27 AND value < 30
          AND EXISTS (SELECT 1 FROM comorbid c WHERE c.person_id = r.person_id AND c.event_date <= r.measurement_date)""",
    "first_banded": "SELECT person_id, MIN(measurement_date) AS first_banded FROM banded GROUP BY person_id",
    # One row per person with the first date of each kind of evidence, then one per date there is.
    "evidence_wide": """
        SELECT person_id, MIN(first_date) AS condition_dx, MIN(first_high) AS bmi_ge_30, MIN(first_banded) AS bmi_ge_27_plus_comorb
        FROM (FROM first_dx UNION ALL BY NAME FROM first_high UNION ALL BY NAME FROM first_banded) GROUP BY person_id""",
    "candidates": """
        SELECT person_id, index_date, index_source, list_position(['condition_dx', 'bmi_ge_30', 'bmi_ge_27_plus_comorb'], index_source) AS source_rank
        FROM (UNPIVOT (SELECT * FROM evidence_wide) ON condition_dx, bmi_ge_30, bmi_ge_27_plus_comorb INTO NAME index_source VALUE index_date)""",
    "chosen": """
        SELECT person_id, index_date, index_source FROM candidates
        QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY index_date, source_rank) = 1""",
    "flagged": """
        SELECT c.*, """ + ", ".join(
        f"""(SELECT COUNT(*) FROM candidates x WHERE x.person_id = c.person_id AND x.index_date = c.index_date
                AND x.source_rank = {rank})::INTEGER AS {flag}"""
        for rank, flag in enumerate(("obesity_dx_flag", "bmi_ge_30_flag", "bmi_ge_27_plus_comorb_flag"), start=1)
    ) + " FROM chosen c",
    "core": """
        SELECT person_id,
               COALESCE(CAST(birth_datetime AS DATE),
                        TRY_CAST(printf('%04d-%02d-%02d', year_of_birth, COALESCE(NULLIF(month_of_birth, 0), 1),
                                        COALESCE(NULLIF(day_of_birth, 0), 1)) AS DATE)) AS birth_date,
               gender_concept_id, race_concept_id, ethnicity_concept_id
        FROM person""",
    "first_death": "SELECT person_id, MIN(death_date) AS death_date FROM death WHERE death_date IS NOT NULL GROUP BY person_id",
    # One row per person, a column per rule.
    "visit_rule": """
        SELECT c.person_id, bool_or(CAST(COALESCE(v.visit_start_date, v.visit_start_datetime) AS DATE) < c.index_date) AS visited
        FROM chosen c LEFT JOIN visit_occurrence v ON v.person_id = c.person_id GROUP BY c.person_id""",
    "period_rule": """
        SELECT c.person_id, bool_or(o.observation_period_start_date <= c.index_date AND c.index_date <= o.observation_period_end_date) AS observed
        FROM chosen c LEFT JOIN observation_period o ON o.person_id = c.person_id GROUP BY c.person_id""",
    "seen_before": "SELECT person_id FROM visit_rule WHERE visited",
    "covered_index": "SELECT person_id FROM period_rule WHERE observed",
    "aged": f"""
        SELECT f.*, birth_date, {_rounded_age('birth_date', 'index_date')} AS age_at_index,
               gender_concept_id, race_concept_id, ethnicity_concept_id
        FROM flagged f JOIN core USING (person_id)""",
    "rules": """
        SELECT a.*, death_date, visited, observed,
               index_date >= DATE '1995-03-01' AND index_date <= DATE '2001-12-31' AS in_dates,
               age_at_index >= 18 AS adult, birth_date <= index_date AS born, death_date < index_date AS dead
        FROM aged a LEFT JOIN first_death USING (person_id) LEFT JOIN visit_rule USING (person_id) LEFT JOIN period_rule USING (person_id)""",
    "cohort": """
        SELECT * EXCLUDE (visited, observed, in_dates, adult, born, dead) FROM rules
        WHERE visited AND observed AND in_dates AND adult AND born AND dead IS NOT TRUE""",
    # Exposure, evidence rules.
    "base": """
        SELECT person_id, index_date AS obesity_index_date, index_source, birth_date, age_at_index,
               gender_concept_id, race_concept_id, ethnicity_concept_id, death_date FROM cohort""",
    "exposures": f"SELECT person_id, concept_id, day AS event_date, event_id FROM drug_days SEMI JOIN set_exposure USING (concept_id) WHERE day {IN_STUDY}",
    "first_use": """
        SELECT person_id, MIN(event_date) AS exposure_date,
               arg_min(concept_id, (event_date, event_id, concept_id)) AS exposure_concept_id
        FROM exposures GROUP BY person_id""",
    # Exposed at any time, with or without a date.
    "ever_treated": "SELECT DISTINCT person_id FROM drug_exposure WHERE drug_concept_id IN (SELECT concept_id FROM set_exposure)",
    "user_candidates": """
        WITH rules AS (
            SELECT b.person_id, f.exposure_date, f.exposure_concept_id, date_diff('day', b.obesity_index_date, f.exposure_date) AS gap,
                   bool_or(o.observation_period_start_date <= f.exposure_date AND f.exposure_date <= o.observation_period_end_date) AS observed
            FROM base b JOIN first_use f ON f.person_id = b.person_id
            LEFT JOIN observation_period o ON o.person_id = b.person_id GROUP BY ALL)
        SELECT person_id, exposure_date AS exposure_index_date, exposure_concept_id, CAST(gap AS INTEGER) AS days_from_index
        FROM rules WHERE observed AND gap >= 0 AND gap <= 730""",
    "arms": f"""
        SELECT b.*, u.exposure_index_date, u.exposure_concept_id, u.days_from_index,
               {_rounded_age('b.birth_date', 'u.exposure_index_date')} AS age_at_exposure_index,
               CASE WHEN u.person_id IS NULL THEN 0 ELSE 1 END AS user_flag
        FROM base b LEFT JOIN user_candidates u ON u.person_id = b.person_id""",
    # Windowed rules.
    "w_evidence": f"""
        SELECT person_id, condition_start_date AS obesity_date, condition_occurrence_id AS record_id,
               'diagnosis' AS obesity_criterion, CAST(NULL AS DOUBLE) AS bmi_value, 1 AS source_rank
        FROM condition_occurrence
        WHERE condition_concept_id IN (SELECT concept_id FROM set_conditions) AND condition_start_date {IN_STUDY}
        UNION ALL
        SELECT person_id, measurement_date, measurement_id,
               CASE WHEN TRY_CAST(value_as_number AS DOUBLE) >= 30 THEN 'bmi_30plus' ELSE 'bmi_27to29' END,
               TRY_CAST(value_as_number AS DOUBLE), 2
        FROM measurement
        WHERE measurement_concept_id = 0 AND measurement_date {IN_STUDY} AND TRY_CAST(value_as_number AS DOUBLE) >= 27""",
    "w_entry": """
        SELECT person_id, MIN(obesity_date) AS obesity_entry_date,
               FIRST(obesity_criterion ORDER BY source_rank, obesity_date, record_id) AS obesity_criterion
        FROM w_evidence GROUP BY person_id""",
    "w_born": """
        SELECT person_id, TRY_CAST(printf('%04d-%02d-%02d', year_of_birth, COALESCE(NULLIF(month_of_birth, 0), 1),
                                          COALESCE(NULLIF(day_of_birth, 0), 1)) AS DATE) AS birth_date,
               gender_concept_id, race_concept_id
        FROM person""",
    "w_aged": f"""
        SELECT e.*, p.birth_date, p.gender_concept_id, p.race_concept_id,
               {_whole_years('p.birth_date', 'e.obesity_entry_date')} AS age_at_obesity_entry
        FROM w_entry e LEFT JOIN w_born p ON p.person_id = e.person_id
        WHERE {_whole_years('p.birth_date', 'e.obesity_entry_date')} >= 18""",
    "w_visits": """
        SELECT a.person_id, COUNT(*) AS n FROM w_aged a JOIN visit_occurrence v ON v.person_id = a.person_id
        WHERE v.visit_start_date >= DATE '1995-01-01' AND v.visit_end_date <= DATE '2001-12-31'
          AND v.visit_start_date < a.obesity_entry_date
        GROUP BY a.person_id""",
    "w_specific": """
        SELECT DISTINCT person_id FROM condition_occurrence
        WHERE condition_concept_id IN (SELECT concept_id FROM set_specific)""",
    "w_cohort": """
        SELECT a.*, CAST(COALESCE(v.n, 0) AS INTEGER) AS visits_before_entry,
               s.person_id IS NOT NULL AS has_specific_condition
        FROM w_aged a LEFT JOIN w_visits v ON v.person_id = a.person_id
        LEFT JOIN w_specific s ON s.person_id = a.person_id""",
    "w_exposures": f"""
        SELECT person_id, drug_exposure_start_date AS event_date, drug_exposure_id AS event_id,
               CASE WHEN drug_concept_id IN (SELECT concept_id FROM set_gamma) THEN 'gamma'
                    WHEN drug_concept_id IN (SELECT concept_id FROM set_beta) THEN 'beta'
                    ELSE 'alpha' END AS exposure_drug
        FROM drug_exposure
        WHERE drug_concept_id IN (SELECT concept_id FROM set_exposure) AND drug_exposure_start_date {IN_STUDY}""",
    "w_first": """
        SELECT person_id, event_date AS exposure_index_date, exposure_drug FROM (
            SELECT x.*, ROW_NUMBER() OVER (PARTITION BY x.person_id ORDER BY x.event_date, x.event_id) AS rn
            FROM w_exposures x JOIN w_cohort c ON c.person_id = x.person_id AND x.event_date >= c.obesity_entry_date)
        WHERE rn = 1""",
    "w_arms": """
        SELECT c.*, f.exposure_index_date, f.exposure_drug, CASE WHEN f.person_id IS NULL THEN 0 ELSE 1 END AS user_flag
        FROM w_cohort c LEFT JOIN w_first f ON f.person_id = c.person_id""",
    # Wide drug table.
    "dated_use": f"SELECT person_id, concept_id, day FROM drug_days WHERE day {IN_STUDY}",
    "universe": "SELECT DISTINCT person_id FROM dated_use",
    "drug_days_by_set": " UNION ALL ".join(
        f"SELECT '{d}' AS drug, person_id, day FROM dated_use SEMI JOIN set_{d} USING (concept_id)"
        for d in ("alpha", "beta", "gamma")
    ),
    "wide": "SELECT person_id, " + ", ".join(
        f"(COUNT(day) FILTER (WHERE drug = '{d}') > 0)::INTEGER AS {d}_used, MIN(day) FILTER (WHERE drug = '{d}') AS {d}_first_date"
        for d in ("alpha", "beta", "gamma", "delta")
    ) + " FROM universe LEFT JOIN drug_days_by_set USING (person_id) GROUP BY person_id",
    # Covariates of the evidence arms.
    "indexed": """
        SELECT *, CASE WHEN user_flag = 1 THEN exposure_index_date ELSE obesity_index_date END AS index_date FROM arms""",
    "demographics": """
        SELECT *, CASE gender_concept_id WHEN 8507 THEN 'M' WHEN 8532 THEN 'F' END AS sex, 'Other' AS race FROM indexed""",
    **{
        f"has_{f}": f"""
        SELECT DISTINCT i.person_id FROM indexed i JOIN condition_occurrence e ON e.person_id = i.person_id
        WHERE e.condition_concept_id IN ({ids}) AND e.condition_start_date <= i.index_date"""
        for f, ids in {"c_a": "11", "c_b": "12, 13", "c_c": "15"}.items()
    },
    **{
        f"has_{f}": f"""
        SELECT DISTINCT i.person_id FROM indexed i JOIN drug_exposure e ON e.person_id = i.person_id
        WHERE e.drug_concept_id IN ({ids}) AND e.drug_exposure_start_date <= i.index_date"""
        for f, ids in {"m_a": "50", "m_b": "60, 61"}.items()
    },
    **{
        f"latest_{lab}": f"""
        SELECT person_id, value FROM (
            SELECT i.person_id, TRY_CAST(m.value_as_number AS DOUBLE) AS value,
                   ROW_NUMBER() OVER (PARTITION BY i.person_id ORDER BY m.measurement_date DESC, m.measurement_id DESC) AS rn
            FROM indexed i JOIN measurement m ON m.person_id = i.person_id
            WHERE m.measurement_concept_id IN ({ids}) AND m.measurement_date <= i.index_date
              AND TRY_CAST(m.value_as_number AS DOUBLE) IS NOT NULL)
        WHERE rn = 1"""
        for lab, ids in {"lab_a": "1, 2", "lab_b": "3", "lab_bmi": "0"}.items()
    },
    "covariates": "SELECT d.*, " + ", ".join(
        f"CASE WHEN d.person_id IN (SELECT person_id FROM has_{f}) THEN 1 ELSE 0 END AS {f}"
        for f in ("c_a", "c_b", "c_c", "m_a", "m_b")
    ) + """, 0 AS m_none, la.value AS lab_a, lb.value AS lab_b, lc.value AS lab_bmi
        FROM demographics d LEFT JOIN latest_lab_a la ON la.person_id = d.person_id
        LEFT JOIN latest_lab_b lb ON lb.person_id = d.person_id
        LEFT JOIN latest_lab_bmi lc ON lc.person_id = d.person_id""",
    # Scores.
    "encoded": "SELECT person_id, user_flag AS treatment, index_date, race_concept_id, " + ", ".join(
        "CAST(CASE sex WHEN 'F' THEN 0 WHEN 'M' THEN 1 END AS DOUBLE) AS sex" if f == "sex"
        else f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES
    ) + " FROM covariates",
    "feature_medians": "SELECT " + ", ".join(f"median({f}) AS {f}" for f in FEATURES) + " FROM encoded",
    "imputed": "SELECT e.person_id, e.treatment, e.index_date, e.race_concept_id, " + ", ".join(
        f"COALESCE(e.{f}, m.{f}) AS {f}" for f in FEATURES
    ) + " FROM encoded e CROSS JOIN feature_medians m",
    "moments": "SELECT " + ", ".join(
        f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES
    ) + " FROM imputed",
    "scored": """
        SELECT *, ROUND(((((-1.5 + 0.02 * age_at_index) + 0.3 * sex) + 0.5 * c_b) + -0.4 * m_b) + 0.01 * lab_a, 6) AS logit_ps
        FROM imputed""",
    "width": "SELECT 0.2 * stddev_pop(logit_ps) AS width FROM scored",
    "gaps": """
        SELECT u.person_id AS user_person_id, c.person_id AS nonuser_person_id, abs(u.logit_ps - c.logit_ps) AS gap
        FROM scored u JOIN scored c ON u.treatment = 1 AND c.treatment = 0""",
    "nearest": """
        SELECT user_person_id, nonuser_person_id, gap FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_person_id ORDER BY gap, nonuser_person_id) AS rn FROM gaps)
        WHERE rn = 1""",
    "pairs": """
        SELECT user_person_id, nonuser_person_id, gap FROM (
            SELECT n.*, ROW_NUMBER() OVER (PARTITION BY nonuser_person_id ORDER BY user_person_id) AS rn
            FROM nearest n WHERE gap <= (SELECT width FROM width))
        WHERE rn = 1""",
    "matched": """
        SELECT * FROM scored WHERE person_id IN (SELECT user_person_id FROM pairs)
           OR person_id IN (SELECT nonuser_person_id FROM pairs)""",
    **{
        f"smd_{label}": " UNION ALL ".join(
            f"""SELECT feature, m1 AS user_mean, m0 AS non_user_mean,
                   CASE WHEN sqrt((v1 + v0) / 2) > 0 THEN abs(m1 - m0) / sqrt((v1 + v0) / 2) ELSE 0 END AS smd
            FROM (SELECT '{f}' AS feature,
                         avg(CASE WHEN treatment = 1 THEN {f} END) AS m1, var_samp(CASE WHEN treatment = 1 THEN {f} END) AS v1,
                         avg(CASE WHEN treatment = 0 THEN {f} END) AS m0, var_samp(CASE WHEN treatment = 0 THEN {f} END) AS v0
                  FROM {source})"""
            for f in FEATURES
        )
        for label, source in {"before": "scored", "after": "matched"}.items()
    },
    # Survival of the matched people.
    "followed": """
        SELECT m.person_id, m.treatment, CASE WHEN m.sex = 1 THEN 'M' ELSE 'F' END AS stratum, m.index_date,
               (SELECT MAX(o.observation_period_end_date) FROM observation_period o WHERE o.person_id = m.person_id
                AND m.index_date BETWEEN o.observation_period_start_date AND o.observation_period_end_date) AS obs_end,
               d.death_date
        FROM scored m LEFT JOIN first_death d ON d.person_id = m.person_id""",
    "outcome_events": f"""
        SELECT person_id, {CONDITION_DAY} AS day,
               CASE WHEN condition_concept_id IN (21, 22) THEN 'out_a' ELSE 'out_b' END AS outcome
        FROM condition_occurrence WHERE condition_concept_id IN (21, 22, 5, 6, 7)""",
    "timed": """
        SELECT f.*, o.outcome,
               LEAST(f.obs_end, f.death_date, DATE '2001-12-31', CAST(f.index_date + INTERVAL 60 MONTH AS DATE)) AS censor,
               (SELECT MIN(e.day) FROM outcome_events e WHERE e.person_id = f.person_id AND e.outcome = o.outcome
                AND e.day > f.index_date) AS event
        FROM followed f CROSS JOIN (SELECT unnest(['out_a', 'out_b']) AS outcome) o WHERE f.obs_end IS NOT NULL""",
    "survival": """
        SELECT person_id, treatment, stratum, outcome, CAST(date_diff('day', index_date, LEAST(event, censor)) AS INTEGER) AS T,
               CASE WHEN event <= censor THEN 1 ELSE 0 END AS E,
               CASE WHEN event <= censor THEN 1 WHEN death_date = censor THEN 2 ELSE 0 END AS E2
        FROM timed WHERE censor >= index_date""",
    "arm_days": """
        SELECT outcome, treatment, T, COUNT(*) AS leaving,
               SUM(CASE WHEN E2 = 1 THEN 1 ELSE 0 END) AS events, SUM(CASE WHEN E2 = 2 THEN 1 ELSE 0 END) AS competing
        FROM survival GROUP BY outcome, treatment, T""",
    "arm_risk": """
        SELECT *, SUM(leaving) OVER (PARTITION BY outcome, treatment ORDER BY T DESC) AS at_risk FROM arm_days""",
}


def _risk(keys: str) -> str:
    return f"""
        SELECT {keys}, T, d0, d1,
               CAST(SUM(m0) OVER (PARTITION BY {keys} ORDER BY T DESC) AS BIGINT) AS n0,
               CAST(SUM(m1) OVER (PARTITION BY {keys} ORDER BY T DESC) AS BIGINT) AS n1
        FROM (SELECT {keys}, T, COUNT(*) FILTER (WHERE E = 1 AND treatment = 0) AS d0,
                     COUNT(*) FILTER (WHERE E = 1 AND treatment = 1) AS d1,
                     COUNT(*) FILTER (WHERE treatment = 0) AS m0, COUNT(*) FILTER (WHERE treatment = 1) AS m1
              FROM survival GROUP BY {keys}, T)"""


def _cox(keys: str, rounds: int = 14) -> str:
    """Newton steps from zero on the Efron likelihood, one sub-query a step; no estimate without events in both arms."""
    using = f"USING ({keys})"
    steps = [f"""
        shares AS (
            SELECT {keys}, d0, d1, n0, n1, i / (d0 + d1) AS f, d1 / (d0 + d1) AS part
            FROM (SELECT *, unnest(range(d0 + d1)) AS i FROM ({_risk(keys)}) WHERE d0 + d1 > 0)),
        groups AS (SELECT DISTINCT {keys} FROM survival),
        both_arms AS (SELECT {keys} FROM shares GROUP BY {keys} HAVING SUM(d0) > 0 AND SUM(d1) > 0),
        b0 AS (SELECT {keys}, 0.0::DOUBLE AS b, 0.0::DOUBLE AS info FROM both_arms)"""]
    for k in range(rounds):
        steps.append(f"""
        b{k + 1} AS (
            SELECT {keys}, ANY_VALUE(b) + SUM(part - m) / SUM(m * (1 - m)) AS b, SUM(m * (1 - m)) AS info FROM (
                SELECT s.*, b, exp(b) * (n1 - f * d1) / (exp(b) * (n1 - f * d1) + n0 - f * d0) AS m
                FROM shares s JOIN b{k} {using}) GROUP BY {keys})""")
    low, high = (f"ROUND(exp(b {sign} 1.959963984540054 / sqrt(info)), 6)" for sign in "-+")
    return f"""WITH {','.join(steps)}
        SELECT {keys}, ROUND(exp(b), 6) AS "HR", {low} AS "HR_lower_95CI", {high} AS "HR_upper_95CI"
        FROM groups LEFT JOIN b{rounds} {using}"""


def _rounded(columns: str, *doubles: str, source: str) -> str:
    parts = [columns, *[f"ROUND({d}, 6) AS {d}" for d in doubles]]
    return f"SELECT {', '.join(p for p in parts if p)} FROM {source}"


def _islands(gap: int) -> str:
    """Days on which a person is observed, counting ``gap`` days behind each period, put together day by day."""
    return f"""
        WITH days AS (
            SELECT DISTINCT person_id, unnest(generate_series(observation_period_start_date, observation_period_end_date, INTERVAL 1 DAY))::DATE AS day FROM observation_period),
        edges AS (SELECT person_id, day, COALESCE(day - lag(day) OVER (PARTITION BY person_id ORDER BY day) > {gap + 1}, TRUE) AS fresh FROM days),
        numbered AS (SELECT person_id, day, SUM(fresh::INT) OVER (PARTITION BY person_id ORDER BY day) AS island FROM edges)
        SELECT person_id, MIN(day) AS obs_start, MAX(day) AS obs_end FROM numbered GROUP BY person_id, island"""


_ARM_COLUMNS = (
    "person_id, obesity_index_date, index_source, birth_date, age_at_index, gender_concept_id, "
    "race_concept_id, ethnicity_concept_id, death_date"
)
_W_COLUMNS = (
    "person_id, obesity_entry_date, obesity_criterion, birth_date, age_at_obesity_entry, gender_concept_id, "
    "race_concept_id, visits_before_entry, has_specific_condition"
)
_WITH_DEATH = "person_id IN (SELECT person_id FROM death)"

CHECKS: dict[str, str] = {
    "concept_expand": "SELECT set_name, concept_id FROM all_sets",
    "concept_expand_no_self": _expanded("100, 7, 115", include_self=False),
    "concept_unexpanded": "SELECT DISTINCT drug_concept_id AS concept_id FROM drug_exposure",
    "concept_names": """
        SELECT i.concept_id, c.concept_name
        FROM (SELECT DISTINCT condition_concept_id AS concept_id FROM condition_occurrence) i
        LEFT JOIN concept c ON c.concept_id = i.concept_id""",
    "concept_vocab": """
        SELECT concept_id FROM concept WHERE vocabulary_id = 'Brand#11'
          AND concept_id IN (SELECT drug_concept_id FROM drug_exposure)""",
    "concept_standard": """
        SELECT concept_id FROM concept WHERE standard_concept = 'S'
          AND concept_id IN (SELECT drug_concept_id FROM drug_exposure)""",
    "concept_details": """
        SELECT s.set_name, c.concept_id, c.concept_name, c.vocabulary_id, c.domain_id,
               CASE WHEN (s.set_name, c.concept_id) IN (('conditions', 0), ('comorbidities', 20), ('measurements', 0),
                         ('exposure', 100), ('exposure', 110), ('exposure', 120), ('alpha', 100), ('beta', 110),
                         ('gamma', 120)) THEN 1 ELSE 0 END AS is_original
        FROM all_sets s JOIN concept c ON c.concept_id = s.concept_id""",
    "concept_summary": """
        SELECT n.set_name, n.original_ids, n.n_original, COALESCE(s.n, 0) AS n_total
        FROM (VALUES ('conditions', '0', 1), ('measurements', '0', 1), ('comorbidities', '20', 1),
                     ('exposure', '100;110;120', 3), ('alpha', '100', 1), ('beta', '110', 1), ('gamma', '120', 1),
                     ('delta', '', 0)) AS n(set_name, original_ids, n_original)
        LEFT JOIN (SELECT set_name, COUNT(*) AS n FROM all_sets GROUP BY set_name) s ON s.set_name = n.set_name""",
    "drug_concepts": "SELECT concept_id FROM set_alpha UNION SELECT concept_id FROM set_beta UNION SELECT concept_id FROM set_gamma",
    "id_lists": "SELECT CAST(ancestor_concept_id AS VARCHAR) AS feature, descendant_concept_id AS concept_id FROM concept_ancestor",
    "acc_person": f"""
        SELECT person_id, year_of_birth, gender_concept_id FROM person
        WHERE year_of_birth BETWEEN 1940 AND 1980 AND {_WITH_DEATH}""",
    "acc_obs": """
        SELECT person_id, observation_period_start_date, observation_period_end_date FROM observation_period
        WHERE observation_period_start_date >= DATE '1995-02-01' AND observation_period_end_date <= DATE '2001-06-30'""",
    "acc_condition": f"""
        SELECT condition_occurrence_id, person_id, condition_concept_id, condition_start_date FROM condition_occurrence
        WHERE {_WITH_DEATH} AND condition_concept_id IN (SELECT concept_id FROM set_conditions)
          AND condition_start_date {IN_STUDY}""",
    "acc_members": f"""
        SELECT measurement_id, person_id, measurement_concept_id, measurement_date FROM measurement
        WHERE person_id IN (SELECT person_id FROM indexed) AND measurement_concept_id IN (0, 3) AND measurement_date {IN_STUDY}""",
    "member_days": """
        SELECT i.person_id, i.index_date, count(*) AS n FROM indexed i
        JOIN condition_occurrence e ON e.person_id = i.person_id AND e.condition_start_date <= i.index_date GROUP BY ALL""",
    "acc_drug": f"""
        SELECT drug_exposure_id, person_id, drug_concept_id, drug_exposure_start_date FROM drug_exposure
        WHERE {_WITH_DEATH} AND drug_concept_id IN (50, 60, 61) AND drug_exposure_start_date >= DATE '1995-01-01'""",
    "acc_measurement": f"""
        SELECT measurement_id, person_id, measurement_concept_id, measurement_date, value_as_number FROM measurement
        WHERE measurement_concept_id IN (0, 3) AND measurement_date {IN_STUDY}""",
    "acc_procedure": f"""
        SELECT procedure_occurrence_id, person_id, procedure_concept_id, procedure_date FROM procedure_occurrence
        WHERE {_WITH_DEATH} AND procedure_concept_id IN (1, 2, 3) AND procedure_date <= DATE '2001-12-31'""",
    "acc_visit": """
        SELECT visit_occurrence_id, person_id, visit_concept_id, visit_start_date FROM visit_occurrence
        WHERE visit_concept_id IN (9201, 9202) AND visit_start_date >= DATE '1996-01-01'
          AND visit_end_date <= DATE '2000-12-31'""",
    "acc_empty_set": """
        SELECT 'no filter' AS "case", COUNT(*) AS n FROM condition_occurrence
        UNION ALL SELECT 'empty list', 0 UNION ALL SELECT 'empty frame', 0""",
    "date_range": f"SELECT person_id, death_date FROM death WHERE death_date {IN_STUDY}",
    "sql_query": "SELECT visit_concept_id, COUNT(*) AS n FROM visit_occurrence GROUP BY visit_concept_id",
    "csv_person": "SELECT person_id, year_of_birth, month_of_birth, CAST(gender_concept_id AS BIGINT) AS gender_concept_id, CAST(birth_datetime AS DATE) AS born FROM person",
    "csv_measurement": "SELECT measurement_id, person_id, measurement_concept_id, measurement_date, value_as_number FROM measurement",
    "csv_arms": f"SELECT {_ARM_COLUMNS}, exposure_index_date, exposure_concept_id, days_from_index, age_at_exposure_index, user_flag FROM arms",
    "csv_quoted": """SELECT doc_id, replace(text, 'e ', 'e", "') AS text FROM documents""",
    "csv_delimited": "SELECT concept_id, concept_name, domain_id, standard_concept FROM concept",
    "csv_dates": "SELECT person_id, death_date FROM death",
    "csv_dropped": """
        SELECT CASE WHEN visit_occurrence_id % 5 = 0 THEN 'visit_occurrence_id' ELSE 'visit_start_date' END AS reason, COUNT(*) AS n
        FROM visit_occurrence WHERE visit_occurrence_id % 5 = 0 OR visit_occurrence_id % 3 = 0 GROUP BY 1""",
    "file_drugs": """
        SELECT set_name, COUNT(*) AS n FROM (
            SELECT 'five' AS set_name, concept_id FROM concept WHERE concept_id < 200 AND concept_id % 20 = 5
            UNION SELECT 'ten', descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (
                SELECT concept_id FROM concept WHERE concept_id IN (100, 110))) s
        JOIN drug_exposure ON drug_concept_id = concept_id GROUP BY set_name""",
    "file_features": """
        SELECT 'f' || CAST(drug_concept_id % 10 AS VARCHAR) AS set_name, COUNT(*) AS n
        FROM drug_exposure WHERE drug_concept_id % 10 < 3
          AND drug_concept_id IN (SELECT concept_id FROM concept WHERE concept_id < 200) GROUP BY 1""",
    "file_sets": """
        SELECT set_name, COUNT(*) AS n FROM drug_exposure CROSS JOIN (SELECT unnest(['lab', 'set']) AS set_name)
        WHERE drug_concept_id IN (SELECT concept_id FROM concept WHERE concept_id IN (100, 110)) GROUP BY 1""",
    "written_matching": """
        SELECT 'matched_users' AS name, COUNT(*) AS n FROM matched WHERE treatment = 1
        UNION ALL SELECT 'matched_nonusers', COUNT(*) FROM matched WHERE treatment = 0
        UNION ALL SELECT 'match_pairs', COUNT(*) FROM pairs
        UNION ALL SELECT 'balance_stats', COUNT(*) FROM smd_after
        UNION ALL SELECT 'arms', COUNT(*) FROM arms""",
    "ps_gradient": "SELECT 'intercept' AS feature, 0.0::DOUBLE AS gradient UNION ALL "
    + " UNION ALL ".join(f"SELECT 'z_{f}', 0.0 FROM feature_medians WHERE {f} IS NOT NULL" for f in FEATURES),
    "cox_limits": _cox("outcome"),
    "cox_subgroup_limits": _cox("outcome, stratum"),
    "study_evidence_balance": "SELECT feature, ROUND(smd, 6) AS smd_before FROM smd_before WHERE user_mean IS NOT NULL AND non_user_mean IS NOT NULL",
    "study_evidence_attrition": """
        SELECT NULL::INTEGER AS user_flag, 'cohort' AS step, COUNT(*) AS n FROM cohort
        UNION ALL SELECT user_flag, step, COUNT(*) FROM arms CROSS JOIN (SELECT unnest(['initial', 'eligible']) AS step) GROUP BY user_flag, step""",
    "study_windowed_attrition": f"""
        WITH dated AS (SELECT *, CASE WHEN user_flag = 1 THEN exposure_index_date ELSE obesity_entry_date END AS t0 FROM w_arms),
        ruled AS (
            SELECT d.person_id, d.user_flag, {_whole_years('d.birth_date', 'd.t0')} >= 30 AS old_enough, d.visits_before_entry > 0 AS visited,
                   bool_or(s.concept_id IS NOT NULL AND {CONDITION_DAY} <= d.t0) AS excluded
            FROM dated d LEFT JOIN condition_occurrence e ON e.person_id = d.person_id
            LEFT JOIN ({_expanded("30")}) s ON s.concept_id = e.condition_concept_id GROUP BY ALL)
        SELECT NULL::INTEGER AS user_flag, 'cohort' AS step, COUNT(*) AS n FROM w_cohort
        UNION ALL SELECT user_flag, 'initial', COUNT(*) FROM ruled GROUP BY user_flag
        UNION ALL SELECT user_flag, 'min_age', COUNT(*) FILTER (WHERE old_enough) FROM ruled GROUP BY user_flag
        UNION ALL SELECT user_flag, 'baseline_visit', COUNT(*) FILTER (WHERE old_enough AND visited) FROM ruled GROUP BY user_flag
        UNION ALL SELECT user_flag, 'eligible', COUNT(*) FROM ruled WHERE old_enough AND visited AND excluded IS NOT TRUE GROUP BY user_flag""",
    "evidence_condition": "SELECT person_id, first_date FROM first_dx",
    "evidence_measure": "SELECT person_id, measurement_date, ROUND(value, 6) AS value FROM readings",
    "evidence_high": "SELECT person_id, first_high FROM first_high",
    "comorbidity_events": "SELECT person_id, event_date FROM comorbid",
    "evidence_banded": "SELECT person_id, measurement_date FROM banded",
    "banded_first": "SELECT person_id, first_banded FROM first_banded",
    "index_candidates": "SELECT person_id, index_date, index_source, source_rank FROM candidates",
    "index_choice": "SELECT person_id, index_date, index_source FROM chosen",
    "index_flags": "SELECT * FROM flagged",
    "index_capped": "SELECT person_id, index_date, index_source FROM chosen ORDER BY person_id LIMIT 100",
    "birth_date": "SELECT person_id, birth_date, gender_concept_id, race_concept_id, ethnicity_concept_id FROM core",
    "prior_visit": "SELECT person_id, index_date FROM chosen WHERE person_id IN (SELECT person_id FROM seen_before)",
    "coverage": "SELECT person_id, index_date FROM chosen WHERE person_id IN (SELECT person_id FROM covered_index)",
    "death_first": "SELECT person_id, death_date FROM first_death",
    "cohort": "SELECT * FROM cohort",
    "attrition": "SELECT 'evidence' AS step, COUNT(DISTINCT person_id) AS n FROM chosen UNION ALL SELECT 'cohort', COUNT(*) FROM cohort",
    "windowed_evidence": "SELECT person_id, obesity_date, record_id, obesity_criterion, ROUND(bmi_value, 6) AS bmi_value FROM w_evidence",
    "windowed_entry": "SELECT person_id, obesity_entry_date, obesity_criterion FROM w_entry",
    "cohort_windowed": f"SELECT {_W_COLUMNS} FROM w_cohort",
    "cohort_windowed_specific": f"SELECT {_W_COLUMNS} FROM w_cohort WHERE has_specific_condition",
    "visit_counts": "SELECT person_id, visits_before_entry FROM w_cohort",
    "specific_condition": "SELECT person_id, has_specific_condition FROM w_cohort",
    "evidence_counts": """
        SELECT obesity_criterion, COUNT(DISTINCT person_id) AS n_persons, COUNT(*) AS n_records
        FROM w_evidence GROUP BY obesity_criterion""",
    "entry_ages": """
        SELECT COUNT(*) AS n_persons, MIN(age_at_obesity_entry) AS min_age, MAX(age_at_obesity_entry) AS max_age,
               COUNT(*) FILTER (WHERE visits_before_entry >= 1) AS n_with_visit FROM w_cohort""",
    "exposure_events": "SELECT person_id, concept_id, event_date, event_id FROM exposures",
    "first_exposure": "SELECT person_id, exposure_date, exposure_concept_id FROM first_use",
    "bucketed_cohort": "SELECT * FROM cohort",
    "written_results": "SELECT user_person_id, nonuser_person_id, ROUND(gap, 6) AS ps_distance FROM pairs",
    "observation_islands": _islands(0),
    "observation_islands_gap": _islands(180),
    "follow_up_islands": f"""
        SELECT i.person_id, i.index_date FROM indexed i WHERE EXISTS (
            SELECT 1 FROM ({_islands(180)}) o WHERE o.person_id = i.person_id
            AND i.index_date BETWEEN o.obs_start AND o.obs_end AND date_diff('day', i.index_date, o.obs_end) >= 730)""",
    "survival_islands": f"""
        WITH seen AS (
            SELECT m.person_id, m.treatment, m.index_date, d.death_date,
                   LEAST(o.obs_end, d.death_date, DATE '2001-12-31', CAST(m.index_date + INTERVAL 60 MONTH AS DATE)) AS stop
            FROM scored m JOIN ({_islands(0)}) o ON o.person_id = m.person_id AND m.index_date BETWEEN o.obs_start AND o.obs_end
            LEFT JOIN first_death d ON d.person_id = m.person_id),
        firsts AS (
            SELECT s.*, w.outcome, (SELECT MIN(e.day) FROM outcome_events e WHERE e.person_id = s.person_id AND e.outcome = w.outcome AND e.day > s.index_date) AS hit
            FROM seen s CROSS JOIN (SELECT unnest(['out_a', 'out_b']) AS outcome) w)
        SELECT person_id, treatment, outcome, CAST(date_diff('day', index_date, LEAST(stop, COALESCE(hit, stop))) AS INTEGER) AS T,
               CAST(COALESCE(hit <= stop, FALSE) AS INTEGER) AS E
        FROM firsts WHERE stop >= index_date""",
    "observation_spans": """
        SELECT person_id, observation_period_start_date AS obs_start, MAX(observation_period_end_date) AS obs_end
        FROM observation_period GROUP BY 1, 2""",
    "exposure_candidates": "SELECT person_id, exposure_index_date, exposure_concept_id, days_from_index FROM user_candidates",
    "users": """
        SELECT person_id, exposure_index_date, exposure_concept_id, days_from_index, obesity_index_date, index_source,
               birth_date, age_at_exposure_index, gender_concept_id, race_concept_id, ethnicity_concept_id, death_date
        FROM arms WHERE user_flag = 1""",
    "non_users": f"SELECT {_ARM_COLUMNS} FROM arms WHERE user_flag = 0",
    "non_users_clean": f"SELECT {_ARM_COLUMNS} FROM arms WHERE user_flag = 0 AND person_id NOT IN (SELECT person_id FROM ever_treated)",
    "arms_clean": "SELECT person_id, user_flag FROM arms WHERE user_flag = 1 OR person_id NOT IN (SELECT person_id FROM ever_treated)",
    "arms_unexposed": "SELECT 0 AS user_flag, COUNT(*) AS n FROM base HAVING COUNT(*) > 0",
    "arms": f"SELECT {_ARM_COLUMNS}, exposure_index_date, exposure_concept_id, days_from_index, age_at_exposure_index, user_flag FROM arms",
    "arm_counts": "SELECT user_flag, COUNT(*) AS n FROM arms GROUP BY user_flag",
    "labelled_exposures": """
        SELECT person_id, event_date, FIRST(exposure_drug ORDER BY event_id) AS exposure_drug
        FROM w_exposures GROUP BY person_id, event_date""",
    "users_windowed": f"SELECT {_W_COLUMNS}, exposure_index_date, exposure_drug FROM w_arms WHERE user_flag = 1",
    "non_users_windowed": f"SELECT {_W_COLUMNS} FROM w_arms WHERE user_flag = 0",
    "drug_distribution": "SELECT exposure_drug, COUNT(*) AS n FROM w_arms WHERE user_flag = 1 GROUP BY exposure_drug",
    "drug_universe": "SELECT person_id FROM universe",
    "drug_table": "SELECT * FROM wide",
    "drug_table_cohort": "SELECT c.person_id, " + ", ".join(
        f"COALESCE(w.{d}_used, 0) AS {d}_used, w.{d}_first_date" for d in ("alpha", "beta", "gamma", "delta")
    ) + " FROM cohort c LEFT JOIN wide w ON w.person_id = c.person_id",
    "drug_usage": " UNION ALL ".join(
        f"SELECT '{d}' AS drug, COUNT(*) AS n_persons, CAST(SUM({d}_used) AS BIGINT) AS n_users, "
        f"ROUND(SUM({d}_used) * 100.0 / COUNT(*), 6) AS percent FROM wide"
        for d in ("alpha", "beta", "gamma", "delta")
    ),
    "drug_count_distribution": """
        SELECT alpha_used + beta_used + gamma_used + delta_used AS drug_count, COUNT(*) AS person_count
        FROM wide GROUP BY 1""",
    "eligible_users": f"SELECT {_W_COLUMNS}, exposure_index_date, exposure_drug FROM w_arms WHERE user_flag = 1 AND age_at_obesity_entry >= 30 AND visits_before_entry >= 1",
    "eligible_non_users": f"SELECT {_W_COLUMNS} FROM w_arms WHERE user_flag = 0 AND age_at_obesity_entry >= 30 AND visits_before_entry >= 1",
    "eligibility_attrition": """
        SELECT user_flag, 'initial' AS step, COUNT(*) AS n FROM w_arms GROUP BY user_flag
        UNION ALL SELECT user_flag, 'min_age', COUNT(*) FILTER (WHERE age_at_obesity_entry >= 30) FROM w_arms GROUP BY user_flag
        UNION ALL SELECT user_flag, 'baseline_visit',
               COUNT(*) FILTER (WHERE age_at_obesity_entry >= 30 AND visits_before_entry >= 1) FROM w_arms GROUP BY user_flag""",
    "followup_min": """
        SELECT i.person_id, i.index_date, i.user_flag FROM indexed i WHERE EXISTS (
            SELECT 1 FROM observation_period o WHERE o.person_id = i.person_id
            AND i.index_date BETWEEN o.observation_period_start_date AND o.observation_period_end_date
            AND date_diff('day', i.index_date, o.observation_period_end_date) >= 365)""",
    **{
        f"baseline_{kind}": f"""
        SELECT i.person_id, i.user_flag FROM indexed i WHERE {test} EXISTS (
            SELECT 1 FROM condition_occurrence e WHERE e.person_id = i.person_id AND e.condition_concept_id BETWEEN 30 AND 39
            AND {CONDITION_DAY} <= i.index_date)"""
        for kind, test in {"inclusion": "", "exclusion": "NOT"}.items()
    },
    "index_dates": "SELECT person_id, user_flag, index_date FROM indexed",
    "demographics": "SELECT person_id, sex, race FROM demographics",
    "cov_conditions": "SELECT person_id, c_a, c_b, c_c FROM covariates",
    "cov_drugs": "SELECT person_id, m_a, m_b, m_none FROM covariates",
    "cov_labs": _rounded("person_id", "lab_a", "lab_b", "lab_bmi", source="covariates"),
    "cov_lookback": "SELECT i.person_id, " + ", ".join(
        f"""CAST(EXISTS (SELECT 1 FROM condition_occurrence e WHERE e.person_id = i.person_id
            AND e.condition_concept_id IN ({ids}) AND e.condition_start_date <= i.index_date
            AND e.condition_start_date >= CAST(i.index_date - INTERVAL 12 MONTH AS DATE)) AS INTEGER) AS {f}"""
        for f, ids in {"c_a": "11", "c_b": "12, 13", "c_c": "15"}.items()
    ) + " FROM indexed i",
    "lab_lookback": """
        SELECT i.person_id, (
            SELECT ROUND(arg_max(TRY_CAST(m.value_as_number AS DOUBLE), (m.measurement_date, m.measurement_id)), 6)
            FROM measurement m WHERE m.person_id = i.person_id AND m.measurement_concept_id IN (1, 2)
            AND TRY_CAST(m.value_as_number AS DOUBLE) IS NOT NULL AND m.measurement_date <= i.index_date
            AND m.measurement_date >= CAST(i.index_date - INTERVAL 12 MONTH AS DATE)) AS lab_a
        FROM indexed i""",
    "covariates": "SELECT person_id, user_flag, index_date, age_at_index, sex, race, c_a, c_b, c_c, m_a, m_b, m_none, "
    "ROUND(lab_a, 6) AS lab_a, ROUND(lab_b, 6) AS lab_b, ROUND(lab_bmi, 6) AS lab_bmi FROM covariates",
    "baseline_period": """
        SELECT person_id, CAST(index_date - INTERVAL 12 MONTH AS DATE) AS baseline_start, index_date AS baseline_end
        FROM indexed""",
    "smoking": """
        SELECT visit_occurrence_id, CASE
            WHEN code IN ('01', '1', '1.0', '02', '2', '2.0', '07', '7', '7.0', '08', '8', '8.0') THEN 'Current Smoker'
            WHEN code IN ('03', '3', '3.0') THEN 'Former Smoker' WHEN code IN ('04', '4', '4.0') THEN 'Never Smoker'
            ELSE 'Unknown' END AS smoking
        FROM (SELECT visit_occurrence_id, CASE WHEN visit_occurrence_id % 13 = 0 THEN NULL
                     WHEN visit_occurrence_id % 3 = 0 THEN '0' || CAST(visit_occurrence_id % 10 AS VARCHAR)
                     WHEN visit_occurrence_id % 3 = 1 THEN CAST(visit_occurrence_id % 10 AS VARCHAR)
                     ELSE CAST(visit_occurrence_id % 10 AS VARCHAR) || '.0' END AS code
              FROM visit_occurrence)""",
    "sex_clean": """
        SELECT person_id, CASE WHEN label IN ('F', 'M') THEN label END AS sex FROM (
            SELECT person_id, CASE gender_concept_id WHEN 8507 THEN 'M' WHEN 8532 THEN 'F' ELSE 'Unknown' END AS label FROM person)""",
    "bmi": """
        SELECT measurement_id, ROUND(TRY_CAST(value_as_number AS DOUBLE) / NULLIF(h * h, 0), 6) AS bmi
        FROM (SELECT measurement_id, value_as_number, measurement_concept_id * 20 / 100 AS h FROM measurement)""",
    "any_flag": "SELECT person_id, GREATEST(c_a, c_b, c_c) AS any_condition FROM covariates",
    "combined_arms": """
        SELECT person_id, user_flag AS treatment, exposure_index_date,
               CASE WHEN user_flag = 0 THEN age_at_index END AS age_at_index FROM arms""",
    "encode": "SELECT person_id, sex FROM encoded",
    "medians": " UNION ALL ".join(f"SELECT '{f}' AS feature, ROUND({f}, 6) AS median FROM feature_medians" for f in FEATURES),
    "medians_wide": """
        SELECT 'l_quantity' AS feature, ROUND(median(l_quantity), 6) AS median FROM lineitem
        UNION ALL SELECT 'l_extendedprice', ROUND(median(l_extendedprice), 6) FROM lineitem
        UNION ALL SELECT 'l_partkey', ROUND(median(l_partkey), 6) FROM lineitem""",
    "impute_median": _rounded("person_id, treatment", *FEATURES, source="imputed"),
    "scale_features": "SELECT i.person_id, " + ", ".join(
        f"ROUND((i.{f} - m.m_{f}) / CASE WHEN m.s_{f} = 0 THEN 1 ELSE m.s_{f} END, 6) AS z_{f}" for f in FEATURES
    ) + " FROM imputed i CROSS JOIN moments m",
    "ps_fixed": """
        SELECT person_id, treatment, ROUND(p, 6) AS propensity_score, ROUND(ln(c / (1 - c)), 6) AS logit_ps
        FROM (SELECT *, GREATEST(LEAST(p, 0.999), 0.001) AS c
              FROM (SELECT *, 1.0 / (1.0 + exp(-(6 * (logit_ps + 0.2)))) AS p FROM scored))""",
    "caliper": "SELECT ROUND(width, 6) AS caliper FROM width",
    "nearest": "SELECT user_person_id, nonuser_person_id, ROUND(gap, 6) AS ps_distance FROM nearest",
    "match_pairs": "SELECT user_person_id, nonuser_person_id, ROUND(gap, 6) AS ps_distance FROM pairs",
    "matched": "SELECT person_id, treatment, ROUND(logit_ps, 6) AS logit_ps FROM matched",
    "match_rate": """
        SELECT n_users, n_pairs, ROUND(n_pairs / n_users, 6) AS match_rate
        FROM (SELECT COUNT(*) AS n_users FROM scored WHERE treatment = 1), (SELECT COUNT(*) AS n_pairs FROM pairs)""",
    "score_ranges": """
        SELECT treatment, COUNT(*) AS n, ROUND(MIN(p), 6) AS min_score, ROUND(MAX(p), 6) AS max_score
        FROM (SELECT treatment, 1.0 / (1.0 + exp(-logit_ps)) AS p FROM scored) GROUP BY treatment""",
    "smd": _rounded("feature", "user_mean", "non_user_mean", "smd", source="smd_after"),
    "smd_before_after": """
        SELECT b.feature, ROUND(b.smd, 6) AS smd_before, ROUND(a.smd, 6) AS smd_after, a.smd <= 0.1 AS balanced
        FROM smd_before b LEFT JOIN smd_after a ON a.feature = b.feature
        WHERE b.user_mean IS NOT NULL AND b.non_user_mean IS NOT NULL""",
    "imbalance": "SELECT feature, ROUND(smd, 6) AS smd FROM smd_before WHERE smd > 0.1 ORDER BY smd_before.smd DESC, feature LIMIT 5",
    "survival_data": "SELECT person_id, treatment, outcome, T, E FROM survival",
    "survival_uncovered": """
        WITH moved AS (SELECT person_id, treatment, CAST(index_date - INTERVAL 400 DAY AS DATE) AS t0 FROM scored),
        watched AS (
            SELECT m.*, o.outcome, d.death_date,
                   LEAST(m.seen_until, DATE '2001-12-31', CAST(t0 + INTERVAL 60 MONTH AS DATE)) AS last_day
            FROM (SELECT person_id, treatment, t0, MAX(observation_period_end_date) AS seen_until FROM moved JOIN observation_period USING (person_id)
                  WHERE t0 BETWEEN observation_period_start_date AND observation_period_end_date GROUP BY ALL) m
            CROSS JOIN (SELECT unnest(['out_a', 'out_b']) AS outcome) o
            LEFT JOIN first_death d ON d.person_id = m.person_id),
        hit AS (
            SELECT w.person_id, w.treatment, w.outcome, w.t0, LEAST(w.last_day, w.death_date) AS stop,
                   MIN(e.day) FILTER (WHERE e.day > w.t0) AS first_event
            FROM watched w LEFT JOIN outcome_events e ON e.person_id = w.person_id AND e.outcome = w.outcome
            GROUP BY ALL)
        SELECT person_id, treatment, outcome, CAST(date_diff('day', t0, LEAST(stop, first_event)) AS INTEGER) AS T,
               COALESCE(first_event <= stop, FALSE)::INTEGER AS E
        FROM hit WHERE stop >= t0""",
    "survival_competing": "SELECT person_id, treatment, outcome, T, E2 AS E FROM survival",
    "risk_table": _risk("outcome"),
    "subgroup_risk": _risk("outcome, stratum"),
    "km": """
        SELECT outcome, treatment, T, CAST(at_risk AS BIGINT) AS at_risk, CAST(events AS BIGINT) AS events,
               ROUND(product(1 - events / at_risk) OVER (PARTITION BY outcome, treatment ORDER BY T), 6) AS survival
        FROM arm_risk""",
    "cif": """
        SELECT outcome, treatment, T, CAST(at_risk AS BIGINT) AS at_risk, CAST(events AS BIGINT) AS events,
               CAST(competing AS BIGINT) AS competing,
               ROUND(SUM(alive * events / at_risk) OVER (PARTITION BY outcome, treatment ORDER BY T), 6) AS incidence
        FROM (SELECT *, COALESCE(product(1 - (events + competing) / at_risk) OVER (
                  PARTITION BY outcome, treatment ORDER BY T ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS alive
              FROM arm_risk)""",
    "person_summary": """
        SELECT COUNT(DISTINCT person_id) AS n_persons, COUNT(*) AS n_records,
               ROUND(COUNT(*) / COUNT(DISTINCT person_id), 6) AS records_per_person FROM measurement""",
    "follow_up": """
        SELECT person_id, CAST(date_diff('day', s, e) AS INTEGER) AS days, ROUND(date_diff('day', s, e) / 30.44, 6) AS months,
               ROUND(date_diff('day', s, e) / 365.25, 6) AS years,
               LEAST(e, CAST(s + INTERVAL 24 MONTH AS DATE)) AS capped_end
        FROM (SELECT person_id, observation_period_start_date AS s, observation_period_end_date AS e FROM observation_period)""",
    "person_agg": f"""
        SELECT person_id, MIN({CONDITION_DAY}) AS first_day, MAX({CONDITION_DAY}) AS last_day, COUNT(*) AS n
        FROM condition_occurrence GROUP BY person_id""",
    "person_first": """
        SELECT person_id, FIRST(visit_concept_id ORDER BY visit_start_date, visit_occurrence_id) AS visit_concept_id,
               MIN(visit_start_date) AS visit_start_date FROM visit_occurrence GROUP BY person_id""",
    "last_value": """
        SELECT person_id, ROUND(arg_max(v, (measurement_date, measurement_id)), 6) AS last_value
        FROM (SELECT *, TRY_CAST(value_as_number AS DOUBLE) AS v FROM measurement) WHERE v IS NOT NULL GROUP BY person_id""",
    "parsed_dates": "SELECT visit_occurrence_id, visit_start_date AS day FROM visit_occurrence",
    "ages": f"""
        SELECT p.person_id, {_whole_years('p.birth_date', 'o.observation_period_end_date')} AS whole_years,
               {_rounded_age('p.birth_date', 'o.observation_period_end_date')} AS rounded_years
        FROM core p JOIN observation_period o ON o.person_id = p.person_id""",
}


def _needed(sql: str) -> list[str]:
    """Steps a statement reads, directly or through others, in the order they must be declared."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", todo.pop()):
            if name in STEPS and name not in wanted:
                wanted.add(name)
                todo.append(STEPS[name])
    return [name for name in STEPS if name in wanted]


def check_sql(key: str) -> str:
    """The complete statement for one registered query."""
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in _needed(CHECKS[key]))
    # A check may declare sub-queries of its own.
    own = f"SELECT * FROM ({CHECKS[key]})" if CHECKS[key].lstrip().startswith("WITH") else CHECKS[key]
    return f"WITH {steps}\n{own}" if steps else own
