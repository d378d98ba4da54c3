"""Declared column types of the clinical common data model.

Only columns the operators use are listed. Other columns of a file are carried along as text.
"""

from __future__ import annotations

TABLE_TYPES: dict[str, dict[str, str]] = {
    "person": {
        "person_id": "bigint",
        "gender_concept_id": "bigint",
        "year_of_birth": "int",
        "month_of_birth": "int",
        "day_of_birth": "int",
        "birth_datetime": "timestamp",
        "race_concept_id": "bigint",
        "ethnicity_concept_id": "bigint",
    },
    "observation_period": {
        "observation_period_id": "bigint",
        "person_id": "bigint",
        "observation_period_start_date": "date",
        "observation_period_end_date": "date",
    },
    "visit_occurrence": {
        "visit_occurrence_id": "bigint",
        "person_id": "bigint",
        "visit_concept_id": "bigint",
        "visit_start_date": "date",
        "visit_start_datetime": "timestamp",
        "visit_end_date": "date",
        "visit_end_datetime": "timestamp",
    },
    "condition_occurrence": {
        "condition_occurrence_id": "bigint",
        "person_id": "bigint",
        "condition_concept_id": "bigint",
        "condition_start_date": "date",
        "condition_start_datetime": "timestamp",
    },
    "drug_exposure": {
        "drug_exposure_id": "bigint",
        "person_id": "bigint",
        "drug_concept_id": "bigint",
        "drug_exposure_start_date": "date",
        "drug_exposure_start_datetime": "timestamp",
    },
    "procedure_occurrence": {
        "procedure_occurrence_id": "bigint",
        "person_id": "bigint",
        "procedure_concept_id": "bigint",
        "procedure_date": "date",
    },
    # The value stays text: one unreadable reading must not drop the whole record.
    "measurement": {
        "measurement_id": "bigint",
        "person_id": "bigint",
        "measurement_concept_id": "bigint",
        "measurement_date": "date",
        "measurement_datetime": "timestamp",
        "value_as_number": "string",
    },
    "observation": {"observation_id": "bigint", "person_id": "bigint"},
    "death": {"person_id": "bigint", "death_date": "date"},
    "concept": {
        "concept_id": "bigint",
        "concept_name": "string",
        "concept_code": "string",
        "concept_class_id": "string",
        "vocabulary_id": "string",
        "domain_id": "string",
        "standard_concept": "string",
    },
    "concept_ancestor": {"ancestor_concept_id": "bigint", "descendant_concept_id": "bigint"},
    "concept_relationship": {"concept_id_1": "bigint", "concept_id_2": "bigint"},
    "vocabulary": {"vocabulary_id": "string"},
    "drug_strength": {"drug_concept_id": "bigint", "ingredient_concept_id": "bigint"},
}

# Column each fact table is looked up by, used to sort converted files.
CONCEPT_COLUMN = {
    "visit_occurrence": "visit_concept_id",
    "condition_occurrence": "condition_concept_id",
    "drug_exposure": "drug_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "measurement": "measurement_concept_id",
    "concept_ancestor": "ancestor_concept_id",
}
