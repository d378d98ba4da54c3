"""Parameters of the study the registered queries run."""

from __future__ import annotations

from cohortry.plans.study import WINDOWED, Study
from cohortry.sources.concept_files import ConceptSpec

DRUGS = {
    "alpha": ConceptSpec((100,)),
    "beta": ConceptSpec((110,)),
    "gamma": ConceptSpec((120,)),
    "delta": ConceptSpec(()),
}

STUDY = Study(
    study_start="1995-01-01",
    study_end="2001-12-31",
    min_index_date="1995-03-01",
    conditions=ConceptSpec((0,)),
    measurements=ConceptSpec((0,), include_descendants=False),
    comorbidities=ConceptSpec((20,)),
    exposure=ConceptSpec((100, 110, 120)),
    drugs=DRUGS,
    condition_features={"c_a": (11,), "c_b": (12, 13), "c_c": (15,)},
    drug_features={"m_a": (50,), "m_b": (60, 61), "m_none": ()},
    labs={"lab_a": (1, 2), "lab_b": (3,), "lab_bmi": (0,)},
    matching_features=("age_at_index", "sex", "c_a", "c_b", "c_c", "m_a", "m_b", "lab_a", "lab_b", "lab_bmi"),
    outcomes={"out_a": (21, 22), "out_b": (5, 6, 7)},
    max_followup_years=5,
)

WINDOWED_STUDY = STUDY.with_changes(
    rules=WINDOWED,
    specific=ConceptSpec((30,), include_self=False),
    matching_features=("age_at_obesity_entry",) + STUDY.matching_features[1:],
)
