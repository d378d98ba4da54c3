"""Ready-made parameters of the wide drug table."""

from __future__ import annotations

from ..sources.concept_files import ConceptSpec

# Ingredient concepts and window of the incretin drug table.
INGREDIENTS = {
    "semaglutide": 793143,
    "liraglutide": 40170911,
    "dulaglutide": 45774435,
    "exenatide": 1583722,
    "lixisenatide": 44506754,
    "albiglutide": 44816332,
    "tirzepatide": 779705,
}
WINDOW_START, WINDOW_END = "2015-01-01", "2025-09-30"


def ingredient_specs() -> dict[str, ConceptSpec]:
    return {name: ConceptSpec((concept,)) for name, concept in INGREDIENTS.items()}
