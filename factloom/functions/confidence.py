"""Confidence by source, decay by age, and presentation bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.numeric import round_exact
from factloom.functions.time import whole_days

# Base confidence by kind of source, and the score of an unknown kind.
SOURCE_SCORES = {
    "government_registry": 0.95,
    "signed_legal_document": 0.92,
    "operational_system": 0.85,
    "third_party_data_provider": 0.75,
    "manual_crm_entry": 0.60,
    "web_scraping": 0.50,
    "user_submitted_form": 0.40,
    "ml_model_inference": 0.35,
    "free_text_extraction": 0.30,
}
UNKNOWN_SOURCE_SCORE = 0.40

# Rate-of-change class -> (lowest factor, days until the line reaches zero).
DECAY_CLASSES = {"fast": (0.1, 30.0), "medium": (0.3, 365.0), "slow": (0.6, 1825.0)}
STEADY_FACTOR = 0.95

# Lower edges of the presentation bands.
ASSERTIVE_FROM = 0.80
HEDGED_FROM = 0.50


def source_confidence(
    source_type: Column,
    scores: dict[str, float] | None = None,
    default: float = UNKNOWN_SOURCE_SCORE,
) -> Column:
    """Base confidence of a source type; unknown or NULL types get the default."""
    scores = SOURCE_SCORES if scores is None else scores
    table = F.create_map(*[F.lit(x) for pair in scores.items() for x in pair])
    return F.coalesce(F.try_element_at(table, source_type), F.lit(default))


def decay_factor(rate_class: Column, asserted_at: Column, now: Column) -> Column:
    """Share of confidence left after the whole days since assertion."""
    age = whole_days(now, asserted_at).cast("double")
    factor = F.when(F.lit(False), F.lit(0.0))
    for name, (lowest, span) in DECAY_CLASSES.items():
        factor = factor.when(
            rate_class == name, F.greatest(F.lit(lowest), F.lit(1.0) - age / F.lit(span))
        )
    return factor.otherwise(F.lit(STEADY_FACTOR))


def decayed(confidence: Column, rate_class: Column, asserted_at: Column, now: Column) -> Column:
    return round_exact(confidence.cast("double") * decay_factor(rate_class, asserted_at, now), 2)


def confidence_band(confidence: Column) -> Column:
    """How a value may be presented: assertive, hedged or uncertain."""
    return (
        F.when(confidence >= ASSERTIVE_FROM, "assertive")
        .when(confidence >= HEDGED_FROM, "hedged")
        .when(confidence.isNotNull(), "uncertain")
    )
