"""Hype expressions: lexicon score, guards, bands and inherited confidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlytics.functions.text import has_three_characters

# Hype lexicon and weights, each term counted once per text.
STRONG_TERMS = ["🚀", "moon", "diamond hands", "lfg", "yolo", "💎", "🙌"]
MEDIUM_TERMS = ["let's go", "i'm in", "buying", "hold", "bullish"]
NEGATIVE_TERMS = ["risky", "careful", "not sure", "bear", "sell"]
STRONG_WEIGHT = 0.3
MEDIUM_WEIGHT = 0.2
NEGATIVE_WEIGHT = -0.2
TRIPLE_EXCLAMATION = 0.2
EXCLAMATION = 0.1
ALL_CAPS = 0.2
# Inheritance rules.
HYPE_THRESHOLD = 0.3
CONTEXT_BONUS = 0.2
CONTEXT_CAP = 0.75
PARENT_FACTOR = 0.8
PARENT_CAP = 0.5
# Lower ends of the hype bands, highest first.
BANDS = [
    (0.9, "0.90-1.00"),
    (0.7, "0.70-0.89"),
    (0.5, "0.50-0.69"),
    (0.3, "0.30-0.49"),
]
LOWEST_BAND = "0.00-0.29"


def clamp_unit(score: Column) -> Column:
    """Score as a number in [0, 1]; anything that is not a number is 0."""
    number = F.coalesce(score.try_cast("double"), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))


def lexicon_hype(text: Column, quiet: Column | None = None) -> Column:
    """Native hype score of a text, in [0, 1]; ``quiet`` is its lower-case form, if at hand."""
    quiet = F.lower(text) if quiet is None else quiet
    weights = (
        [(term, STRONG_WEIGHT) for term in STRONG_TERMS]
        + [(term, MEDIUM_WEIGHT) for term in MEDIUM_TERMS]
        + [(term, NEGATIVE_WEIGHT) for term in NEGATIVE_TERMS]
    )
    parts = [F.when(quiet.contains(term), weight).otherwise(0.0) for term, weight in weights]
    parts.append(
        F.when(text.contains("!!!"), TRIPLE_EXCLAMATION)
        .when(text.contains("!"), EXCLAMATION)
        .otherwise(0.0)
    )
    shouted = (F.upper(text) == text) & (quiet != text) & (F.length(text) > 3)
    parts.append(F.when(shouted, ALL_CAPS).otherwise(0.0))
    return clamp_unit(reduce(lambda left, right: left + right, parts, F.lit(0.0)))


def guarded_hype(text: Column, score: Column) -> Column:
    """``score`` in [0, 1], 0 for texts too short to carry any mood."""
    return F.when(has_three_characters(text), clamp_unit(score)).otherwise(0.0)


def hype_band(score: Column) -> Column:
    rounded = F.round(score, 2)
    chain = F.when(rounded >= BANDS[0][0], BANDS[0][1])
    for low, label in BANDS[1:]:
        chain = chain.when(rounded >= low, label)
    return chain.otherwise(LOWEST_BAND)


def context_confidence(hype: Column) -> Column:
    """Confidence of a ticker a comment takes from its post."""
    return F.least(F.lit(CONTEXT_CAP), hype + F.lit(CONTEXT_BONUS))


def parent_confidence(confidence: Column, distance: Column) -> Column:
    """Confidence of a ticker handed down ``distance`` >= 1 replies.

    Only the first step can meet the cap, so later steps are a power.  ``least`` skips
    nulls, hence the guard.
    """
    first = F.least(F.lit(PARENT_CAP), confidence * PARENT_FACTOR)
    return F.when(
        confidence.isNotNull(), first * F.pow(F.lit(PARENT_FACTOR), (distance - 1).cast("double"))
    )
