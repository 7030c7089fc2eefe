"""Labels cut out of numbers, and lookups in small fixed vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.catalogue import NEGATIVE, NEUTRAL, POSITIVE, PRIORITY_TIERS


def valence_label(score: Column, cut: float = 0.05) -> Column:
    """Positive from ``cut`` up, negative from ``-cut`` down, neutral between."""
    return (
        F.when(score >= F.lit(cut), F.lit(POSITIVE))
        .when(score <= F.lit(-cut), F.lit(NEGATIVE))
        .otherwise(F.lit(NEUTRAL))
    )


def tier_of(score: Column, tiers: Sequence[tuple[str, float | None]] = PRIORITY_TIERS) -> Column:
    """First tier whose floor the score reaches; a null score gets the last tier."""
    *upper, (last, _) = tiers
    out = None
    for name, floor in upper:
        test = score >= F.lit(float(floor))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit(last))


def majority_label(negatives: Column, neutrals: Column, positives: Column) -> Column:
    """Vote over a message's aspect labels; ties lean to the negative side."""
    return (
        F.when(
            negatives >= F.greatest(positives, neutrals),
            F.when(negatives > 0, NEGATIVE).when(neutrals > 0, NEUTRAL).otherwise(POSITIVE),
        )
        .when(positives > neutrals, POSITIVE)
        .otherwise(NEUTRAL)
    )


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value of a small fixed dictionary; null for unknown and for null keys."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(pairs, key)


def label_or_code(key: Column, table: Mapping[str, str]) -> Column:
    """Like :func:`lookup`, but an unknown code stands for itself."""
    return F.coalesce(lookup(key, table), key)
