"""Text cut into tokens, clauses and list columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.catalogue import CLAUSE_BREAK

#: Words of two or more characters of any script.
WORDS = r"(?U)\b\w\w+\b"
#: Words of two or more ASCII letters or digits (same matches in RE2 engines).
ASCII_WORDS = r"[a-z0-9]{2,}"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression that is used twice, or inside a lambda, would otherwise be
    evaluated at each use: the optimiser folds a projected column back into the
    lambda that reads it.
    """
    return F.get(F.transform(F.array(value), body), 0)


def tokens(text: Column, pattern: str = WORDS) -> Column:
    """Lower-cased tokens in text order, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def word_grams(words: Column, longest: int) -> Column:
    """The words plus all runs of 2..``longest`` words, joined by a space."""
    parts, runs = [words], words
    for size in range(2, longest + 1):
        following = F.slice(words, size, F.greatest(F.size(words), F.lit(1)))
        # the shorter side is padded with null, and null + text is null
        runs = F.zip_with(runs, following, lambda a, b: F.concat(a, F.lit(" "), b))
        runs = F.filter(runs, lambda run: run.isNotNull())
        parts.append(runs)
    return F.concat(*parts)


def clauses(text: Column, pattern: str = CLAUSE_BREAK) -> Column:
    """Clauses of a message, in text order, without the blank ones."""
    pieces = F.split(text, "(?U)" + pattern)
    return F.filter(pieces, lambda piece: piece.rlike(r"(?U)\S"))


def joined(items: Column) -> Column:
    """A list column as the pipe-joined text used in CSV files."""
    return F.array_join(items, "|")


def split_list(text: Column) -> Column:
    return F.split(text, r"\|")


def split_pairs(text: Column, first: str = "theme", second: str = "sentiment") -> Column:
    """``a:x|b:y`` as an array of structs."""

    def pair(item: Column) -> Column:
        halves = F.split(item, ":")
        return F.struct(F.get(halves, 0).alias(first), F.get(halves, 1).alias(second))

    return F.transform(split_list(text), pair)


def joined_pairs(
    pairs: Column, first: str = "theme", second: str = "sentiment", empty: str = ""
) -> Column:
    """The inverse; an empty list becomes ``empty``."""
    text = joined(F.transform(pairs, lambda p: F.concat_ws(":", p[first], p[second])))
    return F.when(F.size(pairs) == 0, F.lit(empty)).otherwise(text)
