"""Classes of a text column, by built-in predicates only."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

Rules = Mapping[str, Callable[[Column], Column]]


def starts_with(letter: str) -> Callable[[Column], Column]:
    """Starts with ``letter`` in either case; false for an empty text."""
    return lambda text: text.ilike(f"{letter}%")


def contains(part: str) -> Callable[[Column], Column]:
    return lambda text: text.contains(part)


# The two city classes.
CITY_CLASSES: Rules = {"starts_with_a": starts_with("a"), "contains_hyphen": contains("-")}


def exclusive_class(text: Column, rules: Rules = CITY_CLASSES) -> Column:
    """The first class whose rule holds, else null."""
    return F.coalesce(*[F.when(rule(text), F.lit(name)) for name, rule in rules.items()])


def overlapping_classes(text: Column, rules: Rules = CITY_CLASSES) -> Column:
    """Array of every class whose rule holds."""
    return F.array_compact(F.array(*[F.when(rule(text), F.lit(name)) for name, rule in rules.items()]))
