"""Ordered classification rules: the first rule that holds gives the label."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Label = str | int | None


def first_match(rules: Iterable[tuple[Column, Label | Column]], default: Label | Column = None) -> Column:
    """Label of the first rule whose test is true; a NULL test does not match."""
    chain = None
    for test, label in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    if chain is None:
        raise ValueError("at least one rule is needed")
    if default is None:
        return chain
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def by_value(value: Column, classes: Mapping[str, Sequence[str]]) -> list[tuple[Column, Label]]:
    """Rules that map listed values to the name of their class."""
    return [(value.isin(*members), name) for name, members in classes.items()]


def contains_any(value: Column, *parts: str) -> Column:
    test = value.contains(parts[0])
    for part in parts[1:]:
        test = test | value.contains(part)
    return test


def buckets(value: Column, bounds: Sequence[tuple[int | None, int | None, str]]) -> Column:
    """Label of the first closed range holding the value; None leaves an end open."""
    rules = []
    for low, high, label in bounds:
        if low is None:
            test = value <= high
        elif high is None:
            test = value >= low
        else:
            test = value.between(low, high)
        rules.append((test, label))
    return first_match(rules)
