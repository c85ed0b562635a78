"""Full-outer merge of two sides with a policy per output column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pick:
    """How one output column is taken from the left and right rows."""

    left: str | None = None
    right: str | None = None
    switch: str | None = None

    def expression(self) -> str:
        """SQL over the sides `l` and `r`."""
        left, right = f"l.`{self.left}`", f"r.`{self.right}`"
        if self.switch:
            return f"CASE WHEN l.`{self.switch}` IS NULL THEN {left} ELSE {right} END"
        if self.left and self.right:
            return f"coalesce({left}, {right})"
        return left if self.left else right


def prefer_left(left: str, right: str | None = None) -> Pick:
    """The left value, or the right one where the left is NULL or absent."""
    return Pick(left, right or left)


def only_left(name: str) -> Pick:
    return Pick(left=name)


def only_right(name: str) -> Pick:
    return Pick(right=name)


def right_once_set(switch: str, left: str, right: str | None = None) -> Pick:
    """The right value once the left `switch` column is set; until then the left value."""
    return Pick(left, right or left, switch)


def merge(left: DataFrame, right: DataFrame, key: str, policy: Mapping[str, Pick], how: str = "full") -> DataFrame:
    joined = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), how)
    return joined.selectExpr(*[f"{pick.expression()} AS `{out}`" for out, pick in policy.items()])
