"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stack_rows(*parts: DataFrame) -> DataFrame:
    """All rows of parts that have the same columns in the same order."""
    for part in parts[1:]:
        if part.columns != parts[0].columns:
            raise ValueError(f"columns differ: {parts[0].columns} and {part.columns}")
    return reduce(DataFrame.unionByName, parts)
