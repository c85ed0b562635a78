"""Result types both engines render alike: text for dates and times, double for decimals, bigint for integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c.cast("double"), 4)
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def typed(body: str, times: Sequence[str] = (), numbers: Sequence[str] = (), counts: Sequence[str] = ()) -> str:
    """The same rendering for a DuckDB select."""
    parts = [f"CAST({c} AS VARCHAR) AS {c}" for c in times]
    parts += [f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in numbers]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in counts]
    replaced = f" REPLACE ({', '.join(parts)})" if parts else ""
    return f"SELECT *{replaced} FROM ({body}) AS result"
