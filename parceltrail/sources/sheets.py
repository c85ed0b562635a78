"""The exported cargo sheet as CSV: rows that fit its schema, and a report of those that don't.

All cells are read as text and converted one by one, so a rejected row names the cells that are no number or no date. A row
with too few or too many cells is rejected as a whole. Nothing turns into NULL unreported: a row is in exactly one of the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parceltrail.sources.tables import SCHEMAS

SHEET = "smu_template_2"
DATES = {"report_date": "M/d/yyyy"}
_MALFORMED = "__malformed"


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, and the raw line where its cells don't match the header's."""
    texts = [T.StructField(f.name, T.StringType()) for f in SCHEMAS[SHEET]]
    schema = T.StructType([*texts, T.StructField(_MALFORMED, T.StringType())])
    reader = spark.read.schema(schema).option("columnPruning", "false")  # a row is judged by all of its cells
    return reader.csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_MALFORMED)


def _converted() -> dict[str, Column]:
    """Every column that isn't plain text, NULL where the cell can't be read as what it should be."""
    numbers = {f.name: F.col(f.name).try_cast(f.dataType) for f in SCHEMAS[SHEET] if f.dataType != T.StringType()}
    return numbers | {name: F.try_to_timestamp(F.col(name), F.lit(form)).cast("date") for name, form in DATES.items()}


def _reasons() -> Column:
    """What is wrong with a row: an array of texts, empty for a good one."""
    cells = [
        F.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"{name} is no {'date' if name in DATES else 'number'}"))
        for name, value in _converted().items()
    ]
    whole = F.when(F.col(_MALFORMED).isNotNull(), F.array(F.lit("wrong number of cells")))
    return F.coalesce(whole, F.array_compact(F.array(*cells)))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The rows that fit the schema; dates stay text until the plan parses them."""
    rows = _cells(spark, path).where(F.size(_reasons()) == 0)
    numbers = {name: value for name, value in _converted().items() if name not in DATES}
    return rows.withColumns(numbers).select(*SCHEMAS[SHEET].fieldNames())


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """line and reason of every other row: the raw line, or the cells as CSV, and what is wrong with it."""
    cells = F.to_csv(F.struct(*SCHEMAS[SHEET].fieldNames()))
    rows = _cells(spark, path).withColumn("reasons", _reasons()).where(F.size("reasons") > 0)
    return rows.select(F.coalesce(_MALFORMED, cells).alias("line"), F.array_join("reasons", "; ").alias("reason"))
