"""Small frames for fixtures."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from parceltrail.sources.tables import SCHEMAS, Tables


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows given as dicts; columns that are left out are NULL."""
    schema = SCHEMAS[name]
    for row in rows:
        unknown = set(row) - set(schema.fieldNames())
        assert not unknown, f"{name} has no {unknown}"
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], schema)


def tables(spark: SparkSession, **rows: list[dict]) -> Tables:
    """All tables, empty unless rows are given."""
    return Tables({name: table(spark, name, rows.get(name, [])) for name in SCHEMAS})


def options(**groups: dict[str, str]) -> list[dict]:
    return [
        {"type_option": kind, "option_value": value, "option_name": label}
        for kind, codes in groups.items()
        for value, label in codes.items()
    ]


def by_key(df: DataFrame, key: str = "waybill_no") -> dict:
    rows = df.collect()
    found = {row[key]: row.asDict() for row in rows}
    assert len(found) == len(rows), "key repeats"
    return found
