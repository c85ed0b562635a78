"""Facts clustered by parcel: catalog tables bucketed and sorted by the parcel number.

Reports group and join the facts by parcel. Over clustered facts Spark does that bucket by bucket, without an exchange, and
where each bucket is one file (as written here) without a sort. All facts of a report should have the same number of buckets.

A bucket is read by one task, so a parcel that holds a large share of a log must not be clustered: such a log stays as it is,
dated, where exchanges pre-aggregate and AQE splits. The writer looks for such keys first and refuses them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from parceltrail.operators.skew import hot_groups

KEY = "waybill_no"
#: Buckets in order are as good as sorted if each is one file; off by default in Spark, as older writers made several.
READ_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class HotKey(ValueError):
    """A key holds so many rows that one task should not read them."""


def write_clustered(
    df: DataFrame, table: str, buckets: int, hot_rows: int, key: str = KEY, path: str | None = None, then_by: Sequence[str] = ()
) -> None:
    """Replace a catalog table by `df`, bucketed by `key` and sorted by it and `then_by`, a file for each bucket.

    Raises HotKey, and writes nothing, if a key (or the missing one) has `hot_rows` rows or more. `path` makes an external
    table.
    """
    found = hot_groups(df.select(key), [key], hot_rows).take(1)
    if found:
        raise HotKey(f"{table}: {key} {found[0][0]!r} has {found[0]['__n']} rows, {hot_rows} or more")
    # Rows go to tasks by the hash that buckets have, so every task writes one bucket.
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *then_by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    """A clustered table, with the session told to trust the order inside its buckets."""
    spark.conf.set(READ_ORDER, "true")
    return spark.table(table)
