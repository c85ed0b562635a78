"""Refreshing a stored mart after more rows came in: only parcels with new rows are recomputed, only their partitions rewritten.

For reports whose rows depend on one parcel's rows in the facts, on dimensions and on the day. A run keeps a list of the
input files it read beside the marts. The next run reads the parcel numbers of new files, whatever their rows' times, and
computes the report over those parcels alone. Their old and new partitions of the mart are written again, with the rows of
other parcels taken over. Without such a list, on another day, with other options, after a dimension changed or a file left
(a compaction), the whole mart is replaced.

Facts must be folders of files that are added and never changed. The list is written last: a run that fails is made up for by
the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parceltrail.functions.clock import Clock
from parceltrail.operators.skew import same_keys
from parceltrail.sources.tables import SCHEMAS, Tables, read_mart, write_mart

KEY = "waybill_no"
FACTS = [name for name, schema in SCHEMAS.items() if KEY in schema.fieldNames()]
MARK = "__mark"


def day_of(clock: Clock, *options: object) -> str:
    """What must be the same for two runs to have equal rows for a parcel without new rows."""
    return " ".join(map(str, [clock.utc_today, clock.local_today, clock.tz, *options]))


def input_files(t: Tables, names: Sequence[str]) -> DataFrame:
    """name and path of every file of the named tables."""
    parts = [t[name].select(F.lit(name).alias("name"), F.col("_metadata.file_path").alias("path")).distinct() for name in names]
    return reduce(DataFrame.unionByName, parts)


def _file_system(spark: SparkSession, path: str):
    """(the file system of a path, the path) by Hadoop's API."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def make_folder(spark: SparkSession, path: str) -> None:
    system, hadoop = _file_system(spark, path)
    system.mkdirs(hadoop)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    system, hadoop = _file_system(spark, path)
    return spark.read.schema("name string, path string").parquet(path) if system.exists(hadoop) else None


def new_files(now: DataFrame, before: DataFrame) -> dict[str, list[str]] | None:
    """Files of facts that weren't there, by table; None if a file left or one of another table is new."""
    if not before.where(F.col("name") != MARK).join(now, ["name", "path"], "left_anti").isEmpty():
        return None
    found: dict[str, list[str]] = {}
    for row in now.join(before, ["name", "path"], "left_anti").collect():  # files since the last run
        found.setdefault(row["name"], []).append(row["path"])
    return found if set(found) <= set(FACTS) else None


def parcels_in(spark: SparkSession, files: Mapping[str, Sequence[str]]) -> DataFrame:
    """Parcel numbers in files, the missing one too."""
    schema = T.StructType([T.StructField(KEY, T.StringType())])
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(*paths) for paths in files.values()]).distinct()


def only(rows: DataFrame, parcels: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of the parcels, or with "left_anti" of all others; a missing number is a parcel of its own."""
    named = parcels.select(F.col(KEY).alias(f"__of_{KEY}"))
    return rows.join(named, same_keys(rows, named, [KEY], "__of_"), how)


def _in(column: str, values: Sequence[object]) -> Column:
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known) if known else F.lit(False)
    return test | F.col(column).isNull() if None in values else test


def _drop_partitions(spark: SparkSession, target: str, partition: str, values: Sequence[object]) -> None:
    for value in values:
        system, path = _file_system(spark, f"{target}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        system.delete(path, True)


def refresh(
    t: Tables,
    names: Sequence[str],
    report: Callable[[Tables], DataFrame],
    target: str,
    partition: str,
    state: str,
    mark: str,
) -> str:
    """Brings the mart at `target` up to date and says how: "whole", "partitions" or "nothing".

    `names`: the tables that the report reads; `report`: the rows with the partition column; `state`: where the list of files
    is kept; `mark`: see `day_of`.
    """
    spark = t[names[0]].sparkSession
    now = input_files(t, names).persist()
    before = _stored(spark, state)
    files = None
    if before is not None and not before.where((F.col("name") == MARK) & (F.col("path") == mark)).isEmpty():
        files = new_files(now, before)
    if files is None:
        write_mart(report(t), target, [partition])
        how = "whole"
    elif files:
        _rewrite(spark, t, names, report, target, partition, f"{state}_fresh", files)
        how = "partitions"
    else:
        how = "nothing"
    if files is None or files:
        rows = now.unionByName(spark.createDataFrame([(MARK, mark)], "name string, path string"))
        rows.write.mode("overwrite").parquet(state)
    now.unpersist()
    return how


def _rewrite(
    spark: SparkSession,
    t: Tables,
    names: Sequence[str],
    report: Callable[[Tables], DataFrame],
    target: str,
    partition: str,
    stage: str,
    files: Mapping[str, Sequence[str]],
) -> None:
    touched = parcels_in(spark, files).persist()  # joined with every fact and three times with the mart
    part = t
    for name in set(names) & set(FACTS):
        part = part.with_table(name, only(t[name], touched))
    write_mart(report(part), stage)
    fresh, old = read_mart(spark, stage), read_mart(spark, target)
    fresh = fresh.select(*old.columns)
    left = only(old, touched).select(partition)
    # One value for each day of the report's look-back at most.
    days = [row[0] for row in fresh.select(partition).unionByName(left).distinct().collect()]
    if not days:
        touched.unpersist()
        return
    stays = only(old.where(_in(partition, days)), touched, "left_anti")
    filled = {row[0] for row in stays.select(partition).unionByName(fresh.select(partition)).distinct().collect()}
    # The old files are read before the commit that replaces them.
    write_mart(stays.unionByName(fresh), target, [partition], only_partitions=True)
    _drop_partitions(spark, target, partition, [day for day in days if day not in filled])
    touched.unpersist()
