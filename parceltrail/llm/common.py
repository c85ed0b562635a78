"""Helpers that all corpus operators share: reading, scratch folders, word bytes, connected components' seeds."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD_GAPS = "[ \\t\\n\\x0B\\f\\r]+"


_shipped: list[SparkContext] = []


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a session whose launcher didn't (--py-files, PYTHONPATH)."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped[:] = [context]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one; a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut, in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: narrower on disk than a checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for work columns that no column of `df` has, whatever the case of its letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"__{name}"
        while name in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def lower_ascii(text: Column) -> Column:
    """Null counts as empty; only A-Z change."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def texts_of(column) -> list[str]:
    """Python strings of an Arrow string column; null counts as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets of length rows + 1) of an Arrow string column without copying it.

    Null counts as empty. Offsets start at 0.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


SLICE_ROWS, SLICE_BYTES = 4096, 16 << 20


def byte_slices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of SLICE_ROWS rows and SLICE_BYTES bytes of text column `name` at most, or one longer text."""
    for batch in batches:
        _, ends = byte_view(batch.column(name))
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1
            stop = max(at + 1, min(fit, at + SLICE_ROWS))
            yield batch.slice(at, stop - at)
            at = stop
