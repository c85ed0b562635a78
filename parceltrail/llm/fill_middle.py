"""Operator 12: fill-in-the-middle transformation on a piece table.

A document is a row of descriptors (buffer, start, stop) over immutable buffers: the bytes of the texts as Arrow holds them,
and the sentinels. Cutting splits descriptors, an arrangement is a permutation of them, and the inverse permutation restores
the order of the text; text bytes are copied only where an output is handed on, and hashes stream the descriptors.

Where a document is cut and how it is arranged follows from the SHA-256 of `seed:doc_id` alone, so reruns, retried tasks and
other partitionings agree. Cuts count code points, anywhere in the whole text. Documents that hold a sentinel stay plain:
in every other output each sentinel stands once (none can arise across a border, as each begins with its only `<`), which
is what `restore` finds the pieces by.

A null text counts as empty; empty texts are plain, with cuts of null. A null doc_id is hashed as no digits. Repeated rows
get equal results, as nothing but doc_id and text is read. Columns besides these are ignored, an empty table gives an empty
result. Rows are worked on in slices of SLICE_BYTES (or one text, if longer): nothing is shuffled and nothing is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_slices, byte_view, documents

SEED = 1
PLAIN_PERCENT, SPM_PERCENT = 10, 20
MARKS = (b"<P>", b"<S>", b"<M>")
FORMS = ("plain", "psm", "spm")
#: Columns of a cut and marked table: prefix, middle, suffix, then the sentinels. A row for each form.
ORDERS = np.array([[0, 1, 2, 3, 4, 5], [3, 0, 4, 2, 5, 1], [4, 2, 3, 0, 5, 1]])
#: The sentinels in the order in which the outputs of a form have them.
MARK_ORDERS = ((), (0, 1, 2), (1, 0, 2))


@dataclass(frozen=True)
class PieceTable:
    """Texts as descriptors: a row for each text, a column for each piece, bytes start to stop of buffers[source]."""

    buffers: tuple[memoryview, ...]
    source: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    def cut(self, at: np.ndarray) -> PieceTable:
        """One column more: in each row the piece that holds byte `at` of the text (from 0) is split there."""
        rows, width = self.start.shape
        ends = np.cumsum(self.stop - self.start, axis=1)
        which = np.minimum((ends < at[:, None]).sum(1), width - 1)
        column = np.arange(width + 1)[None, :]
        from_ = np.where(column <= which[:, None], column, column - 1)
        source, start, stop = (np.take_along_axis(x, from_, 1) for x in (self.source, self.start, self.stop))
        line = np.arange(rows)
        border = self.stop[line, which] - (ends[line, which] - at)
        stop[line, which] = border
        start[line, which + 1] = border
        return PieceTable(self.buffers, source, start, stop)

    def with_pieces(self, buffer: memoryview, spans: list[tuple[int, int]], wanted: np.ndarray) -> PieceTable:
        """A column more for each span of a further buffer; empty in rows that don't want it."""
        rows, new = len(self.start), len(self.buffers)
        low = np.tile(np.array([a for a, _ in spans], np.int64), (rows, 1))
        high = np.where(wanted[:, None], np.array([b for _, b in spans], np.int64), low)
        return PieceTable(
            (*self.buffers, buffer),
            np.hstack([self.source, np.full((rows, len(spans)), new)]),
            np.hstack([self.start, low]),
            np.hstack([self.stop, high]),
        )

    def permuted(self, order: np.ndarray) -> PieceTable:
        """Column k of a row is the row's column order[k]."""
        return PieceTable(self.buffers, *(np.take_along_axis(x, order, 1) for x in (self.source, self.start, self.stop)))

    def stream(self, row: int) -> Iterator[memoryview]:
        for source, start, stop in zip(self.source[row].tolist(), self.start[row].tolist(), self.stop[row].tolist()):
            if stop > start:
                yield self.buffers[source][start:stop]

    def bytes_of(self, row: int) -> bytes:
        return b"".join(self.stream(row))

    def sha256(self, row: int) -> str:
        digest = hashlib.sha256()
        for piece in self.stream(row):
            digest.update(piece)
        return digest.hexdigest()


def whole_texts(data: np.ndarray, ends: np.ndarray) -> PieceTable:
    """One descriptor for each text of `data` (bytes) and `ends` (offsets, one more than texts)."""
    return PieceTable((memoryview(data),), np.zeros((len(ends) - 1, 1), np.int64), ends[:-1, None], ends[1:, None])


def dice_of(doc_ids: list[int | None], seed: int) -> np.ndarray:
    """The first four 32-bit numbers (big endian) of each document's digest."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).digest()[:16] for d in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


@dataclass(frozen=True)
class Arranged:
    """A slice of documents: the pieces in output order, and per document its form (a place in FORMS) and counts."""

    table: PieceTable
    form: np.ndarray
    n: np.ndarray
    prefix: np.ndarray
    middle: np.ndarray


def arrange(doc_ids: list[int | None], column: pa.Array, seed: int, plain_percent: int, spm_percent: int) -> Arranged:
    data, ends = byte_view(column)
    texts = whole_texts(data, ends)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of every code point
    first = np.searchsorted(heads, ends)
    n = np.diff(first)
    h = dice_of(doc_ids, seed)
    cuts = h[:, :2] % (n + 1)[:, None]
    low, high = cuts.min(1), cuts.max(1)
    byte_of = lambda chars: np.r_[heads, len(data)][first[:-1] + chars] - ends[:-1]
    plain = (n == 0) | (h[:, 2] % 100 >= 100 - plain_percent)
    for row in np.flatnonzero(~plain).tolist():
        text = bytes(texts.buffers[0][ends[row] : ends[row + 1]])
        plain[row] = any(mark in text for mark in MARKS)
    form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm_percent, 2, 1))
    spans = list(zip(np.cumsum([0, *map(len, MARKS)]).tolist(), np.cumsum([len(m) for m in MARKS]).tolist()))
    marked = texts.cut(byte_of(low)).cut(byte_of(high)).with_pieces(memoryview(b"".join(MARKS)), spans, form > 0)
    return Arranged(marked.permuted(ORDERS[form]), form, n, low, high - low)


def restored(outputs: list[bytes], form: np.ndarray) -> PieceTable:
    """The texts that outputs of `arrange` stand for, as descriptors over the outputs; needs nothing else of them."""
    table = whole_texts(np.frombuffer(b"".join(outputs), np.uint8), np.cumsum([0, *map(len, outputs)]))
    borders = np.zeros((len(outputs), 5), np.int64)  # plain: all text lies after the fifth border
    for row, (output, kind) in enumerate(zip(outputs, form.tolist())):
        if kind:
            mark = [output.index(MARKS[k]) for k in MARK_ORDERS[kind]]
            borders[row] = [3, mark[1], mark[1] + 3, mark[2], mark[2] + 3]
    for k in range(borders.shape[1]):
        table = table.cut(borders[:, k])
    # Plain texts are whole in the last column; any order of empty pieces before it is right.
    back = np.argsort(ORDERS[form], axis=1)
    back[form == 0] = np.arange(6)
    table = table.permuted(back)
    drop = np.repeat((form > 0)[:, None], 6, 1) & (np.arange(6) >= 3)
    return PieceTable(table.buffers, table.source, table.start, np.where(drop, table.start, table.stop))


def _columns(got: Arranged) -> list[pa.Array]:
    plain = got.form == 0
    names = pa.array([FORMS[k] for k in got.form.tolist()], pa.string())
    return [pa.array(got.n), names, pa.array(got.prefix, mask=plain), pa.array(got.middle, mask=plain)]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


FIELDS = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def transform(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (the arranged text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            got = arrange(part.column("doc_id").to_pylist(), part.column("text"), seed, plain_percent, spm_percent)
            texts = pa.array([got.table.bytes_of(row) for row in range(part.num_rows)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_columns(got), texts], [*FIELDS, "output"])

    return _keyed(docs).mapInArrow(run, f"{SCHEMA}, output string")


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text of every row of doc_id, form and output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "output"):
            raw = part.column("output").cast(pa.binary()).to_pylist()
            form = np.array([FORMS.index(k) for k in part.column("form").to_pylist()], np.int64)
            table = restored(raw, form)
            texts = pa.array([table.bytes_of(row) for row in range(part.num_rows)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), texts], ["doc_id", "text"])

    return outputs.select(F.col("doc_id").cast("long").alias("doc_id"), "form", "output").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """As `transform`, with the SHA-256 of the output and of the text rebuilt from output and form in place of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            got = arrange(part.column("doc_id").to_pylist(), part.column("text"), seed, plain_percent, spm_percent)
            rows = range(part.num_rows)
            back = restored([got.table.bytes_of(row) for row in rows], got.form)
            sums = [pa.array([table.sha256(row) for row in rows], pa.string()) for table in (got.table, back)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *_columns(got), *sums], [*FIELDS, "output_sha256", "restored_sha256"]
            )

    return _keyed(docs).mapInArrow(run, f"{SCHEMA}, output_sha256 string, restored_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents
), d AS (
  SELECT doc_id, body, CAST(length(body) AS BIGINT) AS n,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (length(body) + 1) AS a,
         CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (length(body) + 1) AS b,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) % 100 AS c,
         CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 AS d
  FROM h
), f AS (
  SELECT doc_id, body, n, least(a, b) AS p, greatest(a, b) AS q,
         CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR c >= 90 THEN 'plain'
              WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), o AS (
  SELECT *, substr(body, 1, p) AS prefix, substr(body, p + 1, q - p) AS middle, substr(body, q + 1) AS suffix FROM f
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM o
"""
