"""Operator 1: token ids in patched frame-of-reference blocks.

Texts are encoded with the `tokenizers` library and an end id is appended to each document. Ids of documents in ascending
doc_id order are stored in segments: blocks of BLOCK ids are reduced by their minimum, packed at the width that holds
PERCENTILE of them, and the high bits of the others go to an exception list; an index holds each block's minimum, width,
and the starts of its packed bytes and exceptions, so a reader reaches any id without unpacking what comes before.

File format: a Parquet table with a row per segment (shard, part, first, n_docs, n_ids, blob), written through Spark and so
to any store; `first` is the number of ids before the segment in its shard. Shards are ranges of doc_id, one task each.
All numbers in `blob` are little-endian; `pack` and `unpack` state its layout.

A null text counts as empty and yields the end id alone. A null doc_id comes first in order. Rows that repeat a doc_id all
appear, ordered by their ids. Extra columns are ignored. An empty table gives an empty file and result.

The library sees each distinct unit (a run of letters, digits or other signs with the space before it) once per worker while the unit stays in a
bounded table: the vocabulary's splitting rule never joins what such
units part. Texts with white space beyond ASCII or
with a special token's string are given to the library whole.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parceltrail.llm.bpe import spans
from parceltrail.llm.common import byte_view, documents, shared_folder
from parceltrail.llm.rolling import PrefixHash, distinct, mixed

VOCABULARY, END_ID = "byte_bpe_50k.json", 2
BLOCK, PERCENTILE = 128, 0.9
SEGMENT_IDS = 1 << 19
KEPT_UNITS = 1_000_000
SLICE_BYTES = 2_000_000
SEGMENTS = "shard int, part int, first long, n_docs long, n_ids long, blob binary"
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
# Letters, digits and other signs of ASCII: where they meet the splitting rule always parts them. Not so for 0: spaces,
# the apostrophe of contractions, and what lies beyond ASCII.
_KIND = np.zeros(256, np.uint8)
_KIND[33:128] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[39] = 0
_OTHER_GAPS = re.compile("[\x85\xa0  -     　]")


# ---- blocks


def bits_of(values: np.ndarray) -> np.ndarray:
    """Number of bits each value (below 2**53) takes; 0 takes none."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray) -> bytes:
    """Header (n ids, n blocks, packed bytes, exceptions), index, packed bytes, exception places and their high bits."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1] if n else 0, np.int64)
    padded[:n] = ids
    table = padded.reshape(blocks, BLOCK)
    low = table.min(1) if blocks else np.zeros(0, np.int64)
    rest = table - low[:, None]
    rank = int(PERCENTILE * BLOCK)
    widths = bits_of(np.partition(rest, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.int64)
    high = rest >> widths[:, None]
    at, place = np.nonzero(high)
    packed_sizes = widths * (BLOCK // 8)
    starts = np.r_[0, np.cumsum(packed_sizes)]
    packed = np.zeros(starts[-1], np.uint8)
    for width in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == width)
        # A column of all blocks at a time goes to its place in the blocks' 64-bit words.
        columns = (rest[own].T & ((1 << width) - 1)).astype(np.uint64)
        words = np.zeros((width * BLOCK // 64, len(own)), np.uint64)
        for k in range(BLOCK):
            word, shift = divmod(k * width, 64)
            words[word] |= columns[k] << np.uint64(shift)
            if shift + width > 64:
                words[word + 1] |= columns[k] >> np.uint64(64 - shift)
        packed[starts[own][:, None] + np.arange(width * BLOCK // 8)] = np.ascontiguousarray(words.T).astype("<u8").view(np.uint8)
    exceptions = np.r_[0, np.cumsum(np.bincount(at, minlength=blocks))]
    return b"".join([
        np.array([n, blocks, len(packed), len(at)], "<u4").tobytes(),
        low.astype("<u4").tobytes(), widths.astype("<u1").tobytes(), starts.astype("<u4").tobytes(), exceptions.astype("<u4").tobytes(),
        packed.tobytes(), place.astype("<u1").tobytes(), high[at, place].astype("<u4").tobytes(),
    ])


def unpack(raw: bytes) -> np.ndarray:
    """The ids of a packed run, as unsigned 32-bit integers."""
    n, blocks, size, patched = np.frombuffer(raw, "<u4", 4).tolist()
    at = 16

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(raw, kind, count, at)
        at += got.nbytes
        return got

    low, widths = take("<u4", blocks), take("<u1", blocks)
    starts, exceptions = take("<u4", blocks + 1).astype(np.int64), take("<u4", blocks + 1).astype(np.int64)
    packed, place, high = take("<u1", size), take("<u1", patched), take("<u4", patched)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == width)
        taken = packed[starts[own][:, None] + np.arange(width * BLOCK // 8)]
        words = np.ascontiguousarray(taken.view("<u8").T).astype(np.uint64)
        columns = np.empty((BLOCK, len(own)), np.uint32)
        for k in range(BLOCK):
            word, shift = divmod(k * width, 64)
            value = words[word] >> np.uint64(shift)
            if shift + width > 64:
                value = value | words[word + 1] << np.uint64(64 - shift)
            columns[k] = value & np.uint64((1 << width) - 1)
        rest[own] = columns.T
    of = np.repeat(np.arange(blocks), np.diff(exceptions))
    rest[of, place] |= high << widths[of].astype(np.uint32)
    return (rest + low[:, None]).ravel()[:n]


# ---- encoding


class UnitEncoder:
    """Encodes many texts with a byte-level vocabulary, each distinct unit once while the table holds it."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.feed = self._whole(["\n"])[0][0]
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _add(self, units: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units))))
        self.ends = np.r_[self.ends, len(self.flat) + np.cumsum(sizes)]
        self.flat = np.r_[self.flat, ids.astype(np.int32)]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units in a row, number of each): one library call, a line feed between units that hold none.

        A line feed before signs, or before the space of signs, is a piece of its own, so its id parts the units' ids.
        """
        ids = np.array(self._whole([b"\n".join([*units, b""]).decode()])[0], np.int64)
        feeds = np.flatnonzero(ids == self.feed)
        return ids[ids != self.feed], np.diff(np.r_[-1, feeds]) - 1

    def learn(self, units: list[bytes]) -> None:
        """Adds the distinct `units` to the table."""
        fresh = [u for u in units if u not in self.number]
        if len(self.number) + len(fresh) > KEPT_UNITS:
            self.forget()
            fresh = units
        signs = [u for u in fresh if not u.isspace()]
        if signs:
            self._add(signs, *self._units(signs))
        for u in set(fresh).difference(signs) if len(signs) < len(fresh) else ():
            ids = np.array(self._whole([u.decode()])[0], np.int64)
            self._add([u], ids, np.array([len(ids)]))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets); `data` holds UTF-8 without other white space or special tokens."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        gap = _GAP[data]
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        change = np.r_[True, gap[1:] != gap[:-1], True] | edge
        start = change[:-1] & ~gap  # first byte of a run of signs
        after_gap = start & ~edge[:-1] & np.r_[False, gap[:-1]]
        joins = after_gap & np.r_[False, data[:-1] == 32]
        cut = change.copy()
        before = np.flatnonzero(after_gap) - 1
        cut[before] = True  # the last byte of white space before signs starts a unit, with them if it is a space
        cut[np.flatnonzero(joins)] = False
        kind = _KIND[data]
        cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        at = np.flatnonzero(cut)
        starts, stops = at[:-1], at[1:]
        keys = mixed(PrefixHash(data).of(starts, stops))
        first, unit = distinct(keys)
        # Equal hashes must mean equal bytes; where they don't, every unit stands for itself.
        sizes = stops - starts
        same = (sizes == sizes[first][unit]).all()
        if same:
            moved = np.repeat(starts[first][unit] - starts, sizes)
            same = bool((data == data[np.arange(n) + moved]).all())
        if not same:
            first = unit = np.arange(len(starts))
        raw = data.tobytes()
        units = [raw[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())]
        self.learn(list(dict.fromkeys(units)) if not same else units)
        number = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))[unit]
        ids, ends = spans(self.flat, self.ends[number], self.ends[number + 1])
        return ids, ends[np.searchsorted(starts, bounds)]

    def encode_column(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow string column (null: none)."""
        ids, ends = self.encode_flat(column)
        return np.split(ids, ends[1:-1]) if len(column) else []

    def encode_flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets) of an Arrow string column."""
        data, bounds = byte_view(column)
        raw = data.tobytes()
        # Other white space starts with the byte 0xC2 or one from 0xE1 on.
        plain = not ((data >= 0xE1).any() or (data == 0xC2).any()) or not _OTHER_GAPS.search(raw.decode())
        if plain and not any(s in raw for s in self.specials):
            return self.encode(data, bounds)
        out: list[np.ndarray] = []
        for text in column.to_pylist():
            raw = (text or "").encode()
            if any(s in raw for s in self.specials) or _OTHER_GAPS.search(text or ""):
                out.append(np.array(self._whole([text])[0], np.int32))
            else:
                out.append(self.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
        return np.concatenate(out), np.r_[0, np.cumsum([len(x) for x in out])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> UnitEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    return UnitEncoder(path)


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of slices of about SLICE_BYTES; one long text is a slice of its own."""
    _, ends = byte_view(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE_BYTES, side="right")) - 1)
        yield a, b
        a = b


# ---- files


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encodes `docs` and writes the segments of all documents to `path`."""
    vocabulary_path = vocabulary or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shares = F.percentile_approx("doc_id", [k / shards for k in range(1, shards)] or [0.5], 100 * shards)
    borders = np.array(source.agg(shares).first()[0] or [], np.int64)[: shards - 1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(vocabulary_path)
        wide = "<u2" if model.library.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                flat, ends = model.encode_flat(part.column("text"))
                raw = np.insert(flat, ends[1:], end_id).astype(wide).tobytes()
                upto = (int(wide[2]) * (ends + np.arange(len(ends)))).tolist()
                ids = [raw[i:j] for i, j in zip(upto, upto[1:])]
                doc_id = part.column("doc_id")
                shard = np.searchsorted(borders, doc_id.fill_null(np.iinfo(np.int64).min).to_numpy(), side="left")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), doc_id, pa.array([wide[1:]] * len(ids)), pa.array(ids, pa.binary())],
                    ["shard", "doc_id", "kind", "ids"],
                )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, first = None, 0, 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            known = [d is not None for d, _ in held]
            table = b"".join([
                np.array([len(held)], "<u8").tobytes(), np.array([d or 0 for d, _ in held], "<i8").tobytes(),
                np.array(known, "<u1").tobytes(), np.array([len(x) for _, x in held], "<u4").tobytes(),
            ])
            row = [[shard], [part], [first], [len(held)], [len(ids)], [table + pack(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "part", "first", "n_docs", "n_ids", "blob"])

        for batch in batches:
            for s, d, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "kind", "ids"))):
                if held and (s != shard or size >= SEGMENT_IDS):
                    yield flush()
                    part, first = part + 1, first + size
                    held, size = [], 0
                if s != shard:
                    shard, part, first = s, 0, 0
                ids = np.frombuffer(raw, f"<{kind}").astype(np.int64)
                held.append((d, ids))
                size += len(ids)
        if held:
            yield flush()

    encoded = source.mapInArrow(encode, "shard int, doc_id long, kind string, ids binary")
    ordered = encoded.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    ordered.mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_documents(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids of all documents in a row, their offsets) of a segment's blob."""
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    doc_id = np.frombuffer(raw, "<i8", n, 8)
    known = np.frombuffer(raw, "<u1", n, 8 + 8 * n)
    sizes = np.frombuffer(raw, "<u4", n, 8 + 9 * n).astype(np.int64)
    ids = unpack(raw[8 + 13 * n :])
    return [d if k else None for d, k in zip(doc_id.tolist(), known.tolist())], ids, np.r_[0, np.cumsum(sizes)]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary of little-endian unsigned 32-bit integers) of every document in the files."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    # A number per shard, and shards are as many as the writer's shuffle partitions.
    totals = sorted(table.groupBy("shard").agg(F.sum("n_ids")).collect())
    before = dict(zip([s for s, _ in totals], np.r_[0, np.cumsum([n for _, n in totals])].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "blob"))):
                doc_id, ids, ends = read_documents(blob)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc_id), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids.astype("<u4"))]
                ).cast(pa.binary())
                columns = [pa.array(doc_id, pa.int64()), pa.array(before[shard] + first + ends[:-1]), pa.array(np.diff(ends)), raw]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return table.select("shard", "first", "blob").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
