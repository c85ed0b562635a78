"""Operator 6: SimHash near-duplicates, found by covering locality-sensitive hashing.

Each bit position carries a vector of radius + 1 bits; a table for every other vector v keeps the positions whose vector
has an odd inner product with v. Positions in which two fingerprints differ are at most `radius` vectors, so some v is
orthogonal to all of them and its table puts both fingerprints in one bucket: no pair within the radius is missed.

Distinct fingerprints stand for their documents. A bucket is searched breadth first: what is reached leaves the set that
later members are compared with, so a bucket of n fingerprints emits at most n - 1 edges and a dense one costs about n
comparisons. In buckets that are larger than a block, the same covering is laid over the bits the bucket leaves free, and
again inside that.

`near_duplicates` gives every row its fingerprint and component; `drop_near_duplicates` leaves one row of each component. Both
link fingerprints by distance alone.

A null text counts as empty. A text without words has fingerprint zero and is linked like any other; one of fewer words
than a shingle has one shingle of all of them. Repeated rows and ties share fingerprint and component. Rows of a null
doc_id get their fingerprint and the component of the others; the smallest doc_id that is not null names it, and a row
without doc_id stays only where its component has no other. Extra columns are ignored by `near_duplicates` and carried by
`drop_near_duplicates`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_view, documents, free_names, stored
from parceltrail.llm.components import components

BITS = 64
SEED = 42
QUERY_WORDS, QUERY_RADIUS = 4, 4
BLOCK = 2048
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_buffers(column: pa.Array) -> Iterator[tuple[int, bytes, list[int], list[int]]]:
    """(row, words joined by single spaces, start of each word, end of each word) of every text that has words."""
    data, ends = byte_view(column)
    for row, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
        text = _LOWER[data[a:b]]
        inside = ~_IS_GAP[text]
        starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]]) if len(text) else np.zeros(0, np.int64)
        if not len(starts):
            continue
        # A word's letters and the gap right after it stay: words then lie joined in one buffer.
        keep = inside | np.r_[False, inside[:-1]]
        joined = text[keep]
        joined[_IS_GAP[joined]] = 32
        raw = joined.tobytes().rstrip(b" ")
        first = np.cumsum(keep)[starts] - 1
        yield row, raw, first.tolist(), [*(first[1:] - 1).tolist(), len(raw)]


def shingle_hashes(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, XXH64 of each run of `words` words joined by a space) of an Arrow string column, repeats included."""
    digest = xxhash.xxh64_intdigest
    for row, raw, first, last in word_buffers(column):
        stops = last[words - 1 :] or last[-1:]
        yield row, np.array([digest(raw[p:q], SEED) for p, q in zip(first, stops)], np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is one where it is set in over half of the hashes; none at all gives zero."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key (a hash of the text, as it stands) and fp (the fingerprint's 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                got = np.zeros(part.num_rows, np.uint64)
                for row, hashes in shingle_hashes(part.column("text"), words):
                    got[row] = fingerprint_of(hashes)
                columns = [part.column("doc_id"), part.column("key"), pa.array(got.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "fp"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return plain.mapInArrow(run, "doc_id long, key long, fp long")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions: any `radius` positions are absent from at least one of them.

    The first positions carry the unit vectors, so over `radius` + 1 positions or more no mask is zero or comes twice.
    """
    width = radius + 1
    order = sorted(range(1 << width), key=lambda v: (v.bit_count() != 1, -v.bit_count(), v))
    vectors = {bit: order[k % len(order)] for k, bit in enumerate(bits)}
    return [sum(1 << b for b, m in vectors.items() if (m & v).bit_count() % 2) for v in range(1, 1 << width)]


def forest(values: np.ndarray, members: np.ndarray, radius: int, wide_radius: int, edges: list[tuple[int, int]]) -> None:
    """Adds a star of edges for each group that links of one block connect, from its first member to the others.

    Links: first columns within radius, the others within theirs. Members ascend, so a group that many buckets hold gets
    the same star in most of them.
    """
    rest = members
    while len(rest) > 1:
        first = int(rest[0])
        reached, rest = [first], rest[1:]
        while reached and len(rest):
            me = reached.pop()
            near = np.bitwise_count(values[rest, 0] ^ values[me, 0]) <= radius
            if values.shape[1] > 1:
                near &= np.bitwise_count(values[rest, 1:] ^ values[me, 1:]).sum(1, dtype=np.int64) <= wide_radius
            found = rest[near].tolist()
            if found:
                edges += [(first, other) for other in found]
                reached += found
                rest = rest[~near]


def bucket_edges(values: np.ndarray, free: int, radius: int, wide_radius: int = 0) -> list[tuple[int, int]]:
    """Edges (positions) that connect what links of a bucket connect.

    `free`: the mask of first-column bits in which members may differ. Large buckets are cut by covering masks over them,
    so that members of one sub-bucket agree in more bits, until few free bits or few distinct first columns are left. Every
    cut closes bits, so the cutting ends.
    """
    edges: list[tuple[int, int]] = []
    todo = [(np.arange(len(values)), free)]
    while todo:
        members, open_bits = todo.pop()
        positions = [b for b in range(BITS) if open_bits >> b & 1]
        few = len(members) <= BLOCK or len(positions) <= 2 * radius + 2
        if few or len(np.unique(values[members, 0])) <= BLOCK:
            forest(values, members, radius, wide_radius, edges)
            continue
        for mask in covering_masks(positions, radius):
            keys = values[members, 0] & np.uint64(mask)
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            todo += [(members[g], open_bits & ~mask) for g in np.split(order, cuts) if len(g) > 1]
    return edges


def links(distinct: DataFrame, radius: int, narrow: list[str], wide: list[str], wide_radius: int = 0) -> DataFrame:
    """Edges (a, b) between nodes that connect all that links connect.

    `distinct`: node and fingerprints, all longs. A link: some column of `narrow` differs in at most `radius` bits and all
    columns of `wide` together in at most `wide_radius`.
    """
    masks = covering_masks(list(range(BITS)), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[
        F.struct(F.lit(k + len(masks) * i).alias("t"), F.col(c).bitwiseAND(F.lit(m)).alias("key"), F.col(c).alias("fp"))
        for i, c in enumerate(narrow) for k, m in enumerate(signed)
    ])
    buckets = distinct.select("node", *wide, F.explode(tables).alias("b")).select("b.*", "node", *wide)
    spread = buckets.repartition("t", "key").sortWithinPartitions("t", "key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4 + len(wide), 0), np.int64)
        for batch in batches:
            rows = np.hstack([held, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])])
            cuts = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(0)) + 1
            whole = cuts[-1] if len(cuts) else 0  # the last bucket may go on in the next batch
            if whole:
                yield from emit(rows[:, :whole], cuts[:-1])
            held = rows[:, whole:]
        if held.shape[1]:
            yield from emit(held, np.zeros(0, np.int64))

    def emit(rows: np.ndarray, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = np.ascontiguousarray(rows[[2, *range(4, len(rows))]].T).view(np.uint64)
        starts, stops = np.r_[0, cuts], np.r_[cuts, rows.shape[1]]
        sizes = stops - starts
        pair = starts[sizes == 2]
        apart = np.bitwise_count(values[pair] ^ values[pair + 1]).astype(np.int64)
        pair = pair[(apart[:, 0] <= radius) & (apart[:, 1:].sum(1) <= wide_radius)]
        found = [np.stack([pair, pair + 1])]
        for a, b in zip(starts[sizes > 2].tolist(), stops[sizes > 2].tolist()):
            free = ~masks[int(rows[0, a]) % len(masks)] & ((1 << 64) - 1)
            edges = bucket_edges(values[a:b], free, radius, wide_radius)
            if edges:
                found.append(np.array(edges).T + a)
        at = np.hstack(found)
        if at.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(rows[3, at[0]]), pa.array(rows[3, at[1]])], ["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def labelled(prints: DataFrame, radius: int) -> DataFrame:
    """fp and label (one for each component of fingerprints) of every fingerprint, stored."""
    distinct = stored(prints.select("fp").distinct(), "distinct")
    labels = components(stored(links(distinct.select("fp", F.col("fp").alias("node")), radius, ["fp"], []), "links"))
    named = distinct.join(labels, distinct["fp"] == labels["node"], "left")
    return stored(named.select("fp", F.coalesce("label", "fp").alias("label")), "named")


def near_duplicates(docs: DataFrame, words: int = 5, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links of at most `radius` bits) of every row."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = stored(first.join(labelled(prints, radius), "fp"), "firsts")
    heads = stored(named.groupBy("label").agg(F.min("first").alias("component_id")), "heads")
    of_print = named.join(heads, "label").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = QUERY_WORDS, radius: int = QUERY_RADIUS) -> DataFrame:
    """The rows of `docs` that stay, with all columns: of each component the row of the smallest doc_id.

    A row is known by doc_id and a hash of its text; of rows that repeat both, one stays.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")
    rows = prints.join(labelled(prints, radius), "fp").select("label", row.alias("row"))
    shared = rows.groupBy("label").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(shared.select("label", "head"), "heads")
    gone = rows.join(shared, "label").where(F.col("row") != F.col("head")).select("row.doc_id", "row.key").distinct()
    gone = stored(gone, "gone")

    doc_id, key, of, of_key = free_names(docs, "doc_id", "key", "of", "of_key")
    keyed = docs.withColumns({doc_id: F.col("doc_id").cast("long"), key: F.xxhash64("text")})
    names = [F.col("doc_id").alias(of), F.col("key").alias(of_key)]
    same = F.col(doc_id).eqNullSafe(F.col(of)) & (F.col(key) == F.col(of_key))
    left = keyed.join(gone.select(*names), same, "left_anti")
    repeated = stored(prints.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    if not repeated.isEmpty():  # rows that occur once needn't move for those that don't
        again = repeated.select(*names)
        once = left.join(again, same, "left_semi").dropDuplicates([doc_id, key])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.drop(doc_id, key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), QUERY_WORDS, QUERY_RADIUS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
