"""Operator 7: approximate nearest neighbours by shifted space-filling curves.

Vectors are classed by equal components, so copies are indexed once; a class keeps the `k + 1` smallest ids, which is all
that an answer can need. Each of ORDERINGS random rotations projects unit vectors to AXES numbers; quantiles of a bounded
sample spread them over a grid, which a random shift moves, and the Hilbert key of the cell orders the table. Spark
range-partitions every ordering by key; BLOCK neighbouring rows make a block. A query visits its own block and `reach`
blocks on either side in every ordering, and what it meets is ranked by the exact cosine on the original vectors.

`reach` is fitted: at most PROBES queries are compared with all rows (in blocks), and the smallest reach that finds
TARGET of their true neighbours in some ordering is taken. Where vectors have structure it stays at a few blocks; where
they have none, as uniform directions in many dimensions, no order keeps neighbours together and it grows with the table.

Vectors that are null, zero, hold null or non-finite components, or differ in length from the table's longest take no part,
nor do rows without vec_id. Rows that repeat an id and its vector count once. Ties go to the smaller id. A query with fewer
than k candidates gets all of them, one with none has no row; an empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import stored

ORDERINGS, AXES, BITS = 16, 8, 7
BLOCK = 512
SAMPLE, PROBES, TARGET = 4096, 64, 0.96
NEAREST, QUERY_STEP = 5, 50
#: A query's visits are dealt to as many groups, so a group holds the queries of a bounded stretch of blocks.
VISITS = 64


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows of coordinates below 2**bits), by Skilling's transform."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(axes):
            hit = (x[:, i] >> level & 1) == 1
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= swap
            x[:, i] ^= swap
            x[:, 0] ^= np.where(hit, low, 0)
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[:, i] >> level & 1)
    return key


class Curves:
    """Rotations, shifts and grid borders of all orderings, from a fixed seed and a sample of unit vectors."""

    def __init__(self, sample: np.ndarray) -> None:
        dice = np.random.default_rng(11)
        width = sample.shape[1]
        self.axes = min(AXES, width)
        self.turns = [np.linalg.qr(dice.normal(size=(width, width)))[0][:, : self.axes] for _ in range(ORDERINGS)]
        self.shifts = dice.random((ORDERINGS, self.axes))
        self.borders = [np.sort(sample @ turn, axis=0) for turn in self.turns]

    def keys(self, unit: np.ndarray, ordering: int) -> np.ndarray:
        at, borders = unit @ self.turns[ordering], self.borders[ordering]
        spread = np.stack([np.searchsorted(borders[:, a], at[:, a]) for a in range(self.axes)], axis=1) / (len(borders) + 1)
        return hilbert_keys(((spread + self.shifts[ordering]) / 2 * (1 << BITS)).astype(np.int64), BITS)


def matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of `a` with the same row of `b`."""
    over = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
    return np.einsum("ij,ij->i", a, b) / over


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of the k nearest rows of every query, ties to the smaller id."""
    rough = unit_rows(queries) @ unit_rows(rows).T
    most = min(k, len(rows))
    bar = -np.partition(-rough, most - 1, axis=1)[:, most - 1]
    q, r = np.nonzero(rough >= bar[:, None] - 1e-12)
    exact = cosines(queries[q], rows[r])
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], r[rank < k], exact[rank < k]


def classes(vectors: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """(cls, ids, vec, asked) of every distinct usable vector, (query_id, cls) of every query.

    cls: the smallest id; ids: the k + 1 smallest; vec: components as little-endian doubles; asked: a query has this vector.
    """
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    table = table.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    width = table.agg(F.max(F.size("v"))).first()[0]
    table = table.where(F.size("v") == F.lit(width or 0)).withColumn("asked", is_query)
    order = Window.partitionBy("v").orderBy("vec_id")
    # The rank limit is applied in each task before the exchange, so a vector of very many copies stays small.
    few = table.withColumn("nth", F.dense_rank().over(order)).where(F.col("nth") <= k + 1)
    members = few.groupBy("v").agg(F.min("vec_id").alias("cls"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
    asked = table.where("asked").groupBy("v").agg(F.lit(True).alias("asked"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(v, "<f8").tobytes() for v in batch.column("v").to_pylist()]
            columns = [batch.column("cls"), batch.column("ids"), pa.array(raw, pa.binary()), batch.column("asked")]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "ids", "vec", "asked"])

    joined = members.join(asked, "v", "left").select("cls", "ids", "v", F.coalesce("asked", F.lit(False)).alias("asked"))
    named = stored(joined, "classes")
    of_query = table.where("asked").select(F.col("vec_id").alias("query_id"), "v").distinct().join(named.select("v", "cls"), "v")
    return named.mapInArrow(packed, "cls long, ids array<long>, vec binary, asked boolean"), of_query.select("query_id", "cls")


def first_by_hash(table: DataFrame, rows: int, seed: int) -> DataFrame:
    """The `rows` rows of smallest hash of cls; a threshold from the count keeps what tasks send bounded, however many they are."""
    spread = F.pmod(F.xxhash64("cls", F.lit(seed)), F.lit(1 << 31))
    rate = min(1.0, (1.2 * rows + 100) / max(1, table.count()))
    return table.where(spread < int(rate * (1 << 31))).orderBy(spread, "cls").limit(rows)


def ordered(table: DataFrame) -> DataFrame:
    """ordering, part, block, cls, ids, vec, asked: every class once in each ordering, stored in order of keys."""
    sample = first_by_hash(table, SAMPLE, 0).select("vec").collect()
    spark = table.sparkSession
    curves = spark.sparkContext.broadcast(Curves(unit_rows(matrix([bytes(r[0]) for r in sample]))) if sample else None)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                unit = unit_rows(matrix(part.column("vec").to_pylist()))
                for n in range(ORDERINGS):
                    head = [pa.array(np.full(len(unit), n, np.int32)), pa.array(curves.value.keys(unit, n))]
                    yield pa.RecordBatch.from_arrays([*head, *part.columns], ["ordering", "key", *part.schema.names])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            ordering = batch.column("ordering").to_numpy()
            block = np.zeros(len(ordering), np.int64)
            for n in np.unique(ordering).tolist():
                own = np.flatnonzero(ordering == n)
                block[own] = (seen.get(n, 0) + np.arange(len(own))) // BLOCK
                seen[n] = seen.get(n, 0) + len(own)
            columns = [batch.column("ordering"), pa.array(np.full(len(block), part, np.int32)), pa.array(block)]
            names = ["cls", "ids", "vec", "asked"]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in names)], ["ordering", "part", "block", *names])

    kinds = "cls long, ids array<long>, vec binary, asked boolean"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = table.mapInArrow(keyed, f"ordering int, key long, {kinds}").repartitionByRange(parts, "ordering", "key", "cls")
    in_order = spread.sortWithinPartitions("ordering", "key", "cls").mapInArrow(blocked, f"ordering int, part int, block long, {kinds}")
    return stored(in_order, "ordered")


def numbered(table: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(`table` with `at`: the block's place in its ordering, number of blocks of every ordering)."""
    # A row per ordering and task of the range partitioning: bounded by the number of partitions.
    counts = sorted(table.groupBy("ordering", "part").agg(F.max("block")).collect())
    base: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for ordering, part, last in counts:
        base[ordering, part] = total.get(ordering, 0)
        total[ordering] = total.get(ordering, 0) + int(last) + 1
    spark = table.sparkSession
    rows = [(o, p, b) for (o, p), b in base.items()]
    bases = spark.createDataFrame(rows, "ordering int, part int, base long")
    return table.join(F.broadcast(bases), ["ordering", "part"]).withColumn("at", F.col("base") + F.col("block")), total


def fitted_reach(table: DataFrame, placed: DataFrame, k: int) -> int:
    """The smallest number of blocks to either side that finds TARGET of the true neighbours of a sample of queries."""
    probes = first_by_hash(table.where("asked"), PROBES, 1).select("cls", "vec").collect()
    if not probes:
        return 0
    probe_ids = np.array([r[0] for r in probes])
    asked = table.sparkSession.sparkContext.broadcast((probe_ids, matrix([bytes(r[1]) for r in probes])))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = asked.value
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                own = part.column("cls").to_numpy()
                q, r, s = best(queries, matrix(part.column("vec").to_pylist()), own, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(own[r]), pa.array(s)], ["query", "cls", "score"])

    met = table.select("cls", "vec").mapInArrow(nearest, "query long, cls long, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "cls")
    pairs = met.withColumn("nth", F.row_number().over(order)).where(f"nth <= {k + 1} and cls <> query").select("query", "cls").collect()
    named = sorted({*probe_ids.tolist(), *(r[1] for r in pairs)})  # at most PROBES * (k + 2) ids
    places: dict[int, dict[int, int]] = {}
    for cls, ordering, at in placed.where(F.col("cls").isin(named)).select("cls", "ordering", "at").collect():
        places.setdefault(cls, {})[ordering] = at
    apart = sorted(min(abs(at - places[c][o]) for o, at in places[q].items()) for q, c in pairs)
    return int(apart[min(len(apart) - 1, int(TARGET * len(apart)))]) if apart else 0


def search(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row with `is_query` (a condition on vec_id)."""
    table, of_query = classes(vectors, is_query, k)
    table = stored(table, "packed")
    placed, total = numbered(ordered(table))
    reach = fitted_reach(table, placed, k)
    blocks = F.element_at(F.create_map(*[F.lit(x) for pair in total.items() for x in pair]), F.col("ordering")) if total else F.lit(0)
    first, last = F.greatest(F.col("at") - reach, F.lit(0)), F.least(F.col("at") + reach, blocks - 1)
    visits = placed.where("asked").select("ordering", "cls", "vec", F.explode(F.sequence(first, last)).alias("to"), "at")
    stretch = F.floor((F.col("to") - F.col("at") + reach) / VISITS).cast("int")
    visits = visits.select(
        F.col("ordering").alias("of"), "to", stretch.alias("part_of"), F.col("cls").alias("query"), F.col("vec").alias("asked_vec")
    )
    stretches = F.explode(F.sequence(F.lit(0), F.lit(2 * reach // VISITS)))
    rows = placed.select("ordering", "at", stretches.alias("stretch"), "cls", "vec")

    def meet(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(block):
            return pd.DataFrame({"query": [], "cls": [], "score": []})
        own = block["cls"].to_numpy()
        q, r, s = best(matrix(asked["asked_vec"].tolist()), matrix(block["vec"].tolist()), own, k + 1)
        return pd.DataFrame({"query": asked["query"].to_numpy()[q], "cls": own[r], "score": s})

    asked_by, held_by = visits.groupBy("of", "to", "part_of"), rows.groupBy("ordering", "at", "stretch")
    met = asked_by.cogroup(held_by).applyInPandas(meet, "query long, cls long, score double")
    found = met.groupBy("query", "cls").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "cls")
    top = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).drop("nth")
    members = top.join(table.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    # Of all ids an answer can hold, k + 1 a class of queries are enough: a query drops itself.
    near = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    few = stored(members.withColumn("nth", F.row_number().over(near)).where(F.col("nth") <= k + 1), "answers")
    pairs = of_query.join(few, F.col("cls") == F.col("query")).where(F.col("query_id") != F.col("vec_id"))
    own = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return own.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_STEP == 0)
