"""Operator 9: a quality classifier on random-indexing word vectors.

Every token bucket has a sparse random index vector. One pass over all documents adds to each bucket the index vectors of
its neighbours; the sums, one table of BUCKETS x WIDTH numbers whatever the corpus' size, are its word vector. A document
is the mean and the spread of its word vectors, how much its neighbouring vectors are alike, and its length. A two-layer network is trained with numpy on the driver, on
at most TRAIN_ROWS labelled documents (of smallest hash), and its temperature is set on a part held back from
training. A second pass scores all documents.

A null or empty text has no tokens: its mean and spread are zero, and it is scored like any other. Rows are scored one by
one, so ties, repeated rows and extra columns need no rule. Labels that are null teach nothing; with no usable label every
score is 0.5. A row without doc_id is never learned from and counts as held out. An empty table gives an empty result.

Tokens are runs of letters, digits or other signs, case kept, hashed to buckets. Each task adds up its own table and sends
blocks of it; blocks are summed in two steps, by block and salt and then by block, in constant memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_view, documents, free_names
from parceltrail.llm.rolling import PrefixHash, mixed, runs

BUCKETS, WIDTH, SIGNS, REACH = 1 << 14, 64, 4, 2
FEATURES = 2 * WIDTH + 3
BLOCKS = 64
TRAIN_ROWS = 20_000
HIDDEN, ROUNDS, BATCH = 32, 40, 256
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 5, 0
SLICE_ROWS, CHUNK = 512, 1 << 16
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, row of each token) of an Arrow string column."""
    data, ends = byte_view(column)
    starts, stops = runs(_KIND[data], ends)
    hashes = mixed(PrefixHash(data).of(starts, stops))
    return (hashes >> np.uint64(64 - 14)).astype(np.int64), np.searchsorted(ends, starts, side="right") - 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of the few nonzero numbers of every bucket's index vector, from a fixed seed."""
    dice = np.random.default_rng(9)
    at = np.argsort(dice.random((BUCKETS, WIDTH)), axis=1)[:, :SIGNS]
    return at.astype(np.int64), np.tile(np.array([1.0, -1.0], np.float64), SIGNS // 2)


def _neighbours(bucket: np.ndarray, row: np.ndarray, table: np.ndarray, at: np.ndarray, signs: np.ndarray) -> None:
    """Adds to each token's bucket the index vectors of tokens up to REACH places away in the same text."""
    for gap in range(1, REACH + 1):
        same = row[gap:] == row[:-gap]
        left, right = bucket[:-gap][same], bucket[gap:][same]
        for own, other in ((left, right), (right, left)):
            for k in range(SIGNS):
                table += np.bincount(own * WIDTH + at[other, k], minlength=BUCKETS * WIDTH) * signs[k]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums tables' blocks by their first columns while they pass; holds one array for each key of the task."""
    sums: dict[tuple, np.ndarray] = {}
    names: list[str] = []
    for batch in batches:
        names = batch.schema.names
        keys = zip(*(batch.column(n).to_pylist() for n in names[:-1]))
        for key, raw in zip(keys, batch.column(names[-1])):
            part = np.frombuffer(raw.as_buffer(), np.float64)
            sums[key] = sums[key] + part if key in sums else part.copy()
    if sums:
        columns = [pa.array(c, pa.int32()) for c in zip(*sums)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in sums.values()])], names)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x WIDTH word vectors of unit length, from the neighbours of every token of every document."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, signs = index_vectors()
        table, seen = np.zeros(BUCKETS * WIDTH), False
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                bucket, row = tokens(batch.column("text").slice(a, SLICE_ROWS))
                for b in range(0, len(bucket), 1 << 21):
                    _neighbours(bucket[b : b + (1 << 21)], row[b : b + (1 << 21)], table, at, signs)
                seen = seen or len(bucket) > 0
        if seen:
            blocks = table.reshape(BLOCKS, -1)
            salt = TaskContext.get().partitionId() % (1 << 20)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array([salt] * BLOCKS, pa.int32()), pa.array([x.tobytes() for x in blocks])],
                ["block", "salt", "sums"],
            )

    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // BLOCKS)
    parts = docs.select("text").mapInArrow(gather, "block int, salt int, sums binary")
    parts = parts.withColumn("salt", F.pmod("salt", F.lit(salts)).cast("int"))
    some = parts.repartition("block", "salt").mapInArrow(_summed, "block int, salt int, sums binary")
    whole = some.select("block", "sums").repartition("block").mapInArrow(_summed, "block int, sums binary")
    table = np.zeros((BLOCKS, BUCKETS // BLOCKS * WIDTH))
    for block, sums in whole.collect():  # BLOCKS rows: the table's size is fixed
        table[block] += np.frombuffer(sums, np.float64)
    table = table.reshape(BUCKETS, WIDTH)
    table -= table.mean(0)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers per text: mean and spread of its word vectors, likeness and sameness of next words, log length.

    Pairs of neighbours that a chunk's border parts are left out of the likeness.
    """
    bucket, row = tokens(column)
    n = len(column)
    sums, squares, echo = np.zeros((n, WIDTH)), np.zeros((n, WIDTH)), np.zeros((n, 2))
    for a in range(0, len(bucket), CHUNK):
        own, part = row[a : a + CHUNK], vectors[bucket[a : a + CHUNK]]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums[own[first]] += np.add.reduceat(part, first, axis=0)
        squares[own[first]] += np.add.reduceat(part * part, first, axis=0)
        near = np.einsum("ij,ij->i", part[1:], part[:-1])
        near[own[1:] != own[:-1]] = 0
        echo[:, 0] += np.bincount(own[1:], near, minlength=n)
        echo[:, 1] += np.bincount(own[1:], near > 0.999, minlength=n)
    count = np.bincount(row, minlength=n).astype(float)
    by = np.maximum(count, 1)[:, None]
    mean = sums / by
    spread = np.sqrt(np.maximum(squares / by - mean * mean, 0))
    return np.hstack([mean, spread, echo / by, np.log1p(count)[:, None]])


@dataclass(frozen=True)
class Network:
    """tanh layer and logistic output over standardised features, divided by a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias) @ self.second + self.second_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss; the last fifth of the shuffled rows sets the temperature."""
    width = FEATURES
    flat = Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)
    if not len(y):
        return flat
    dice = np.random.default_rng(7)
    order = dice.permutation(len(y))
    x, y = x[order], y[order].astype(float)
    fit = max(1, len(y) * 4 // 5)
    centre, scale = x[:fit].mean(0), x[:fit].std(0) + 1e-6
    z = (x[:fit] - centre) / scale
    weights = [dice.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), dice.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(ROUNDS):
        shuffled = dice.permutation(fit)
        for a in range(0, fit, BATCH):
            pick = shuffled[a : a + BATCH]
            hidden = np.tanh(z[pick] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3]))) - y[pick]) / len(pick)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [z[pick].T @ back + 1e-4 * weights[0], back.sum(0), hidden.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(slopes):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                weights[k] = weights[k] - 0.003 * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    if fit == len(y):
        return net
    raw, truth = net.logit(x[fit:]), y[fit:]
    choices = np.geomspace(0.25, 8, 61)
    losses = [np.mean(np.logaddexp(0, raw / t) - truth * raw / t) for t in choices]
    return Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]), float(choices[int(np.argmin(losses))]))


def fold() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(HELD_OUT_FOLD))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """(word vectors from all of `docs`, network from the labelled rows outside the held-out fold)."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    known = known.where(fold() != HELD_OUT_FOLD)
    # A threshold from the count lets a few more rows pass than are wanted, however many tasks read the labels.
    spread, rate = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)), min(1.0, (1.2 * TRAIN_ROWS + 100) / max(1, known.count()))
    known = known.where(spread < int(rate * (1 << 31))).orderBy(spread, "doc_id", "quality").limit(TRAIN_ROWS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                x = features(part.column("text"), shared.value)
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), rows], ["doc_id", "quality", "x"])

    # The sample is bounded by TRAIN_ROWS, and so is what reaches the driver for each repetition of a doc_id.
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    rows = pairs.select("doc_id", "quality", "text").mapInArrow(read, "doc_id long, quality int, x array<double>")
    rows = sorted(rows.orderBy("doc_id").limit(TRAIN_ROWS).collect())
    x = np.array([r[2] for r in rows]).reshape(len(rows), FEATURES)
    return vectors, train(x, np.array([r[1] for r in rows]))


def score(docs: DataFrame, vectors: np.ndarray, net: Network, out: str = "score") -> DataFrame:
    """`docs` with a column `out` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                got = model.score(features(part.column("text"), table))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got)], [*part.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{out}` double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier doesn't reject, with all columns."""
    (mark,) = free_names(docs, "score")
    return score(docs, *fit(docs, labels), mark).where(F.col(mark) >= threshold).drop(mark)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors, net = fit(docs, labels_of(spark, sf_dir))
    return score(docs, vectors, net).select(
        "doc_id", (fold() == HELD_OUT_FOLD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
