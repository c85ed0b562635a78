"""Operator 13: language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are the code points of the lower-cased text, with every run of other signs than letters as one gap. Runs of one to
three of them are hashed to BUCKETS buckets. A document is its shares of inverse-document-frequency weighted buckets; the
frequencies come from all documents that may be learned from. The weights are trained on the driver by
follow-the-regularised-leader (FTRL-proximal), whose L1 part keeps most of them at zero and whose L2 part keeps the others
small, and a temperature, set on a fifth of the sample that training doesn't see, makes probabilities of the scores.

What bounds the model: BUCKETS, and TRAIN_ROWS documents to learn weights from, equally many of each language where it has
them (those of smallest hash); at most LANGS languages, the most frequent ones. Everything else covers all documents.

A null text, and a text without a letter, is `und` with score 0, and so is every text if nothing could be learned. A null lang
teaches nothing, the empty lang is a language like any other. A row without doc_id is not learned from and counts as held
out. Rows are predicted one by one, so ties, repeated rows and extra columns need no rule; of equally likely languages the
smaller in code point order is taken. Very long texts are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_slices, documents, texts_of
from parceltrail.llm.rolling import mixed

ORDERS, BUCKET_BITS = 3, 15
BUCKETS = 1 << BUCKET_BITS
TRAIN_ROWS, LANGS = 4_000, 256
FOLDS, HELD_OUT_FOLD = 4, 2
UNKNOWN = "und"
#: Shares times this are the features: a text of one repeated bucket would have the value SPREAD.
SPREAD = 30.0
EPOCHS, STEP, SOFT, L1, L2 = 4, 0.3, 1.0, 0.02, 0.01
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GAP = 32


@functools.cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts in a row, row of each): lower case, gaps as one sign, a gap before each text and after it."""
    padded = [f" {text.lower()} " for text in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(texts)), [len(p) for p in padded])
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[np.cumsum([0, *map(len, padded[:-1])])] = True
    return np.where(is_letter, points, _GAP)[keep], row[keep]


def histograms(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, occurrences by bucket) of every text that has a letter."""
    if not texts:
        return
    points, row = symbols(texts)
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    signs = points.astype(np.uint64) + np.uint64(1)
    of_order, h = [], np.zeros(len(signs), np.uint64)
    for order in range(ORDERS):
        h = h[: len(signs) - order] * _BASE + signs[order:]
        of_order.append((mixed(h + np.uint64(order)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        if b - a > 1:  # more than the first gap: a letter
            yield k, np.bincount(np.concatenate([x[a : max(a, b - n)] for n, x in enumerate(of_order)]), minlength=BUCKETS)


@dataclass(frozen=True)
class Model:
    """Languages in code point order, inverse document frequencies, and a column of weights for each language."""

    langs: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        if not self.langs:
            return UNKNOWN, 0.0
        own = counts * self.idf
        logits = (SPREAD / own.sum() * (own @ self.weights) + self.bias) / self.temperature
        shares = np.exp(logits - logits.max())
        best = int(np.argmax(shares))
        return self.langs[best], float(min(1.0, shares[best] / shares.sum()))


def softmax(logits: np.ndarray) -> np.ndarray:
    shares = np.exp(logits - logits.max(-1, keepdims=True))
    return shares / shares.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], truth: np.ndarray, width: int, classes: int) -> np.ndarray:
    """`width` x `classes` weights of sparse rows (places, values) by FTRL-proximal with an elastic net; most are zero."""
    z, n = np.zeros((width, classes)), np.zeros((width, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((SOFT + np.sqrt(n)) / STEP + L2)

    dice = np.random.default_rng(13)
    for _ in range(EPOCHS):
        for k in dice.permutation(len(rows)).tolist():
            at, value = rows[k]
            w = weights(z[at], n[at])
            error = softmax(value @ w)
            error[truth[k]] -= 1
            slope = np.outer(value, error)
            square = slope * slope
            before = n[at]
            z[at] += slope - (np.sqrt(before + square) - np.sqrt(before)) / STEP * w
            n[at] = before + square
    return weights(z, n)


def train(langs: list[str], idf: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """The model of rows (place of the language, buckets, occurrences)."""
    used = sorted({k for k, _, _ in rows})
    if not used:
        return Model((), idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    truth = np.searchsorted(used, [k for k, _, _ in rows])
    sparse = []
    for _, at, count in rows:
        value = count * idf[at]
        # One bucket more than the text's is always on: the bias.
        sparse.append((np.r_[at, BUCKETS], np.r_[value * (SPREAD / value.sum()), 1.0]))
    order = np.random.default_rng(7).permutation(len(rows))
    fit = order[: max(1, len(order) * 4 // 5)].tolist()
    w = ftrl([sparse[k] for k in fit], truth[fit], BUCKETS + 1, len(used))
    temperature, rest = 1.0, order[len(fit) :].tolist()
    if rest and len(used) > 1:
        logits = np.stack([sparse[k][1] @ w[sparse[k][0]] for k in rest])
        choices = np.geomspace(0.1, 10, 81)
        losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(rest)), truth[rest]], 1e-12)).mean() for t in choices]
        temperature = float(choices[int(np.argmin(losses))])
    return Model(tuple(langs[k] for k in used), idf, w[:BUCKETS], w[BUCKETS], temperature)


def fold() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(HELD_OUT_FOLD))


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Number of texts with each bucket: BUCKETS numbers, whatever the size of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for part in byte_slices(batches, "text"):
            for _, counts in histograms(texts_of(part.column("text"))):
                seen += counts > 0
        at = np.flatnonzero(seen)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "docs"])

    parts = docs.select("text").mapInArrow(run, "bucket long, docs long")
    found = np.zeros(BUCKETS, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("docs").alias("docs")).collect():
        found[bucket] = n
    return found


def sample(docs: DataFrame, counts: dict[str, int], train_rows: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the language in `counts`, buckets, occurrences) of the rows of smallest hash, equally many per language.

    A threshold from the languages' counts lets about twice the rows that are wanted pass, however many partitions there are.
    """
    each = max(1, train_rows // len(counts))
    rates = [(lang, k, min(1.0, (2 * each + 40) / n)) for k, (lang, n) in enumerate(counts.items())]
    known = docs.sparkSession.createDataFrame(rates, "lang string, place int, rate double")
    drawn = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("hash")).join(F.broadcast(known), "lang")
    drawn = drawn.where(F.pmod("hash", F.lit(1 << 31)) < F.col("rate") * float(1 << 31)).select("place", "hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            rows, buckets, counts = [], [], []
            for row, found in histograms(texts_of(part.column("text"))):
                at = np.flatnonzero(found)
                rows.append(row)
                buckets.append(at.astype("<u2").tobytes())
                counts.append(found[at].astype("<f4").tobytes())
            if rows:
                own = [part.column(c).take(pa.array(rows)) for c in ("place", "hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(buckets), pa.array(counts)], ["place", "hash", "buckets", "counts"])

    vectors = drawn.mapInArrow(run, "place int, hash long, buckets binary, counts binary")
    order = Window.partitionBy("place").orderBy(F.pmod("hash", F.lit(1 << 31)), "hash", "buckets", "counts")
    first = vectors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each)
    rows = sorted((r.place, r.rank, bytes(r.buckets), bytes(r.counts)) for r in first.collect())  # `train_rows` at most
    return [(k, np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(n, "<f4").astype(float)) for k, _, at, n in rows]


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model of the rows of `docs` (doc_id, text, lang) outside the held-out fold that have a lang and a text."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    usable = usable.where("lang is not null and text is not null").where(fold() != HELD_OUT_FOLD)
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGS).collect()
    counts = {r.lang: r.n for r in sorted(counts, key=lambda r: r.lang)}
    if not counts:
        return train([], np.ones(BUCKETS), [])
    idf = np.log((1 + sum(counts.values())) / (1 + np.minimum(document_frequencies(usable), sum(counts.values())))) + 1
    return train(list(counts), idf, sample(usable, counts, train_rows))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            found = [(UNKNOWN, 0.0)] * part.num_rows
            for row, counts in histograms(texts_of(part.column("text"))):
                found[row] = shared.value.predict(counts)
            columns = [part.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs)).select("doc_id", (fold() == HELD_OUT_FOLD).alias("held_out"), "lang_pred", "score")
