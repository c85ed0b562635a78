"""Operator 2: exact duplicates, screened by static binary-fuse filters of an immutable snapshot.

A snapshot keeps one row per distinct digest and, per hash bucket of digests, a binary-fuse filter of its members. An
incoming batch is first reduced to its distinct digests (duplicates inside the batch are grouped there), each is
screened by its bucket's filter, and only the filter's positives join the snapshot's exact buckets. Rows that share a
digest with any other row then have their bytes compared with the row that stays.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the largest doc_id
stays (a null doc_id is smaller than any). Rows that repeat a doc_id and its text are one group like any equal texts:
every row carrying the kept doc_id is marked kept, and `drop_duplicates` leaves one of them. Extra columns are ignored by
`find_duplicates` and carried by `drop_duplicates`. An empty table gives an empty result.

At scale only digests travel, but for the texts of the byte comparison; groups are pre-aggregated per task, buckets follow
the digest's hash, and the joins that a group of many copies makes uneven are plain equi-joins, whose partitions AQE
splits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.common import cut, documents, free_names, lower_ascii, shared_folder, stored

BUCKET_DIGESTS = 500_000


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) of keys under a seed."""
    x = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class FuseFilter:
    """A 3-wise binary-fuse filter with 8-bit fingerprints: three table cells xor to a member's fingerprint."""

    def __init__(self, seed: int, segment: int, cells: np.ndarray) -> None:
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """(three cells of each key in neighbouring segments, fingerprints)."""
        h = _mixed(keys, seed)
        starts = cells // segment - 2
        first = ((h >> np.uint64(32)) * np.uint64(starts * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """A filter of distinct 64-bit keys; peels all cells that one key is left in, round by round."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 2 ** max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3)))
        cells = (max(math.ceil(n * factor / segment), 1) + 2) * segment
        for seed in range(1, 200):
            places, prints = cls._places(keys, seed, segment, cells)
            count = np.bincount(places.ravel(), minlength=cells)
            owner = np.zeros(cells, np.int64)
            for row in places:
                np.bitwise_xor.at(owner, row, np.arange(n))
            rounds = []
            left = n
            alone = np.flatnonzero(count == 1)
            while len(alone):
                key, first = np.unique(owner[alone], return_index=True)
                rounds.append((key, alone[first]))
                left -= len(key)
                gone = places[:, key]
                for row in gone:
                    np.subtract.at(count, row, 1)
                    np.bitwise_xor.at(owner, row, key)
                alone = np.unique(gone)
                alone = alone[count[alone] == 1]
            if not left:
                table = np.zeros(cells, np.uint8)
                for key, cell in reversed(rounds):
                    own = places[:, key]
                    table[cell] = prints[key] ^ table[own[0]] ^ table[own[1]] ^ table[own[2]]
                return cls(seed, segment, table)
        raise RuntimeError("no seed peels this set of keys")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """True for every member, and for about one in 256 of the others."""
        places, prints = self._places(keys.astype(np.uint64), self.seed, self.segment, len(self.cells))
        return self.cells[places[0]] ^ self.cells[places[1]] ^ self.cells[places[2]] == prints

    def packed(self) -> bytes:
        return np.array([self.seed, self.segment], "<u4").tobytes() + self.cells.tobytes()

    @classmethod
    def unpacked(cls, raw: bytes) -> FuseFilter:
        seed, segment = np.frombuffer(raw, "<u4", 2).tolist()
        return cls(seed, segment, np.frombuffer(raw, np.uint8, offset=8))


@dataclass(frozen=True)
class Snapshot:
    """An immutable set of documents: `digests` has a row per distinct digest, `filters` one per bucket."""

    digests: DataFrame
    filters: DataFrame
    buckets: int


def digested(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(lower_ascii(F.col("text")), 256).alias("digest"))


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    """A row per digest: its bucket, 64-bit key, number of rows and largest doc_id."""
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.max("doc_id").alias("keep_id"))
    return groups.select("digest", "size", "keep_id", F.xxhash64("digest").alias("key")).withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    )


def build_snapshot(rows: DataFrame, buckets: int) -> Snapshot:
    """The snapshot of digested rows, stored in the shared folder: groups by bucket, and each bucket's filter."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        packed = FuseFilter.build(group["key"].to_numpy().view(np.uint64)).packed()
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1].to_numpy(), "filter": [packed]})

    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession)
    groups = _grouped(rows, buckets)
    groups.write.parquet(f"{folder}/digests")
    digests = spark.read.schema(groups.schema).parquet(f"{folder}/digests")
    filters = digests.select("bucket", "key").groupBy("bucket").applyInPandas(build, "bucket int, filter binary")
    filters.write.parquet(f"{folder}/filters")
    return Snapshot(digests, spark.read.schema(filters.schema).parquet(f"{folder}/filters"), buckets)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Distinct incoming digests (digest, size, keep_id, bucket, key) with `maybe`: the bucket's filter holds them."""

    def test(group: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy().view(np.uint64)
        held = FuseFilter.unpacked(filters["filter"].iloc[0]).holds(keys) if len(filters) else np.zeros(len(keys), bool)
        return group.assign(maybe=held)

    groups = _grouped(incoming, snapshot.buckets)
    schema = "digest string, size long, keep_id long, key long, bucket int, maybe boolean"
    return groups.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(test, schema)


def find_duplicates(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, a row for each row of `docs`.

    `in_snapshot`: condition on doc_id for the rows that form the snapshot; the others are the incoming batch.
    """
    spark = docs.sparkSession
    rows = stored(digested(docs), "digests")
    settled = F.coalesce(in_snapshot, F.lit(False))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / BUCKET_DIGESTS))
    snapshot = build_snapshot(rows.where(settled), buckets)
    screened = cut(screen(rows.where(~settled), snapshot))

    # Positives meet the exact bucket; what is in no second row anywhere needs no more work.
    positives = screened.where("maybe").select("bucket", "digest", "size", "keep_id")
    exact = snapshot.digests.select("bucket", "digest", F.col("size").alias("old_size"), F.col("keep_id").alias("old_id"))
    both = positives.join(exact, ["bucket", "digest"])
    part = lambda df: df.select("digest", "size", "keep_id")
    alike = (
        part(screened.where("size > 1"))
        .unionByName(part(snapshot.digests.where("size > 1")))
        .unionByName(part(both.where("size = 1")))
        .unionByName(both.where("old_size = 1").select("digest", F.col("old_size").alias("size"), F.col("old_id").alias("keep_id")))
        .groupBy("digest")
        .agg(F.sum("size").alias("group_size"), F.max("keep_id").alias("keep_id"))
    )
    alike = cut(alike)

    # Bytes of all rows of such a digest against those of the row that stays.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower_ascii(F.col("text")).alias("body"))
    members = stored(
        texts.withColumn("digest", F.sha2("body", 256)).join(alike.select("digest", "keep_id"), "digest"), "members"
    )
    models = (
        members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("body").alias("model"))
    )
    compared = members.join(stored(models, "models"), "digest").select(
        "doc_id", "digest", F.when(F.col("body") != F.col("model"), F.col("body")).alias("other")
    )
    compared = stored(compared, "compared")
    groups = compared.groupBy(F.col("digest").alias("of_digest"), F.col("other").alias("of_other")).agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")
    )
    groups = stored(groups, "groups")
    same = F.col("digest").eqNullSafe(F.col("of_digest")) & F.col("other").eqNullSafe(F.col("of_other"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    repeated = compared.join(groups, same).select(
        "doc_id", "keep_id", "group_size", kept, F.col("digest").alias("text_sha256")
    )
    single = rows.join(alike.select("digest"), "digest", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("digest").alias("text_sha256")
    )
    return single.unionByName(repeated)


def older_half(docs: DataFrame) -> Column:
    """The condition that splits the table at the middle of its range of doc_id."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") <= (0 if low is None else (low + high) // 2)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all columns."""
    found = find_duplicates(docs, older_half(docs)).where("kept").select("doc_id", "text_sha256").distinct()
    doc_id, digest = free_names(docs, "doc_id", "digest")
    keyed = docs.withColumns({doc_id: F.col("doc_id").cast("long"), digest: F.sha2(lower_ascii(F.col("text")), 256)})
    stays = keyed[doc_id].eqNullSafe(found["doc_id"]) & (keyed[digest] == found["text_sha256"])
    return keyed.join(found, stays, "left_semi").dropDuplicates([doc_id, digest]).drop(doc_id, digest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return find_duplicates(docs, older_half(docs))


SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
