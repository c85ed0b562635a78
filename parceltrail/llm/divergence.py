"""Operator 11: source divergence audit by count-cell ranking.

How far the terms of a source lie from those of the other sources of its language, and which terms it uses more than the
language does. Shares are integers, p = 1 + floor(10**9 * (count + 5) / (N + 5 V)), computed by two exact long divisions
(counts below 2.9 * 10**14; beyond that Spark reports an overflow).

A term's value depends on nothing but its count in the group and in the language. So terms are counted by cells (group count,
language count), the value is taken once for each cell, cells of equal value merge, and a running sum of their multiplicities
says which values hold the first ranks. Only terms of those cells are read again, and ranked in UTF-8 order within a value.
Pairs of sources are summed over cells (count in one, count in the other) in the same way, block of terms by block of terms.

A null text, lang or source counts as ''. Every occurring (lang, source) takes part in pairs, also one without terms, and has
value 0 where the language keeps no term. Rows are documents: repeated rows, also of one or of a null doc_id, count as often
as they occur. Equal values rank by the item's UTF-8 bytes. Other columns are ignored, an empty table gives an empty result.

Work is spread by (lang, source, term), counted within slices and tasks before the shuffle, so a frequent term or a source
with a third of all rows sends a row per task. The first values of a group come from its tasks' own first values. Blocks of
terms and strips of sources bound what a task holds of a language, however many of either there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_slices, byte_view, documents, stored
from parceltrail.llm.rolling import runs

MIN_DOCS, ADDED, TOP = 30, 5, 50
SCALE = (31_250, 32_000)  # 10**9 in two factors, so that products stay longs
#: Rows of counts in a block (between the two, the square of the number of sources), and sources in a strip.
BLOCK_ROWS, STRIP = (1 << 16, 1 << 20), 512
_LETTER = np.zeros(256, np.uint8)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, place in these of each occurrence, row of each occurrence) of an Arrow string column."""
    data, ends = byte_view(column)
    kind = _LETTER[data]
    starts, stops = runs(kind, ends)
    offsets = np.r_[0, np.cumsum(stops - starts)]
    letters = _LOWER[data[kind != 0]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), np.searchsorted(ends, starts, side="right") - 1


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that have it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            terms, place, row = terms_of(part.column("text"))
            if not len(place):
                continue
            pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
            names = sorted(set(pairs))
            number = {pair: k for k, pair in enumerate(names)}
            group = np.array([number[pair] for pair in pairs], np.int64)
            by_row, n = np.unique(row * len(terms) + place, return_counts=True)
            by_group, at = np.unique(group[by_row // len(terms)] * len(terms) + by_row % len(terms), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([pair[k] for pair in names]).take(pa.array(by_group // len(terms))) for k in (0, 1)),
                    terms.take(pa.array(by_group % len(terms))).cast(pa.binary()).cast(pa.string()),
                    pa.array(np.bincount(at, n).astype(np.int64)),
                    pa.array(np.bincount(at).astype(np.int64)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    parts = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """p of a count, from the names of its column, of N's and of V's."""
    over = f"({total} + {ADDED} * {terms})"
    first = f"({count} + {ADDED}) * {SCALE[0]}L"
    return F.expr(f"1L + ({first} div {over}) * {SCALE[1]}L + ({first} % {over}) * {SCALE[1]}L div {over}")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """As `share`, for an array."""
    over = max(total + ADDED * terms, 1)
    first = (counts + ADDED) * SCALE[0]
    return 1 + first // over * SCALE[1] + first % over * SCALE[1] // over


def cell_sums(own: pd.DataFrame, groups: pd.DataFrame, first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
    """(source, sums of f over the block's terms with each later source) for sources from `first` to before `last`.

    Sources are places in `groups`. `own`: source, term, n of the block; `groups`: source, size (N) and terms (V), a row per
    source of the language.
    """
    place, names = pd.factorize(own["term"])
    width, count = len(names), own["n"].to_numpy(np.int64)
    which = pd.Index(groups["source"]).get_indexer(own["source"])
    held, kinds, values, times = [], [], [], []
    for k, (size, terms) in enumerate(zip(groups["size"].tolist(), groups["terms"].tolist())):
        mine = np.flatnonzero(which == k) if len(own) else np.zeros(0, np.int64)
        distinct, kind, often = np.unique(count[mine], return_inverse=True, return_counts=True)
        held.append(place[mine])
        kinds.append(kind + 1)  # kind 0: the source doesn't have the term
        values.append(shares(np.r_[0, distinct], size, terms))
        times.append(np.r_[0, often])
    for s in range(first, min(last, len(groups))):
        kind_of = np.zeros(width, np.int64)
        kind_of[held[s]] = kinds[s]
        sums = np.zeros(len(groups) - s - 1, np.int64)
        for t in range(s + 1, len(groups)):
            met = kind_of[held[t]]
            cells, many = np.unique(met * len(values[t]) + kinds[t], return_counts=True)
            f = np.abs(values[s][cells // len(values[t])] - values[t][cells % len(values[t])])
            alone = times[s] - np.bincount(met, minlength=len(times[s]))  # terms of s that t doesn't have
            alone[0] = width - len(held[t]) - alone[1:].sum()
            sums[t - s - 1] = f @ many + np.abs(values[s] - values[t][0]) @ alone
        yield s, sums


def pair_sums(
    counts: DataFrame, groups: DataFrame, langs: DataFrame, block_rows: tuple[int, int] = BLOCK_ROWS, strip: int = STRIP
) -> DataFrame:
    """lang, source, item (another source) and value of every ordered pair of a language's sources."""
    low, high = block_rows
    wide = langs.select(
        "lang",
        F.ceil(F.col("rows") / F.least(F.greatest(F.col("sources") * F.col("sources"), F.lit(low)), F.lit(high))).alias("blocks"),
        F.ceil(F.col("sources") / strip).alias("strips"),
    ).select("lang", F.greatest("blocks", F.lit(1)).alias("blocks"), "strips")
    strips = F.explode(F.sequence(F.lit(0), (F.col("strips") - 1).cast("int"))).alias("strip")
    dealt = counts.join(wide, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int"))
    dealt = dealt.select("lang", "block", strips, "source", "term", "n")
    tasks = groups.join(wide, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    tasks = tasks.select("lang", "block", strips, "source", "size", "terms")

    def run(key: tuple, own: pd.DataFrame, all_groups: pd.DataFrame) -> pd.DataFrame:
        all_groups = all_groups.sort_values("source", ignore_index=True)
        names = all_groups["source"].to_numpy()
        parts = [
            pd.DataFrame({"lang": key[0], "source": names[s], "item": names[s + 1 :], "value": sums})
            for s, sums in cell_sums(own, all_groups, int(key[2]) * strip, int(key[2] + 1) * strip)
        ]
        return pd.concat(parts) if parts else pd.DataFrame(columns=["lang", "source", "item", "value"])

    keys = ["lang", "block", "strip"]
    sums = dealt.groupBy(*keys).cogroup(tasks.groupBy(*keys)).applyInPandas(run, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(*(F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("source", "item"), ("item", "source"))))
    return sums.select("lang", F.explode(both).alias("p"), "value").select("lang", "p.source", "p.item", "value")


def first_terms(counts: DataFrame, groups: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    """lang, source, item (a term), value and rank of the first terms of every group."""
    sized = counts.join(groups, ["lang", "source"]).join(langs.select("lang", F.col("size").alias("lang_size")), "lang")
    cells = sized.groupBy("lang", "source", "n", "total", "size", "lang_size", "terms").agg(F.count(F.lit(1)).alias("many"))
    cells = cells.withColumns({"p": share("n", "size", "terms"), "q": share("total", "lang_size", "terms")}).where("p > q")
    cells = stored(cells.select("lang", "source", "n", "total", (F.col("p") - F.col("q")).alias("value"), "many"), "cells")
    values = cells.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # A value is one term at least: no more than the `top` largest can matter, and each task passes on only its own.
    values = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("many").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    best = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value")
    items = counts.join(best, ["lang", "source", "n", "total"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = items.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_rows: tuple[int, int] = BLOCK_ROWS, strip: int = STRIP
) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: all pairs of sources, and the first `top` terms of each group."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    everything = stored(term_counts(plain), "counts")
    kept = everything.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= min_docs).select("lang", "term", "total")
    counts = stored(everything.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept")

    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("rows"))
    widths = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = plain.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(widths, "lang", "left")
    groups = stored(groups.fillna(0, ["size", "rows", "terms"]), "groups")
    langs = groups.groupBy("lang").agg(
        F.sum("size").alias("size"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("sources"), F.max("terms").alias("terms")
    )
    langs = stored(langs, "langs")
    groups = groups.select("lang", "source", "size", "terms")

    pairs = pair_sums(counts, groups, langs, block_rows, strip)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    fields = ["lang", "source", "part", "item", "value", "rank"]
    terms = first_terms(counts, groups, langs, top)
    return pairs.withColumn("part", F.lit("pair")).select(fields).unionByName(terms.withColumn("part", F.lit("term")).select(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), t AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counted GROUP BY lang, source) s ON g.lang = s.lang AND g.source = s.source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5) // (g.n + 5 * l.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.total + 5) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank
  FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT),
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INT)
  FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
