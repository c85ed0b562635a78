"""Operator 8: mixing sources to target weights by cube-method balanced sampling.

A document's expected number of copies is its source's target over its source's size. The whole part is taken; the
fractional parts are inclusion probabilities that the cube method moves to 0 or 1: of three undecided documents at a time
they move along the vector that leaves both the token total and the document total as they are, one way or the other by
a coin whose odds keep every expectation, until one of the three is decided. Documents are dealt to bounded blocks of
their source by hash; what a block leaves undecided (two documents at most) meets in the next round's blocks, until one
block a source is left. The last block holds back its smallest documents (HELD_BACK at most) for the landing, which brings
the token total to its due within about the smallest document.

Sizes count words; a null text counts 0. Null is a source of its own, last in order. A source of size 0 has target 0 and
takes nothing. Rows that repeat a doc_id are documents of their own in `mix`; in `mixed_documents` rows of one doc_id share one
number of copies, the largest. Extra columns are ignored by `mix` and carried by
`mixed_documents`. The coins come from hashes of source and block: reruns agree, also after a lost executor.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import WORD_GAPS, cut, documents, free_names, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK_ROWS = 4096
HELD_BACK = 64
EDGE = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    words = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), WORD_GAPS), "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.size(words).cast("long").alias("size"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, source_docs, target of every source.

    Weights repeat over sources in code-point order, null last. Targets are `weight * level`, at most `most` times the
    source's size, where the level makes them sum to all sizes: what resharing the excess by weight comes to. The windows
    run over one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    cap = (F.col("source_size") * most).cast("double")
    ranked = sources.withColumn("weight", F.element_at(table, (place % len(weights) + 1).cast("int"))).withColumn("cap", cap)
    # In order of the level at which they reach their caps, the first source that the level of the rest doesn't fill ends it.
    rising = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(onward)).withColumn("at", F.row_number().over(rising))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))
    level = F.min(fits).over(every)["level"]
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(level, F.lit(0.0)))
    return ranked.withColumn("target", target).select("source", "source_size", "source_docs", "target")


def _step(p: list[float], size: list[float], coin: Callable[[], float]) -> None:
    """Moves two or three probabilities along a balanced direction until one is 0 or 1."""
    if len(p) == 3:
        along = [size[1] - size[2], size[2] - size[0], size[0] - size[1]]
        if not any(along):
            along = [1.0, -1.0, 0.0]
    else:
        along = [1.0, -1.0]
    up = min((((1 - x) / u) if u > 0 else (x / -u)) for x, u in zip(p, along) if u)
    down = min(((x / u) if u > 0 else ((1 - x) / -u)) for x, u in zip(p, along) if u)
    move = up if coin() * (up + down) < down else -down
    for k, u in enumerate(along):
        x = p[k] + move * u
        p[k] = 0.0 if x < EDGE else 1.0 if x > 1 - EDGE else x


def flight(p: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities after the flight phase: at most two remain between 0 and 1; both totals are as before."""
    coin = random.Random(seed).random
    out = p.copy()
    held: list[int] = []
    own_p: list[float] = []
    own_size: list[float] = []
    for k, (x, s) in enumerate(zip(p.tolist(), size.tolist())):
        if not EDGE < x < 1 - EDGE:
            continue
        held.append(k)
        own_p.append(x)
        own_size.append(s)
        while len(held) == 3 or (len(held) == 2 and own_size[0] == own_size[1]):
            _step(own_p, own_size, coin)
            for j in reversed(range(len(held))):
                if own_p[j] in (0.0, 1.0):
                    out[held[j]] = own_p[j]
                    del held[j], own_p[j], own_size[j]
    for j, k in enumerate(held):
        out[k] = own_p[j]
    return out


def landing(p: np.ndarray, size: np.ndarray, back: np.ndarray, seed: int) -> np.ndarray:
    """Decides what the flight left open and the documents held `back` for it (positions, large to small).

    Coins decide while the rest can still bring the token total to its due; the smallest then fill what is due.
    """
    coin = random.Random(seed).random
    out = p.copy()
    left = np.setdiff1d(np.flatnonzero((p > EDGE) & (p < 1 - EDGE)), back)
    left = left[np.argsort(-size[left], kind="stable")]
    ordered = [*left.tolist(), *back.tolist()]
    due, room = float((p[ordered] * size[ordered]).sum()), float(size[ordered].sum())
    by_coin = len(left) + len(back) // 2
    for n, k in enumerate(ordered):
        s = float(size[k])
        room -= s
        if n < by_coin:
            take = bool(coin() < p[k])
            beyond = [max(due - t * s - room, t * s - due, 0.0) for t in (False, True)]
            take = take if beyond[take] <= beyond[not take] else not take
        else:
            take = bool(s <= due or (n == len(ordered) - 1 and s < 2 * due))
        out[k] = float(take)
        due -= take * s
    return out


def _round(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def decide(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "spread", "doc_id"], ascending=[False, True, True], kind="stable")
        source = block["source"].iloc[0]
        seed = xxhash.xxh64_intdigest(f"{source!r} {int(block['block'].iloc[0])} {last}".encode())
        p, size = block["p"].to_numpy(float), block["size"].to_numpy(float)
        if not last:
            return block.assign(p=flight(p, size, seed))
        undecided = np.flatnonzero((p > EDGE) & (p < 1 - EDGE))
        back = undecided[-min(HELD_BACK, len(undecided) // 2) :] if len(undecided) > 1 else undecided[:0]
        held = p[back]
        p[back] = 0.0
        p = flight(p, size, seed)
        p[back] = held
        return block.assign(p=landing(p, size, back, seed + 1))

    return decide


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row."""
    sized = stored(sizes(docs), "sizes")
    of_source = cut(targets(sized, weights, most))
    largest = of_source.agg(F.max("source_docs")).first()[0] or 1
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    keyed = of_source.withColumnRenamed("source", "of")
    rows = sized.join(keyed, sized["source"].eqNullSafe(keyed["of"])).drop("of").withColumns({
        "whole": F.floor(ratio + EDGE), "p": F.greatest(ratio - F.floor(ratio + EDGE), F.lit(0.0)),
        "spread": F.xxhash64("doc_id", "source", "size"), "blocks": F.ceil(F.col("source_docs") / BLOCK_ROWS),
    })
    rows = rows.withColumn("block", F.pmod("spread", "blocks")).drop("source_docs", "blocks")
    schema = rows.schema
    done, blocks = None, math.ceil(largest / BLOCK_ROWS)
    while True:
        rows = cut(rows.groupBy("source", "block").applyInPandas(_round(blocks == 1), schema))
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        decided = rows.where(~undecided)
        done = decided if done is None else done.unionByName(decided)
        if blocks == 1:
            break
        rows = rows.where(undecided).withColumn("block", F.floor(F.col("block") / (BLOCK_ROWS // 4)))
        blocks = math.ceil(blocks / (BLOCK_ROWS // 4))
    copies = (F.col("whole") + F.col("p")).cast("long")
    return done.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with all columns."""
    found = mix(docs, weights, most).where("copies > 0")
    of, copies, copy = free_names(docs, "of", "copies", "copy")
    found = found.groupBy(F.col("doc_id").alias(of)).agg(F.max("copies").alias(copies))
    taken = docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found[of])).drop(of)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies, copy)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(documents(spark, sf_dir))
    return found.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
