"""Exact, near and repeated-string duplicates against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parceltrail.llm import cube_mix, exact_dedup, simhash, suffix_dedup
from parceltrail.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_fuse_filter_holds_its_keys_and_few_others():
    dice = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 1000, 50_000):
        keys = np.unique(dice.integers(0, 2**63, n).astype(np.uint64))
        made = exact_dedup.FuseFilter.unpacked(exact_dedup.FuseFilter.build(keys).packed())
        assert made.holds(keys).all()
        assert made.holds(dice.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01


def exact_expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", ["doc_id <= 4", "doc_id < 0", "doc_id is not null"])
def test_exact_duplicates_of_odd_documents(odd, odd_rows, cut):
    got = exact_dedup.find_duplicates(odd, F.expr(cut)).collect()
    assert sorted(map(tuple, got), key=str) == exact_expected([r[:2] for r in odd_rows])


def test_exact_duplicates(docs, plain_docs, empty):
    got = exact_dedup.find_duplicates(docs, exact_dedup.older_half(docs)).collect()
    assert sorted(map(tuple, got), key=str) == exact_expected([r[:2] for r in plain_docs])
    assert exact_dedup.find_duplicates(empty, exact_dedup.older_half(empty)).count() == 0


def test_exact_duplicates_leave_with_all_columns(odd, odd_rows):
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns
    want = {(keep, sha) for _, keep, _, _, sha in exact_expected([r[:2] for r in odd_rows])}
    got = [(r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in left.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    dice = np.random.default_rng(5)
    pairs = [*((i, i + 1) for i in range(60)), *((200, 100 + i) for i in range(50)), *map(tuple, dice.integers(300, 400, (60, 2)).tolist())]
    want = union_find({n for p in pairs for n in p}, pairs)
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if any(n in p and p[0] != p[1] for p in pairs)}


def plain_print(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(found[i : i + words]) for i in range(max(len(found) - words + 1, min(1, len(found))))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_in_the_radius(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    dice = np.random.default_rng(radius)
    for _ in range(500):
        apart = sum(1 << int(b) for b in dice.choice(64, radius, replace=False))
        assert any(not mask & apart for mask in masks)


def near_expected(rows, words, radius):
    prints = [plain_print(text, words) for _, text in rows]
    at = list(range(len(rows)))
    pairs = [(i, j) for i in at for j in at[:i] if (prints[i] ^ prints[j]).bit_count() <= radius]
    root = union_find(at, pairs)
    heads = defaultdict(list)
    for i in at:
        heads[root[i]].append(rows[i][0])
    low = {r: min((d for d in ids if d is not None), default=None) for r, ids in heads.items()}
    return sorted(((rows[i][0], prints[i], low[root[i]]) for i in at), key=str)


def test_near_duplicates(docs, plain_docs, odd, odd_rows, empty):
    for frame, rows in ((docs, [r[:2] for r in plain_docs]), (odd, [r[:2] for r in odd_rows])):
        got = simhash.near_duplicates(frame, 4, 4).collect()
        assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == near_expected(rows, 4, 4)
    assert simhash.near_duplicates(empty).count() == 0


def test_large_buckets_lose_no_link():
    dice = np.random.default_rng(8)
    centres = dice.integers(0, 2**63, 40).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in dice.choice(32, 2, replace=False)) for _ in range(6000)], np.uint64)
    values = np.unique((centres[dice.integers(0, 40, 6000)] & ~np.uint64(0xFFFFFFFF)) ^ flips)[:, None]
    edges = simhash.bucket_edges(values, (1 << 64) - 1, 4)
    close = [(i, int(j)) for i in range(0, len(values), 7) for j in np.flatnonzero(np.bitwise_count(values[:, 0] ^ values[i, 0]) <= 4)]
    root = union_find(range(len(values)), edges)
    assert all(root[i] == root[j] for i, j in close)


@pytest.mark.parametrize("bits", range(5, 65))
def test_masks_are_distinct_and_never_zero(bits):
    masks = simhash.covering_masks(list(range(bits)), 4)
    assert len(set(masks)) == len(masks) == 31 and 0 not in masks


@pytest.mark.parametrize("bits", [[*range(16)], [0, 3, *range(8, 40, 3), 41, 50, 63]])
def test_cutting_ends_within_few_free_bits(bits):
    dice = np.random.default_rng(4)
    picked = dice.choice(1 << len(bits), 3000, replace=False)
    values = np.array([sum(1 << b for k, b in enumerate(bits) if v >> k & 1) for v in picked.tolist()], np.uint64)[:, None]
    edges = simhash.bucket_edges(values, sum(1 << b for b in bits), 4)
    close = [(i, int(j)) for i in range(0, len(values), 7) for j in np.flatnonzero(np.bitwise_count(values[:, 0] ^ values[i, 0]) <= 4)]
    root = union_find(range(len(values)), edges)
    assert all(root[i] == root[j] for i, j in close)


def test_cutting_ends_for_equal_first_columns():
    values = np.stack([np.full(5000, 77), np.arange(5000) % 8], axis=1).astype(np.uint64)
    root = union_find(range(5000), simhash.bucket_edges(values, (1 << 32) - 1, 4, 3))
    assert len(set(root.values())) == 1


def stays_expected(rows, words, radius):
    """doc_ids of the rows that stay: of each component the smallest, one without doc_id only if there is no other."""
    prints = [plain_print(text, words) for _, text in rows]
    at = list(range(len(rows)))
    root = union_find(at, [(i, j) for i in at for j in at[:i] if (prints[i] ^ prints[j]).bit_count() <= radius])
    heads = {}
    for i in at:
        heads[root[i]] = min(heads.get(root[i], (2,)), (rows[i][0] is None, rows[i][0] or 0))
    return sorted((None if without else doc_id for without, doc_id in heads.values()), key=str)


def near_rows():
    """Texts with small changes of their own, so that fingerprints lie 0 to 20 bits apart, copies in hot groups, odd rows."""
    dice = np.random.default_rng(2)
    texts, rows = [[f"w{int(x)}" for x in dice.zipf(1.4, int(n)) % 3000] for n in dice.integers(1, 400, 60)], []
    for text in texts:
        for changes in (0, 0, 1, 2, 5, 20):
            copy = text.copy()
            for where in dice.integers(0, len(copy), changes).tolist():
                copy[where] = "swapped"
            rows.append(" ".join(copy) if changes else "\t".join(copy).upper())
    rows += [rows[7]] * 200 + [None, "", " \n", "one", "ONE"]
    return [(int(k), t) for k, t in zip(dice.permutation(len(rows)), rows)] + [(None, rows[9]), (None, "no other like it"), (None, "no other like it"), (3, rows[9])]


@pytest.mark.parametrize(("words", "radius"), [(4, 4), (1, 2)])
def test_one_row_of_each_component_stays(spark, words, radius):
    rows = near_rows()
    names = "doc_id long, text string, __doc_id int, __KEY string, key int, fp int, __of string, row int, label int, head string"
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3, "o", 4, 5, "h") for r in rows], names).repartition(5)
    left = simhash.drop_near_duplicates(frame, words, radius)
    assert left.columns == frame.columns
    got, want = left.collect(), stays_expected(rows, words, radius)
    assert sorted((r.doc_id for r in got), key=str) == want
    assert 30 < len(want) < len(rows) - 200 and all((r.doc_id, r.text) in set(rows) for r in got)


def test_one_row_of_each_component_of_the_test_data(docs, plain_docs, odd, odd_rows, empty):
    for frame, rows in ((docs, [r[:2] for r in plain_docs]), (odd, [r[:2] for r in odd_rows])):
        left = simhash.drop_near_duplicates(frame)
        assert left.columns == frame.columns
        assert sorted((r.doc_id for r in left.collect()), key=str) == stays_expected(rows, 4, 4)
    assert simhash.drop_near_duplicates(empty).columns == empty.columns and simhash.drop_near_duplicates(empty).count() == 0


def test_rows_of_one_doc_id_are_told_apart(spark):
    rows = [(9, "one text of an id"), (9, "another text of one id"), (9, "one text of an id"), (10, "another text of one id")]
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, left.collect())) == [(9, "another text of one id"), (9, "one text of an id")]


def test_work_columns_take_free_names(spark):
    rows = [(1, "a b c", "x"), (1, "A b c", "y"), (2, "other words here", "z")]
    clashes = ["__doc_id", "__digest", "__of", "__copies", "__copy", "__Key", "__of_", "__of_key"]
    for more in (clashes[:4], clashes[4:]):
        columns = ", ".join(f"{c} string" for c in more)
        frame = spark.createDataFrame([(*r, *r[2:] * (len(more) - 1)) for r in rows], f"doc_id long, text string, {columns}")
        assert exact_dedup.drop_duplicates(frame).columns == frame.columns
        assert {r[2] for r in simhash.drop_near_duplicates(frame).collect()} <= {"x", "y", "z"}
        assert {r.doc_id for r in cube_mix.mixed_documents(frame.withColumn("source", F.lit("s"))).collect()} <= {1, 2}


def repeats_expected(rows):
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k in range(len(text) - 49):
            first.setdefault(text[k : k + 50], doc_id)
    out = []
    for doc_id, text in rows:
        change = np.zeros(len(text) + 1, int)
        for k in range(len(text) - 49):
            low = first[text[k : k + 50]]
            if low is not None and (doc_id is None or low < doc_id):
                change[k] += 1
                change[k + 50] -= 1
        gone = np.cumsum(change)[:-1] > 0
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("chunk_bytes", "hot_chunks", "part_bytes"), [(2_000_000, 256, 1 << 26), (20_000, 3, 30_000), (3_000, 2, 1 << 26)])
def test_repeated_strings(docs, plain_docs, odd, odd_rows, chunk_bytes, hot_chunks, part_bytes):
    for frame, rows in ((docs, plain_docs), (odd, odd_rows)):
        got = suffix_dedup.remove_repeats(frame, False, chunk_bytes, hot_chunks, part_bytes).collect()
        assert sorted(map(tuple, got), key=str) == repeats_expected([(r[0], (r[1] or "").encode()) for r in rows])


def test_repeated_strings_of_nothing(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_order_is_the_order_of_the_strings():
    dice = np.random.default_rng(4)
    data = dice.choice(np.frombuffer(b"ab", np.uint8), 4000)
    starts = dice.integers(0, 3900, 1500)
    sizes = dice.integers(1, 90, 1500)
    pieces = suffix_dedup.Suffixes(data, suffix_dedup.PrefixHash(data), starts, sizes)
    order, equal = pieces.order()
    texts = [data[a : a + s].tobytes() for a, s in zip(starts, sizes)]
    assert [texts[k] for k in order] == sorted(texts)
    assert equal.tolist() == [k > 0 and texts[order[k]] == texts[order[k - 1]] for k in range(len(order))]
