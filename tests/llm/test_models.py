"""Language model, classifier, neighbours, mixing and licenses."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parceltrail.llm import class_lm, cube_mix, hilbert_ann, license_scan, quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def lm_result(frame):
    learned = frame.select("doc_id", "text").where(class_lm.fold() != class_lm.HELD_OUT_FOLD)
    return class_lm.score(frame, class_lm.fit(learned), learned.count()).collect()


def lm_expected(rows):
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    count, ends = Counter(), 0
    for doc_id, text in rows:
        if not held(doc_id):
            count.update(words(text))
            ends += 1
    total, distinct = sum(count.values()) + ends, len(count) + (ends > 0)
    unit = math.log10(total + distinct + 1)
    out = []
    for doc_id, text in rows:
        own = words(text)
        base = sum(math.log10(count[w] + 1) for w in own) + math.log10(ends + 1) - (len(own) + 1) * unit
        known = sum(count[w] > 0 for w in own) + (ends > 0)
        out.append((doc_id, held(doc_id), len(own) + 1, known, total, round(base, 6)))
    return sorted(out, key=str)


def test_language_model(docs, plain_docs, odd, odd_rows, empty):
    for frame, rows in ((docs, plain_docs), (odd, odd_rows)):
        got = lm_result(frame)
        short = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
        assert sorted(short, key=str) == lm_expected([r[:2] for r in rows])
        assert all(r.score < 0 for r in got)
    assert lm_result(empty) == []


def test_classes_predict_held_out_text_better_than_words_alone(docs):
    held = [r for r in lm_result(docs) if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def plain_classes(model):
    """word -> class by the model's list, others by ending, with nothing of the model's own lookup."""
    flat, listed = model.classes.frequent.flat.tobytes(), {}
    for k, (a, b) in enumerate(zip(model.classes.frequent.starts.tolist(), model.classes.frequent.stops.tolist())):
        if k < len(model.classes.of_word):
            listed[flat[a:b].decode()] = int(model.classes.of_word[k])

    def of(word):
        if word not in listed:
            one = class_lm.Words.of(pa.array([word]))
            listed[word] = int(model.classes.of_ending[one.endings()[0]])
        return listed[word]

    return of


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_class_model_against_brute_force(request, name):
    """Transitions, class sizes and scores recounted from the texts, given the classes; all probabilities sum to one."""
    frame = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    learned = frame.select("doc_id", "text").where(class_lm.fold() != class_lm.HELD_OUT_FOLD)
    model = class_lm.fit(learned, min_count=3)
    of, end = plain_classes(model), class_lm.CLASSES
    count, pairs = Counter(), np.zeros((end + 1, end + 1))
    texts = [words(t) for d, t in rows if not held(d)]
    for own in texts:
        count.update(own)
        path = [end, *map(of, own), end]
        for a, b in zip(path, path[1:]):
            pairs[a, b] += 1
    if name == "docs":
        assert len(model.classes.of_word) == sum(n >= 3 for n in count.values()) > class_lm.SEEDS + 100
    share = (pairs.sum(0) + 1) / (pairs.sum() + end + 1)
    step = (pairs + share) / (pairs.sum(1, keepdims=True) + 1)
    size = [sum(n + 1 for w, n in count.items() if of(w) == c) + 1 for c in range(end)] + [1]
    assert np.allclose(model.transition, np.log10(step)) and np.allclose(10**model.class_size, size)
    for previous in range(end + 1):
        total = sum(step[previous, of(w)] * (n + 1) / size[of(w)] for w, n in count.items())
        total += sum(step[previous, c] / size[c] for c in range(end)) + step[previous, end]  # unseen words, the end
        assert math.isclose(total, 1, rel_tol=1e-9)
    want = []
    for doc_id, text in rows:
        own = words(text)
        path = [end, *map(of, own), end]
        logs = sum(math.log10((count[w] + 1) / size[of(w)]) for w in own)
        want.append((str(doc_id), round(logs + sum(math.log10(step[a, b]) for a, b in zip(path, path[1:])), 6)))
    got = class_lm.score(frame, model, len(texts)).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted(want)


def test_words_beyond_the_list_are_clustered_too(spark, monkeypatch):
    """Words of min_count occurrences that no task can hold go to their best class; the model is that of the moved classes."""
    rng = np.random.default_rng(5)
    spelled = [f"{'abcdefgh'[k % 8]}{k}{'xyz'[k % 3]}" for k in range(400)]
    weight = 1 / np.arange(3, 403)
    texts = [" ".join(rng.choice(spelled, rng.integers(0, 40), p=weight / weight.sum())) for _ in range(300)]
    texts += ["a398z a398z a399x a398z", None, "", "unseen a398z a399x"] * 4
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    learned = frame.where(class_lm.fold() != class_lm.HELD_OUT_FOLD)
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    known = [words(t) for d, t in enumerate(texts) if not held(d)]
    count = Counter(w for own in known for w in own)
    tokens = sum(count.values()) + len(known)
    monkeypatch.setattr(class_lm, "FREQUENT", tokens // 30)  # words of 30 occurrences are listed
    model = class_lm.fit(learned, min_count=4)
    start, end = plain_classes(model), class_lm.CLASSES
    later = [w for w, n in count.items() if 4 <= n < max(2, tokens / class_lm.FREQUENT)]
    assert len(later) > len(model.classes.of_word) > 0

    def counted(of):
        pairs = np.zeros((end + 1, end + 1))
        for own in known:
            path = [end, *map(of, own), end]
            np.add.at(pairs, (path[:-1], path[1:]), 1)
        return pairs

    table, want = counted(start), {}
    for word in later:
        into, out, loop = np.zeros((1, end + 1)), np.zeros((1, end + 1)), np.zeros(1)
        for own in known:
            for k, w in enumerate(own):
                if w == word:
                    into[0, start(own[k - 1]) if k else end] += 1
                    out[0, start(own[k + 1]) if k + 1 < len(own) else end] += 1
                    loop += k + 1 < len(own) and own[k + 1] == word
        gain = class_lm.gains(table, into, out, loop, np.array([start(word)]))[0]
        if gain.max() > gain[start(word)] + 1e-9:
            want[word] = int(gain.argmax())
    got = {r.word: r.now for r in model.moves.collect()}
    assert got == want and len(want) > 20
    assert any(a in want and b in want for own in known for a, b in zip(own, own[1:]))

    of = lambda w: want.get(w) if w in want else start(w)
    pairs = counted(of)
    step = (pairs + (pairs.sum(0) + 1) / (pairs.sum() + end + 1)) / (pairs.sum(1, keepdims=True) + 1)
    size = [sum(n + 1 for w, n in count.items() if of(w) == c) + 1 for c in range(end)] + [1]
    assert np.allclose(model.transition, np.log10(step)) and np.allclose(10**model.class_size, size)
    scores = {r.doc_id: r.score for r in class_lm.score(frame, model, len(known)).collect()}
    for doc_id, text in enumerate(texts):
        own = words(text)
        path = [end, *map(of, own), end]
        plain = sum(math.log10((count[w] + 1) / size[of(w)]) for w in own) + sum(math.log10(step[a, b]) for a, b in zip(path, path[1:]))
        assert math.isclose(scores[doc_id], plain, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("apart", [True, False])
def test_words_beyond_the_list_make_no_rows_where_they_meet(spark, monkeypatch, apart):
    """Every stored step has a row for each text, block of words or distinct word, and scores come from rows of texts alone."""
    spelled = [f"{'abcdefgh'[k % 8]}{k}{'xyz'[k % 3]}" for k in range(60)]
    texts = [" ".join(f"{spelled[(k * 7 + j * (1 + k % 3)) % 60]}{' the' * apart}" for j in range(40)) for k in range(70)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(class_lm, "FREQUENT", 40)  # words of a 40th of all tokens are listed
    made, write = Counter(), class_lm.stored

    def counted(df, name):
        kept = write(df, name)
        made[name] += kept.count()
        return kept

    monkeypatch.setattr(class_lm, "stored", counted)
    learned = frame.where(class_lm.fold() != class_lm.HELD_OUT_FOLD)
    model = class_lm.fit(learned, min_count=4)
    result = class_lm.score(frame, model, learned.count())
    assert len(result.collect()) == 70 and model.moves.count() > 1
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made["open"] <= 2 * (min(60, blocks) + 1)  # of a task: a row for each block that has words, and its table
    assert made["moves"] <= made["counts"] <= 61
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_numbers_of_words_beyond_a_long_list():
    """Endings are counted from the list's length on, also where that needs more than two bytes."""
    low = np.array([7, 500 | class_lm.FREE, 70_000 & 0xFFFF, 3], "<u2")
    high = np.array([class_lm.RARE, class_lm.RARE, 70_000 >> 16, 0], np.uint8)
    sizes = np.array([1, 0, 3])
    part = pa.RecordBatch.from_arrays([class_lm.pieces(low, sizes), class_lm.pieces(high, sizes)], ["low", "high"])
    index, row, free = class_lm.indices(part, 80_000)
    assert index.tolist() == [80_007, 80_500, 70_000, 3] and row.tolist() == [0, 2, 2, 2]
    assert free.tolist() == [False, True, False, False]
    index, row, free = class_lm.indices(part.slice(1), 80_000)
    assert index.tolist() == [80_500, 70_000, 3] and row.tolist() == [1, 1, 1]


def test_rows_come_together_over_batches():
    row = [1, 1, 2, 3, 3, 3, 3, 3, 5]
    whole = pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(range(9))], ["row", "n"])
    for cut in (1, 2, 3, 9):
        got = list(class_lm.whole_rows(whole.slice(a, cut) for a in range(0, 9, cut)))
        assert [x for b in got for x in b.column("n").to_pylist()] == list(range(9))
        seen = [x for b in got for x in set(b.column("row").to_pylist())]
        assert len(seen) == len(set(seen)) == 4


def test_moves_follow_the_likelihood():
    """The gain of a move is what the class bigrams' likelihood gains by it, recounted from the words."""
    dice = np.random.default_rng(3)
    table = dice.integers(0, 9, (13, 13))
    of = np.r_[dice.integers(0, 4, 12), 4]

    def likelihood(classes):
        hot = np.eye(5)[classes]
        between = hot.T @ table @ hot
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(between) - f(between.sum(0)) - f(between.sum(1))

    hot = np.eye(5)[of]
    at = np.arange(12)
    gain = class_lm.gains(hot.T @ table @ hot, (table.T @ hot)[:12], (table @ hot)[:12], table[at, at].astype(float), of[:12])
    assert (gain[:, 4] == -np.inf).all()
    for w in range(12):
        for c in range(4):
            other = of.copy()
            other[w] = c
            assert math.isclose(gain[w, c] - gain[w, of[w]], likelihood(other) - likelihood(of), abs_tol=1e-6)


def test_gains_of_words_with_few_neighbours():
    """The shorter sum has the same gains, with the word's own class, itself and nothing beside it."""
    dice = np.random.default_rng(4)
    table = dice.integers(0, 2, (41, 41)) * dice.integers(0, 5, (41, 41))
    table[5], table[:, 6] = 0, 0
    of = np.r_[dice.integers(0, 7, 40), 7]
    hot = np.eye(8)[of]
    at = np.arange(40)
    given = (hot.T @ table @ hot, (table.T @ hot)[:40], (table @ hot)[:40], table[at, at].astype(float), of[:40])
    got, want = class_lm.few_gains(*given), class_lm.gains(*given)
    assert np.allclose(got[:, :-1], want[:, :-1], atol=1e-7) and (got[:, -1] == -np.inf).all()


def test_contexts_are_packed_without_loss():
    for codes, n in (([], []), ([0, 3, 300], [1, 2, 3]), ([7, 70_000, 536_000], [1, 300, 1 << 40])):
        got = class_lm.unpacked(*class_lm.packed(np.array(codes, np.int64), np.array(n, np.int64)))
        assert [x.tolist() for x in got] == [codes, n]


def test_rounds_in_spark_raise_the_likelihood(docs):
    held = {}
    for rounds in (0, 2):
        learned = docs.select("doc_id", "text").where(class_lm.fold() != class_lm.HELD_OUT_FOLD)
        model = class_lm.fit(learned, rounds, min_count=5)
        held[rounds] = sum(r.score for r in class_lm.score(docs, model, learned.count()).collect() if not r.held_out)
    assert held[2] > held[0]


def test_exchange_finds_classes():
    dice = np.random.default_rng(1)
    table = dice.integers(0, 20, (class_lm.UNITS + 1, class_lm.UNITS + 1))
    of = class_lm.exchange(table, classes=8, rounds=1)
    assert of[-1] == 8 and set(of[:-1].tolist()) <= set(range(8))
    halves = np.zeros((21, 21), int)
    halves[:10, 10:20], halves[10:20, :10] = dice.integers(1, 30, (2, 10, 10))
    of = class_lm.exchange(halves, classes=2, rounds=6)
    assert len(set(of[:10].tolist())) == len(set(of[10:20].tolist())) == 1 and of[0] != of[10]


def test_quality(spark, docs, sf_dir, odd, odd_rows, empty):
    labels = quality.labels_of(spark, sf_dir)
    vectors, net = quality.fit(docs, labels)
    scored = quality.score(docs, vectors, net).join(labels, "doc_id").where(quality.fold() == quality.HELD_OUT_FOLD)
    rows = [(r.score, r.quality) for r in scored.collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    got = quality.score(odd.drop("score"), vectors, net).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert quality.keep_good(odd, labels.where("false")).columns == odd.columns
    nothing = quality.keep_good(empty, labels)
    assert nothing.columns == empty.columns and nothing.count() == 0


def vector_rows():
    dice = np.random.default_rng(6)
    rows = [(k, v.tolist()) for k, v in enumerate(dice.normal(size=(900, 12)).astype(np.float32))]
    twin = rows[100][1]
    rows += [(1000 + k, twin) for k in range(30)]
    rows += [(150, rows[150][1]), (2000, None), (2050, [0.0] * 12), (2001, [None] + [1.0] * 11), (2002, [float("nan")] + [1.0] * 11)]
    return [*rows, (2003, [1.0, 2.0]), (None, [1.0] * 12), (2004, [float("inf")] + [1.0] * 11)]


@pytest.mark.parametrize("block", [512])
def test_neighbours(spark, block):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cls": F.lit(1), "ids": F.lit("x")})
    got = {}
    for r in hilbert_ann.search(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    usable = {k: np.array(v, np.float64) for k, v in rows if k is not None and k < 2000}
    ids = np.array(sorted(usable))
    table = np.stack([usable[k] for k in ids.tolist()])
    norms = np.sqrt((table * table).sum(1))
    hits = asked = 0
    assert set(got) == {k for k in usable if k % 50 == 0}
    for q, found in got.items():
        score = table @ usable[q] / norms / np.sqrt((usable[q] ** 2).sum())
        order = [ids[k] for k in np.lexsort((ids, -score.round(12))) if ids[k] != q][:5]
        assert sorted(found) == [1, 2, 3, 4, 5]
        hits += len({v for v, _ in found.values()} & {int(i) for i in order})
        asked += 5
        assert all(abs(s - score[np.flatnonzero(ids == v)[0]]) < 1e-12 for v, s in found.values())
    assert hits / asked >= 0.9
    few = spark.createDataFrame([(50, [1.0, 0.0]), (51, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in hilbert_ann.search(few, F.col("vec_id") % 50 == 0).collect()] == [(50, 1, 51, 0.0)]
    assert hilbert_ann.search(few.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_hilbert_curve_visits_all_cells_in_steps_of_one():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert_ann.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def mix_expected(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cube_mix.WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        open_ -= over or open_
    return target


def test_mix(docs, plain_docs, odd, odd_rows, empty):
    for frame, rows in ((docs, plain_docs), (odd, [(r[0], r[1], r[3]) for r in odd_rows])):
        got = cube_mix.mix(frame).collect()
        sizes = Counter()
        for _, text, source in rows:
            sizes[source] += len(words(text))
        target = mix_expected(dict(sizes))
        taken, largest = Counter(), Counter()
        for r in got:
            assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
            assert 0 <= r.copies <= 3
            taken[r.source] += r.copies * r.size
            largest[r.source] = max(largest[r.source], r.size)
        assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), len(words(t))) for d, t, _ in rows)
        assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
        assert sorted(map(str, cube_mix.mix(frame).collect())) == sorted(map(str, got))
    assert cube_mix.mix(empty).count() == 0


def test_flight_keeps_both_totals():
    dice = np.random.default_rng(3)
    p, size = dice.random(500), dice.integers(0, 2000, 500)
    out = cube_mix.flight(p, size, 1)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert math.isclose(out.sum(), p.sum(), abs_tol=1e-5) and math.isclose((out * size).sum(), (p * size).sum(), rel_tol=1e-6)


def test_mixed_documents_repeat(odd):
    left = cube_mix.mixed_documents(odd.where("doc_id is null or doc_id > 5"))
    assert left.columns == odd.columns
    copies = {(r.doc_id, r.size): r.copies for r in cube_mix.mix(odd.where("doc_id is null or doc_id > 5")).collect()}
    assert left.where("doc_id = 7").count() == next(c for (d, _), c in copies.items() if d == 7)


def license_expected(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, found = [], set()
    for phrase, label in license_scan.PHRASES.items():
        phrase = phrase.split()
        for k in range(len(own)):
            if own[k : k + len(phrase)] == phrase:
                at.append(k)
                found.add(label)
    return len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(found))


def test_licenses(docs, odd, empty):
    for frame in (docs, odd):
        rows = license_scan.scan(frame).drop("spans").collect()
        texts = [r.text for r in frame.collect()]
        got = sorted((str((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in rows))
        assert got == sorted(str(license_expected(t)) for t in texts)
        assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in rows)
        assert all(0 <= r.score <= 1 for r in rows)
    assert license_scan.scan(empty).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (b"licensed under the gnu general public license, version 3", ["gpl-3"]),
        (b"spdx-license-identifier: mpl-2.0", ["mpl-2"]),
        (b"released under the cc-by-nc-sa 4.0 license", ["cc-by-nc", "cc-by-nc-sa"]),
        (b"the apache license, version 2.0 and the bsd 3-clause license", ["apache-2", "bsd-3-clause"]),
        (b"under the mit license under the mit license", ["mit", "mit"]),
        (b"a permit licensed to smith", []),
        (b"all rights reserved.", ["proprietary"]),
    ],
)
def test_rules(text, labels):
    assert len(license_scan.rules()) > 200
    assert sorted(d.label for d in license_scan.detections(text)) == labels
